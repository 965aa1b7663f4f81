"""Subject summaries start from one written table of event states, and count spells that are alike."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.operators import subject as S

CFG = DemandConfig(end=date(2020, 6, 30), train_days=200, windows=(30,), interval_days=90, min_support=0)


@pytest.fixture(scope="module")
def inputs(spark):
    rows = []
    for subject in range(12):
        # subjects 6 to 11 repeat 0 to 5; one event is no visit, one has no supply
        for k, gap in enumerate((0, 7, 7, 20 + subject % 6)):
            day = date(2020, 1, 5) + timedelta(days=gap * k + subject % 3)
            rows.append(("A", "1", day, f"P{subject}", 0 if k == 1 else 7 * k, 0.0 if (k, subject % 6) == (2, 4) else 1.0 + k, 5.0, "D01"))
    rows.append(("A", "1", date(2020, 1, 5), None, 7, 2.0, 5.0, "D01"))
    rx = spark.createDataFrame(
        rows, "yj_code string, store_code string, dispensing_date date, patient_no string, hi_kaisu long, total_dose double, drug_price double, doctor_code string"
    )
    return rx, spark.createDataFrame([("A", "000001")], "yj_code string, store_code string")


def test_summaries_do_not_read_the_facts_again(inputs, tmp_path):
    rx, pairs = inputs
    rx.write.parquet(f"{tmp_path}/facts")
    out = S.patient_agg(rx.sparkSession.read.parquet(f"{tmp_path}/facts"), pairs, CFG)
    files = out.inputFiles()
    assert files and not [f for f in files if str(tmp_path) in f]


def test_summaries_equal_those_of_the_dense_days(inputs):
    rx, pairs = inputs
    dense = S.subject_intervals(rx, pairs, CFG).filter("num_visit > 0")
    cells = [S.aggregate(op, m).alias(f"{op}_{m}_yj_store") for op in CFG.ops for m in S.AGG_MEASURES]
    expected = {r[2]: r for r in dense.groupBy(*CFG.keys).agg(*cells).collect()}
    got = S.patient_agg(rx, pairs, CFG).collect()
    assert {r[2] for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        for c in [f"{op}_{m}_yj_store" for op in CFG.ops for m in S.AGG_MEASURES]:
            a, b = r[c], expected[r[2]][c]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-9)), (r[2], c)


def test_modes_are_the_same_from_written_states(inputs):
    rx, pairs = inputs
    plain = S.interval_mode(rx, pairs, CFG)
    again = S.interval_mode(rx, pairs, CFG, S.event_states(rx, pairs, CFG))
    assert plain.count() and plain.exceptAll(again).isEmpty() and again.exceptAll(plain).isEmpty()


def test_alike_spells_become_days_once(inputs):
    rx, pairs = inputs
    twice = rx.unionByName(rx.withColumn("patient_no", F.concat(F.lit("Q"), "patient_no")).where("patient_no is not null"))
    plan = S.patient_agg(twice, pairs, CFG)._jdf.queryExecution().optimizedPlan().toString()
    dense = plan[plan.index("explode(sequence(valid_from") :]
    assert "__weight" in dense[dense.index("Aggregate") :].split("\n")[0]
