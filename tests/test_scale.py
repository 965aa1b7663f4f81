"""Work that must not grow with copies of the facts or of long texts."""

from pyspark.sql import functions as F

from demandspark.operators import dataset as D
from demandspark.operators import model as M
from demandspark.plans import queries as Q


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_long_texts_are_no_literals_of_the_plan(spark):
    texts = [("D07 " * 5000) + str(i) for i in range(4)]
    rows = [(f, t) for f in ("train", "valid") for t in [*texts, "short", "x" * 64, None]] + [("test", "D07 " * 5000)]
    df = spark.createDataFrame(rows, "split_flag string, doctors string")
    encoder = M.fit_encoder(df, ["doctors"])
    coded = M.apply_encoder(df, encoder, ["doctors"])
    known = {r.text: r.code for r in encoder.collect()}
    assert [known[t] for t in sorted(known)] == list(range(7))
    assert {r.doctors: r.doctors_code for r in coded.collect()} == {t: known.get(t, known["other"]) for _, t in rows}
    only = spark.createDataFrame([], df.schema)
    assert len(_plan(M.apply_encoder(only, encoder, ["doctors"]))) < 10_000


def test_a_flow_joins_the_sources_once(spark, smoke):
    c = Q.context(spark, smoke)
    for df in (c.pairs, c.calendar, c.panel, c.doctors):
        files = "".join(df.inputFiles())
        assert "lineitem" not in files and "orders" not in files
    assert Q.context(spark, smoke, Q.CHECK.with_(sample_rate=7)).data is c.data
    assert c.data.facts.exceptAll(c.data.rx).isEmpty() and c.data.rx.exceptAll(c.data.facts).isEmpty()


def test_prescriber_texts_are_joined_last(spark, smoke):
    c = Q.context(spark, smoke)
    plan = _plan(D.train_dataset(c.panel, c.calendar, c.doctors, c.cfg).where(F.col("doctors") != ""))
    assert plan.count("Join ") > 2 and "strategy=merge" in plan
    assert plan.index("strategy=merge") < min(plan.index(x, plan.index("Join ") + 1) for x in ("Join ",))
