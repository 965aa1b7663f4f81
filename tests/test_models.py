"""The model queries' own tables: what the fit reads and what its queries return."""

import pyarrow as pa
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.stage import stage
from demandspark.operators import dataset as D
from demandspark.operators import model as M
from demandspark.operators import publish as B
from demandspark.plans.queries import END, categories_of, context, operator

SHORT = DemandConfig(end=END, train_days=60, windows=(60, 30), lags=(1, 7, 28), max_last_days=60)


def test_train_gbt_scores_every_test_row_under_its_keys(spark, smoke):
    c = context(spark, smoke, SHORT)
    scored = operator("train_gbt", spark, smoke, SHORT)
    assert scored.columns == [*SHORT.keys, "total_dose_monthly", B.PRED]
    known = [*SHORT.keys, "total_dose_monthly"]
    want = D.with_label(c.panel, SHORT).where("split_flag = 'test'").select(*known)
    got = scored.where(F.col(B.PRED).isNotNull()).select(*known)
    assert not want.isEmpty() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_the_fit_takes_keys_in_the_order_of_the_prescriber_texts(spark, smoke):
    c = context(spark, smoke, SHORT)
    both = c.doctors.join(c.doctor_keys.withColumnRenamed("doctors", "key"), SHORT.pair).collect()
    assert len(both) == c.doctors.count() == c.doctor_keys.count()
    known = [r for r in both if r.doctors is not None]
    assert [r.key for r in sorted(known, key=lambda r: r.doctors)] == sorted(r.key for r in known)
    assert len({r.doctors for r in known}) == len({r.key for r in known}) == len({(r.doctors, r.key) for r in known})
    _, coded, encoder = c.fit
    texts = {r.text for r in encoder.where("feature = 'doctors'").collect()}
    assert texts <= {r.key for r in known} | {"other"} and len(texts) > 1
    assert "doctors" not in coded.columns and "doctors_code" in coded.columns


def test_the_fit_reads_the_codes_that_the_texts_would_give(spark, smoke):
    c = context(spark, smoke, SHORT)
    rows = stage(D.train_dataset(c.panel, c.calendar, c.doctors, SHORT, "log"), "train")
    coded, _ = c.fit[1:]
    by_text = M.apply_encoder(rows, M.fit_encoder(rows, categories_of(rows)), categories_of(rows))
    want, got = (sorted(r.h for r in x.select(F.xxhash64(*[F.col(f"`{k}`") for k in coded.columns]).alias("h")).collect()) for x in (by_text, coded))
    assert want == got and len(got) > 1000


def test_rows_go_to_python_in_small_batches(spark):
    """Some 380 features a row: Arrow's buffers lie outside the heap."""
    sizes = spark.range(7000).coalesce(1).mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in it), "n long")
    assert [r.n for r in sizes.collect()] == [2000, 2000, 2000, 1000]
