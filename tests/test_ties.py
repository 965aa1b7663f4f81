"""Running totals with ties over range partitions, against a plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandspark.functions import stage as S


def plain(df):
    w = Window.partitionBy("g")
    cum = F.when(F.col("x").isNotNull(), F.sum("x").over(w.orderBy(F.col("x").asc_nulls_first())))
    return df.withColumn("cum", cum).withColumn("whole", F.sum("x").over(w))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ties_across_borders(spark, partitions):
    """A value that most rows share, NULLs, negative values, groups in one partition and over many."""
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rows = [(i % 3 if i % 100 else None, None if i % 17 == 0 else float(7 if i % 4 else i % 11 - 3), i) for i in range(900)]
        df = spark.createDataFrame(rows, "g int, x double, id long")
        got = S.tie_totals(df, ["g"], "x", "cum", "whole", ["id"])
        assert got.columns == ["g", "x", "id", "cum", "whole"]
        assert sorted(map(str, got.collect())) == sorted(map(str, plain(df).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_value_of_all_rows_is_spread(spark, monkeypatch):
    staged = {}
    real = S.stage

    def spying(df, name):
        staged[name] = real(df, name)
        return staged[name]

    monkeypatch.setattr(S, "stage", spying)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # so few rows would be one partition
    try:
        df = spark.range(4000).select(F.lit(1).alias("g"), F.lit(2.0).alias("x"), "id")
        got = S.tie_totals(df, ["g"], "x", "cum", "whole", ["id"])
        assert got.select("cum", "whole").distinct().collect() == [(8000.0, 8000.0)]
        sizes = [r["count"] for r in staged["ranges"].groupBy("__part").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2000
    finally:
        spark.conf.set(coalesce, "true")


def test_no_join_on_the_value(spark):
    """The rows are joined by group and partition only."""
    df = spark.range(100).select(F.lit(1).alias("g"), (F.col("id") % 7).cast("double").alias("x"), "id")
    plan = S.tie_totals(df, ["g"], "x", "cum", "whole", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    top = plan.split("Join")[1].split("\n")[0]
    assert "__part" in top and "x#" not in top.replace("__x#", "")


def test_empty(spark):
    assert S.tie_totals(spark.createDataFrame([], "g int, x double, id long"), ["g"], "x", "cum", "whole", ["id"]).count() == 0
