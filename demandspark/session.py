"""Session settings the plans are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Static-safe SQL settings: AQE re-plans skewed joins and small partitions;
# generated methods too large for the JIT fall back to split projections.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # window stages are CPU-bound: let small shuffles keep all cores busy
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # wide feature projections run faster as split projections than inside one
    # whole-stage method, which would be too large for the JIT
    "spark.sql.codegen.maxFields": "40",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # rows with hundreds of features: Arrow's buffers are outside the heap, in each task and its worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def tuned(spark: SparkSession) -> SparkSession:
    """A new session with the caller's settings and those above; the caller's is not touched."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return tune(own)


def session(name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; local masters get laptop-sized defaults."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
            b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
