"""File scans and sinks: snapshots, bounded fact scans, CSV and sampled reads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.config import DemandConfig
from demandspark.functions.scalar import pad_code


def snapshot_copy(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a Parquet table in full, replacing the target."""
    spark.read.parquet(source).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def scan_between(df: DataFrame, day: str, start: date, end: date) -> DataFrame:
    """Rows with ``start <= day <= end``."""
    return df.filter(F.col(day).between(F.lit(start), F.lit(end)))


def scan_half_open(df: DataFrame, day: str, start: date, end: date) -> DataFrame:
    """Rows with ``start <= day < end``."""
    return df.filter((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end)))


def fact_scan(rx: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Dispensing facts of the run's span with padded location codes."""
    return scan_between(rx, cfg.day, cfg.panel_start, cfg.end).withColumn(cfg.location, pad_code(cfg.location))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write the chosen columns with a header row."""
    (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV with a header; columns are matched by name, then cast."""
    text = spark.read.option("header", True).csv(path)
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def debug_sample(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Rows whose ``key`` is among its first ``n`` distinct values in sort order."""
    first = df.select(key).distinct().orderBy(F.col(key).asc_nulls_first()).limit(n)
    return df.join(first, key, "left_semi")
