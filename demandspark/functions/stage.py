"""Materialised intermediates and totals over groups too large for one task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CHECKPOINT = "spark.checkpoint.dir"
_local: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local master."""
    named = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getConf().get(_CHECKPOINT)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="demandspark-")
    return _local[app]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Folders staged inside are deleted at the end: for steps that leave their result in a table."""
    app = spark.sparkContext.applicationId
    before = set(_staged.setdefault(app, []))
    try:
        yield
    finally:
        for path in [p for p in _staged[app] if p not in before]:
            remove(spark, path)
            _staged[app].remove(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Cuts the lineage, survives the loss of executors, and lets several
    consumers share the work.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other; right keys are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[c for c in right.columns if c not in set(keys)],
    )
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    totals: Mapping[str, Column],
    name: str = "running",
) -> DataFrame:
    """Inclusive running totals of ``totals`` in ascending ``order`` within ``group``.

    ``(group, order)`` must be unique.  A group may be far larger than a task:
    the rows are range-partitioned by (group, order) and staged, each partition
    accumulates on its own, and the few per-partition totals supply the offsets.
    NULL orders come first, as in an ascending window.
    """
    ranged = stage(
        df.select(*group, order, *[e.alias(k) for k, e in totals.items()])
        .repartitionByRange(*group, order)
        .withColumn("__part", F.spark_partition_id()),
        name,
    )
    local = Window.partitionBy(*group, "__part").orderBy(F.col(order).asc_nulls_first())
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, "__part")
        .agg(*[F.sum(k).alias(f"__sum_{k}") for k in totals])
        .select(*group, "__part", *[F.coalesce(F.sum(f"__sum_{k}").over(before), F.lit(0)).alias(f"__off_{k}") for k in totals])
    )
    running = ranged.select(*group, order, "__part", *[F.sum(k).over(local).alias(k) for k in totals])
    return null_safe(running, offsets, [*group, "__part"]).select(
        *group, order, *[(F.col(k) + F.col(f"__off_{k}")).alias(k) for k in totals]
    )


def tie_totals(df: DataFrame, group: Sequence[str], value: str, cum: str, whole: str, spread: Sequence[str], name: str = "ranges") -> DataFrame:
    """``df`` with the running total of ``value`` in its own ascending order within ``group`` (ties
    share one), and the group's total.

    Rows stay in range partitions of (group, value), and equal values are spread over partitions
    by ``spread``, so that neither a group nor a common value has to fit a task.  Each partition
    accumulates on its own.  What lies outside is added from a small table of one row per group
    and partition: the totals of the partitions before, and for the largest value of a partition
    the rows behind its border that have it too.  A NULL value has a NULL running total.
    """
    part, x = "__part", F.col(value)
    ranged = stage(df.repartitionByRange(*group, value, F.xxhash64(*spread)).withColumn(part, F.spark_partition_id()), name)
    here = Window.partitionBy(*group, part)
    local = here.orderBy(x.asc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ranged.groupBy(*group, part).agg(F.min(x).alias("__low"), F.max(x).alias("__high"), F.sum(x).alias("__sum"))
    # rows of a partition's smallest value: what an earlier partition with that largest value lacks
    lowest = null_safe(ranged.select(*group, part, value), ends.select(*group, part, "__low"), [*group, part])
    lowest = lowest.where(x == F.col("__low")).groupBy(*group, part).agg(F.sum(x).alias("__at_low"))
    borders = stage(null_safe(ends, lowest, [*group, part]), f"{name}-borders")
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    later = borders.where("__low is not null").select(*group, F.col(part).alias("__later"), F.col("__low").alias("__high"), "__at_low")
    carried = null_safe(borders.where("__high is not null").select(*group, part, "__high"), later, [*group, "__high"]).where(F.col("__later") > F.col(part))
    carried = carried.groupBy(*group, part).agg(F.sum("__at_low").alias("__carry"))
    outside = null_safe(
        borders.select(*group, part, "__high", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"), F.sum("__sum").over(Window.partitionBy(*group)).alias(whole)), carried, [*group, part]
    )
    rows = null_safe(ranged.withColumn(cum, F.sum(x).over(local)), outside, [*group, part])
    carry = F.when(x == F.col("__high"), F.coalesce("__carry", F.lit(0))).otherwise(F.lit(0))
    total = F.when(x.isNotNull(), F.col(cum) + F.col("__before") + carry)
    return rows.select(*df.columns, total.alias(cum), whole)
