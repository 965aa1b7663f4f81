"""Maintained Parquet tables: replace, date-range refresh and upsert.

Tables are partitioned by one column (a day, or a month derived from it).  A refresh or an
upsert reads and writes only the touched partitions and becomes visible at once, as a new
snapshot (``snapshots``); what an interrupted job has written is no part of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.stage import stage
from demandspark.operators.quality import assert_unique
from demandspark.sources.snapshots import commit, folders, read_folders

#: Rows of one file that an upsert writes.
ROWS_PER_FILE = 1_000_000
MONTH = "dispensing_month"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of now, or an empty typed frame before the first write."""
    return read_folders(spark, path, folders(spark, path), schema)


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> None:
    """Create or replace: partitioned directories, rows sorted within each file."""
    if partition_by:
        df = df.repartition(*partition_by, *cluster_by[:1])
    if partition_by or cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def refreshed(existing: DataFrame, fresh: DataFrame, day: str, start: date, end: date) -> DataFrame:
    """``existing`` with the days ``[start, end)`` replaced by ``fresh``."""
    inside = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end))
    return existing.filter(~inside).unionByName(fresh.filter(inside))


def refresh_range(
    fresh: DataFrame,
    path: str,
    day: str,
    start: date,
    end: date,
    keys: Sequence[str],
    cluster_by: Sequence[str] = (),
) -> None:
    """Delete the days ``[start, end)`` of the table and insert ``fresh``.

    Monthly partitions; only months overlapping the range are written anew, and
    months left without rows are removed.  All months change at once.
    """
    spark = fresh.sparkSession
    low, high = start.strftime("%Y-%m"), end.strftime("%Y-%m")
    inside = lambda folder: low <= folder.partition("=")[2] <= high
    touched = [f for f in folders(spark, path) if inside(f.partition("/")[2])]
    new = refreshed(read_folders(spark, path, touched, fresh.schema), fresh, day, start, end)
    rows = new.withColumn(MONTH, F.date_format(day, "yyyy-MM")).repartition(MONTH, *cluster_by[:1]).sortWithinPartitions(MONTH, *cluster_by)
    in_range = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end))
    commit(rows, path, MONTH, inside, lambda written: assert_unique(written.filter(in_range), keys))


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """MERGE: matched rows take the ``update`` columns, unmatched source rows are added.

    Key comparison is plain equality, so NULL keys never match.
    """
    cols = target.columns
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.select(*cols).withColumn("__s", F.lit(True)).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    from_source = F.col("t.__t").isNull()

    def value(c: str):
        take = F.col("s.__s").isNotNull() if c in set(update) else from_source
        return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return t.join(s, cond, "full_outer").select(*[value(c) for c in cols])


def merge_table(
    source: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    update: Sequence[str],
    partition_by: str,
) -> None:
    """Upsert ``source`` into the table at ``path``; duplicate source keys are an error.

    ``partition_by`` must be one of the keys, so a matched row never changes
    partition: only partitions present in the source are read and rewritten.
    """
    if partition_by not in keys:
        raise ValueError("partition_by must be a merge key")
    spark = source.sparkSession
    src = stage(source.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), "merge-source")
    assert_unique(src, keys)
    touched = src.select(partition_by).distinct()
    files = 1 + src.count() // max(1, touched.count()) // ROWS_PER_FILE
    target = read_table(spark, path, schema).join(touched, partition_by, "left_semi").select(*schema.names)
    rows = (
        merged(target, src, keys, update)
        # one file in each directory, or as many as its rows need
        .repartition(partition_by, F.pmod(F.xxhash64(*keys), F.lit(files)))
        .sortWithinPartitions(partition_by, *[k for k in keys if k != partition_by])
    )
    commit(rows, path, partition_by, lambda _: False)
