"""Snapshots of partitioned Parquet tables: every change is one switch of a manifest.

``path/data/commit=<id>/<column>=<value>/`` holds the partitions that a change wrote;
``path/_manifest/<n>`` lists the folders that make up version n.  A change writes a new folder,
checks it, and then moves the next manifest into place, so that a reader sees the table before
the change or after it, whatever happens to the job.  A second writer that was faster makes the
move fail.  Versions before the last two are removed after a change.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Versions that stay readable for queries that have begun.
KEEP = 2


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests that are there, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{path}/_manifest") if re.fullmatch(r"\d+", n))


def folders(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """``commit=<id>/<column>=<value>`` of the newest or the given version; none before the first."""
    known = versions(spark, path)
    if not known:
        return []
    fs, where = _fs(spark, f"{path}/_manifest/{known[-1] if version is None else version}")
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_folders(spark: SparkSession, path: str, names: list[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
    rows = spark.read.schema(whole).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{n}" for n in names])
    return rows.select(*schema.names)


def _switch(spark: SparkSession, path: str, names: list[str], after: int) -> None:
    """Make ``names`` version ``after + 1``; fails if another writer has made it."""
    fs, draft = _fs(spark, f"{path}/_manifest/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.writeBytes(json.dumps(sorted(names)))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(fs.makeQualified(draft), fs.makeQualified(_fs(spark, f"{path}/_manifest/{after + 1}")[1]), never)


def commit(df: DataFrame, path: str, partition_by: str, replaced: Callable[[str], bool], check: Callable[[DataFrame], object] | None = None) -> int:
    """Write ``df`` as the new content of its partitions; returns the version.

    ``replaced`` says of a partition's folder (``column=value``) whether it goes in any case.
    ``check`` gets the written rows and raises if they must not become part of the table.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    before = folders(spark, path)
    own = f"commit={uuid.uuid4().hex}"
    df.write.partitionBy(partition_by).parquet(f"{path}/data/{own}")
    written = [f"{own}/{n}" for n in _names(spark, f"{path}/data/{own}") if n.startswith(f"{partition_by}=")]
    try:
        if check is not None:
            check(read_folders(spark, path, written, df.schema))
        new = {n.partition("/")[2] for n in written}
        kept = [n for n in before if n.partition("/")[2] not in new and not replaced(n.partition("/")[2])]
        _switch(spark, path, [*kept, *written], known[-1] if known else 0)
    except BaseException:
        fs, where = _fs(spark, f"{path}/data/{own}")
        fs.delete(where, True)
        raise
    vacuum(spark, path)
    return (known[-1] if known else 0) + 1


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove manifests before the last ``keep``, and what none of the others lists."""
    known = versions(spark, path)
    used = {n for v in known[-keep:] for n in folders(spark, path, v)}
    for v in known[:-keep]:
        gone = [n for n in folders(spark, path, v) if n not in used]
        for n in gone:
            fs, where = _fs(spark, f"{path}/data/{n}")
            fs.delete(where, True)
        fs, where = _fs(spark, f"{path}/_manifest/{v}")
        fs.delete(where, False)
