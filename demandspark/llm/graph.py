"""Connected components of an edge table, by alternating stars, in Spark throughout."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions.stage import fresh_path, remove
from demandspark.llm.common import lean


#: Edges that a task connects at once before they are handed on.
HELD = 200_000


def connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: its edges (u, v) as stars of the smallest node each, which connect the same nodes."""
    up: dict = {}

    def root(x):
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def stars():
        found = [(x, r) for x in up if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], kind) for k in (0, 1)], names=["u", "v"])

    kind, held = None, 0
    for batch in batches:
        kind = batch.schema.field("u").type
        for lo in range(0, batch.num_rows, HELD):
            part = batch.slice(lo, HELD)
            for u, v in zip(part.column("u").to_pylist(), part.column("v").to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
            held += part.num_rows
            if held >= HELD:
                yield stars()
                up.clear()
                held = 0
    if held:
        yield stars()


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "stars") -> DataFrame:
    """(node, root) for every node of an edge but the roots; the root is the smallest node.

    Every round links each node's larger neighbours to the smallest one, then its smaller
    neighbours; both are a grouped minimum joined back, so that no node's neighbours have
    to meet in one task.  Each round is a written table.  Tasks connect their own edges beforehand,
    which leaves few rounds.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = fresh_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    ordered = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")
    start = ordered.mapInArrow(lean(connected), ordered.schema).distinct()
    (stars, path), before = written(start), None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last = path
        stars, path = written(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        remove(spark, last)
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
