"""Table invariants, each checked by one distributed job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """A table violates a declared invariant."""


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter((F.col("rows") > 1) | any_null)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise unless ``keys`` are unique and non-NULL; returns ``df`` unchanged."""
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        raise QualityError(f"keys {list(keys)} are not unique or NULL, e.g. {[tuple(r) for r in bad]}")
    return df


def gap_violations(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Series whose row count differs from their span of days (gaps or duplicates)."""
    span = F.datediff(F.max(day), F.min(day)) + 1
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"), span.alias("days"))
        .filter(F.col("rows") != F.col("days"))
    )


def assert_dense(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Raise unless every series is gap-free (given unique keys)."""
    bad = gap_violations(df, keys, day).limit(5).collect()
    if bad:
        raise QualityError(f"series have gaps, e.g. {[tuple(r) for r in bad]}")
    return df


def assert_filled(df: DataFrame, schema) -> DataFrame:
    """Raise if a column that ``schema`` declares as never NULL holds one."""
    must = [f.name for f in schema.fields if not f.nullable]
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in must]).first()
    bad = {c: row[c] for c in must if row[c]}
    if bad:
        raise ValueError(f"NULL in {bad}")
    return df
