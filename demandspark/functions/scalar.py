"""Scalar column expressions with the NULL and calendar semantics the operators rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_code(c: str | Column, width: int = 6) -> Column:
    """Zero-pad a location code to ``width`` characters."""
    return F.lpad(_col(c), width, "0")


def strict_greatest(c: str | Column, bound) -> Column:
    """``greatest(c, bound)`` that stays NULL when ``c`` is NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(bound)))


def strict_least(c: str | Column, bound) -> Column:
    """``least(c, bound)`` that stays NULL when ``c`` is NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(bound)))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, or 0 where the denominator is 0 or NULL."""
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def sunday_week(d: str | Column) -> Column:
    """Week of the year 0-53 where weeks start on Sunday (not the ISO week)."""
    d = _col(d)
    return F.floor((F.dayofyear(d) - F.dayofweek(d) + 7) / 7).cast("long")


def calendar_parts(d: str | Column) -> dict[str, Column]:
    """Day-of-week (Sunday = 1), day-of-year, day-of-month and Sunday week as longs."""
    d = _col(d)
    return {
        "dayofweek": F.dayofweek(d).cast("long"),
        "dayofyear": F.dayofyear(d).cast("long"),
        "day": F.dayofmonth(d).cast("long"),
        "week": sunday_week(d),
    }


def cyclic(c: str, period: int) -> dict[str, Column]:
    """Sine and cosine of a 1-based cyclic calendar column."""
    angle = 2.0 * F.pi() * (F.col(c) - 1) / period
    return {f"{c}_sin": F.sin(angle), f"{c}_cos": F.cos(angle)}


def cyclic_encodings() -> dict[str, Column]:
    """The six cyclic columns of the datasets."""
    return {**cyclic("dayofyear", 366), **cyclic("day", 31), **cyclic("dayofweek", 7)}


def code_levels(item: str) -> dict[str, Column]:
    """Hierarchy levels encoded in a 12-character item code."""
    return {
        "yakko_keiro_zaikei": F.substring(item, 1, 9),
        "yakko_bunrui": F.substring(item, 1, 4),
        "touyo_keiro": F.substring(item, 5, 3),
        "zaikei": F.substring(item, 8, 1),
    }
