"""Calendar dimension: weekday, day type and the neighbour-day sequence."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the calendar's labels.
WEEKEND = "土日"
WEEKDAY = "平日"
YEAR_END = "年末年始休暇"

DOCUMENTED_WEEKEND = (1, 7)
SHIFTED_WEEKEND = (5, 6)


def year_end_closure(d: Column) -> Column:
    """29 December to 3 January."""
    month, dom = F.month(d), F.dayofmonth(d)
    return ((month == 12) & (dom >= 29)) | ((month == 1) & (dom <= 3))


def calendar_dim(
    spark: SparkSession,
    start: date,
    years: int,
    holidays: DataFrame,
    weekend_dows: tuple[int, ...] = DOCUMENTED_WEEKEND,
) -> DataFrame:
    """One row per day from ``start`` to ``start + 365 * years`` inclusive.

    ``holidays`` has columns ``jst_date`` and ``name``.  A weekend outranks a
    holiday, which outranks a weekday.  ``weekend_dows`` uses Sunday = 1; the
    default is Saturday and Sunday, ``SHIFTED_WEEKEND`` marks Thursday and Friday.
    """
    last = start + timedelta(days=365 * years)
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start - timedelta(days=1)), F.lit(last + timedelta(days=1)), F.expr("interval 1 day"))
        ).alias("jst_date")
    )
    names = holidays.groupBy("jst_date").agg(F.min("name").alias("name"))
    dow = F.dayofweek("jst_date").cast("long")
    typed = (
        days.join(names, "jst_date", "left")
        .withColumn("dayofweek", dow)
        .withColumn(
            "day_type",
            F.when(dow.isin(*weekend_dows), F.lit(WEEKEND))
            .when(F.col("name").isNotNull(), F.col("name"))
            .when(year_end_closure(F.col("jst_date")), F.lit(YEAR_END))
            .otherwise(F.lit(WEEKDAY)),
        )
        .withColumn("is_holiday", F.col("day_type") != WEEKDAY)
    )
    # one row per calendar day, about 365 per year: a single small partition
    by_day = Window.orderBy("jst_date")
    flag = F.col("is_holiday").cast("int").cast("string")
    sequence = F.concat(F.lag(flag).over(by_day), flag, F.lead(flag).over(by_day))
    return (
        typed.withColumn("day_type_sequence", sequence)
        .filter(F.col("jst_date").between(F.lit(start), F.lit(last)))
        .select("jst_date", "is_holiday", "dayofweek", "day_type", "day_type_sequence")
    )
