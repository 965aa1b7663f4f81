"""ABC classes from trailing demand shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.scalar import safe_ratio
from demandspark.functions.stage import stage, tie_totals


def trailing_sum(panel: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Sums of target and subject counts over the preceding days, today excluded."""
    before = (
        Window.partitionBy(*cfg.pair)
        .orderBy(F.unix_date(F.col(cfg.day)))
        .rangeBetween(-cfg.abc_days, -1)
    )
    first = F.date_sub(F.lit(cfg.abc_start), cfg.abc_days)
    rows = panel.filter((F.col(cfg.day) >= first) & (F.col(cfg.day) < F.date_sub(F.lit(cfg.dataset_end), cfg.horizon - 1)))
    return rows.select(
        *cfg.keys,
        F.sum("total_dose_by_yj_store").over(before).alias("sum_total_dose"),
        F.sum(F.coalesce("nunique_patient_by_yj_store", F.lit(0))).over(before).alias("count_prescription"),
    )


def _daily_share(df: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Cumulative shares within a day over all pairs.

    A day holds every pair, and very many of them may have one value, so neither is
    gathered: see ``tie_totals``.
    """
    out = df
    for metric, share in (("sum_total_dose", "total_dose_rank_by_yj"), ("count_prescription", "count_rank_by_yj")):
        value = F.col(metric).cast("double")
        out = tie_totals(out.withColumn("__x", value), [cfg.day], "__x", "__cum", "__whole", cfg.pair, "abc")
        # a NULL value has a NULL running total: its share is NULL unless the day's total is 0
        part = F.when(F.coalesce(F.col("__whole") != 0, F.lit(False)), F.col("__cum") / F.col("__whole")).otherwise(F.lit(0.0))
        out = out.withColumn(share, part).drop("__x", "__cum", "__whole")
    return out


def cum_share(df: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Ascending cumulative shares within the day and within (location, day).

    A (location, day) holds at most one row per item, so a plain window suffices
    there.  Ties share one value.
    """
    whole = Window.partitionBy(cfg.location, cfg.day)

    def share(c: str) -> Column:
        return safe_ratio(F.sum(c).over(whole.orderBy(F.col(c).asc_nulls_first())), F.sum(c).over(whole))

    local = df.withColumns(
        {
            "total_dose_rank_by_yj_store": share("sum_total_dose"),
            "count_rank_by_yj_store": share("count_prescription"),
        }
    )
    return _daily_share(local, cfg).select(
        *cfg.keys,
        "sum_total_dose",
        "count_prescription",
        "total_dose_rank_by_yj",
        "total_dose_rank_by_yj_store",
        "count_rank_by_yj",
        "count_rank_by_yj_store",
    )


def abc_flag(share: Column) -> Column:
    return F.when(share >= 0.3, "a").when((share < 0.3) & (share >= 0.1), "b").otherwise("c")


def abc_class(panel: DataFrame, cfg: DemandConfig, share_col: str = "count") -> DataFrame:
    """Class per pair and prediction day of the test range.

    ``share_col`` chooses the share behind both flags: "count" or "total_dose".
    """
    delay = cfg.horizon - 1
    used = F.date_add(cfg.day, delay)
    rows = trailing_sum(panel, cfg).filter((used >= F.lit(cfg.abc_start)) & (used < F.lit(cfg.dataset_end)))
    return (
        cum_share(stage(rows, "abc-sums"), cfg)
        .withColumn(cfg.day, F.date_add(cfg.day, delay))
        .withColumns(
            {
                "model_abc_flag": abc_flag(F.col(f"{share_col}_rank_by_yj")),
                "data_abc_flag": abc_flag(F.col(f"{share_col}_rank_by_yj_store")),
            }
        )
    )
