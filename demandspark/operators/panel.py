"""Dense item x location x day panels with forward-horizon targets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.scalar import calendar_parts, pad_code
from demandspark.functions.stage import stage
from demandspark.sources.files import fact_scan
from demandspark.sources.schemas import MASTER_COLUMNS


def drug_master(drug: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Item attributes: application start as a date, lower-case unit name."""
    return (
        drug.withColumn("application_start_date", F.to_date("application_start_date"))
        .withColumn("tanni_name", F.lower("tanni_name"))
        .select(cfg.item, *MASTER_COLUMNS)
    )


def assortment(srq: DataFrame, drug: DataFrame, units: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Distinct (item, location) pairs that are stocked."""
    return (
        srq.join(drug.select("yj_id", cfg.item), "yj_id", "left")
        .join(
            units.select(F.col("soshiki_unit_id").alias("soshiki_unit_id_store"), "soshiki_unit_code"),
            "soshiki_unit_id_store",
            "left",
        )
        .select(cfg.item, pad_code("soshiki_unit_code").alias(cfg.location))
        .distinct()
    )


def each_day(df: DataFrame, day: str, start: date, end: date) -> DataFrame:
    """One row per input row and day of ``[start, end]``; narrow, no shuffle."""
    return df.withColumn(day, F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))))


def dense_panel(pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Every pair on every day of the span with its calendar parts."""
    return each_day(pairs, cfg.day, cfg.panel_start, cfg.end).withColumns(calendar_parts(cfg.day))


def daily_by_subject(rx: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Facts of the span summed per (item, location, day, subject).

    Every later aggregate starts here, so one busy key is combined map-side
    before any other shuffle sees it.
    """
    return (
        fact_scan(rx, cfg)
        .groupBy(*cfg.keys, cfg.subject)
        .agg(F.sum("total_dose").alias("total_dose"), F.sum("drug_price").alias("total_price"))
    )


def nunique_by_store(rx: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Exact distinct subjects per (item, location, day)."""
    return fact_scan(rx, cfg).groupBy(*cfg.keys).agg(F.count_distinct(cfg.subject).alias("nunique_patient_by_yj_store"))


def nunique_by_item(rx: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Exact distinct subjects per (item, day) over all locations."""
    return (
        fact_scan(rx, cfg).groupBy(cfg.item, cfg.day).agg(F.count_distinct(cfg.subject).alias("nunique_patient_by_yj"))
    )


def _forward_sums(df: DataFrame, keys: list[str], cfg: DemandConfig, names: dict[str, str]) -> DataFrame:
    ahead = Window.partitionBy(*keys).orderBy(cfg.day).rowsBetween(0, cfg.horizon - 1)
    complete = F.col(cfg.day) < F.lit(cfg.panel_end)
    return df.withColumns({out: F.sum(src).over(ahead) for out, src in names.items()}).filter(complete)


def _densify(days: DataFrame, facts: DataFrame, keys: list[str], cfg: DemandConfig, count: str) -> DataFrame:
    """Zero-filled daily series of the template ``days``.

    Template and facts are united and partitioned by the series key once; the
    per-day aggregation and the following windows reuse that partitioning.
    """
    columns = [*keys, cfg.day]
    template = days.select(
        *columns,
        F.lit(0.0).alias("dose"),
        F.lit(0.0).alias("price"),
        F.lit(None).cast("long").alias(count),
        F.lit(1).alias("stocked"),
    )
    rows = facts.select(
        *columns,
        F.coalesce(F.col("total_dose").cast("double"), F.lit(0.0)).alias("dose"),
        F.coalesce(F.col("total_price").cast("double"), F.lit(0.0)).alias("price"),
        F.col(count).cast("long").alias(count),
        F.lit(0).alias("stocked"),
    )
    return (
        template.unionByName(rows)
        .repartition(*keys)
        .groupBy(*columns)
        .agg(
            F.sum("dose").alias("dose"),
            F.sum("price").alias("price"),
            F.max(count).alias(count),
            F.max("stocked").alias("stocked"),
        )
        .filter("stocked = 1")
        .drop("stocked")
    )


def daily_by_pair(rx: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Sums and distinct subjects per (item, location, day), written: pairs and items both start from it."""
    daily = daily_by_subject(rx, cfg).groupBy(*cfg.keys).agg(
        F.sum("total_dose").alias("total_dose"),
        F.sum("total_price").alias("total_price"),
        F.count(cfg.subject).alias("nunique_patient_by_yj_store"),
    )
    return stage(daily, "daily")


def pair_targets(daily: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Forward sums and the day's distinct subjects per (item, location, day)."""
    grid = _densify(
        each_day(pairs, cfg.day, cfg.panel_start, cfg.end), daily, cfg.pair, cfg, "nunique_patient_by_yj_store"
    )
    return _forward_sums(
        grid, cfg.pair, cfg, {"total_dose_by_yj_store": "dose", "total_price_by_yj_store": "price"}
    ).drop("dose", "price")


def item_targets(rx: DataFrame, daily: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Forward sums over stocked locations and distinct subjects over all locations, per (item, day)."""
    amounts = (
        daily.join(pairs, cfg.pair, "left_semi")
        .groupBy(cfg.item, cfg.day)
        .agg(F.sum("total_dose").alias("total_dose"), F.sum("total_price").alias("total_price"))
        .withColumn("nunique_patient_by_yj", F.lit(None).cast("long"))
    )
    subjects = nunique_by_item(rx, cfg).select(
        cfg.item,
        cfg.day,
        F.lit(0.0).alias("total_dose"),
        F.lit(0.0).alias("total_price"),
        "nunique_patient_by_yj",
    )
    items = pairs.select(cfg.item).distinct()
    grid = _densify(
        each_day(items, cfg.day, cfg.panel_start, cfg.end),
        amounts.unionByName(subjects),
        [cfg.item],
        cfg,
        "nunique_patient_by_yj",
    )
    return _forward_sums(
        grid, [cfg.item], cfg, {"total_dose_by_yj": "dose", "total_price_by_yj": "price"}
    ).drop("dose", "price")


def horizon_target(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Keys and the four forward-horizon sums."""
    daily = daily_by_pair(rx, cfg)
    item = item_targets(rx, daily, pairs, cfg).drop("nunique_patient_by_yj")
    return (
        pair_targets(daily, pairs, cfg)
        .drop("nunique_patient_by_yj_store")
        .join(item, [cfg.item, cfg.day], "left")
        .select(
            *cfg.keys,
            "total_dose_by_yj_store",
            "total_dose_by_yj",
            "total_price_by_yj_store",
            "total_price_by_yj",
        )
    )


def horizon_panel(rx: DataFrame, pairs: DataFrame, drug: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The dense panel: calendar parts, item attributes, targets and subject counts."""
    master = drug_master(drug, cfg).distinct()
    daily = daily_by_pair(rx, cfg)
    return (
        pair_targets(daily, pairs, cfg)
        .join(item_targets(rx, daily, pairs, cfg), [cfg.item, cfg.day], "left")
        .join(master, cfg.item, "left")
        .withColumns(calendar_parts(cfg.day))
        .withColumn("days_from_application", F.datediff("application_start_date", cfg.day).cast("long"))
        .select(
            *cfg.keys,
            "dayofweek",
            "dayofyear",
            "day",
            "week",
            *MASTER_COLUMNS,
            "days_from_application",
            "nunique_patient_by_yj_store",
            "nunique_patient_by_yj",
            "total_dose_by_yj_store",
            "total_dose_by_yj",
            "total_price_by_yj_store",
            "total_price_by_yj",
        )
    )


def diff_panel(panel: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The panel plus the quantity targets ``horizon - 1`` rows back and the change since."""
    series = Window.partitionBy(*cfg.pair).orderBy(cfg.day)
    measures = ("total_dose_by_yj_store", "total_dose_by_yj")
    lagged = panel.withColumns({f"lag_{m}": F.lag(m, cfg.horizon - 1).over(series) for m in measures})
    return lagged.withColumns({f"diff_{m}": F.col(m) - F.col(f"lag_{m}") for m in measures})


def minmax_scaler(panel: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Per-pair minima and maxima of both quantity targets over the training days."""
    days = F.col(cfg.day)
    return (
        panel.filter((days >= F.lit(cfg.train_start)) & (days < F.lit(cfg.train_end)))
        .groupBy(*cfg.pair)
        .agg(
            *[
                fn(m).alias(f"{p}_{m}")
                for m in ("total_dose_by_yj_store", "total_dose_by_yj")
                for p, fn in (("min", F.min), ("max", F.max))
            ]
        )
    )


def scaled_panel(panel: DataFrame, scaler: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The panel plus min-max scaled quantity targets; a constant series scales to 0."""

    def scaled(m: str):
        span = F.col(f"max_{m}") - F.col(f"min_{m}")
        return F.when(span == 0, F.lit(0.0)).when(span != 0, (F.col(m) - F.col(f"min_{m}")) / span)

    measures = ("total_dose_by_yj_store", "total_dose_by_yj")
    return (
        panel.join(scaler, cfg.pair, "left")
        .withColumns({f"scaled_{m}": scaled(m) for m in measures})
        .select(*panel.columns, *[f"scaled_{m}" for m in measures])
    )


def code_hierarchy(panel: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The panel plus the hierarchy levels of its item code."""
    from demandspark.functions.scalar import code_levels

    return panel.withColumns(code_levels(cfg.item))
