"""Train and predict datasets.

``train_dataset`` shuffles the narrow panel once, by (item, location): all pair
windows and the sampling run on that partitioning.  Item- and name-level columns
are computed on their own small series and joined last, to the sampled rows only.

``predict_dataset`` needs one base day only, so every window collapses to a
conditional aggregate: three grouped aggregations with map-side combine.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.moments import quoted
from demandspark.functions.scalar import cyclic_encodings
from demandspark.functions.stage import null_safe
from demandspark.operators import features as X
from demandspark.operators.subject import aggregate
from demandspark.sources.schemas import ITEM_MEASURES, MEASURES, PAIR_MEASURES

# Horizon values are unknown when predicting: dropped from every dataset.
UNAVAILABLE = (
    "total_price_by_yj_store",
    "nunique_patient_by_yj_store",
    "total_dose_by_yj",
    "total_dose_by_yj_store",
    "total_price_by_yj",
    "nunique_patient_by_yj",
)
SCALED_TARGETS = ("scaled_total_dose_by_yj", "scaled_total_dose_by_yj_store")


@dataclass(frozen=True)
class Label:
    """How a dataset derives its label and which panel variant feeds it."""

    column: str
    variant: str
    source: str
    nonzero: str  # "positive" or "nonzero": rows kept without sampling
    all_splits: bool = False  # sample every split and keep rows between splits


LABELS = {
    "log": Label("total_dose_monthly", X.BASE, "log1p(total_dose_by_yj_store)", "positive"),
    "raw": Label("total_dose_monthly", X.BASE, "total_dose_by_yj_store", "positive"),
    "diff": Label("diff_total_dose_monthly", X.DIFF, "diff_total_dose_by_yj_store", "nonzero"),
    "scaled": Label("total_dose_monthly", X.SCALED, "scaled_total_dose_by_yj_store", "positive", True),
}


def drop_unavailable(df: DataFrame, columns=UNAVAILABLE) -> DataFrame:
    return df.drop(*columns)


def split_flag(cfg: DemandConfig) -> Column:
    """train / valid / test by day; NULL in the horizon-long gaps between them."""
    d = F.col(cfg.day)

    def within(a, b):
        return (d >= F.lit(a)) & (d < F.lit(b))

    return (
        F.when(within(cfg.train_start, cfg.train_end), "train")
        .when(within(cfg.valid_start, cfg.valid_end), "valid")
        .when(d >= F.lit(cfg.test_start), "test")
    )


def dataset_days(df: DataFrame, cfg: DemandConfig) -> DataFrame:
    return df.filter((F.col(cfg.day) >= F.lit(cfg.train_start)) & (F.col(cfg.day) <= F.lit(cfg.dataset_end)))


def with_label(panel: DataFrame, cfg: DemandConfig, label: str = "log") -> DataFrame:
    """Dataset days with cyclic encodings, the label and the split flag."""
    spec = LABELS[label]
    return dataset_days(panel, cfg).withColumns(
        {**cyclic_encodings(), spec.column: F.expr(spec.source), "split_flag": split_flag(cfg)}
    )


def train_sample(df: DataFrame, cfg: DemandConfig, label: str = "log") -> DataFrame:
    """Keep every k-th zero-label row of a pair in day order, all other labelled
    rows and the whole test split, in a single pass.

    Rows between the splits have a NULL flag: they drop out unless the label
    samples all splits.
    """
    spec = LABELS[label]
    y, flag = F.col(spec.column), F.col("split_flag")
    sampled = F.lit(True) if spec.all_splits else flag != "test"
    zero = F.coalesce((y == 0) & sampled, F.lit(False))
    kept = (y > 0 if spec.nonzero == "positive" else y != 0) & sampled
    rank = F.sum(zero.cast("int")).over(Window.partitionBy(*cfg.pair).orderBy(cfg.day))
    keep = (zero & (F.col("__rank") % cfg.sample_rate == 0)) | F.coalesce(kept, F.lit(False))
    if not spec.all_splits:
        keep = keep | F.coalesce(flag == "test", F.lit(False))
    return df.withColumn("__rank", rank).filter(keep).drop("__rank")


def feature_columns(cfg: DemandConfig) -> list[str]:
    return [*X.target_columns(cfg), *X.segment_columns(cfg, "dow"), *X.segment_columns(cfg, "dts")]


def _item_columns(cfg: DemandConfig) -> list[str]:
    return [*X.item_target_columns(cfg), *X.segment_names(cfg, "dow", 1), *X.segment_names(cfg, "dts", 1)]


def _item_frame(panel: DataFrame, calendar: DataFrame, cfg: DemandConfig, variant: str) -> DataFrame:
    """All item-level train features per (item, day) on one partitioning by item."""
    shift = cfg.horizon
    series = X.with_calendar(X.item_series(panel, cfg, variant), calendar, cfg, ["day_type_sequence"])
    series = series.withColumn("dayofweek", F.dayofweek(cfg.day).cast("long"))
    # cuts to the feature history between its two windows
    series = X._last_nonzero(
        series, [cfg.item], cfg, shift, "total_dose_by_yj", F.col("active"), X.LAST_NONZERO[1]
    )
    for kind in ("dow", "dts"):
        series = X.add_segment_item(series, cfg, kind, shift)
    series = X.feature_days(X.add_item_targets(series, cfg, "train"), cfg)
    return X.packed(series, [cfg.item, cfg.day], _item_columns(cfg), "__item")


def _name_columns(cfg: DemandConfig) -> list[str]:
    return [*X.segment_names(cfg, "dow", 2), *X.segment_names(cfg, "dts", 2)]


def _name_frame(panel: DataFrame, calendar: DataFrame, cfg: DemandConfig, variant: str) -> DataFrame:
    """All name-level train features per (generic name, location, day)."""
    series = X.with_calendar(
        X.name_series(X.history(panel, cfg), cfg, variant), calendar, cfg, ["day_type_sequence"]
    )
    for kind in ("dts", "dow"):
        series = X.add_name_stats(series, cfg, kind, cfg.horizon)
    series = X.feature_days(series, cfg)
    return X.packed(series, ["general_name", cfg.location, cfg.day], _name_columns(cfg), "__name")


def _pair_rows(panel: DataFrame, calendar: DataFrame, cfg: DemandConfig, label: str) -> DataFrame:
    """Panel rows of the dataset days with label, split, recency and the pair's features, sampled."""
    spec, shift = LABELS[label], cfg.horizon
    carried = [c for c in panel.columns if c not in set(cfg.keys)]
    # the panel's own columns ride along packed, so the windows move one value
    rows = panel.select(
        *cfg.keys,
        "dayofweek",
        F.struct(*carried).alias("__panel"),
        *[F.col(X.source_column(m, spec.variant)).alias(m) for m in PAIR_MEASURES],
        F.col("total_dose_by_yj_store").alias("__dose"),
    )
    rows = X.with_calendar(rows, calendar, cfg, ["day_type_sequence", "is_holiday", "day_type"])
    # also serves the windows by weekday and by day type within a pair
    rows = rows.repartition(*cfg.pair)

    in_recency = (F.col("__dose") >= 0) & (F.col(cfg.day) >= F.lit(cfg.recency_start))
    visited = F.when((F.col("__dose") > 0) & in_recency, F.col(cfg.day))
    last_day = F.last(visited, ignorenulls=True).over(X.until_row(cfg.pair, cfg.day, shift))
    for kind in ("dow", "dts"):
        rows = X.add_segment_pair(rows, cfg, kind, shift)
    rows = rows.withColumn(X.RECENCY, F.when(in_recency, X.recency_expr(cfg, last_day)))
    rows = dataset_days(X.add_pair_targets(rows, cfg, "train", trim=False), cfg)
    inside = f"{quoted(cfg.day)} >= date'{cfg.feature_start}'"
    other = {*_item_columns(cfg), *_name_columns(cfg)}
    rows = rows.selectExpr(
        *cfg.keys,
        *[f"__panel.{quoted(c)} as {quoted(c)}" for c in carried],
        *[f"if({inside}, {quoted(c)}, null) as {quoted(c)}" for c in feature_columns(cfg) if c not in other],
        X.RECENCY,
        "is_holiday",
        "day_type",
        "day_type_sequence",
    )
    return train_sample(with_label(rows, cfg, label), cfg, label)


def _if_small(series: DataFrame, panel: DataFrame, cfg: DemandConfig, keys: list[str], columns: int) -> DataFrame:
    """``series``, broadcast if its counted rows stay below Spark's limit: the estimate for so many windows is far
    above their size, and rows that meet it by broadcast stay partitioned by pair."""
    spark = panel.sparkSession
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    # a value and its null bit, keys and the row's own bytes
    rows = max(0, limit) // (9 * columns + 128)
    days = X.feature_days(panel, cfg).select(*keys).distinct()
    return F.broadcast(series) if rows and days.count() <= rows else series


def train_dataset(
    panel: DataFrame,
    calendar: DataFrame,
    doctors: DataFrame,
    cfg: DemandConfig,
    label: str = "log",
    subject: DataFrame | None = None,
) -> DataFrame:
    """Sampled training rows with label, split flag and all features.

    ``panel`` must carry the label's variant columns (``diff_*`` / ``scaled_*``);
    ``subject`` optionally adds the aggregated subject features.
    """
    spec = LABELS[label]
    rows = _pair_rows(panel, calendar, cfg, label)
    by_item, by_name = [cfg.item, cfg.day], ["general_name", cfg.location, cfg.day]
    items = _if_small(_item_frame(panel, calendar, cfg, spec.variant), panel, cfg, by_item, len(_item_columns(cfg)))
    names = _if_small(_name_frame(panel, calendar, cfg, spec.variant), panel, cfg, by_name, len(_name_columns(cfg)))
    rows = null_safe(rows.join(items, by_item, "left"), names, by_name)
    gone = {*UNAVAILABLE, *(SCALED_TARGETS if spec.variant == X.SCALED else ())}
    own = [c for c in rows.columns if c not in {"__item", "__name", *gone}]
    rows = rows.selectExpr(
        *[quoted(c) for c in own],
        *[f"__item.{quoted(c)} as {quoted(c)}" for c in _item_columns(cfg)],
        *[f"__name.{quoted(c)} as {quoted(c)}" for c in _name_columns(cfg)],
    )
    if subject is not None:
        rows = rows.join(subject, cfg.keys, "left")
        own = [*cfg.keys, *[c for c in own if c not in set(cfg.keys)]]
    # last: no other join moves the prescriber texts, which grow with the facts
    columns = [*own, *[c for c in doctors.columns if c not in set(cfg.pair)]]
    columns += [c for c in rows.columns if c not in set(columns)]
    return X.with_doctors(rows, doctors, cfg).select(*[quoted(c) for c in columns])


# -- prediction ----------------------------------------------------------------
def features_asof(panel: DataFrame, calendar: DataFrame, cfg: DemandConfig, variant: str = X.BASE) -> DataFrame:
    """Predict-mode features of the base day only, one row per (item, location).

    Equals the windowed predict-mode tables at that day: a trailing window of a
    single day is an aggregate over the rows inside it.
    """
    d0 = cfg.base_day
    day = F.col(cfg.day)
    rows = X.with_calendar(
        X.history(panel, cfg).filter(day <= F.lit(d0)), calendar, cfg, ["day_type_sequence"]
    )
    today = calendar.filter(F.col("jst_date") == F.lit(d0)).select("day_type_sequence").head()
    same = {
        "dow": F.dayofweek(day) == F.dayofweek(F.lit(d0)),
        "dts": F.col("day_type_sequence").eqNullSafe(F.lit(today[0] if today else None).cast("string")),
    }
    src = {m: F.col(X.source_column(m, variant)) for m in MEASURES}

    def since(w: int) -> Column:
        return day >= F.lit(d0 - timedelta(days=w))

    def stats(measures):
        return [
            aggregate(op, F.when(since(w), src[m])).alias(X.stat_name(m, op, w))
            for op in cfg.ops
            for w in cfg.windows
            for m in measures
        ]

    def segments(level: int, m: str, kinds=("dow", "dts")):
        return [
            aggregate(op, F.when(since(w) & same[k] if (k, level) != ("dow", 2) else since(w), src[m])).alias(
                f"{X.GROUP_NAMES[k][level]}_{op}_{w}"
            )
            for k in kinds
            for op in cfg.category_ops
            for w in cfg.windows
        ]

    active = src["total_dose_by_yj_store"] != 0
    dose = F.col("total_dose_by_yj_store")

    def last_active(m: str) -> Column:
        return F.max_by(src[m], F.when(active, day))

    pair = rows.groupBy(*cfg.pair).agg(
        *stats(PAIR_MEASURES),
        *[
            F.max(F.when(day == F.lit(d0 - timedelta(days=n)), src[m])).alias(f"lag{n}_{m}")
            for n in cfg.lags
            for m in MEASURES
        ],
        last_active("total_dose_by_yj_store").alias(X.LAST_NONZERO[0]),
        *segments(0, "total_dose_by_yj_store"),
        F.max(F.when((dose > 0) & (day >= F.lit(cfg.recency_start)), day)).alias("__last_day"),
    )
    item = rows.groupBy(cfg.item).agg(
        *stats(ITEM_MEASURES), last_active("total_dose_by_yj").alias(X.LAST_NONZERO[1]), *segments(1, "total_dose_by_yj")
    )
    name = rows.groupBy("general_name", cfg.location).agg(*segments(2, "total_dose_by_yj_store"))

    base = panel.filter(day == F.lit(d0)).select(*cfg.keys, "general_name", dose.alias("__dose"))
    out = base.join(pair, cfg.pair, "left").join(item, cfg.item, "left")
    out = null_safe(out, name, ["general_name", cfg.location])
    out = out.withColumn(X.RECENCY, F.when(F.col("__dose") >= 0, X.recency_expr(cfg, F.col("__last_day"))))
    exprs = [*X.lag_minus_avg_exprs(cfg, "by_yj_store"), *X.lag_minus_avg_exprs(cfg, "by_yj")]
    return out.selectExpr("*", *exprs).select(*cfg.keys, *feature_columns(cfg), X.RECENCY)


def predict_dataset(
    panel: DataFrame, calendar: DataFrame, doctors: DataFrame, cfg: DemandConfig, label: str = "log"
) -> DataFrame:
    """Feature rows of the base day, dated one horizon later.

    Calendar columns and encodings describe the base day itself.  The diff
    variant keeps the pair's current target, needed to invert its label.
    """
    spec = LABELS[label]
    drop = [c for c in UNAVAILABLE if not (label == "diff" and c == "total_dose_by_yj_store")]
    if label == "scaled":
        drop += SCALED_TARGETS
    base = panel.filter(F.col(cfg.day) == F.lit(cfg.base_day)).withColumns(cyclic_encodings())
    if label == "scaled":
        base = base.withColumn(spec.column, F.expr(spec.source))
    rows = base.drop(*drop).join(features_asof(panel, calendar, cfg, spec.variant), cfg.keys, "left")
    rows = X.with_doctors(rows, doctors, cfg)
    rows = X.with_calendar(rows, calendar, cfg, ["is_holiday", "day_type", "day_type_sequence"])
    return rows.withColumn(cfg.day, F.date_add(cfg.day, cfg.horizon))
