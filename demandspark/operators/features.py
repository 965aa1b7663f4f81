"""Feature families over the dense panel.

Every family exists as a step that appends columns to a panel-like frame
(``add_*``) and as a table function that returns keys plus its columns.  The
datasets chain the steps on one partitioning by (item, location); only values
that live at item or name level are joined, as narrow columns.

``mode`` is "train" (windows end a horizon before the row) or "predict"
(windows end on the row itself, because the panel stops a horizon earlier).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.moments import (
    add_trailing_moments,
    over,
    quoted,
    range_frame,
    ranged_stats,
    trailing_stats,
)
from demandspark.functions.stage import null_safe
from demandspark.sources.schemas import ITEM_MEASURES, MEASURES, PAIR_MEASURES

BASE, DIFF, SCALED = "", "diff_", "scaled_"


def source_column(measure: str, variant: str) -> str:
    """Panel column behind a measure: only the quantity targets have variants."""
    return variant + measure if measure.startswith("total_dose") else measure


def shift_of(mode: str, cfg: DemandConfig) -> int:
    if mode not in ("train", "predict"):
        raise ValueError("mode must be 'train' or 'predict'")
    return cfg.horizon if mode == "train" else 0


def history(panel: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Panel days any trailing window of the features can reach."""
    return panel.filter(F.col(cfg.day).between(F.lit(cfg.history_start), F.lit(cfg.panel_end)))


def feature_days(df: DataFrame, cfg: DemandConfig) -> DataFrame:
    return df.filter((F.col(cfg.day) >= F.lit(cfg.feature_start)) & (F.col(cfg.day) < F.lit(cfg.panel_end)))


def _measures(panel: DataFrame, cfg: DemandConfig, variant: str, names: Sequence[str], extra: Sequence[str] = ()):
    """Narrow projection: keys, the measures under their plain names, extra columns."""
    return panel.select(*cfg.keys, *extra, *[F.col(source_column(m, variant)).alias(m) for m in names])


def stat_name(m: str, op: str, w: int) -> str:
    return f"{m}_{op}_{w}"


def stat_columns(cfg: DemandConfig) -> list[str]:
    return [stat_name(m, op, w) for op in cfg.ops for w in cfg.windows for m in MEASURES]


def lag_columns(cfg: DemandConfig) -> list[str]:
    return [f"lag{n}_{m}" for n in cfg.lags for m in MEASURES]


LAST_NONZERO = ("lag_non_zero_total_dose_by_yj_store", "lag_non_zero_total_dose_by_yj")


# -- item-level series -------------------------------------------------------
def item_series(panel: DataFrame, cfg: DemandConfig, variant: str = BASE) -> DataFrame:
    """One row per (item, day): item measures, location count and activity flag.

    The panel repeats item measures on every location, so any aggregate of them
    is exact; grouping by (item, day) combines map-side and never gathers an
    item's rows in one task.
    """
    active = F.col(source_column("total_dose_by_yj_store", variant)) != 0
    return panel.groupBy(cfg.item, cfg.day).agg(
        *[F.max(source_column(m, variant)).alias(m) for m in ITEM_MEASURES],
        F.count(F.lit(1)).cast("double").alias("locations"),
        F.coalesce(F.max(active), F.lit(False)).alias("active"),
    )


# -- trailing statistics -----------------------------------------------------
def add_stats(
    df: DataFrame, cfg: DemandConfig, measures: Sequence[str], shift: int, dense: bool = True
) -> DataFrame:
    fn = trailing_stats if dense else ranged_stats
    return fn(df, cfg.pair, cfg.day, list(measures), cfg.windows, cfg.ops, shift, stat_name)


def item_stats(series: DataFrame, cfg: DemandConfig, mode: str, dense: bool = True) -> DataFrame:
    """Item statistics per (item, day) on the item's own daily series.

    Every location repeats the item's values, so one series per item serves all
    locations.  In predict mode the reference window holds the replicated rows:
    ``locations`` copies of each value.
    """
    fn = trailing_stats if dense else ranged_stats
    copies = "1" if mode == "train" else "locations"
    return fn(
        series, [cfg.item], cfg.day, list(ITEM_MEASURES), cfg.windows, cfg.ops, shift_of(mode, cfg), stat_name, copies
    )


def stats_features(
    panel: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE, dense: bool = True
) -> DataFrame:
    """Trailing AVG / STDDEV / MIN / MAX of the six measures over every window.

    Item measures are the same at all locations of a panel whose pairs share one
    span, so they are computed once per item and joined.  In predict mode their
    sample standard deviation ranges over the rows of all locations.
    """
    rows = history(panel, cfg)
    pair = add_stats(_measures(rows, cfg, variant, PAIR_MEASURES), cfg, PAIR_MEASURES, shift_of(mode, cfg), dense)
    names = [stat_name(m, op, w) for op in cfg.ops for w in cfg.windows for m in ITEM_MEASURES]
    items = feature_days(item_stats(item_series(rows, cfg, variant), cfg, mode, dense), cfg)
    items = items.select(cfg.item, cfg.day, *names)
    return (
        feature_days(pair, cfg)
        .join(items, [cfg.item, cfg.day], "left")
        .select(*cfg.keys, *stat_columns(cfg))
    )


# -- lags ---------------------------------------------------------------------
def add_lags(
    df: DataFrame,
    cfg: DemandConfig,
    shift: int,
    dense: bool = True,
    keys: Sequence[str] | None = None,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """As-of lags: the value exactly ``n + shift`` days back on a gap-free series,
    otherwise the last row at least that old; NULL values are values."""
    base = [quoted(c) for c in df.columns]
    keys = keys or cfg.pair
    if not dense:
        part = ", ".join(quoted(k) for k in keys)
        cols = [
            f"last({quoted(m)}) over (partition by {part} order by unix_date({quoted(cfg.day)}) "
            f"range between unbounded preceding and {n + shift} preceding) as {quoted(f'lag{n}_{m}')}"
            for n in cfg.lags
            for m in measures
        ]
        return df.selectExpr(*base, *cols)
    packed = f"array({', '.join(f'cast({quoted(m)} as double)' for m in measures)})"
    spec = over(keys, cfg.day)
    df = df.selectExpr(*base, f"{packed} as __row")
    df = df.selectExpr(*base, *[f"lag(__row, {n + shift}) {spec} as __lag{n}" for n in cfg.lags])
    counts = {m for m in measures if m.startswith("nunique")}
    return df.selectExpr(
        *base,
        *[
            (f"cast(__lag{n}[{i}] as bigint)" if m in counts else f"__lag{n}[{i}]") + f" as {quoted(f'lag{n}_{m}')}"
            for n in cfg.lags
            for i, m in enumerate(measures)
        ],
    )


def lag_features(
    panel: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE, dense: bool = True
) -> DataFrame:
    rows = _measures(history(panel, cfg), cfg, variant, MEASURES)
    return feature_days(add_lags(rows, cfg, shift_of(mode, cfg), dense), cfg).select(*cfg.keys, *lag_columns(cfg))


# -- last non-zero value -------------------------------------------------------
def until(keys: Sequence[str], day: str, shift: int):
    return (
        Window.partitionBy(*keys)
        .orderBy(F.unix_date(F.col(day)))
        .rangeBetween(Window.unboundedPreceding, -shift)
    )


def until_row(keys: Sequence[str], day: str, shift: int):
    """The same frame on a gap-free series; shares the day sort of the other windows."""
    return Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, -shift)


def _last_nonzero(df: DataFrame, keys, cfg: DemandConfig, shift: int, value: str, active, out: str) -> DataFrame:
    """Two delayed carries on a gap-free series: among active rows, then over all rows.

    The inner carry sees the full table, the outer one only the feature history.
    """
    upto = until_row(keys, cfg.day, shift)
    inner = F.last(F.when(active, F.struct(F.col(value).alias("x"))), ignorenulls=True).over(upto)
    df = df.withColumn("__inner", F.when(active, inner["x"]))
    df = history(df, cfg)
    return df.withColumn(out, F.last("__inner", ignorenulls=True).over(upto)).drop("__inner")


def add_last_nonzero_pair(df: DataFrame, cfg: DemandConfig, shift: int) -> DataFrame:
    m = "total_dose_by_yj_store"
    return _last_nonzero(df, cfg.pair, cfg, shift, m, F.col(m) != 0, LAST_NONZERO[0])


def item_last_nonzero(series: DataFrame, cfg: DemandConfig, shift: int) -> DataFrame:
    m = "total_dose_by_yj"
    out = _last_nonzero(series, [cfg.item], cfg, shift, m, F.col("active"), LAST_NONZERO[1])
    return out.select(cfg.item, cfg.day, LAST_NONZERO[1])


def last_nonzero(panel: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE) -> DataFrame:
    """Last non-zero target by pair and by item, delayed twice by the mode's shift."""
    shift = shift_of(mode, cfg)
    pair = add_last_nonzero_pair(_measures(panel, cfg, variant, ["total_dose_by_yj_store"]), cfg, shift)
    item = item_last_nonzero(item_series(panel, cfg, variant), cfg, shift)
    return (
        feature_days(pair, cfg)
        .join(feature_days(item, cfg), [cfg.item, cfg.day], "left")
        .select(*cfg.keys, *LAST_NONZERO)
    )


# -- lag minus average ----------------------------------------------------------
def lag_minus_avg_exprs(cfg: DemandConfig, scope: str) -> list[str]:
    """Differences of one scope, "by_yj_store" or "by_yj"; the pair also has the last non-zero one."""
    out = []
    for w in cfg.windows:
        avg = f"total_dose_{scope}_AVG_{w}"
        out += [f"lag{n}_total_dose_{scope} - {avg} as lag{n}_minus_avg{w}_{scope}" for n in cfg.lags]
        if scope == "by_yj_store":
            out.append(f"{LAST_NONZERO[0]} - {avg} as lag_non_zero_minus_avg{w}_{scope}")
    return out


def lag_minus_avg_columns(cfg: DemandConfig) -> list[str]:
    exprs = [*lag_minus_avg_exprs(cfg, "by_yj_store"), *lag_minus_avg_exprs(cfg, "by_yj")]
    return [e.rsplit(" as ", 1)[1] for e in exprs]


def target_columns(cfg: DemandConfig) -> list[str]:
    return [*stat_columns(cfg), *lag_columns(cfg), *LAST_NONZERO, *lag_minus_avg_columns(cfg)]


def item_target_columns(cfg: DemandConfig) -> list[str]:
    """The target features that depend on (item, day) only."""
    return [
        *[stat_name(m, op, w) for op in cfg.ops for w in cfg.windows for m in ITEM_MEASURES],
        *[f"lag{n}_{m}" for n in cfg.lags for m in ITEM_MEASURES],
        LAST_NONZERO[1],
        *[e.rsplit(" as ", 1)[1] for e in lag_minus_avg_exprs(cfg, "by_yj")],
    ]


def add_item_targets(series: DataFrame, cfg: DemandConfig, mode: str) -> DataFrame:
    """Item-level statistics, lags and differences on the item series."""
    series = add_lags(series, cfg, shift_of(mode, cfg), keys=[cfg.item], measures=ITEM_MEASURES)
    series = item_stats(series, cfg, mode)
    return series.selectExpr("*", *lag_minus_avg_exprs(cfg, "by_yj"))


def add_pair_targets(df: DataFrame, cfg: DemandConfig, mode: str, trim: bool = True) -> DataFrame:
    """Pair-level statistics, lags, last non-zero and differences.

    All windows share the (item, location) partitioning and the day order.  The
    feature days are cut out between the windows and the wide projections.
    """
    shift = shift_of(mode, cfg)
    df = add_last_nonzero_pair(df, cfg, shift)
    df = add_lags(df, cfg, shift, measures=PAIR_MEASURES)
    df = add_stats(df, cfg, PAIR_MEASURES, shift)
    if trim:
        df = feature_days(df, cfg)
    return df.selectExpr("*", *lag_minus_avg_exprs(cfg, "by_yj_store"))


def packed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """Keys plus all ``columns`` as one struct: joins and sorts move a single value."""
    return df.select(*keys, F.struct(*columns).alias(name))


def target_features(panel: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE) -> DataFrame:
    """The complete target-feature table, one row per key and feature day.

    Item-level columns are computed once per item and joined, packed, to the
    feature days only, after the pair windows.
    """
    shift = shift_of(mode, cfg)
    item_columns = item_target_columns(cfg)
    series = _last_nonzero(
        item_series(panel, cfg, variant), [cfg.item], cfg, shift, "total_dose_by_yj", F.col("active"), LAST_NONZERO[1]
    )
    items = packed(
        feature_days(add_item_targets(series, cfg, mode), cfg), [cfg.item, cfg.day], item_columns, "__item"
    )
    out = add_pair_targets(_measures(panel, cfg, variant, PAIR_MEASURES), cfg, mode).join(items, [cfg.item, cfg.day], "left")
    own = set(item_columns)
    return out.selectExpr(
        *[quoted(k) for k in cfg.keys],
        *[f"__item.{quoted(c)} as {quoted(c)}" if c in own else quoted(c) for c in target_columns(cfg)],
    )


def lag_minus_avg(panel: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE) -> DataFrame:
    return target_features(panel, cfg, mode, variant).select(*cfg.keys, *lag_minus_avg_columns(cfg))


# -- segment statistics -----------------------------------------------------------
GROUP_NAMES = {
    "dow": ("total_dose_by_yj_store_dow", "total_dose_by_yj_dow", "total_dose_by_name_store"),
    "dts": ("total_dose_by_yj_store_dts", "total_dose_by_yj_dts", "total_dose_by_name_store_dts"),
}
SEGMENT = {"dow": "dayofweek", "dts": "day_type_sequence"}


def segment_columns(cfg: DemandConfig, kind: str) -> list[str]:
    return [f"{g}_{op}_{w}" for op in cfg.category_ops for w in cfg.windows for g in GROUP_NAMES[kind]]


def add_segment_pair(df: DataFrame, cfg: DemandConfig, kind: str, shift: int) -> DataFrame:
    """Statistics of a pair's own days of one segment (weekday or day-type sequence)."""
    return ranged_stats(
        df,
        [*cfg.pair, SEGMENT[kind]],
        cfg.day,
        ["total_dose_by_yj_store"],
        cfg.windows,
        cfg.category_ops,
        shift,
        lambda m, op, w: f"{GROUP_NAMES[kind][0]}_{op}_{w}",
    )


def segment_names(cfg: DemandConfig, kind: str, level: int) -> list[str]:
    return [f"{GROUP_NAMES[kind][level]}_{op}_{w}" for op in cfg.category_ops for w in cfg.windows]


def add_segment_item(series: DataFrame, cfg: DemandConfig, kind: str, shift: int) -> DataFrame:
    """Statistics of an item's rows at all locations within a segment, per (item, day)."""
    return ranged_stats(
        series,
        [cfg.item, SEGMENT[kind]],
        cfg.day,
        ["total_dose_by_yj"],
        cfg.windows,
        cfg.category_ops,
        shift,
        lambda m, op, w: f"{GROUP_NAMES[kind][1]}_{op}_{w}",
        "locations",
    )


def name_series(panel: DataFrame, cfg: DemandConfig, variant: str = BASE, extra: Sequence[str] = ()) -> DataFrame:
    """Count, sum, M2, min and max of the items sharing a generic name, per (name, location, day)."""
    x = F.col(source_column("total_dose_by_yj_store", variant))
    return panel.groupBy("general_name", cfg.location, cfg.day, *extra).agg(
        F.count(x).cast("double").alias("__n"),
        F.sum(x).alias("__s"),
        (F.var_pop(x) * F.count(x)).alias("__v"),
        F.min(x).alias("__lo"),
        F.max(x).alias("__hi"),
    )


def _pooled(op: str, n: str, s: str, v: str, days: str, m2: str, lo: str, hi: str) -> str:
    """Statistic over day groups of equal size: within-day M2 plus spread of the daily sums."""
    if op == "AVG":
        return f"if({n} > 0, {s} / {n}, null)"
    if op == "STDDEV":
        return f"if({n} > 1, sqrt(({v} + {m2} * {days} / {n}) / ({n} - 1)), null)"
    return lo if op == "MIN" else hi


def add_name_stats(series: DataFrame, cfg: DemandConfig, kind: str, shift: int) -> DataFrame:
    """Statistics over all items of a (generic name, location), per (name, location, day).

    On a dense panel every day of a group holds the same number of values, so
    its pooled variance follows from daily sums and daily M2 alone.
    """
    group = ["general_name", cfg.location]
    names = {(op, w): f"{GROUP_NAMES[kind][2]}_{op}_{w}" for op in cfg.category_ops for w in cfg.windows}
    base = [quoted(c) for c in series.columns]
    if kind == "dow":
        df, cells = add_trailing_moments(
            series, group, cfg.day, ["__n", "__s", "__v", "__lo", "__hi"], cfg.windows, shift
        )
        exprs = []
        for (op, w), out in names.items():
            c = {m: cells[m, w] for m in ("__n", "__s", "__v", "__lo", "__hi")}
            exprs.append(
                _pooled(op, c["__n"].s, c["__s"].s, c["__v"].s, c["__s"].n, c["__s"].m2, c["__lo"].lo, c["__hi"].hi)
                + f" as {quoted(out)}"
            )
        return df.selectExpr(*base, *exprs)
    part = ", ".join(quoted(k) for k in [*group, SEGMENT[kind]])
    exprs = []
    for (op, w), out in names.items():
        f = f"over (partition by {part} order by unix_date({quoted(cfg.day)}) {range_frame(w + shift, shift)})"
        exprs.append(
            _pooled(
                op,
                f"sum(__n) {f}",
                f"sum(__s) {f}",
                f"sum(__v) {f}",
                f"count(__s) {f}",
                f"(var_pop(__s) {f} * count(__s) {f})",
                f"min(__lo) {f}",
                f"max(__hi) {f}",
            )
            + f" as {quoted(out)}"
        )
    return series.selectExpr(*base, *exprs)


def with_calendar(df: DataFrame, calendar: DataFrame, cfg: DemandConfig, columns: Sequence[str]) -> DataFrame:
    return df.join(calendar.select(F.col("jst_date").alias(cfg.day), *columns), cfg.day, "left")


def _segment_features(panel: DataFrame, cfg: DemandConfig, kind: str, mode: str, variant: str) -> DataFrame:
    shift = shift_of(mode, cfg)
    segment = SEGMENT[kind]
    series = panel.groupBy(cfg.item, cfg.day, segment).agg(
        F.max(source_column("total_dose_by_yj", variant)).alias("total_dose_by_yj"),
        F.count(F.lit(1)).cast("double").alias("locations"),
    )
    items = feature_days(add_segment_item(series, cfg, kind, shift), cfg).select(
        cfg.item, cfg.day, *segment_names(cfg, kind, 1)
    )
    names = feature_days(add_name_stats(name_series(panel, cfg, variant, [segment]), cfg, kind, shift), cfg).select(
        "general_name", cfg.location, cfg.day, *segment_names(cfg, kind, 2)
    )
    rows = _measures(panel, cfg, variant, ["total_dose_by_yj_store"], ["general_name", segment])
    out = feature_days(add_segment_pair(rows, cfg, kind, shift), cfg)
    out = out.join(items, [cfg.item, cfg.day], "left")
    out = null_safe(out, names, ["general_name", cfg.location, cfg.day])
    return out.select(*cfg.keys, *segment_columns(cfg, kind))


def category_features(panel: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE) -> DataFrame:
    """AVG / STDDEV by weekday (pair and item) and by generic name at the location."""
    return _segment_features(history(panel, cfg), cfg, "dow", mode, variant)


def holiday_features(
    panel: DataFrame, calendar: DataFrame, cfg: DemandConfig, mode: str = "train", variant: str = BASE
) -> DataFrame:
    """The same three groupings within each day-type sequence."""
    rows = with_calendar(history(panel, cfg), calendar, cfg, ["day_type_sequence"])
    return _segment_features(rows, cfg, "dts", mode, variant)


# -- recency ------------------------------------------------------------------------
RECENCY = "day_from_last_prescription"


def recency_expr(cfg: DemandConfig, last_day) -> "F.Column":
    """Days since ``last_day``, capped; a missing one counts from the look-back start."""
    since = F.datediff(F.col(cfg.day), F.coalesce(last_day, F.lit(cfg.recency_start)))
    return F.least(since, F.lit(cfg.max_last_days)).cast("long")


def days_since_last(panel: DataFrame, cfg: DemandConfig, mode: str = "train") -> DataFrame:
    """Capped days since the last day with a positive target, in one pass.

    Rows with a negative or NULL target drop out; the result covers the whole
    look-back, not only the feature days.
    """
    x = F.col("total_dose_by_yj_store")
    rows = panel.filter(F.col(cfg.day).between(F.lit(cfg.recency_start), F.lit(cfg.panel_end)) & (x >= 0))
    last_day = F.last(F.when(x > 0, F.col(cfg.day)), ignorenulls=True).over(
        until(cfg.pair, cfg.day, shift_of(mode, cfg))
    )
    return rows.select(*cfg.keys, recency_expr(cfg, last_day).alias(RECENCY))


# -- prescribers ------------------------------------------------------------------------
def doctor_counts(rx: DataFrame, cfg: DemandConfig, pad: bool = True) -> DataFrame:
    """Facts ``n`` per (item, location) and prescriber in the training span."""
    from demandspark.functions.scalar import pad_code
    from demandspark.sources.files import scan_half_open

    location = pad_code(cfg.location) if pad else F.col(cfg.location)
    return (
        scan_half_open(rx, cfg.day, cfg.prescriber_start, cfg.prescriber_end)
        .withColumn(cfg.location, location)
        .groupBy(*cfg.pair, "doctor_code")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def doctor_feature(rx: DataFrame, cfg: DemandConfig, pad: bool = True, form: str = "text") -> DataFrame:
    """Prescriber codes per (item, location) in the training span, sorted, repeats kept.

    Facts are counted per prescriber first, so one busy pair never gathers its
    rows: only its distinct prescribers meet.  ``form="counted"`` writes
    ``code*count`` instead of repeating the code, an equally distinguishing but
    bounded text.  ``form="digest"`` gives a category key of constant size: sums of two hashes of
    each (code, count), which depend on the multiset only, so that a pair gathers nothing.
    ``form="ordered"`` is bounded by the distinct prescribers, too, and sorts as the text does: see ``ordered_word``.
    """
    return doctor_texts(doctor_counts(rx, cfg, pad), cfg, form)


def plain_codes(counts: DataFrame) -> bool:
    """Whether every prescriber code is one word: without blanks and control characters, and not empty."""
    odd = F.col("doctor_code").rlike(r"[\x00-\x20]") | (F.col("doctor_code") == "")
    return not counts.agg(F.max(odd)).first()[0]


def ordered_word(code: Column, n: Column, last: Column) -> Column:
    """``n`` repeats of a plain code, in a form that sorts as the repeats do within their text.

    A larger count sorts later if the text ends with it, and earlier if a (larger) code follows; a
    text that ends sorts before one that goes on.  Counts are written as a letter for the number of
    digits, then the digits, both falling instead of rising if a code follows; nothing for a last 1.
    """
    digits = n.cast("string")
    size = F.length(digits)
    ends = F.concat(code, F.lit(" "), F.char(F.lit(64) + size), digits)
    goes_on = F.concat(code, F.lit(" "), F.char(F.lit(117) - size), F.translate(digits, "0123456789", "9876543210"))
    return F.when(last & (n == 1), code).when(last, ends).otherwise(goes_on)


def doctor_texts(counts: DataFrame, cfg: DemandConfig, form: str = "text") -> DataFrame:
    """The forms of ``doctor_feature`` from its counts; ``ordered`` is for plain codes."""
    code = F.col("doctor_code")
    if form == "digest":
        named = counts.where(code.isNotNull())
        hashed = [F.sum(F.xxhash64(*c).cast("decimal(38,0)")).cast("string") for c in ([code, F.col("n")], [F.lit("prescribers"), F.col("n"), code])]
        digests = named.groupBy(*cfg.pair).agg(F.concat_ws(".", F.sum("n"), F.count(F.lit(1)), *hashed).alias("doctors"))
        return counts.select(*cfg.pair).distinct().join(digests, cfg.pair, "left")
    if form == "counted":
        word = F.concat(code, F.lit("*"), F.col("n").cast("string"))
    elif form == "ordered":
        word = F.col("n")
    else:
        word = F.rtrim(F.repeat(F.concat(code, F.lit(" ")), F.col("n").cast("int")))
    listed = counts.groupBy(*cfg.pair).agg(
        F.sort_array(F.collect_list(F.when(code.isNotNull(), F.struct(code.alias("code"), word.alias("word"))))).alias("ws")
    )
    if form == "ordered":
        n = F.size("ws")
        words = F.transform("ws", lambda w, i: ordered_word(w["code"], w["word"], i + 1 == n))
        return listed.select(*cfg.pair, F.when(n > 0, F.array_join(words, "")).alias("doctors"))
    return listed.select(
        *cfg.pair, F.when(F.size("ws") > 0, F.array_join(F.col("ws")["word"], " ")).alias("doctors")
    )


def with_doctors(df: DataFrame, doctors: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The pairs' prescribers joined to the rows; the texts compress so well that a table of a broadcast's
    size may not fit the driver, so they are never broadcast."""
    return df.join(doctors.hint("merge"), cfg.pair, "left")


def fill_forward(df: DataFrame, keys: Sequence[str], day: str, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the last earlier value of the series."""
    upto = Window.partitionBy(*keys).orderBy(day)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})
