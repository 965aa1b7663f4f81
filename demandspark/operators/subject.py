"""Subject-level revisit features.

The dense subject panel (subject x item x location x day) is by far the largest
table of the pipeline, yet everything it carries changes only on days with a
dispensing event.  So all windows here run over the *events* of a triple, and a
narrow ``explode`` spreads each state over the days until the next event.  The
summaries per (item, location, day) combine the dense rows before they are
shuffled; only ``subject_intervals`` and ``subject_features``, which return the
dense panel itself, join it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.moments import quoted, range_frame
from demandspark.functions.stage import stage
from demandspark.operators.panel import drug_master
from demandspark.sources.files import fact_scan
from demandspark.sources.schemas import MASTER_COLUMNS

_DAY = "interval 1 day"


def aggregate(op: str, c: str):
    fn = {"AVG": F.avg, "STDDEV": F.stddev_samp, "MIN": F.min, "MAX": F.max}[op]
    return fn(c)


def rx_daily(rx: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Facts of the span per (item, location, day, subject); 0 days supplied means unknown."""
    supplied = F.when(F.col("hi_kaisu") != 0, F.col("hi_kaisu"))
    return (
        fact_scan(rx, cfg)
        .groupBy(*cfg.keys, cfg.subject)
        .agg(
            F.sum(supplied).alias("hi_kaisu"),
            F.sum("total_dose").alias("total_dose"),
            F.sum("drug_price").alias("total_price"),
        )
    )


def _events(daily: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Events at stocked pairs with the first and last day of the triple's panel span."""
    triple = Window.partitionBy(*cfg.triple)
    first, last = F.min(cfg.day).over(triple), F.max(cfg.day).over(triple)
    return daily.join(pairs, cfg.pair, "left_semi").withColumns(
        {
            "__from": F.greatest(F.date_sub(first, cfg.head_days), F.lit(cfg.panel_start)),
            "__to": F.least(F.date_add(last, cfg.tail_days), F.lit(cfg.end)),
            "__first": first,
        }
    )


def _supply_end(day: str):
    return F.date_add(F.col(day), F.col("hi_kaisu").cast("int"))


def subject_panel(
    rx: DataFrame, pairs: DataFrame, drug: DataFrame, cfg: DemandConfig
) -> DataFrame:
    """Every day of every triple's span with its facts, zero-filled, and item attributes.

    Each event row becomes its own day plus the empty days up to the next event,
    so the dense rows are produced in place without a join to the facts.
    """
    nxt = F.lead(cfg.day).over(Window.partitionBy(*cfg.triple).orderBy(cfg.day))
    ev = _events(rx_daily(rx, cfg), pairs, cfg).withColumn("__until", F.coalesce(F.date_sub(nxt, 1), F.col("__to")))
    start = F.when(F.col(cfg.day) == F.col("__first"), F.col("__from")).otherwise(F.col(cfg.day))
    days = ev.withColumn("__event", F.col(cfg.day)).withColumn(
        cfg.day, F.explode(F.sequence(start, F.col("__until"), F.expr(_DAY)))
    )
    hit = F.col(cfg.day) == F.col("__event")
    facts = days.select(
        cfg.subject,
        *cfg.keys,
        F.when(hit, _supply_end(cfg.day)).alias("pred_prescription_date"),
        F.when(hit, F.coalesce("total_dose", F.lit(0.0))).otherwise(F.lit(0.0)).alias("total_dose"),
        F.when(hit, F.coalesce("total_price", F.lit(0.0))).otherwise(F.lit(0.0)).alias("total_price"),
    )
    master = drug_master(drug, cfg).distinct().drop("application_start_date")
    return facts.join(master, cfg.item, "left").select(
        *facts.columns, *[c for c in MASTER_COLUMNS if c != "application_start_date"]
    )


def _states(daily: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Per event: the state that holds from the next day until the next event."""
    series = Window.partitionBy(*cfg.triple).orderBy(cfg.day)
    visited = F.coalesce(F.col("total_dose") > 0, F.lit(False))
    return (
        _events(daily, pairs, cfg)
        .withColumns(
            {
                "visited": visited,
                "supply_end": _supply_end(cfg.day),
                "last_visit": F.last(F.when(visited, F.col(cfg.day)), ignorenulls=True).over(series),
                "last_dose": F.last(F.when(visited, F.col("total_dose")), ignorenulls=True).over(series),
                "visits": F.sum(visited.cast("long")).over(series),
                "next_event": F.lead(cfg.day).over(series),
            }
        )
        .withColumns(
            {
                "last_supply_end": F.last("supply_end", ignorenulls=True).over(series),
                "previous_visit": F.lag("last_visit").over(series),
            }
        )
    )


_STATE = (
    "lag_dispensing_date",
    "lag_total_dose",
    "stats_prescription_date",
    "pred_prescription_date",
    "filled_pred_prescription_date",
    "num_visit",
)


def event_states(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The states of all events as a written table: facts are summed, moved and put in order once for all that follows."""
    return stage(_states(rx_daily(rx, cfg), pairs, cfg).drop("hi_kaisu", "total_price"), "states")


def subject_spells(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, states: DataFrame | None = None) -> DataFrame:
    """The subject panel's history as spells: one row for all days, ``valid_from`` to ``valid_to``, that share a state.

    A state changes at events only, so that this, the form to store, grows with the events; the
    dense days come back with ``expand_spells``.  Yesterday's visit and supply end hold on
    the first day of a spell.
    """
    states = _states(rx_daily(rx, cfg), pairs, cfg) if states is None else states
    known = states.select(
        *cfg.triple,
        F.date_add(cfg.day, 1).alias("valid_from"),
        F.coalesce("next_event", "__to").alias("valid_to"),
        F.col("last_visit").alias("lag_dispensing_date"),
        F.col("last_dose").alias("lag_total_dose"),
        F.when(F.col("visited"), F.col(cfg.day)).alias("stats_prescription_date"),
        F.col("supply_end").alias("pred_prescription_date"),
        F.col("last_supply_end").alias("filled_pred_prescription_date"),
        F.col("visits").alias("num_visit"),
    ).filter("valid_from <= valid_to")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    unknown = states.filter(F.col(cfg.day) == F.col("__first")).select(
        *cfg.triple,
        F.col("__from").alias("valid_from"),
        F.col("__first").alias("valid_to"),
        none("date", "lag_dispensing_date"),
        none("double", "lag_total_dose"),
        none("date", "stats_prescription_date"),
        none("date", "pred_prescription_date"),
        none("date", "filled_pred_prescription_date"),
        F.lit(0).cast("long").alias("num_visit"),
    )
    return known.unionByName(unknown)


def expand_spells(spells: DataFrame, cfg: DemandConfig, start: date | None = None, end: date | None = None) -> DataFrame:
    """One row per day of the spells, of the days from ``start`` to ``end`` only if given (both included).

    Spells outside are skipped by their bounds before anything is expanded.
    """
    low, high = F.col("valid_from"), F.col("valid_to")
    if start is not None:
        spells, low = spells.filter(high >= F.lit(start)), F.greatest(low, F.lit(start))
    if end is not None:
        spells, high = spells.filter(F.col("valid_from") <= F.lit(end)), F.least(high, F.lit(end))
    days = spells.withColumn(cfg.day, F.explode(F.sequence(low, high, F.expr(_DAY))))
    fresh = F.col(cfg.day) == F.col("valid_from")
    first = ("stats_prescription_date", "pred_prescription_date")
    return days.select(cfg.subject, *cfg.keys, *[F.when(fresh, F.col(c)).alias(c) if c in first else c for c in _STATE])


def subject_history(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Per panel day: last visit day and dose, yesterday's visit and supply end,
    last known supply end, number of earlier visits."""
    return expand_spells(subject_spells(rx, pairs, cfg), cfg)


def visit_lag(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Keys with the previous visit, filled and unfilled."""
    return subject_history(rx, pairs, cfg).drop("num_visit")


def visit_count(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Number of visits strictly before each panel day."""
    return subject_history(rx, pairs, cfg).select(cfg.subject, *cfg.keys, "num_visit")


def interval_mode(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, states: DataFrame | None = None) -> DataFrame:
    """Most frequent gap between visits in the preceding days, per (item, day).

    For every item and day of the subject panel: the gap occurring most often
    among visits of the previous ``interval_days`` days, with ties going to the
    shorter gap, if its count exceeds ``min_support``.  ``scale_support``
    multiplies counts by the visits on that (item, day), at least 1.

    Counts change only when a visit enters or leaves the window, so each (item,
    gap) is a short list of +/- steps; a running sum over the steps and a narrow
    explode replace a range join of visits with days.
    """
    day, item = cfg.day, cfg.item
    if states is None:
        events = _events(rx_daily(rx, cfg), pairs, cfg)
        visits = events.filter("total_dose > 0").withColumn("previous_visit", F.lag(day).over(Window.partitionBy(*cfg.triple).orderBy(day)))
    else:
        events, visits = states, states.filter("visited")
    visits = visits.select(item, day, F.datediff(day, "previous_visit").cast("long").alias("gap"))
    # one row per (item, day, gap), NULL gap included: it counts as a visit row
    daily = visits.groupBy(item, day, "gap").agg(F.count(F.lit(1)).alias("c"))

    steps = (
        daily.filter("gap is not null")
        .select(
            item,
            "gap",
            F.explode(
                F.array(
                    F.struct(F.date_add(day, 1).alias("d"), F.col("c")),
                    F.struct(F.date_add(day, cfg.interval_days + 1).alias("d"), (-F.col("c")).alias("c")),
                )
            ).alias("s"),
        )
        .groupBy(item, "gap", F.col("s.d").alias("d"))
        .agg(F.sum("s.c").alias("c"))
    )
    series = Window.partitionBy(item, "gap").orderBy("d")
    spells = steps.select(
        item, "gap", "d", F.sum("c").over(series).alias("cnt"), F.date_sub(F.lead("d").over(series), 1).alias("until")
    ).filter("cnt > 0")
    if not cfg.scale_support:
        spells = spells.filter(F.col("cnt") > cfg.min_support)
    best = (
        spells.withColumn("until", F.least("until", F.lit(cfg.end)))
        .filter("d <= until")
        .select(item, F.explode(F.sequence("d", "until", F.expr(_DAY))).alias(day), "cnt", "gap")
        .groupBy(item, day)
        .agg(F.max(F.struct("cnt", (-F.col("gap")).alias("g"))).alias("top"))
    )
    rows = daily.groupBy(item, day).agg(F.sum("c").alias("k"))
    scale = F.greatest(F.coalesce("k", F.lit(1)), F.lit(1)) if cfg.scale_support else F.lit(1)
    return (
        best.join(rows, [item, day], "left")
        .join(panel_days(events, cfg), [item, day], "left_semi")
        .select(
            item,
            day,
            (-F.col("top.g")).alias("interval_prescription"),
            (F.col("top.cnt") * scale).alias("cnt"),
        )
        .filter(F.col("cnt") > cfg.min_support)
    )


def panel_days(events: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Distinct (item, day) of the subject panel, from span starts and ends: a triple has them on its first event."""
    item = cfg.item
    marks = (
        events.filter(F.col(cfg.day) == F.col("__first"))
        .groupBy(item, F.col("__from").alias("a"), F.col("__to").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            item,
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("d"), F.col("n")),
                    F.struct(F.date_add("b", 1).alias("d"), (-F.col("n")).alias("n")),
                )
            ).alias("s"),
        )
        .groupBy(item, F.col("s.d").alias("d"))
        .agg(F.sum("s.n").alias("n"))
    )
    series = Window.partitionBy(item).orderBy("d")
    return (
        marks.select(item, "d", F.sum("n").over(series).alias("open"), F.lead("d").over(series).alias("nxt"))
        .filter("open > 0")
        .select(item, F.explode(F.sequence("d", F.date_sub("nxt", 1), F.expr(_DAY))).alias(cfg.day))
    )


def subject_intervals(
    rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, modes: DataFrame | None = None
) -> DataFrame:
    """Days since the last visit, distance to both predicted visits, earlier visits."""
    modes = interval_mode(rx, pairs, cfg) if modes is None else modes
    day = cfg.day
    return (
        subject_history(rx, pairs, cfg)
        .join(modes.select(cfg.item, day, "interval_prescription"), [cfg.item, day], "left")
        .select(
            *cfg.pair,
            cfg.subject,
            day,
            "lag_total_dose",
            F.datediff(day, "lag_dispensing_date").cast("long").alias("day_from_last_dispensing"),
            F.datediff(day, "filled_pred_prescription_date").cast("long").alias("diff_pred_prescription_date"),
            F.datediff(
                day, F.date_add(F.col("lag_dispensing_date"), F.col("interval_prescription").cast("int"))
            ).cast("long").alias("diff_stats_prescription_date"),
            "num_visit",
        )
    )


def _expected(states: DataFrame, cfg: DemandConfig, at: str, prefix: str) -> DataFrame:
    return states.groupBy(*cfg.pair, F.col(at).alias(cfg.day)).agg(
        F.count(F.lit(1)).alias(f"{prefix}_presciption_count"),
        *[aggregate(op, "last_dose").alias(f"{prefix}_presciption_{op}_lag_total_dose") for op in cfg.ops],
        F.sum("last_dose").alias(f"{prefix}_presciption_sum_lag_total_dose"),
    )


def expected_demand(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, states: DataFrame | None = None) -> DataFrame:
    """Last doses summarised by the day they are expected again, and by visit day.

    ``pred_*`` groups by the end of supply, ``stats_*`` by the day of the visit
    itself.  Both come from the events; a state that would start after the
    triple's span is not counted.
    """
    states = _states(rx_daily(rx, cfg), pairs, cfg) if states is None else states
    states = states.filter(F.col(cfg.day) < F.col("__to"))
    pred = _expected(states.filter("supply_end is not null"), cfg, "supply_end", "pred")
    stats = _expected(states.filter("visited"), cfg, cfg.day, "stats")
    return pred.join(stats, cfg.keys, "full_outer")


def subject_features(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    """The subject feature table: intervals with the expected demand of their key."""
    return subject_intervals(rx, pairs, cfg).join(expected_demand(rx, pairs, cfg), cfg.keys, "left")


AGG_MEASURES = (
    "diff_pred_prescription_date",
    "diff_stats_prescription_date",
    "num_visit",
    "day_from_last_dispensing",
)


def _dose_columns(cfg: DemandConfig) -> list[str]:
    kinds = ("pred", "stats")
    return [
        *[f"{k}_presciption_{op}_lag_total_dose" for op in cfg.ops for k in kinds],
        *[f"{k}_presciption_sum_lag_total_dose" for k in kinds],
    ]


#: Measures of the dense panel, and the one that follows from the mode of its (item, day).
DENSE_MEASURES = ("diff_pred_prescription_date", "num_visit", "day_from_last_dispensing")
MODE_MEASURE = "diff_stats_prescription_date"


def _daily_summaries(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, exact: bool, states: DataFrame | None = None) -> DataFrame:
    """Returning subjects summarised per (item, location, day); ``exact`` adds counts and integer sums.

    The distance to the statistically predicted visit is the days since the last
    visit less the interval mode, one value per (item, day): it is taken off the
    summaries, so that the dense panel is never joined.
    """
    day, weight = cfg.day, F.col("__weight")
    states = event_states(rx, pairs, cfg) if states is None else states
    # what the summaries see of a spell; spells alike are counted and become days once
    seen = [*cfg.pair, "valid_from", "valid_to", "filled_pred_prescription_date", "num_visit", "lag_dispensing_date"]
    alike = subject_spells(rx, pairs, cfg, states).filter("num_visit > 0").groupBy(*seen).agg(F.count(F.lit(1)).alias("__weight"))
    base = alike.withColumn(day, F.explode(F.sequence("valid_from", "valid_to", F.expr(_DAY)))).select(
        *cfg.keys,
        "__weight",
        F.datediff(day, "filled_pred_prescription_date").cast("long").alias("diff_pred_prescription_date"),
        "num_visit",
        F.datediff(day, "lag_dispensing_date").cast("long").alias("day_from_last_dispensing"),
    )
    sums, cells = [], []
    for m in DENSE_MEASURES:
        x, wide = F.col(m).cast("double"), F.col(m).cast("decimal(19,0)")
        sums += [
            F.coalesce(F.sum(F.when(F.col(m).isNotNull(), weight)), F.lit(0).cast("long")).alias(f"__n_{m}"),
            F.sum(x * weight).alias(f"__x_{m}"),
            F.sum(x * x * weight).alias(f"__xx_{m}"),
            F.min(m).alias(f"__lo_{m}"),
            F.max(m).alias(f"__hi_{m}"),
        ]
        if exact:
            sums += [F.sum(F.col(m) * weight).alias(f"__s_{m}"), F.sum((wide * wide * weight).cast("decimal(38,0)")).alias(f"__q_{m}")]
        n, s, q = F.col(f"__n_{m}"), F.col(f"__x_{m}"), F.col(f"__xx_{m}")
        of = {
            "AVG": F.when(n > 0, s / n),
            # sums of whole numbers: exact up to 2^53, so that equal values give 0
            "STDDEV": F.when(n > 1, F.sqrt(F.greatest(n * q - s * s, F.lit(0.0)) / n / (n - 1))),
            "MIN": F.col(f"__lo_{m}"),
            "MAX": F.col(f"__hi_{m}"),
        }
        cells += [of[op].alias(f"{op}_{m}_yj_store") for op in cfg.ops]
    kept = [f"__{k}_{m}" for m in DENSE_MEASURES for k in ("n", "s", "q", "lo", "hi")] if exact else []
    mode, since = F.col("interval_prescription"), "day_from_last_dispensing"
    modes = interval_mode(rx, pairs, cfg, states).select(cfg.item, day, "interval_prescription")
    daily = base.groupBy(*cfg.keys).agg(*sums).select(*cfg.keys, *cells, *kept).join(modes, [cfg.item, day], "left")
    shifted = {
        f"{op}_{MODE_MEASURE}_yj_store": F.col(f"{op}_{since}_yj_store") - mode
        if op != "STDDEV"
        else F.when(mode.isNotNull(), F.col(f"STDDEV_{since}_yj_store"))
        for op in cfg.ops
    }
    if exact:
        n, s, q = F.col(f"__n_{since}"), F.col(f"__s_{since}"), F.col(f"__q_{since}")
        wide = mode.cast("decimal(19,0)")
        shifted |= {
            f"__n_{MODE_MEASURE}": F.when(mode.isNotNull(), n).otherwise(0),
            f"__s_{MODE_MEASURE}": s - n * mode,
            f"__q_{MODE_MEASURE}": (q - wide * s.cast("decimal(19,0)") * 2 + wide * wide * n).cast("decimal(38,0)"),
            f"__lo_{MODE_MEASURE}": F.col(f"__lo_{since}") - mode,
            f"__hi_{MODE_MEASURE}": F.col(f"__hi_{since}") - mode,
        }
    return daily.withColumns(shifted)


def patient_agg(
    rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, windows: Sequence[int] | None = None
) -> DataFrame:
    """Subject features of returning subjects summarised per (item, location, day).

    ``windows`` (default: the configured ``stats_days``) adds the same
    aggregates over ``[t - s - delay, t - delay]``.
    """
    windows = cfg.stats_days if windows is None else tuple(windows)
    states = event_states(rx, pairs, cfg)
    daily = _daily_summaries(rx, pairs, cfg, bool(windows), states)
    out = daily.join(expected_demand(rx, pairs, cfg, states).select(*cfg.keys, *_dose_columns(cfg)), cfg.keys, "left")
    if windows:
        out = _patient_windows(out, cfg, windows)
    names = [f"{op}_{m}_yj_store" for op in cfg.ops for m in AGG_MEASURES]
    return out.select(*cfg.keys, *names, *patient_window_columns(cfg, windows), *_dose_columns(cfg))


def patient_window_columns(cfg: DemandConfig, windows: Sequence[int]) -> list[str]:
    doses = ("pred_presciption_sum_lag_total_dose", "stats_presciption_sum_lag_total_dose")
    return [
        *[f"{op}_{m}_{s}days_yj_store" for op in cfg.ops for s in windows for m in AGG_MEASURES],
        *[f"{op}_{m}_{s}days_yj_store" for op in cfg.ops for s in windows for m in doses],
    ]


def _patient_windows(df: DataFrame, cfg: DemandConfig, windows: Sequence[int]) -> DataFrame:
    """Delayed windows over daily counts and exact integer sums (and daily doses)."""
    part = ", ".join(quoted(k) for k in cfg.pair)
    doses = ("pred_presciption_sum_lag_total_dose", "stats_presciption_sum_lag_total_dose")

    def over(s: int) -> str:
        frame = range_frame(s + cfg.stats_delay, cfg.stats_delay)
        return f"over (partition by {part} order by unix_date({quoted(cfg.day)}) {frame})"

    sums, cells = [], []
    for s in windows:
        for m in AGG_MEASURES:
            for k, fn in (("n", "sum"), ("s", "sum"), ("q", "sum"), ("lo", "min"), ("hi", "max")):
                sums.append(f"{fn}(__{k}_{m}) {over(s)} as __{k}_{m}_{s}")
            n, t, q = f"__n_{m}_{s}", f"__s_{m}_{s}", f"__q_{m}_{s}"
            wide = f"cast({t} as decimal(19,0))"
            cells += [
                f"if({n} > 0, {t} / {n}, null) as AVG_{m}_{s}days_yj_store",
                f"if({n} > 1, sqrt(cast(cast({n} as decimal(12,0)) * cast({q} as decimal(25,0)) - {wide} * {wide} as double)"
                f" / {n} / ({n} - 1)), null) as STDDEV_{m}_{s}days_yj_store",
                f"__lo_{m}_{s} as MIN_{m}_{s}days_yj_store",
                f"__hi_{m}_{s} as MAX_{m}_{s}days_yj_store",
            ]
        for m in doses:
            for op, fn in (("AVG", "avg"), ("STDDEV", "stddev_samp"), ("MIN", "min"), ("MAX", "max")):
                sums.append(f"{fn}({m}) {over(s)} as {op}_{m}_{s}days_yj_store")
    return df.selectExpr("*", *sums).selectExpr("*", *cells)


def patient_window_agg(rx: DataFrame, pairs: DataFrame, cfg: DemandConfig, windows: Sequence[int]) -> DataFrame:
    """Only the windowed columns of ``patient_agg``."""
    out = patient_agg(rx, pairs, cfg, windows)
    return out.select(*cfg.keys, *patient_window_columns(cfg, windows))
