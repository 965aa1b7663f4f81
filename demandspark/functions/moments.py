"""Trailing statistics over daily series.

A moving frame in Spark is re-evaluated from scratch for every row, so five
windows of up to a year cost hundreds of updates per row and measure.  On a
gap-free daily series the same statistics are composed from *tiles*:

1. ``lag`` fetches the last few values, which merge into a short tile (count,
   sum, M2, min and max); a few lagged short tiles merge into a long tile;
2. ``lag`` fetches the non-overlapping tiles that cover each window;
3. all merges use the exact pooled-variance formula.

Only additions of like-signed terms occur (no prefix-sum differences), so zero
stays zero and a constant stretch has a standard deviation of exactly zero.
All steps share one partitioning and one sort, and no moving aggregate runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

STATS = ("n", "s", "v", "lo", "hi")


def quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def over(keys: Sequence[str], day: str, frame: str = "") -> str:
    part = ", ".join(quoted(k) for k in keys)
    return f"over (partition by {part} order by {quoted(day)} {frame})"


def range_frame(low: int, high: int) -> str:
    """Calendar frame ``[t - low, t - high]`` for an order by ``unix_date``."""
    upper = "current row" if high == 0 else f"{high} preceding"
    return f"range between {low} preceding and {upper}"


def cover(length: int, sizes: Sequence[int]) -> list[tuple[int, int]]:
    """Non-overlapping ``(tile size, offset)`` parts of a window, longest tiles first."""
    parts, at = [], 0
    for size in sorted(sizes, reverse=True):
        while length - at >= size:
            parts.append((size, at))
            at += size
    return parts


def choose_tiles(lengths: Sequence[int]) -> tuple[int, ...]:
    """Tile sizes ``(1, short, long)`` needing the fewest fetches; ``short`` divides ``long``."""
    options = [(1,)]
    for long in {n - 1 for n in lengths} | set(lengths):
        for short in range(2, long // 2 + 1):
            if long % short == 0:
                options.append((1, short, long))

    def cost(sizes: tuple[int, ...]) -> int:
        fetched = {part for n in lengths for part in cover(n, sizes)}
        merged = sum(len(cover(n, sizes)) for n in lengths)
        build = sizes[1] + sizes[2] // sizes[1] if len(sizes) > 1 else 0
        return len(fetched) + build + merged // 2

    return min(options, key=lambda o: (cost(o), o))


@dataclass(frozen=True)
class Trailing:
    """Names of the merged moment columns of one (measure, window)."""

    n: str
    s: str
    mean: str
    m2: str
    lo: str
    hi: str


def add_trailing_moments(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    measures: Sequence[str],
    windows: Sequence[int],
    shift: int,
    need: Sequence[str] = STATS,
) -> tuple[DataFrame, dict[tuple[str, int], Trailing]]:
    """Append moments over days ``[t - shift - w, t - shift]`` for every window ``w``.

    Requires one row per key and day without gaps.  Returns the extended frame
    and the column names per (measure, window); helper columns start with ``__``.
    """
    need = [x for x in STATS if x in set(need) | ({"n", "s"} if "v" in need else set())]
    width = len(need)
    measures = list(measures)
    spec = over(keys, day)
    sizes = choose_tiles([w + 1 for w in windows])
    parts = {w: cover(w + 1, sizes) for w in windows}

    def names(m: str, w: object) -> Trailing:
        return Trailing(*(f"__{k}_{measures.index(m)}_{w}" for k in ("n", "s", "mean", "m2", "lo", "hi")))

    def cell(m: str, kind: str, part: tuple[int, str]) -> str:
        size, at = part
        i = measures.index(m)
        if size > 1:
            return f"{at}[{i * width + need.index(kind)}]"
        return f"{at}[{i}]"

    def count(m: str, part: tuple[int, str]) -> str:
        return f"if({cell(m, 'n', part)} is null, 0D, 1D)" if part[0] == 1 else f"coalesce({cell(m, 'n', part)}, 0D)"

    def spread(m: str, part: tuple[int, str], mean: str) -> str:
        if part[0] == 1:
            gap = f"({cell(m, 's', part)} - {mean})"
            return f"coalesce({gap} * {gap}, 0D)"
        gap = f"({cell(m, 's', part)} - {cell(m, 'n', part)} * {mean})"
        return f"coalesce({cell(m, 'v', part)} + {gap} * {gap} / nullif({cell(m, 'n', part)}, 0D), 0D)"

    def extreme(fn: str, values: list[str]) -> str:
        return f"{fn}({', '.join(values)})" if len(values) > 1 else values[0]

    def merge(df: DataFrame, base: list[str], groups: dict[object, list[tuple[int, str]]]) -> DataFrame:
        """Append the merged moments of every measure and group; fetched tiles are dropped."""
        cells = [(m, g, names(m, g)) for m in measures for g in groups]
        fetched = sorted({at for ps in groups.values() for _, at in ps})
        first = []
        for m, g, t in cells:
            ps = groups[g]
            if "n" in need:
                first.append(" + ".join(count(m, p) for p in ps) + f" as {t.n}")
                first.append(" + ".join(f"coalesce({cell(m, 's', p)}, 0D)" for p in ps) + f" as {t.s}")
            if "lo" in need:
                first.append(extreme("least", [cell(m, "lo", p) for p in ps]) + f" as {t.lo}")
            if "hi" in need:
                first.append(extreme("greatest", [cell(m, "hi", p) for p in ps]) + f" as {t.hi}")
        made = [c.rsplit(" as ", 1)[1] for c in first]
        df = df.selectExpr(*base, *fetched, *first)
        if "n" in need:
            means = [f"if({t.n} > 0, {t.s} / {t.n}, null) as {t.mean}" for _, _, t in cells]
            df = df.selectExpr(*base, *fetched, *made, *means)
            made += [t.mean for _, _, t in cells]
        if "v" in need:
            m2 = [f"{' + '.join(spread(m, p, t.mean) for p in groups[g])} as {t.m2}" for m, g, t in cells]
            df = df.selectExpr(*base, *made, *m2)
        return df.drop(*fetched)

    def fetch(df: DataFrame, base: list[str], wanted: dict[tuple[int, int], str]) -> DataFrame:
        lags = [
            (f"lag(__tile{size}, {off}) {spec}" if off else f"__tile{size}") + f" as {at}"
            for (size, off), at in wanted.items()
        ]
        return df.selectExpr(*base, *lags)

    base = [quoted(c) for c in df.columns]
    df = df.selectExpr(*base, f"array({', '.join(f'cast({quoted(m)} as double)' for m in measures)}) as __tile1")
    tiles = ["__tile1"]
    for small, large in zip(sizes, sizes[1:]):
        wanted = {(small, k * small): f"__at{k}" for k in range(large // small)}
        df = fetch(df, [*base, *tiles], wanted)
        df = merge(df, [*base, *tiles], {"tile": [(small, at) for at in wanted.values()]})
        field = {"n": "n", "s": "s", "v": "m2", "lo": "lo", "hi": "hi"}
        packed = [getattr(names(m, "tile"), field[k]) for m in measures for k in need]
        df = df.selectExpr(*base, *tiles, f"array({', '.join(packed)}) as __tile{large}")
        tiles.append(f"__tile{large}")
    at = {p: f"__at{p[0]}_{p[1]}" for p in sorted({p for ps in parts.values() for p in ps})}
    df = fetch(df, base, {(size, off + shift): a for (size, off), a in at.items()})
    df = merge(df, base, {w: [(p[0], at[p]) for p in ps] for w, ps in parts.items()})
    return df, {(m, w): names(m, w) for m in measures for w in windows}


def stat_expr(op: str, t: Trailing, copies: str = "1") -> str:
    """SQL of AVG / STDDEV / MIN / MAX from merged moments.

    ``copies`` counts how often each daily value is replicated in the window
    (item-level values repeated over locations): it leaves AVG, MIN and MAX
    unchanged and weights the sample standard deviation.
    """
    if op == "AVG":
        return t.mean
    if op == "STDDEV":
        return f"if({t.n} * {copies} > 1, sqrt({copies} * {t.m2} / ({t.n} * {copies} - 1)), null)"
    return t.lo if op == "MIN" else t.hi


NEEDS = {"AVG": ("n", "s"), "STDDEV": ("n", "s", "v"), "MIN": ("lo",), "MAX": ("hi",)}


def trailing_stats(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    measures: Sequence[str],
    windows: Sequence[int],
    ops: Sequence[str],
    shift: int,
    name: Callable[[str, str, int], str],
    copies: str = "1",
) -> DataFrame:
    """Append ``op(measure)`` over ``[t - shift - w, t - shift]`` on a gap-free series."""
    need = sorted({k for op in ops for k in NEEDS[op]})
    base = df.columns
    types = {m: df.schema[m].dataType.simpleString() for m in measures}

    def expr(m: str, op: str, w: int) -> str:
        e = stat_expr(op, cells[m, w], copies)
        return f"cast({e} as {types[m]})" if op in ("MIN", "MAX") and types[m] != "double" else e

    df, cells = add_trailing_moments(df, keys, day, measures, windows, shift, need)
    return df.selectExpr(
        *[quoted(c) for c in base],
        *[
            f"{expr(m, op, w)} as {quoted(name(m, op, w))}"
            for op in ops
            for w in windows
            for m in measures
        ],
    )


def ranged_stats(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    measures: Sequence[str],
    windows: Sequence[int],
    ops: Sequence[str],
    shift: int,
    name: Callable[[str, str, int], str],
    copies: str = "1",
) -> DataFrame:
    """The same statistics with plain calendar ``RANGE`` frames.

    For series with gaps (one row per key and observed day), such as the days of
    one weekday or of one day-type sequence, whose frames hold few rows.
    """
    base = df.columns
    ordered = f"unix_date({quoted(day)})"

    def frame(w: int) -> str:
        part = ", ".join(quoted(k) for k in keys)
        return f"over (partition by {part} order by {ordered} {range_frame(w + shift, shift)})"

    def expr(m: str, op: str, w: int) -> str:
        x, f = quoted(m), frame(w)
        if op == "AVG":
            return f"avg({x}) {f}"
        if op == "STDDEV":
            if copies == "1":
                return f"stddev_samp({x}) {f}"
            n = f"count({x}) {f}"
            return f"if({n} * {copies} > 1, sqrt({copies} * {n} * var_pop({x}) {f} / ({n} * {copies} - 1)), null)"
        return f"{op.lower()}({x}) {f}"

    return df.selectExpr(
        *[quoted(c) for c in base],
        *[f"{expr(m, op, w)} as {quoted(name(m, op, w))}" for op in ops for w in windows for m in measures],
    )
