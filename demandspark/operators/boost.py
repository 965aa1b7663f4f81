"""Gradient-boosted regression trees over binned blocks of rows, resumable round by round.

*Blocks.*  Features become bins of one byte (bin 0 for NULL; quantile bins of numbers, a bin for
each frequent code of a category), packed feature by feature into blocks of rows, a written table.
*Rounds.*  A tree grows level by level: one job sums gradients and rows of every open leaf by
feature and bin, in each task first, then by groups of features, and returns the best split of
each leaf, so that the driver sees splits only.  Splits of a level are taken by gain until the
tree has its leaves.  Splits of categories order their bins by mean gradient, so that any set of
categories can part from the rest.
*State.*  Tasks keep the predictions of their blocks in the Python worker and bring them up to
date with the trees that are new; a new worker starts from the first tree.  Gradients are summed
as integers, which makes a tree independent of the order of sums: trees are written every few
rounds, and a fit that goes on from them gives the same model as one that was never interrupted.

The loop uses RDD jobs: a level is one short job of array code, and planning a query for each
costs more than the level itself.
"""

from __future__ import annotations

import math
import sys
import types
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.functions.stage import fresh_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREDICTION = "predicted_total_dose"
#: Rows of a block and of a summary: whole batches of 10,000 rows, or of smaller ones that divide it.
BLOCK_ROWS = 70_000
#: Groups of features whose sums are added up together.
GROUPS = 16
#: Splits by sets of categories: smoothing of the order, extra regularisation.
CATEGORY_SMOOTH, CATEGORY_L2 = 10.0, 10.0
#: Whole units that the largest first gradient is made of.
UNITS = 1 << 29


@dataclass(frozen=True)
class BoostParams:
    """Boosting settings; the defaults are the published ones.

    Fitting stops when ``patience`` rounds have not improved the validation error.  Trees are
    written every ``save_every`` rounds.
    """

    max_iter: int = 100_000
    patience: int = 200
    step: float = 0.01
    leaves: int = 32
    depth: int = 8
    bins: int = 256
    min_rows: int = 10
    row_fraction: float = 0.5
    feature_fraction: float = 0.5
    l1: float = 0.1
    l2: float = 0.1
    seed: int = 777
    save_every: int = 25


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays, parents before children; a leaf has no children (-1).

    ``left_bins``: for each node and bin, whether its rows go left.
    """

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    left_bins: np.ndarray

    @staticmethod
    def root(value: float, rows: int) -> Tree:
        return Tree(np.array([-1]), np.array([-1]), np.array([-1]), np.array([value]), np.zeros(1), np.array([rows]), np.zeros((1, 256), bool))

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each column of ``bins`` (features x rows)."""
        at = np.zeros(bins.shape[1], np.int32)
        for node in np.flatnonzero(self.left >= 0).tolist():
            rows = np.flatnonzero(at == node)
            go = self.left_bins[node][bins[self.feature[node], rows]]
            at[rows] = np.where(go, self.left[node], self.right[node])
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins)]

    def split(self, node: int, s: Split, values: tuple[float, float]) -> Tree:
        """The tree with two leaves under ``node``."""
        n = len(self.left)
        feature, left, right, gain, bins = (x.copy() for x in (self.feature, self.left, self.right, self.gain, self.left_bins))
        feature[node], left[node], right[node], gain[node], bins[node] = s.feature, n, n + 1, s.gain, s.left_bins
        two = lambda a, x: np.append(a, x)
        return Tree(
            two(feature, [-1, -1]), two(left, [-1, -1]), two(right, [-1, -1]), two(self.value, values), two(gain, [0.0, 0.0]),
            two(self.rows, [s.left_rows, s.rows - s.left_rows]), np.concatenate([bins, np.zeros((2, 256), bool)]),
        )


@dataclass(frozen=True)
class Split:
    """The best split of a leaf; ``total`` and ``left_total`` are sums of gradients in units."""

    gain: float
    feature: int
    left_bins: np.ndarray
    total: int
    rows: int
    left_total: int
    left_rows: int


# --- bins ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """How the columns become bins: upper ends of number bins, or the codes of category bins."""

    columns: tuple[str, ...]
    categories: frozenset[str]
    values: tuple[tuple[float, ...], ...]

    def apply(self, i: int, x: np.ndarray) -> np.ndarray:
        """Bins of column ``i``; NULL (NaN) is 0.  Codes without a bin of their own share the last."""
        ends = np.array(self.values[i])
        if self.columns[i] not in self.categories:
            out = 1 + np.searchsorted(ends, x, "left")
        elif len(ends):
            order = np.argsort(ends)
            at = np.minimum(np.searchsorted(ends[order], x), len(ends) - 1)
            out = np.where(ends[order][at] == x, 1 + order[at], len(ends) + 1)
        else:
            out = np.ones(len(x), np.int64)
        return np.where(np.isnan(x), 0, out).astype(np.uint8)


def summary(x: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and their weights that stand for ``x``: all distinct ones, or as many at even ranks."""
    x = np.sort(x[~np.isnan(x)])
    values, counts = np.unique(x, return_counts=True)
    if len(values) <= points:
        return values, counts
    edge = np.linspace(0, len(x), points + 1).astype(np.int64)
    return x[edge[1:] - 1], np.diff(edge)


def quantile_ends(values: np.ndarray, weights: np.ndarray, n: int) -> list[float]:
    """At most ``n`` upper ends of bins with like weights, the largest value left out."""
    order = np.argsort(values, kind="stable")
    values, upto = values[order], np.cumsum(weights[order])
    if not len(values):
        return []
    at = np.searchsorted(upto, upto[-1] * (np.arange(n) + 1) / (n + 1), "left")
    ends = np.unique(values[at])
    return ends[ends < values[-1]].tolist()


def fit_bins(df: DataFrame, columns: Sequence[str], categories: Sequence[str], params: BoostParams) -> Bins:
    """Quantile bins over all rows; bins of categories go to the most frequent codes.

    Tasks summarise each number by points at even ranks, 8 for each bin, of blocks of rows; the
    summaries of a number meet in one group.
    """
    numbers, ends = [c for c in columns if c not in set(categories)], {}
    n, points = params.bins - 2, 8 * params.bins

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def handed():
            out = [summary(np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]), points) for i in range(len(numbers))]
            return pa.RecordBatch.from_arrays(
                [pa.array(range(len(out)), pa.int32()), *[pa.array([x[k].astype(np.float64).tobytes() for x in out], pa.binary()) for k in (0, 1)]], names=["i", "values", "weights"]
            )

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield handed()
                held, rows = [], 0
        if held:
            yield handed()

    def meet(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, values, weights = 0, [], []
        for batch in group:
            for r in batch.select(["i", "values", "weights"]).to_pylist():
                i = r["i"]
                values.append(np.frombuffer(r["values"])), weights.append(np.frombuffer(r["weights"]))
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([quantile_ends(np.concatenate(values), np.concatenate(weights), n)], pa.list_(pa.float64()))], names=["i", "ends"])

    if numbers:
        rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(numbers)])
        met = rows.mapInArrow(summarise, "i int, values binary, weights binary").groupBy("i").applyInArrow(meet, "i int, ends array<double>")
        ends = {numbers[r.i]: tuple(r.ends) for r in met.collect()}  # at most ``bins`` of each column
    if categories:
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for c in categories])).alias("x")
        counts = df.select(values).where("x.v is not null").groupBy("x.c", "x.v").count()
        rank = F.row_number().over(Window.partitionBy("c").orderBy(F.col("count").desc(), "v"))
        for r in counts.withColumn("r", rank).where(F.col("r") <= n).orderBy("c", "r").collect():  # at most ``bins`` of each column
            ends[r.c] = (*ends.get(r.c, ()), r.v)
    return Bins(tuple(columns), frozenset(categories), tuple(ends.get(c, ()) for c in columns))


FLAGS = {"train": 0, "valid": 1}


def write_blocks(df: DataFrame, bins: Bins, label: str, path: str) -> None:
    """Blocks of the rows of ``df`` whose label is not NULL: bins, labels and whether a row trains, validates or neither (2)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, k = TaskContext.get().partitionId(), [], 0

        def block():
            x = np.concatenate([h[0] for h in held], axis=1)
            y, flag = (np.concatenate([h[j] for h in held]) for j in (1, 2))
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k]), pa.array([len(y)], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()), pa.array([flag.tobytes()], pa.binary())],
                names=["block", "n", "bins", "label", "flag"],
            )

        for batch in batches:
            to = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            x = np.stack([bins.apply(i, to(f"f{i}").astype(np.float64)) for i in range(len(bins.columns))])
            held.append((x, to("y"), to("flag").astype(np.uint8)))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield block()
                held, k = [], k + 1
        if held:
            yield block()

    flag = F.coalesce(*[F.when(F.col("split_flag") == name, F.lit(v)) for name, v in FLAGS.items()], F.lit(2))
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(bins.columns)], F.col(label).cast("double").alias("y"), flag.alias("flag"))
    rows.where("y is not null").mapInArrow(pack, "block long, n long, bins binary, label binary, flag binary").write.mode("overwrite").parquet(path)


# --- a level ---------------------------------------------------------------------------------


def kept_in_worker(run: str) -> tuple[dict, list]:
    """Predictions of a run's blocks in this Python worker, and the chunks of trees it has read."""
    module = sys.modules.setdefault("_demandspark_boost", types.ModuleType("_demandspark_boost"))
    if getattr(module, "run", None) != run:
        module.run, module.kept = run, ({}, [])
    return module.kept


def best_splits(sums: np.ndarray, features: Sequence[int], categorical: Sequence[bool], unit: float, p: BoostParams) -> list[tuple[int, Split]]:
    """The best split of each leaf among ``features``; ``sums``: features x leaves x bins x (gradient units, rows)."""
    out: list[tuple[int, Split]] = []
    for leaf in range(sums.shape[1]):
        best = None
        for i, f in enumerate(features):
            units, rows = sums[i, leaf, :, 0], sums[i, leaf, :, 1]
            total, n = int(units.sum()), int(rows.sum())
            if n < 2 * p.min_rows:
                continue
            l2 = p.l2
            if categorical[i]:
                l2 += CATEGORY_L2
                order = np.flatnonzero(rows)
                order = order[np.argsort(units[order] / (rows[order] + CATEGORY_SMOOTH), kind="stable")]
            else:
                order = np.arange(len(rows))
            left, count = np.cumsum(units[order])[:-1], np.cumsum(rows[order])[:-1]
            ok = (count >= p.min_rows) & (n - count >= p.min_rows)
            if not ok.any():
                continue
            gain = np.where(ok, worth(left * unit, count, p.l1, l2) + worth((total - left) * unit, n - count, p.l1, l2), -np.inf)
            k = int(np.argmax(gain))
            gained = float(gain[k] - worth(total * unit, n, p.l1, l2))
            if gained > 1e-12 and (best is None or gained > best.gain):
                mask = np.zeros(256, bool)
                mask[order[: k + 1]] = True
                best = Split(gained, f, mask, total, n, int(left[k]), int(count[k]))
        if best is not None:
            out.append((leaf, best))
    return out


def worth(g, n, l1: float, l2: float):
    return np.maximum(np.abs(g) - l1, 0.0) ** 2 / (n + l2)


def leaf_value(g: float, n: int, p: BoostParams) -> float:
    return -p.step * math.copysign(max(abs(g) - p.l1, 0.0), g) / (n + p.l2)


def level_of(run: str, trees: Sequence, tail: Sequence[Tree], tree: Tree, open_leaves: Sequence[int], features: Sequence[int], fitted: frozenset[int], base: float, unit: float, salt: tuple[int, ...], p: BoostParams, measure: bool):
    """Task: sums by leaf, feature and bin of its blocks, by groups of features; errors so far under -1."""

    def level(blocks: Iterable) -> Iterator[tuple[int, object]]:
        kept, kept_chunks = kept_in_worker(run)
        sums, errors = {}, [0, 0, 0, 0]
        for chunk in trees[len(kept_chunks) :]:
            kept_chunks.append(cloudpickle.loads(chunk.value))
        done = [t for chunk in kept_chunks[: len(trees)] for t in chunk] + list(tail)
        slot = np.full(len(tree.left), -1)
        slot[list(open_leaves)] = np.arange(len(open_leaves))
        groups = [features[g::GROUPS] for g in range(min(GROUPS, len(features)))]
        for block, n, raw, label, flags in blocks:
            bins = np.frombuffer(raw, np.uint8).reshape(-1, n)
            y, flag = np.frombuffer(label), np.frombuffer(flags, np.uint8)
            had, prediction = kept.get(block, (0, np.full(n, base)))
            if had > len(done):
                had, prediction = 0, np.full(n, base)
            for t in done[had:]:
                prediction = prediction + t.predict(bins)
            kept[block] = (len(done), prediction)
            g = prediction - y
            here = np.isin(flag, list(fitted))
            if measure:
                for k, rows in enumerate((here, flag == FLAGS["valid"])):
                    errors[2 * k] += int(np.rint(g[rows] ** 2 * (1 << 20)).sum())
                    errors[2 * k + 1] += int(rows.sum())
            if not open_leaves:
                continue
            here &= np.random.default_rng((*salt, block)).random(n) < p.row_fraction
            at = slot[tree.leaf_of(bins)]
            rows = np.flatnonzero(here & (at >= 0))
            units = np.clip(np.rint(g[rows] / unit), -2 * UNITS, 2 * UNITS)
            first = at[rows] * 256
            size = 256 * len(open_leaves)
            for k, group in enumerate(groups):
                own = sums.setdefault(k, np.zeros((len(group), size, 2), np.int64))
                for i, f in enumerate(group):
                    where = first + bins[f, rows]
                    own[i, :, 0] += np.bincount(where, units, size).astype(np.int64)
                    own[i, :, 1] += np.bincount(where, minlength=size)
        yield from sums.items()
        if measure:
            yield -1, np.array(errors, object)

    return level


# --- fitting ---------------------------------------------------------------------------------


@dataclass
class Boosting:
    """A fit over written blocks: trees so far, and the errors after each of them."""

    spark: SparkSession
    blocks: object
    bins: Bins
    params: BoostParams
    fitted: frozenset[int]
    name: str
    path: str
    trees: list[Tree] = field(default_factory=list)
    errors: list[tuple[float, float]] = field(default_factory=list)
    base: float = 0.0
    unit: float = 1.0
    chunks: list = field(default_factory=list)
    saved: int = 0
    #: Names this fit in the workers: one that goes on from saved trees starts anew there.
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def start(self) -> None:
        """Mean label and the unit of gradients; trees that an earlier fit has left."""
        flags = list(self.fitted)

        def of(blocks):
            for _, n, _, label, flag in blocks:
                y = np.frombuffer(label)[np.isin(np.frombuffer(flag, np.uint8), flags)]
                yield math.fsum(y), len(y), y.min(initial=np.inf), y.max(initial=-np.inf)

        parts = sorted(self.blocks.mapPartitions(of).collect())  # four numbers a block
        n = sum(p[1] for p in parts)
        if not n:
            raise ValueError("no rows to fit")
        self.base = math.fsum(p[0] for p in parts) / n
        widest = max(self.base - min(p[2] for p in parts), max(p[3] for p in parts) - self.base)
        self.unit = 2.0 ** math.ceil(math.log2(max(widest, 1e-300))) / UNITS
        self.trees, self.errors = read_trees(self.spark, self.path, self.name)
        self.saved = len(self.trees)

    def job(self, tree: Tree, open_leaves: Sequence[int], features: Sequence[int], measure: bool) -> dict[int, Split]:
        """One level: the best split of each open leaf."""
        while len(self.trees) - 32 * len(self.chunks) >= 32:
            k = 32 * len(self.chunks)
            self.chunks.append(self.spark.sparkContext.broadcast(cloudpickle.dumps(self.trees[k : k + 32])))  # by value
        tail = self.trees[32 * len(self.chunks) :]
        p, unit = self.params, self.unit
        names, categories = self.bins.columns, self.bins.categories
        salt = (p.seed, sum(map(ord, self.name)), len(self.trees))
        level = level_of(f"{self.path}/{self.name}/{self.token}", self.chunks, tail, tree, open_leaves, features, self.fitted, self.base, unit, salt, p, measure)
        groups = min(GROUPS, len(features))

        def chosen(item):
            k, sums = item
            if k < 0:
                return k, sums
            own = features[k::GROUPS]
            return k, best_splits(sums.reshape(len(own), -1, 256, 2), own, [names[f] in categories for f in own], unit, p)

        parts = max(1, min(groups, self.blocks.getNumPartitions()))
        found = dict(self.blocks.mapPartitions(level).reduceByKey(lambda a, b: a + b, parts).map(chosen).collect())
        if measure:
            e = found.pop(-1)
            self.errors.append(tuple(math.sqrt(e[k] / (1 << 20) / e[k + 1]) if e[k + 1] else math.nan for k in (0, 2)))
        best: dict[int, Split] = {}
        for k in sorted(found):
            for slot, s in found[k]:
                leaf = open_leaves[slot]
                if leaf not in best or (s.gain, -s.feature) > (best[leaf].gain, -best[leaf].feature):
                    best[leaf] = s
        return best

    def grow(self) -> bool:
        """One more tree; False if no split is worth it."""
        p, n = self.params, len(self.bins.columns)
        draw = np.random.default_rng((p.seed, len(self.trees)))
        features = sorted(draw.choice(n, max(1, math.ceil(p.feature_fraction * n)), replace=False).tolist())
        tree, open_leaves, depth = Tree.root(0.0, 0), [0], 0
        measure = len(self.errors) == len(self.trees)
        while open_leaves and depth < p.depth:
            best = self.job(tree, open_leaves, features, measure)
            measure = False
            left = p.leaves - int((tree.left < 0).sum())
            taken = sorted(best.items(), key=lambda x: (-x[1].gain, x[0]))[:left]
            open_leaves = []
            for node, s in taken:
                g = (s.left_total * self.unit, (s.total - s.left_total) * self.unit)
                rows = (s.left_rows, s.rows - s.left_rows)
                children = (len(tree.left), len(tree.left) + 1)
                tree = tree.split(node, s, (leaf_value(g[0], rows[0], p), leaf_value(g[1], rows[1], p)))
                open_leaves += [c for c, r in zip(children, rows, strict=True) if r >= 2 * p.min_rows]
            depth += 1
        if len(tree.left) == 1:
            return False
        self.trees.append(tree)
        if len(self.trees) - self.saved >= p.save_every:
            self.save()
        return True

    def run(self, rounds: int, patience: int | None) -> int:
        """Grow up to ``rounds`` trees; with patience, the best number of trees by validation error."""
        while len(self.trees) < rounds:
            if patience is not None and self.stopped(patience):
                break
            if not self.grow():
                break
        if len(self.errors) == len(self.trees):
            self.job(Tree.root(0.0, 0), [], [], True)
        self.save()
        return self.best()

    def best(self) -> int:
        valid = [v for _, v in self.errors]
        return int(np.nanargmin(valid)) if not all(map(math.isnan, valid)) else len(self.trees)

    def stopped(self, patience: int) -> bool:
        return len(self.errors) - 1 - self.best() >= patience if self.errors and not math.isnan(self.errors[-1][1]) else False

    def save(self) -> None:
        write_trees(self.spark, self.path, self.name, self.trees, self.errors, self.saved)
        self.saved = len(self.trees)


NODES = "fit string, tree int, node int, feature int, left int, right int, value double, gain double, rows long, left_bins binary"
ERRORS = "fit string, tree int, fit_error double, valid_error double"


def node_rows(name: str, trees: Sequence[Tree], first: int = 0) -> list[tuple]:
    return [
        (name, first + k, i, int(t.feature[i]), int(t.left[i]), int(t.right[i]), float(t.value[i]), float(t.gain[i]), int(t.rows[i]), np.packbits(t.left_bins[i]).tobytes())
        for k, t in enumerate(trees)
        for i in range(len(t.left))
    ]


def trees_of(rows: Sequence) -> list[Tree]:
    """Trees from node rows sorted by tree and node."""
    out, at = [], 0
    while at < len(rows):
        to = at
        while to < len(rows) and rows[to].tree == rows[at].tree:
            to += 1
        r = rows[at:to]
        col = lambda c: np.array([x[c] for x in r])
        bins = np.unpackbits(np.frombuffer(b"".join(bytes(x.left_bins) for x in r), np.uint8).reshape(len(r), 32), axis=1).astype(bool)
        out.append(Tree(col("feature"), col("left"), col("right"), col("value"), col("gain"), col("rows"), bins))
        at = to
    return out


def write_trees(spark: SparkSession, path: str, name: str, trees: Sequence[Tree], errors: Sequence, saved: int) -> None:
    """Append the trees from ``saved`` on, and their errors as far as known; one commit each."""
    if len(trees) > saved:
        spark.createDataFrame(node_rows(name, trees[saved:], saved), NODES).coalesce(1).write.mode("append").parquet(f"{path}/trees")
    known = [(name, k, float(a), float(b)) for k, (a, b) in enumerate(errors) if k >= saved]
    spark.createDataFrame(known, ERRORS).coalesce(1).write.mode("append").parquet(f"{path}/errors")


def there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_trees(spark: SparkSession, path: str, name: str) -> tuple[list[Tree], list[tuple[float, float]]]:
    """Trees and errors of an earlier fit, as far as both were written."""
    if not there(spark, f"{path}/trees"):
        return [], []
    nodes = spark.read.schema(NODES).parquet(f"{path}/trees").where(F.col("fit") == name).dropDuplicates(["tree", "node"]).orderBy("tree", "node").collect()  # the model
    trees, errors = trees_of(nodes), {}
    if there(spark, f"{path}/errors"):
        errors = {r.tree: (r.fit_error, r.valid_error) for r in spark.read.schema(ERRORS).parquet(f"{path}/errors").where(F.col("fit") == name).collect()}
    n = 0
    while n < len(trees) and n in errors:
        n += 1
    return trees[:n], [errors[k] for k in range(n)]


@dataclass(frozen=True)
class Boosted:
    """A fitted model: bins, mean and trees."""

    bins: Bins
    base: float
    trees: tuple[Tree, ...]
    errors: tuple[tuple[float, float], ...] = ()

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def predict(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Predictions of rows given as a float array a column."""
        bins = np.stack([self.bins.apply(i, x) for i, x in enumerate(columns)])
        out = np.full(bins.shape[1], self.base)
        for t in self.trees:
            out += t.predict(bins)
        return out

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table of the trees, with the names of the features of splits."""
        names = spark.createDataFrame(list(enumerate(self.bins.columns)), "feature int, name string")
        return spark.createDataFrame(node_rows("final", self.trees), NODES).drop("fit").join(F.broadcast(names), "feature", "left")

    def save(self, spark: SparkSession, path: str) -> None:
        """Three tables under ``path``: bins, nodes and the mean."""
        columns = [(i, c, c in self.bins.categories, list(map(float, self.bins.values[i]))) for i, c in enumerate(self.bins.columns)]
        spark.createDataFrame(columns, "place int, name string, category boolean, ends array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/bins")
        spark.createDataFrame(node_rows("final", self.trees), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.base,)], "base double").coalesce(1).write.mode("overwrite").parquet(f"{path}/base")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        columns = spark.read.parquet(f"{path}/bins").orderBy("place").collect()
        bins = Bins(tuple(r.name for r in columns), frozenset(r.name for r in columns if r.category), tuple(tuple(r.ends) for r in columns))
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        return Boosted(bins, spark.read.parquet(f"{path}/base").first().base, tuple(trees_of(nodes)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its prediction; only the features travel to Python."""
        model = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(self))
        kept: dict = {}

        @F.pandas_udf("double")
        def predicted(rows: pd.DataFrame) -> pd.Series:
            if not kept:
                kept["model"] = cloudpickle.loads(model.value)
            return pd.Series(kept["model"].predict([rows[c].to_numpy(np.float64) for c in rows.columns]))

        features = F.struct(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(self.bins.columns)])
        return df.withColumn(PREDICTION, predicted(features))


def fit_phases(df: DataFrame, features: Sequence[str], categories: Sequence[str], label: str, params: BoostParams, path: str | None = None) -> tuple[Boosted, int]:
    """Rounds by the validation split, then a fit on all rows but those of the test split with
    rounds scaled by the row ratio; returns the model and the rounds of the first fit.

    ``df`` holds no test rows.  With a ``path``, a fit that was interrupted goes on from there:
    blocks, bins and trees of it are read again, for the same data and settings.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, "boosting")
    if there(spark, f"{path}/base/_SUCCESS") and there(spark, f"{path}/blocks/_SUCCESS"):
        bins = Boosted.load(spark, path).bins
    else:
        bins = fit_bins(df, features, categories, params)
        Boosted(bins, 0.0, ()).save(spark, path)
        write_blocks(df, bins, label, f"{path}/blocks")
    table = spark.read.parquet(f"{path}/blocks")
    blocks = table.select("block", "n", "bins", "label", "flag").rdd.map(lambda r: (r[0], r[1], bytes(r[2]), bytes(r[3]), bytes(r[4]))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = Boosting(spark, blocks, bins, params, frozenset({FLAGS["train"]}), "first", path)
        first.start()
        best = max(1, first.run(params.max_iter, params.patience))
        sizes = dict(blocks.flatMap(lambda b: [(int(v), int(c)) for v, c in zip(*np.unique(np.frombuffer(b[4], np.uint8), return_counts=True))]).reduceByKey(lambda a, b: a + b).collect())
        rounds = max(1, int(best * sum(sizes.values()) / max(1, sizes.get(FLAGS["train"], 0))))
        second = Boosting(spark, blocks, bins, params, frozenset({0, 1, 2}), "second", path)
        second.start()
        second.run(rounds, None)
    finally:
        blocks.unpersist()
    return Boosted(bins, second.base, tuple(second.trees), tuple(first.errors)), best


def gain_importance(nodes: DataFrame) -> DataFrame:
    """Total gain of the splits on each feature, descending, from a node table with ``name``."""
    return (
        nodes.where("left >= 0").groupBy(F.col("name").alias("feature")).agg(F.sum("gain").alias("importance")).orderBy(F.col("importance").desc(), "feature")
    )
