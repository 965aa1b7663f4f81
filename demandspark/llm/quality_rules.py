"""Quality rules: statistics of whole texts, base rules on them, and an isolation forest.

The base rules reject short and repetitive texts.  For the others isolation forests over
groups of rule statistics (words and symbols, repetition, case and digits) give anomaly scores:
rows that few random splits isolate are anomalous.  The score of each forest from which a
document is rejected comes from labelled rows: forests are taken one after the other, the best
first, each with those labelled rows that the ones before it keep, and one that parts no poor
rows from good ones any more rejects nothing.

The statistics of all documents are written once.  Each tree is grown from the 256 of
all documents that pass the base rules with the smallest hashes for that tree, rows that
repeat counting once, as isolation forests are defined on small samples; the limits come from
all labelled documents.  Rules and scores cover all documents.

Defined results: a null or empty text has no words and fails the base rules.  Without
labelled rows of both labels every document that passes the base rules is kept.
Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.stage import running_totals, stage
from demandspark.llm.common import BASE, U64, byte_values, class_table, held_out, mix, pieces, ranges, renamed, shared, with_fields, word_bounds, word_hashes

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
TREES, TREE_ROWS = 100, 256
SEED = 7
#: The statistics the forest splits on, as logarithms of a share and the offset: word_chars/n_words,
#: n_symbols/n_words, n_dup_lines/lines, n_repeat_words/n_words, upper/word_chars, digits/word_chars, marks/n_words.
FEATURES, OFFSET = 7, 0.1
#: The statistics of each forest, and the least share of poor rows less that of good rows that its limit rejects.
GROUPS, LEAST_GAIN = ((0, 1, 6), (2, 3), (4, 5)), 0.05


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts of each row, as in COUNTS, and the logarithms of its shares."""
    rows = len(offsets) - 1
    per_row = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[offsets])
    is_word = class_table("space")[data]
    starts, ends, first = word_bounds(is_word, offsets)
    n_words = np.diff(first)
    lead = (data & 0xC0) != 0x80
    word_chars = per_row(lead & is_word)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    n_symbols = per_row(symbol[data])

    # Words in three-word windows that are found twice or more in their text.
    words = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(rows), n_words)
    inside = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    window = mix((words[inside] * BASE + words[inside + 1]) * BASE + words[inside + 2] + mix(row[inside].astype(U64)))
    _, which, count = np.unique(window, return_inverse=True, return_counts=True)
    steps = np.zeros(len(words) + 1, np.int32)
    again = inside[count[which] > 1]
    np.add.at(steps, again, 1)
    np.add.at(steps, again + 3, -1)
    n_repeat = np.diff(np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])[first])

    # Lines with a word that equal an earlier line of their text.
    breaks = data == 10
    l_starts, l_ends, l_first = word_bounds(~breaks, offsets)
    rel = (ranges(np.zeros(len(l_starts), np.int64), l_ends - l_starts)).astype(U64)
    place = ranges(l_starts, l_ends - l_starts)
    value = mix(byte_values()[data[place]] + rel * BASE)
    begin = np.cumsum(l_ends - l_starts) - (l_ends - l_starts)
    line = np.add.reduceat(value, begin) if len(begin) else np.zeros(0, U64)
    filled = np.diff(np.searchsorted(starts, np.append(l_starts, len(data)))) > 0 if len(l_starts) else np.zeros(0, bool)
    l_row = np.repeat(np.arange(rows), np.diff(l_first))
    key = mix(line + mix(l_row.astype(U64)))[filled]
    l_row = l_row[filled]
    n_lines = np.bincount(l_row, minlength=rows)
    _, once = np.unique(key, return_index=True)
    n_dup = n_lines - np.bincount(l_row[once], minlength=rows)

    counts = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], 1).astype(np.int64)
    n = np.maximum(n_words, 1)
    upper = per_row((data >= 65) & (data <= 90))
    digits = per_row((data >= 48) & (data <= 57))
    marks = per_row(lead & is_word & (data < 128) & ~((data >= 48) & (data <= 57)) & ~((data | 32) >= 97) | (data > 122) & (data < 128))
    chars = np.maximum(word_chars, 1)
    shares = np.stack([word_chars / n, n_symbols / n, n_dup / np.maximum(n_lines, 1), n_repeat / n, upper / chars, digits / chars, marks / n], 1)
    return counts, np.log(shares + OFFSET)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


@dataclass
class Forest:
    """Random trees as arrays (trees x nodes): feature (-1: leaf), split and path length of leaves."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    norm: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 to the minus mean path length over that of a random search tree; near 1 is anomalous."""
        total = np.zeros(len(x))
        at_row = np.arange(len(x))
        for f, s, p in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(f) + 1))):
                inner = f[node] >= 0
                right = x[at_row, np.maximum(f[node], 0)] >= s[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += p[node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n values."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(samples: list[np.ndarray], seed: int = SEED) -> Forest:
    """A tree from each sample."""
    rng = np.random.default_rng(seed)
    size = max(2, max(len(x) for x in samples))
    depth = int(np.ceil(np.log2(size)))
    nodes = 2 ** (depth + 1) - 1
    trees = len(samples)
    feature, split, path = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t, x in enumerate(samples):
        todo = [(0, 0, x)]
        while todo:
            node, level, part = todo.pop()
            spread = np.flatnonzero(part.max(0) > part.min(0)) if len(part) > 1 else np.zeros(0, int)
            if level == depth or not len(spread):
                path[t, node] = level + mean_path(len(part))
                continue
            f = int(rng.choice(spread))
            low, high = part[:, f].min(), part[:, f].max()
            s = rng.uniform(low, high)
            s = high if s <= low else s
            feature[t, node], split[t, node] = f, s
            right = part[:, f] >= s
            todo += [(2 * node + 1, level + 1, part[~right]), (2 * node + 2, level + 1, part[right])]
    return Forest(feature, split, path, max(mean_path(size), 1e-9))


@dataclass
class Forests:
    """A forest for each group of statistics."""

    parts: list[Forest]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """A column for each forest."""
        return np.stack([f.scores(x[:, list(g)]) for f, g in zip(self.parts, GROUPS, strict=True)], 1)


VALUES = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, x array<double>"
DRAWN = "tree int, key long, x array<double>"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in pieces(batches):
        counts, x = statistics(data, offsets)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(counts[:, i]) for i in range(len(COUNTS))], pa.array(base_failed(counts)), pa.array(list(x), pa.list_(pa.float64()))],
            names=["doc_id", *COUNTS, "base_failed", "x"],
        )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and x, the statistics of the forest, of each row of ``docs``; written."""
    docs = renamed(docs, doc_id="doc_id", text="text")
    return stage(docs.mapInArrow(_measured, with_fields(docs.select("doc_id").schema, VALUES)), "rule-statistics")


def _matrix(column) -> np.ndarray:
    return np.array([list(v) for v in column], np.float64).reshape(-1, FEATURES)


def _draw(trees: int, bound: int):
    """For each tree, the rows whose hash for it is up to ``bound``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mix(np.arange(1, trees + 1, dtype=U64) * BASE)
        for batch in batches:
            h = batch.column("h").to_numpy().astype(np.int64).view(U64)
            for lo in range(0, len(h), 8192):
                key = mix(h[lo : lo + 8192, None] ^ salts) >> U64(1)
                row, tree = np.nonzero(key <= U64(bound))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree.astype(np.int32)), pa.array(key[row, tree].astype(np.int64)), batch.column("x").take(pa.array(row + lo))], names=["tree", "key", "x"]
                )

    return run


def samples(measured: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS) -> list[np.ndarray]:
    """The rows of each tree: of all that pass the base rules those with the smallest hashes."""
    rows = measured.where("not base_failed").select(F.xxhash64("doc_id", *COUNTS, "x").alias("h"), "x").dropDuplicates(["h"])
    n = rows.count()
    # Twice as many as needed are expected under the bound; fewer than needed are as good as impossible.
    bound = (1 << 63) - 1 if n <= 2 * tree_rows else ((1 << 63) - 1) * 2 * tree_rows // n
    drawn = rows.mapInArrow(_draw(trees, bound), DRAWN).toPandas().sort_values(["tree", "key"])
    found = {t: _matrix(part["x"][:tree_rows]) for t, part in drawn.groupby("tree")}
    return [found.get(t, np.zeros((2, FEATURES))) for t in range(trees)]


def train(measured: DataFrame) -> Forests:
    """The forests from all documents, without limits."""
    drawn = samples(measured)
    return Forests([grow([x[:, list(g)] for x in drawn]) for g in GROUPS])


def scored(measured: DataFrame, forests: Forests) -> DataFrame:
    """The rows of ``measure`` with s, the score of each forest; written."""
    sent = shared(measured.sparkSession, forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(sent.value.scores(x)), pa.list_(pa.float64()))], names=[*batch.schema.names, "s"])

    return stage(measured.mapInArrow(run, with_fields(measured.schema, "s array<double>")), "rule-scores")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """good and the scores of each document that passes the base rules and is labelled, for each of its labels; written."""
    known = renamed(labels, doc_id="doc_id", quality="quality").where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    found = rows.where("not base_failed").join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct("x", "s")).alias("m"))
    return stage(found.select((F.col("quality") == 1).alias("good"), F.col("m.s").alias("s")), "rule-labels")


def best_cuts(rows: DataFrame, forests: list[int]) -> dict[int, tuple[float, int, int]]:
    """For each forest the score that best parts good from poor rows, both weighing the same, and
    the good and poor rows that reach it; ties: the highest.  Infinite if no score parts them.

    Scores are counted and get running totals over range partitions, so that rows are not gathered.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("s")[k].alias("score")) for k in forests])).alias("p")
    counts = rows.select("good", pairs).groupBy("p.k", "p.score").agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("poor"))
    counts = stage(counts, "rule-counts")
    whole = {r.k: (r.good, r.poor, r.top) for r in counts.groupBy("k").agg(F.sum("good").alias("good"), F.sum("poor").alias("poor"), F.max("score").alias("top")).collect()}
    if not all(good and poor for good, poor, _ in whole.values()):
        return {k: (float("inf"), 0, 0) for k in whole}
    n_good, n_poor, _ = next(iter(whole.values()))  # the same rows for each forest
    below = running_totals(counts, ["k"], "score", {"good": F.col("good"), "poor": F.col("poor")}, "rule-totals")
    gain = F.col("good") / F.lit(n_good) + 1 - F.col("poor") / F.lit(n_poor)
    best = {r.k: r.m for r in below.groupBy("k").agg(F.max(F.struct(gain.alias("gain"), "score", "good", "poor")).alias("m")).collect()}
    after = counts.groupBy("k").agg(*[F.min(F.when((F.col("k") == k) & (F.col("score") > m.score), F.col("score"))).alias(f"after{k}") for k, m in best.items()])
    after = {r.k: r[f"after{r.k}"] for r in after.collect()}
    return {k: (float("inf"), 0, 0) if after[k] is None else ((after[k] + m.score) / 2, n_good - m.good, n_poor - m.poor) for k, m in best.items()}


def limits_of(known: DataFrame, n: int = len(GROUPS)) -> list[float]:
    """The limit of each forest from all labelled rows, the best forest first."""
    limits, open_ = [float("inf")] * n, set(range(n))
    number = known.groupBy("good").count().collect()
    n_good, n_poor = (max(1, sum(r["count"] for r in number if r.good is good)) for good in (True, False))
    while open_:
        left = known.where(passing(limits))
        if left.where("not good").isEmpty():
            break
        found = [(poor / n_poor - good / n_good, -k, limit) for k, (limit, good, poor) in best_cuts(left, sorted(open_)).items()]
        gain, k, limit = max(found)
        if gain < LEAST_GAIN:
            break
        limits[-k] = limit
        open_.discard(-k)
    return limits


def passing(limits: list[float]) -> Column:
    """Whether the scores stay below all limits."""
    return reduce(lambda a, b: a & b, [F.col("s")[k] < F.lit(v) for k, v in enumerate(limits)])


def rules_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the counts, the base rules' verdict and the final one, with the anomaly score (the highest of the forests')."""
    measured = measure(docs)
    rows = scored(measured, train(measured))
    kept = ~F.col("base_failed") & passing(limits_of(labelled(rows, labels)))
    return rows.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), F.array_max("s").alias("anomaly"))
