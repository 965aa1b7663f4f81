"""Hard-negative mining: exact integer scores by residue-number-system products, then windowed selection.

1. *Numbers.*  Each component becomes floor(256 * x).  A score is the integer inner product
   of two rows.
2. *Products.*  Anchors and rows are reduced modulo a few primes below 1024, to centred
   residues.  A float32 matrix product of 64 components of them stays below 2^24 and so is
   exact.  As many primes are taken as the largest possible score (the product of the norms)
   asks for, and the signed score follows from its residues by Chinese remaindering, in
   symmetric mixed radix.
3. *Selection.*  A first pass over all rows finds the positives of each anchor.  Each
   positive gives a window of scores, and a second pass finds the best rows of other labels
   in it.  A task keeps the best few of each anchor (or window) only; the tasks' finds are
   ranked by a window function.

Anchors are dealt into groups of a bounded number of bytes by the hash of their id; a group is
broadcast and meets all rows in blocks.  Rows are never shuffled.

Defined results: rows with a null id, label or vector, or with a null or non-finite component
take no part, nor do rows whose integer vector has a norm of 2^31 or more (their scores could
exceed 64 bits).  Vectors of different lengths are compared as if the shorter one went on with
zeros.  Rows that repeat an id are judged one by one; of anchors that are the same in everything
one is an anchor, and the others are rows like any other.  Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.stage import fresh_path
from demandspark.llm.common import renamed, shards

#: Numbers of a group of anchors, 4 bytes each, and rows or anchors that are multiplied at once.
GROUP_BYTES = 16 << 20
ROW_BLOCK, ANCHOR_BLOCK = 2048, 256
#: Components that one float32 product adds up: 64 * 511 * 511 < 2^24.
DEPTH, PRIME_LIMIT = 64, 1024
NORM_LIMIT = float(1 << 31)
LOWEST = np.iinfo(np.int64).min


# --- numbers -------------------------------------------------------------------------------


def primes_below(limit: int) -> list[int]:
    """All primes below ``limit``, largest first."""
    sieve = np.ones(limit, bool)
    sieve[:2] = False
    for i in range(2, math.isqrt(limit) + 1):
        sieve[i * i :: i] &= not sieve[i]
    return [int(p) for p in np.flatnonzero(sieve)[::-1]]


def moduli(bound: float) -> list[int]:
    """The fewest of the largest primes whose product exceeds twice ``bound``."""
    out, product = [], 1
    for p in primes_below(PRIME_LIMIT):
        if product > 2 * bound + 2:
            break
        out.append(p)
        product *= p
    return out


def integers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """vec_id, label and integer vectors (int64, padded with zeros) of the rows that take part."""
    column = batch.column("embedding")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ids, labels = (batch.column(c) for c in ("vec_id", "label"))
    there = ~np.asarray(ids.is_null()) & ~np.asarray(labels.is_null()) & ~np.asarray(column.is_null())
    length = np.asarray(column.value_lengths().fill_null(0), np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)
    scaled = np.floor(values * 256.0)
    there[row[~np.isfinite(values) | ~(np.abs(scaled) < NORM_LIMIT)]] = False
    matrix = np.zeros((len(length), max(int(length.max(initial=0)), 1)), np.float64)
    matrix[row, place] = np.where(there[row], scaled, 0.0)
    there &= np.sqrt((matrix**2).sum(1)) < NORM_LIMIT
    ids, labels = (x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, labels))
    return ids[there], labels[there], matrix[there].astype(np.int64)


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, max(0, width - matrix.shape[1]))))


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Centred residues modulo the odd prime ``p``, as float32."""
    half = (p - 1) // 2
    return ((matrix + half) % p - half).astype(np.float32)


class Residues:
    """Rows of integers modulo primes: exact products with other rows."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        self.norm = float(np.sqrt((matrix.astype(np.float64) ** 2).sum(1)).max(initial=0.0))
        self.kept: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.kept:
            self.kept[p] = residues(self.matrix, p)
        return self.kept[p]

    def part(self, lo: int, hi: int) -> Residues:
        out = Residues(self.matrix[lo:hi])
        out.kept = {p: r[lo:hi] for p, r in self.kept.items()}
        return out


def products(a: Residues, b: Residues) -> np.ndarray:
    """The exact inner products of the rows of ``a`` with those of ``b`` (int64)."""
    primes = moduli(a.norm * b.norm * (1 + 1e-9))
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        x, y = a.modulo(p), b.modulo(p)
        width = min(x.shape[1], y.shape[1])
        total = np.zeros((len(x), len(y)), np.int64)
        for lo in range(0, width, DEPTH):
            total += (x[:, lo : min(lo + DEPTH, width)] @ y[:, lo : min(lo + DEPTH, width)].T).astype(np.int64)
        # mixed radix: subtract the digits so far, divide by their primes, all modulo p
        for digit, q in zip(digits, primes[:k], strict=True):
            total = (total - digit) % p * pow(q, -1, p)
        half = (p - 1) // 2
        digits.append((total + half) % p - half)
    out = np.zeros((len(a.matrix), len(b.matrix)), np.int64)
    for digit, p in zip(digits[::-1], primes[::-1], strict=True):
        out = out * np.int64(p) + digit
    return out


# --- the best few of each slot ---------------------------------------------------------------


class Best:
    """For each slot the ``k`` finds with the highest scores, ties by smaller id."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.score = np.full((slots, k), LOWEST, np.int64)
        self.id = np.full((slots, k), np.iinfo(np.int64).max, np.int64)
        self.own = np.zeros((slots, k), bool)

    def add(self, first: int, scores: np.ndarray, usable: np.ndarray, ids: np.ndarray, own: np.ndarray | None = None) -> None:
        """Finds of the slots from ``first`` on: a row of ``scores`` each, as far as ``usable``."""
        k, slots = self.k, len(scores)
        usable = usable & (scores >= self.score[first : first + slots, -1:])
        crowded = np.flatnonzero(usable.sum(1) > 4 * k)
        if len(crowded):
            # Most of them are behind the k-th of the block itself.
            part = np.where(usable[crowded], scores[crowded], LOWEST)
            kth = np.partition(part, part.shape[1] - k, axis=1)[:, part.shape[1] - k]
            usable[crowded] &= part >= kth[:, None]
        slot, column = np.nonzero(usable)
        if not len(slot):
            return
        touched = np.unique(slot)
        old = np.repeat(touched, k)
        s = np.concatenate([scores[slot, column], self.score[first + touched].ravel()])
        i = np.concatenate([ids[column], self.id[first + touched].ravel()])
        o = np.concatenate([own[slot, column] if own is not None else np.zeros(len(slot), bool), self.own[first + touched].ravel()])
        at = np.concatenate([slot, old])
        order = np.lexsort((~o, i, ~s, at))
        at, s, i, o = at[order], s[order], i[order], o[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at, "left")
        keep = rank < k
        self.score[first + at[keep], rank[keep]] = s[keep]
        self.id[first + at[keep], rank[keep]] = i[keep]
        self.own[first + at[keep], rank[keep]] = o[keep]

    def finds(self) -> tuple[np.ndarray, ...]:
        slot, column = np.nonzero(self.score > LOWEST)
        return slot, self.score[slot, column], self.id[slot, column], self.own[slot, column]


# --- tasks -----------------------------------------------------------------------------------


def blocks(batches: Iterator[pa.RecordBatch], relabel: Callable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROW_BLOCK):
            ids, labels, matrix = integers(batch.slice(lo, ROW_BLOCK))
            if len(ids):
                yield ids, relabel(ids, labels), matrix


def positives_of(group, n: int, relabel: Callable):
    """Task: the ``n`` + 1 best rows of the anchors' own labels, the anchor itself among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix = group.value
        anchors, best = Residues(matrix), Best(len(ids), n + 1)
        for row_ids, row_labels, rows in blocks(batches, relabel):
            width = max(matrix.shape[1], rows.shape[1])
            block = Residues(rows)
            for p in moduli(anchors.norm * block.norm * (1 + 1e-9)):
                anchors.modulo(p)
            for lo in range(0, len(ids), ANCHOR_BLOCK):
                part = slice(lo, lo + ANCHOR_BLOCK)
                own = np.zeros((len(ids[part]), len(row_ids)), bool)
                for i, j in zip(*np.nonzero((ids[part][:, None] == row_ids) & (labels[part][:, None] == row_labels)), strict=True):
                    own[i, j] = np.array_equal(widened(matrix[lo + i : lo + i + 1], width), widened(rows[j : j + 1], width))
                best.add(lo, products(anchors.part(lo, lo + ANCHOR_BLOCK), block), labels[part][:, None] == row_labels, row_ids, own)
        slot, score, found, own = best.finds()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), pa.array(found), pa.array(own)], names=["slot", "score", "id", "own"])

    return run


def negatives_of(group, windows, n: int, relabel: Callable):
    """Task: the ``n`` best rows of other labels in each window (slot of the anchor, lowest and highest score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix = group.value
        slot, low, high = windows.value  # sorted by slot
        anchors, best = Residues(matrix), Best(len(slot), n)
        edge = np.searchsorted(slot, np.arange(0, len(ids) + ANCHOR_BLOCK, ANCHOR_BLOCK))
        for row_ids, row_labels, rows in blocks(batches, relabel):
            block = Residues(rows)
            for p in moduli(anchors.norm * block.norm * (1 + 1e-9)):
                anchors.modulo(p)
            for b, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
                if lo < hi:
                    scores = products(anchors.part(b * ANCHOR_BLOCK, (b + 1) * ANCHOR_BLOCK), block)[slot[lo:hi] - b * ANCHOR_BLOCK]
                    usable = (scores >= low[lo:hi, None]) & (scores <= high[lo:hi, None]) & (labels[slot[lo:hi]][:, None] != row_labels)
                    best.add(lo, scores, usable, row_ids)
        window, score, found, _ = best.finds()
        yield pa.RecordBatch.from_arrays([pa.array(window), pa.array(score), pa.array(found)], names=["window", "score", "id"])

    return run


def distinct_anchors(rows: pa.Table, relabel: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """vec_id, label and integers of the anchors, each once, sorted."""
    parts = [integers(b) for b in rows.combine_chunks().to_batches()] or [(np.zeros(0, np.int64),) * 2 + (np.zeros((0, 1), np.int64),)]
    width = max(m.shape[1] for _, _, m in parts)
    ids, labels, matrix = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([widened(p[2], width) for p in parts])
    all_of = np.concatenate([ids[:, None], relabel(ids, labels)[:, None], matrix], 1)
    all_of = np.unique(all_of, axis=0)
    return all_of[:, 0], all_of[:, 1], np.ascontiguousarray(all_of[:, 2:])


# --- the operator ----------------------------------------------------------------------------

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, relabel: Callable | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Hard negatives of each anchor and positive of ``vectors`` (vec_id, embedding, label).

    Anchors are rows whose vec_id is divisible by ``every``; their positives the first
    ``n_positives`` other rows of the same label.  Negatives are the first ``n_negatives`` rows
    of other labels with low_percent * positive_score <= 100 * negative_score <= 100 *
    positive_score.  ``relabel`` (ids, labels -> labels, numpy) changes labels beforehand.
    """
    spark = vectors.sparkSession
    relabel = relabel or (lambda ids, labels: labels)
    rows = renamed(vectors, vec_id="vec_id", embedding="embedding", label="label").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    chosen = rows.where(F.col("vec_id") % every == 0)
    n, numbers = chosen.agg(F.count("*"), F.sum(F.greatest(F.size("embedding"), F.lit(1)))).first()
    groups = shards(4 * (numbers or 0), group_bytes)
    path = fresh_path(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for g in range(groups):
        anchors = distinct_anchors(chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).toArrow(), relabel)  # about group_bytes
        ids = anchors[0]
        if not len(ids):
            continue
        group = spark.sparkContext.broadcast(anchors)
        found = rows.mapInArrow(positives_of(group, n_positives, relabel), "slot long, score long, id long, own boolean")
        first = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id", F.col("own").desc())
        ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n_positives + 1).toArrow()  # n_positives + 1 of each anchor
        at = np.lexsort((ranked["rank"].to_numpy(), ranked["slot"].to_numpy()))
        slot, score, other, own = (ranked[c].to_numpy()[at] for c in ("slot", "score", "id", "own"))
        # the anchor itself goes: the first of the rows that are the same in everything
        own_rank = np.cumsum(own) - np.where(np.searchsorted(slot, slot) > 0, np.cumsum(own)[np.searchsorted(slot, slot) - 1], 0)
        keep = ~(own & (own_rank == 1))
        slot, score, other = slot[keep], score[keep], other[keep]
        keep = (np.arange(len(slot)) - np.searchsorted(slot, slot) < n_positives) & (score >= 0)  # a negative score leaves no window
        slot, score, other = slot[keep], score[keep], other[keep]
        if not len(slot):
            continue
        low = -(-np.array([low_percent * int(s) for s in score], object) // 100)
        windows = spark.sparkContext.broadcast((slot, low.astype(np.int64), score))
        pairs = pa.table({"window": np.arange(len(slot)), "anchor_id": ids[slot], "positive_id": other, "positive_score": score})
        near = rows.mapInArrow(negatives_of(group, windows, n_negatives, relabel), "window long, score long, id long")
        best = Window.partitionBy("window").orderBy(F.col("score").desc(), "id")
        ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
        result = ranked.join(spark.createDataFrame(pairs), "window").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        result.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


def seventh_next(ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The query's labels: where the id is divisible by 7, the next of ten."""
    return np.where(ids % 7 == 0, np.fmod(labels + 1, 10), labels)
