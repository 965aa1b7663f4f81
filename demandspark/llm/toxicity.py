"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are hashed n-grams of the UTF-8 bytes of the lower-cased text; a feature is
present or not.  From the labelled rows come the smoothed log-count ratios r of the
features; those whose ratio is far from zero and that are not rare are kept and a logistic regression on
r * presence is trained on them.  Scoring looks up the kept features of whole texts.

The classifier is fitted on a bounded sample of labelled rows (``max_rows`` of each
label, in the order of a hash of doc_id); everything is scored.

Defined results: a null or empty text has no features and gets the score of the
intercept.  Without labelled rows of both labels every score is the share of label 1
(0 without any).  Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import U64, byte_values, held_out, lean, lower_table, mix, pieces, ranges, renamed, replacing, rolling, shared, text_bytes, with_fields

ORDERS = (4, 5, 6)
#: A feature must be in this share of the rows of the rarer label, and in this many rows.
LEAST_SHARE, LEAST_ROWS = 0.025, 3
BITS = 20
MAX_ROWS = 1500


@dataclass
class Toxicity:
    """Feature weights (r times the regression's weight), by hashed n-gram, and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, feature = present(data, offsets, self.weights != 0)
        z = np.bincount(row, self.weights[feature], minlength=len(offsets) - 1) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the feature at each position and whether its n-gram lies within one text.

    Every text is read with a blank before and after it, so that its first and last words look like others.
    """
    rows = len(offsets) - 1
    lower = lower_table()[data]
    lower[(lower >= 9) & (lower <= 13)] = 32
    padded = np.insert(lower, np.repeat(offsets, [1, *[2] * (rows - 1), 1]) if rows else [], 32)
    at = offsets + 2 * np.arange(rows + 1)
    values = byte_values()[padded]
    for n in ORDERS:
        h = (mix(rolling(values, n) + U64(n)) >> U64(64 - BITS)).astype(np.int32)
        inside = np.ones(len(h) + n, bool)
        for j in range(1, n):
            inside[np.maximum(at[1:] - j, 0)] = False
        yield h, inside[: len(h)], at


def present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, feature) pairs, of the wanted features only."""
    keys = []
    for h, inside, at in grams(data, offsets):
        p = np.flatnonzero(inside if wanted is None else wanted[h] & inside)
        row = np.searchsorted(at, p, "right") - 1
        keys.append(np.unique(row.astype(np.int64) << BITS | h[p]))
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


def _blocks(texts: list[str], size: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for i in range(0, len(texts), size):
        yield i, *text_bytes(pa.array(texts[i : i + size], pa.string()))


def fit(texts: list[str], labels: np.ndarray, smooth: float = 1.0, least_ratio: float = 2.0, least_share: float = LEAST_SHARE, penalty: float = 1e-4, steps: int = 150) -> Toxicity:
    """Log-count ratios, the choice of features and the regression, on the sample."""
    labels = np.asarray(labels, np.float64)
    n1, n0 = labels.sum(), (1 - labels).sum()
    weights = np.zeros(1 << BITS, np.float32)
    if not n1 or not n0:
        share = n1 / max(1, n1 + n0)
        return Toxicity(weights, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    counts = np.zeros((2, 1 << BITS))
    for i, data, offsets in _blocks(texts):
        row, feature = present(data, offsets, None)
        for y in (0, 1):
            counts[y] += np.bincount(feature[labels[i + row] == y], minlength=1 << BITS)
    p, q = (counts[1] + smooth) / (n1 + 2 * smooth), (counts[0] + smooth) / (n0 + 2 * smooth)
    ratio = np.log(p / q)
    wanted = (np.abs(ratio) >= least_ratio) & (counts.sum(0) >= max(LEAST_ROWS, least_share * min(n1, n0)))
    rows, features = [], []
    for i, data, offsets in _blocks(texts):
        row, feature = present(data, offsets, wanted)
        rows.append(row + i)
        features.append(feature)
    row, feature = np.concatenate(rows), np.concatenate(features)
    chosen = np.flatnonzero(wanted)
    column = np.searchsorted(chosen, feature)
    x = ratio[feature]
    # Both labels weigh the same; Adam on the full sample.
    share = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    w, b = np.zeros(len(chosen)), 0.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[column] * x, minlength=len(labels)) + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * share
        g = np.append(np.bincount(column, e[row] * x, minlength=len(chosen)) + penalty * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    weights[chosen] = w * ratio[chosen]
    return Toxicity(weights, float(b))


#: Bytes of a text that a sample may hold; longer ones are not learned from.
LONGEST = 1 << 17


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[list[str], np.ndarray]:
    """At most ``max_rows`` texts of each label of the rows that are not held out, in the order of a hash.

    Rows that repeat a doc_id give one text for each of its labels, the smallest, so that the
    sample is bounded by max_rows * LONGEST bytes a label.
    """
    known = renamed(labels, doc_id="doc_id", label=label).where(F.col("label").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    # The rank is cut in each task before the shuffle, so that a frequent label stays small.
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.withColumn("rank", rank).where(F.col("rank") <= max_rows).select("doc_id", "label")
    texts = renamed(docs, doc_id="doc_id", text="text").where(F.octet_length("text") <= LONGEST)  # not null
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label").toPandas()
    rows = rows.sort_values(["text", "label"], kind="stable")
    return rows["text"].tolist(), rows["label"].to_numpy()


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Toxicity:
    return fit(*labelled_sample(docs, labels, label, max_rows))


def score(docs: DataFrame, model: Toxicity, column: str = "toxicity") -> DataFrame:
    """``docs`` and the score of each row's ``text``, which replaces a column of that name."""
    docs = replacing(docs, f"{column} double")
    names, sent = docs.columns, shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.scores(data, offsets), pa.float64())], names=[*names, column])

    return docs.mapInArrow(lean(run), with_fields(docs.schema, f"{column} double"))


def toxicity_digest(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """Per document: whether its label may not be learned from, the score and the verdict."""
    scored = score(renamed(docs, doc_id="doc_id", text="text"), train(docs, labels), "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """The documents that score below the limit."""
    scored = score(docs, train(docs, labels), "__toxicity")
    return scored.where(F.col("__toxicity") < limit).drop("__toxicity")
