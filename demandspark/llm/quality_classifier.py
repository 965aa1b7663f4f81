"""Quality classifier: ordinal regression on graded ratings (cumulative links).

One linear score of hashed text features is shared by all grades; ordered thresholds
cut it: P(grade <= k) = sigmoid(threshold_k - score).  The model gives the expected
grade and the probability of reaching a grade, by which documents are selected.

The features are hashed byte 4-grams (case and punctuation included) of the whole
text, as shares of its length, and the logarithm of that length; the score therefore
is a mean of weights over all positions.

The regression is fitted on a bounded sample of labelled rows (``max_rows`` of each
grade, by a hash of doc_id); everything is scored.

Defined results: a null or empty text has no n-grams and is scored by its length
alone.  Without at least two grades among the labels all documents get the one grade
(0 if there is none).  Labels with a null doc_id or grade are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import U64, byte_values, held_out, mix, pieces, renamed, replacing, rolling, shared, text_bytes, with_fields
from demandspark.llm.toxicity import labelled_sample

ORDER = 4
BITS = 16
MAX_ROWS = 1500
#: Weights are learned for shares of positions; this scale makes them comparable to the length's weight.
SCALE = 30.0


@dataclass
class Ordinal:
    """Weights of the features and of the length, the ordered thresholds, the grades they part."""

    weights: np.ndarray
    length_weight: float
    thresholds: np.ndarray
    grades: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total, n = positions(data, offsets, lambda h: self.weights[h])
        return SCALE * total / np.maximum(n, 1) + self.length_weight * length_feature(offsets)

    def reach(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for every grade but the lowest, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -30, 30)))


def length_feature(offsets: np.ndarray) -> np.ndarray:
    return np.log1p(np.diff(offsets)) / 10 - 0.7


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The feature at each position where an n-gram lies within one text, and its row."""
    h = (mix(rolling(byte_values()[data], ORDER)) >> U64(64 - BITS)).astype(np.int32)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[: len(h)] == row[ORDER - 1 : ORDER - 1 + len(h)]
    return h[inside], row[: len(h)][inside]


def positions(data: np.ndarray, offsets: np.ndarray, value) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``value`` of the features over each row's positions, and their number."""
    h, row = features(data, offsets)
    rows = len(offsets) - 1
    return np.bincount(row, value(h), minlength=rows), np.bincount(row, minlength=rows)


def fit(texts: list[str], grades: np.ndarray, steps: int = 200, rate: float = 0.05, penalty: float = 1e-5) -> Ordinal:
    """Maximum likelihood of the cumulative-link model by Adam on the whole sample."""
    levels = np.unique(np.asarray(grades))
    if len(levels) < 2:
        return Ordinal(np.zeros(1 << BITS), 0.0, np.zeros(0), levels if len(levels) else np.zeros(1))
    y = np.searchsorted(levels, grades)
    rows, cols, shares, lengths = [], [], [], []
    for i in range(0, len(texts), 256):
        data, offsets = text_bytes(pa.array(texts[i : i + 256], pa.string()))
        h, row = features(data, offsets)
        key, count = np.unique(row.astype(np.int64) << BITS | h, return_counts=True)
        n = np.bincount(row, minlength=len(offsets) - 1)
        rows.append((key >> BITS) + i)
        cols.append(key & ((1 << BITS) - 1))
        shares.append(SCALE * count / n[key >> BITS])
        lengths.append(length_feature(offsets))
    row, col, x, length = (np.concatenate(a) for a in (rows, cols, shares, lengths))
    del rows, cols, shares
    k = len(levels)
    # Every grade weighs the same.
    weight = 1 / np.bincount(y)[y] / k
    # Thresholds t_0, t_0 + e^d_1, ...: ordered whatever the parameters are.
    params = np.concatenate([np.zeros((1 << BITS) + 1), [-0.5 * (k - 2)], np.zeros(k - 2)])
    d = 1 << BITS
    m, v = np.zeros_like(params), np.zeros_like(params)
    sig = lambda t: 1 / (1 + np.exp(-np.clip(t, -30, 30)))
    for step in range(1, steps + 1):
        steps_up = np.exp(params[d + 2 :])
        cuts = params[d + 1] + np.concatenate([[0], np.cumsum(steps_up)])
        z = np.bincount(row, params[:d][col] * x, minlength=len(y)) + params[d] * length
        below = np.where(y > 0, sig(cuts[np.maximum(y - 1, 0)] - z), 0.0)
        upto = np.where(y < k - 1, sig(cuts[np.minimum(y, k - 2)] - z), 1.0)
        likely = np.maximum(upto - below, 1e-9)
        d_up, d_low = upto * (1 - upto) / likely * weight, below * (1 - below) / likely * weight
        gz = d_up - d_low
        g_cuts = np.bincount(np.minimum(y, k - 2), np.where(y < k - 1, -d_up, 0), minlength=k - 1) + np.bincount(np.maximum(y - 1, 0), np.where(y > 0, d_low, 0), minlength=k - 1)
        tails = np.cumsum(g_cuts[::-1])[::-1]
        g = np.concatenate([np.bincount(col, gz[row] * x, minlength=d) + penalty * params[:d], [gz @ length, tails[0]], tails[1:] * steps_up])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    cuts = params[d + 1] + np.concatenate([[0], np.cumsum(np.exp(params[d + 2 :]))])
    return Ordinal(params[:d], float(params[d]), cuts, levels)


def graded(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Graded ratings of two 0/1 labels: 0 poor, 1 good but toxic, 2 good."""
    q, t = F.col(quality), F.coalesce(F.col(toxic), F.lit(0))
    return labels.select(F.col(doc_id).alias("doc_id"), F.when(q == 0, 0).when(q == 1, F.when(t == 1, 1).otherwise(2)).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, max_rows: int = MAX_ROWS) -> Ordinal:
    return fit(*labelled_sample(docs, ratings, "grade", max_rows))


def grade(docs: DataFrame, model: Ordinal) -> DataFrame:
    """``docs`` with expected_grade and, per grade above the lowest, the probability of reaching it; these replace columns of the same names."""
    fields = "expected_grade double, reach array<double>"
    docs = replacing(docs, fields)
    names, sent = docs.columns, shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch, data, offsets in pieces(batches):
            reach = model.reach(model.scores(data, offsets))
            expected = model.grades[0] + reach @ np.diff(model.grades)
            tails = pa.array(list(reach), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(expected, pa.float64()), tails], names=[*names, "expected_grade", "reach"])

    return docs.mapInArrow(run, with_fields(docs.schema, fields))


def tail_probability(model: Ordinal, least: float) -> Column:
    """P(grade >= least) from the column ``reach``."""
    above = int(np.searchsorted(model.grades, least))
    if above == 0:
        return F.lit(1.0)
    if above >= len(model.grades):
        return F.lit(0.0)
    return F.element_at("reach", above)


def quality_digest(docs: DataFrame, labels: DataFrame, least: float = 1, limit: float = 0.5) -> DataFrame:
    """Per document: expected grade, probability of grade ``least`` or better, and whether it is kept."""
    model = train(docs, graded(labels))
    scored = grade(renamed(docs, doc_id="doc_id", text="text"), model)
    tail = tail_probability(model, least)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", tail.alias("tail_probability"), (tail >= limit).alias("kept"))
