"""Limits of op5 from all labelled rows; edges that meet in a task become stars."""

import numpy as np
import pyarrow as pa

from demandspark.llm import quality_rules as Q
from demandspark.llm.graph import connected


def plain_limits(x, good):
    """The limits as defined, row by row."""
    left, open_, limits = np.ones(len(x), bool), set(range(x.shape[1])), [np.inf] * x.shape[1]
    while open_:
        found = []
        for k in open_:
            cuts = [*np.unique(x[left, k]), np.inf]
            gains = [(left & good & (x[:, k] < c)).sum() / (left & good).sum() + 1 - (left & ~good & (x[:, k] < c)).sum() / (left & ~good).sum() for c in cuts]
            i = max(range(len(cuts)), key=lambda i: (gains[i], i))
            limit = cuts[i] if np.isinf(cuts[i]) or not i else (cuts[i] + cuts[i - 1]) / 2
            gone = left & (x[:, k] >= limit)
            found.append(((gone & ~good).sum() / (~good).sum() - (gone & good).sum() / good.sum(), -k, limit))
        gain, k, limit = max(found)
        if gain < Q.LEAST_GAIN:
            break
        limits[-k], left = limit, left & (x[:, -k] < limit)
        open_.discard(-k)
    return limits


def test_limits_come_from_all_labelled_rows(spark):
    rng = np.random.default_rng(4)
    good = rng.random(6000) < 0.6
    x = np.round(rng.normal(np.where(good[:, None], [0.4, 0.5, 0.5], [0.4, 0.6, 0.55]), 0.08), 2)
    rows = spark.createDataFrame([(bool(g), v.tolist()) for g, v in zip(good, x, strict=True)], "good boolean, s array<double>").repartition(5)
    got = Q.limits_of(rows)
    assert got == plain_limits(x, good) and sum(np.isfinite(got)) >= 1
    one = spark.createDataFrame([(True, [0.1, 0.2, 0.3])] * 3, rows.schema)
    assert Q.limits_of(one) == [np.inf] * 3 and Q.limits_of(rows.limit(0)) == [np.inf] * 3


def test_no_labelled_document_is_left_out(spark):
    n = 6600
    columns = "doc_id long, base_failed boolean, x array<double>, s array<double>"
    rows = spark.createDataFrame([(i, False, [float(i)], [0.1, 0.2, 0.3]) for i in range(n)], columns)
    labels = spark.createDataFrame([(i, 1) for i in range(n)], "doc_id long, quality int")
    learned = [r.n for r in labels.selectExpr("count_if(crc32(cast(doc_id as string)) % 3 != 1) as n").collect()][0]
    assert learned > 4000 and Q.labelled(rows, labels).count() == learned


def test_a_task_connects_its_own_edges():
    batch = pa.RecordBatch.from_arrays([pa.array([*range(1, 500), 900]), pa.array([*range(499), 800])], names=["u", "v"])
    (got,) = connected(iter([batch, batch]))
    assert dict(zip(*(got.column(c).to_pylist() for c in "uv"), strict=True)) == {**{i: 0 for i in range(1, 500)}, 900: 800}
