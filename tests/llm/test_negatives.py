"""Hard negatives: exact products, and the whole result against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.llm import hard_negatives as H
from demandspark.llm.queries import op13_hard_negatives


def brute(rows, every=100, relabel=True):
    """Python integers over all rows."""
    good = []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        good.append((i, (label + 1) % 10 if relabel and i % 7 == 0 else label, tuple(math.floor(256 * float(v)) for v in x)))
    score = lambda a, b: sum(p * q for p, q in zip(a[2], b[2]))
    out = []
    for anchor in sorted({r for r in good if r[0] % every == 0}):
        rest = list(good)
        rest.remove(anchor)
        positives = sorted(((-score(anchor, r), r[0]) for r in rest if r[1] == anchor[1]))[:5]
        others = sorted((-score(anchor, r), r[0]) for r in rest if r[1] != anchor[1])
        for s, p in positives:
            hits = [(t, i) for t, i in others if 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(anchor[0], p, k + 1, i, -s, -t) for k, (t, i) in enumerate(hits)]
    return sorted(out)


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = op13_hard_negatives(spark, path)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("group_bytes", [1, H.GROUP_BYTES])
def test_odd_rows(spark, group_bytes):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 3)), rng.normal(0, 0.2, 5 + i % 3).round(2).tolist()) for i in range(60)]
    rows += rows[:12] + [(10, 1, [0.5]), (None, 1, [0.1]), (20, None, [0.1]), (30, 1, None), (40, 1, [0.1, None]), (50, 1, [float("nan")]), (60, 1, [float("inf")]), (70, 0, [])]
    rows += [(5, 2, [0.3] * 4)] * 9 + [(80, 1, [1e30])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit(1) for c in ("score", "slot", "rank", "anchor_id", "window")})
    want = brute([r for r in rows if r[0] != 80], every=10, relabel=False)
    assert sorted(map(tuple, H.mine(df.repartition(4), every=10, group_bytes=group_bytes).collect())) == want


def test_empty(spark):
    assert H.mine(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


@pytest.mark.parametrize("size", [3, 2**10, 2**20, 2**27])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-size, size + 1, (n, 130)) for n in (7, 9))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert H.products(H.Residues(a), H.Residues(b)).tolist() == want
