"""The isolation forest sees all rule statistics of all documents."""

import numpy as np
import pyarrow as pa

from demandspark.llm import quality_rules
from demandspark.llm.common import text_bytes

LABELS = "doc_id long, quality int"


def _texts(n):
    rng = np.random.default_rng(2)
    for i in range(n):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(80)]
        words = [w.capitalize() if rng.random() < 0.1 else w for w in words]
        words = [str(rng.integers(100)) if rng.random() < 0.03 else w for w in words]
        yield i, " ".join(words)


def test_shouted_numeric_and_long_worded_texts_stand_out(spark):
    rows = list(_texts(600))
    rng = np.random.default_rng(3)
    rows += [
        (1000, rows[0][1].upper()),
        (1001, " ".join(str(rng.integers(1000, 99999)) for _ in range(80))),
        (1002, " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 15)) for _ in range(80))),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.anomaly for r in quality_rules.rules_digest(docs, spark.createDataFrame([], LABELS)).collect()}
    usual = np.quantile([a for i, a in got.items() if i < 600], 0.95)
    assert all(got[i] > usual for i in (1000, 1001, 1002))


def test_every_statistic_is_split_on_and_trees_draw_from_all_rows(spark):
    rows = list(_texts(900))
    measured = quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    drawn = quality_rules.samples(measured)
    assert len(drawn) == quality_rules.TREES and {len(x) for x in drawn} == {quality_rules.TREE_ROWS}
    x = quality_rules.statistics(*text_bytes(pa.array([t for _, t in rows])))[1]
    assert {tuple(v) for part in drawn for v in part.tolist()} == {tuple(v) for v in x.tolist()}
    vary = set(np.flatnonzero(x.max(0) > x.min(0)).tolist())
    assert {0, 4, 5} <= vary and set(np.unique(quality_rules.grow(drawn).feature).tolist()) == {-1} | vary
    again = quality_rules.samples(measured.unionByName(measured).repartition(3))
    assert all((a == b).all() for a, b in zip(drawn, again, strict=True))
