"""Boosting: trees against exhaustive search, categories, resuming, patience, gain."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.operators import boost as B
from demandspark.operators import model as M

SMALL = B.BoostParams(max_iter=6, step=1.0, leaves=2, depth=1, bins=32, min_rows=1, row_fraction=1.0, feature_fraction=1.0, l1=0.0, l2=0.0, patience=3, save_every=2)


def frame(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 20, n).astype(float)
    c = rng.integers(0, 9, n)
    y = np.where(np.isin(c, [1, 4, 7]), 50.0, 0.0) + x + rng.normal(0, 0.1, n)
    flag = np.where(np.arange(n) % 4 == 0, "valid", "train")
    rows = [(i, None if i % 50 == 3 else float(a), int(b), float(v), str(f)) for i, (a, b, v, f) in enumerate(zip(x, c, y, flag))]
    return spark.createDataFrame(rows, "id long, x double, c long, y double, split_flag string").repartition(3, "id").sortWithinPartitions("id")


def fit(spark, df, params, categories=("c",), path=None):
    return B.fit_phases(df, ["x", "c"], categories, "y", params, path)


def same(a, b):
    return a.base == b.base and len(a.trees) == len(b.trees) and all(np.array_equal(getattr(s, k), getattr(t, k)) for s, t in zip(a.trees, b.trees) for k in ("feature", "left", "value", "gain", "rows", "left_bins"))


def test_first_split_is_the_best_of_all(spark):
    """Every cut of the number, by squared error."""
    df = frame(spark).drop("c").withColumn("c", F.lit(0))
    model, _ = fit(spark, df, SMALL)
    rows = [(r.x, r.y) for r in df.collect()]
    y = np.array([v for _, v in rows])
    x = np.array([-1e9 if v is None else v for v, _ in rows])
    best = min((float(((y[m] - y[m].mean()) ** 2).sum() + ((y[~m] - y[~m].mean()) ** 2).sum()), cut) for cut in np.unique(x)[:-1] for m in [x <= cut])
    tree = model.trees[0]
    assert tree.feature[0] == 0
    left = model.predict([x_ := np.where(x < 0, np.nan, x), np.zeros(len(x))]) if len(model.trees) == 1 else model.base + tree.predict(np.stack([model.bins.apply(0, np.where(x < 0, np.nan, x)), model.bins.apply(1, np.zeros(len(x)))]))
    assert ((y - left) ** 2).sum() == pytest.approx(best[0], rel=1e-6)
    total = ((y - y.mean()) ** 2).sum()
    assert tree.gain[0] == pytest.approx(total - best[0], rel=1e-4)


def test_one_split_parts_a_set_of_categories(spark):
    df = frame(spark)
    by_set, _ = fit(spark, df, SMALL)
    by_cut, _ = fit(spark, df, SMALL, categories=())
    first = by_set.trees[0]
    assert by_set.bins.columns[first.feature[0]] == "c"
    codes = np.arange(9.0)
    side = first.left_bins[0][by_set.bins.apply(1, codes)]
    assert set(codes[side]) in ({1, 4, 7}, {0, 2, 3, 5, 6, 8})
    # no cut of the codes comes near
    assert first.gain[0] > 2 * by_cut.trees[0].gain[0]


def test_quantile_bins_of_summaries():
    """Bins of even weight, from blocks that are summarised on their own; few values are kept exactly."""
    rng = np.random.default_rng(0)
    blocks = [rng.normal(k, 1, 5000) for k in range(6)] + [np.array([np.nan] * 9)]
    parts = [B.summary(x, 8 * 64) for x in blocks]
    ends = B.quantile_ends(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), 62)
    counts = np.bincount(np.searchsorted(ends, np.concatenate(blocks[:6]), "left"))
    assert len(ends) == 62 and counts.min() > 0.8 * 30_000 / 63 and counts.max() < 1.2 * 30_000 / 63
    assert B.quantile_ends(*B.summary(np.array([3.0, 1.0, 1.0, np.nan, 2.0]), 100), 62) == [1.0, 2.0]
    assert B.quantile_ends(np.zeros(0), np.zeros(0), 5) == []


def test_rare_and_unknown_codes_share_a_bin():
    bins = B.Bins(("c",), frozenset(["c"]), ((5.0, 2.0),))
    assert bins.apply(0, np.array([5.0, 2.0, 9.0, 3.0, np.nan])).tolist() == [1, 2, 3, 3, 0]


def test_errors_are_those_of_the_model(spark):
    params = B.BoostParams(max_iter=12, step=0.3, leaves=6, depth=3, bins=64, min_rows=3, patience=20, save_every=5)
    df = frame(spark)
    model, best = fit(spark, df, params)
    valid = [v for _, v in model.errors]
    assert len(valid) == 13 and best == int(np.argmin(valid)) and valid[best] < 0.5 * valid[0]
    assert model.rounds == int(best * 600 / 450)
    rest = model.transform(df.where("split_flag = 'valid'"))
    error = rest.agg(F.sqrt(F.avg((F.col("y") - F.col(B.PREDICTION)) ** 2))).first()[0]
    assert error < valid[0]


class Killed(Exception):
    pass


@pytest.mark.parametrize("after", [1, 5, 8])
def test_a_killed_fit_goes_on_to_the_same_model(spark, tmp_path, monkeypatch, after):
    params = B.BoostParams(max_iter=9, step=0.2, leaves=5, depth=3, bins=32, min_rows=3, patience=20, save_every=3)
    df = frame(spark)
    whole, rounds = fit(spark, df, params, path=str(tmp_path / "whole"))
    grow, count = B.Boosting.grow, [0]

    def dying(self):
        count[0] += 1
        if count[0] > after:
            raise Killed
        return grow(self)

    monkeypatch.setattr(B.Boosting, "grow", dying)
    with pytest.raises(Killed):
        fit(spark, df, params, path=str(tmp_path / "killed"))
    kept, _ = B.read_trees(spark, str(tmp_path / "killed"), "first")
    assert len(kept) == after // 3 * 3
    monkeypatch.setattr(B.Boosting, "grow", grow)
    again, rounds_again = fit(spark, df, params, path=str(tmp_path / "killed"))
    assert same(whole, again) and rounds == rounds_again and whole.errors == again.errors


def test_patience(spark):
    run = B.Boosting(spark, None, None, SMALL, frozenset(), "first", "")
    run.errors = [(0, e) for e in (5, 3, 4, 4)]
    assert run.best() == 1 and run.stopped(2) and not run.stopped(3)
    run.errors = [(0, float("nan"))]
    run.trees = [1, 2]
    assert run.best() == 2 and not run.stopped(1)


def test_label_that_never_differs_needs_no_tree(spark):
    model, best = fit(spark, frame(spark).withColumn("y", F.lit(3.0)), SMALL)
    assert model.rounds == 0 and best == 1 and model.base == 3.0


def test_no_valid_rows_uses_all_rounds(spark):
    model, best = fit(spark, frame(spark).withColumn("split_flag", F.lit("train")), SMALL)
    assert best == 6 and model.rounds == 6


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = frame(spark)
    model, _ = fit(spark, df, B.BoostParams(max_iter=5, step=0.5, leaves=8, depth=4, bins=16, patience=5))
    model.save(spark, str(tmp_path / "m"))
    loaded = B.Boosted.load(spark, str(tmp_path / "m"))
    assert same(model, loaded)
    a, b = (m.transform(df).orderBy("id").toPandas() for m in (model, loaded))
    assert a.equals(b) and list(a.columns) == [*df.columns, B.PREDICTION]


def test_total_gain_of_two_trees_by_hand(spark):
    """Tree 0: x with gain 5 over z with gain 2; tree 1: x with gain 1."""
    leaf = np.zeros(256, bool)
    one = B.Tree(np.array([0, 1, -1, -1, -1]), np.array([1, 3, -1, -1, -1]), np.array([2, 4, -1, -1, -1]), np.zeros(5), np.array([5.0, 2.0, 0, 0, 0]), np.ones(5, int), np.stack([leaf] * 5))
    two = B.Tree(np.array([0, -1, -1]), np.array([1, -1, -1]), np.array([2, -1, -1]), np.zeros(3), np.array([1.0, 0, 0]), np.ones(3, int), np.stack([leaf] * 3))
    model = B.Boosted(B.Bins(("x", "z", "unused"), frozenset(), ((), (), ())), 0.0, (one, two))
    rows = M.feature_importance(M.Fit(model, model.bins.columns, 2), spark).collect()
    assert [tuple(r) for r in rows] == [("x", 6.0), ("z", 2.0), ("unused", 0.0)]
    model.nodes(spark).createOrReplaceTempView("nodes")
    by_sql = spark.sql("select name, sum(gain) as g from nodes where left >= 0 group by name order by g desc").collect()
    assert [tuple(r) for r in by_sql] == [("x", 6.0), ("z", 2.0)]
