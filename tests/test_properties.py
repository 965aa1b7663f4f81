"""Properties linking train, predict and as-of features on the test tables."""

import re

import pytest
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.operators import dataset as D
from demandspark.operators import features as X
from demandspark.operators.quality import assert_dense, assert_unique
from demandspark.plans.queries import CHECK, END, context

SHORT = DemandConfig(end=END, train_days=60, windows=(60, 30), lags=(1, 7, 28), max_last_days=60)


@pytest.fixture(scope="module")
def ctx(spark, smoke):
    return context(spark, smoke, SHORT)


def differing(a, b, keys, columns):
    """Names of columns that differ anywhere between two tables joined on ``keys``."""
    j = a.alias("a").join(b.alias("b"), keys)
    cells = []
    for c in columns:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        close = x.isNull() & y.isNull() | (F.abs(x - y) <= 1e-6 * (1 + F.abs(x)))
        cells.append(F.sum(F.when(F.coalesce(close, F.lit(False)), 0).otherwise(1)).alias(c))
    row = j.agg(F.count(F.lit(1)).alias("rows"), *cells).first().asDict()
    assert row.pop("rows") > 0
    return {c for c, n in row.items() if n}


def test_panel_is_dense_and_unique(ctx):
    cfg, panel = ctx.cfg, ctx.panel
    assert_unique(panel, cfg.keys)
    assert_dense(panel, cfg.pair, cfg.day)
    days = (cfg.panel_end - cfg.panel_start).days
    assert panel.count() == ctx.pairs.count() * days


def test_train_row_equals_predict_row_a_horizon_earlier(ctx):
    cfg = ctx.cfg
    train = X.target_features(ctx.panel, cfg)
    predict = X.target_features(ctx.panel, cfg, "predict").withColumn(cfg.day, F.date_add(cfg.day, cfg.horizon))
    differ = differing(train, predict, cfg.keys, X.target_columns(cfg))
    must_match = {c for c in [*X.stat_columns(cfg), *X.lag_columns(cfg)] if "by_yj_store" in c or "_STDDEV_" not in c}
    assert not differ & must_match
    # replicated item values change the sample deviation, the delayed carry the last non-zero value
    assert any("by_yj_STDDEV" in c for c in differ)
    assert differ & set(X.LAST_NONZERO)


def test_weekday_groups_match_and_day_types_do_not(ctx):
    cfg = ctx.cfg

    def shifted(df):
        return df.withColumn(cfg.day, F.date_add(cfg.day, cfg.horizon))

    dow = X.segment_columns(cfg, "dow")
    assert not differing(
        X.category_features(ctx.panel, cfg), shifted(X.category_features(ctx.panel, cfg, "predict")), cfg.keys, dow
    )
    dts = X.segment_columns(cfg, "dts")
    assert differing(
        X.holiday_features(ctx.panel, ctx.calendar, cfg),
        shifted(X.holiday_features(ctx.panel, ctx.calendar, cfg, "predict")),
        cfg.keys,
        dts,
    )


@pytest.mark.parametrize("variant", [X.BASE, X.DIFF])
def test_asof_features_equal_windowed_ones(ctx, variant):
    cfg = ctx.cfg
    panel = ctx.diff if variant else ctx.panel
    asof = D.features_asof(panel, ctx.calendar, cfg, variant)
    assert asof.count() == ctx.pairs.count()
    for table in (
        X.target_features(panel, cfg, "predict", variant),
        X.category_features(panel, cfg, "predict", variant),
        X.holiday_features(panel, ctx.calendar, cfg, "predict", variant),
        X.days_since_last(panel, cfg, "predict"),
    ):
        columns = [c for c in table.columns if c not in cfg.keys]
        assert not differing(asof, table, cfg.keys, columns)


def test_general_frames_equal_dense_lags(ctx):
    cfg = ctx.cfg
    fast, slow = X.lag_features(ctx.panel, cfg), X.lag_features(ctx.panel, cfg, dense=False)
    assert not differing(fast, slow, cfg.keys, X.lag_columns(cfg))


def test_pair_features_shuffle_the_panel_once(ctx):
    """Pair features: one shuffle of the narrow panel, no Python, filters pushed to the scan."""
    rows = X._measures(X.history(ctx.panel, ctx.cfg), ctx.cfg, X.BASE, X.PAIR_MEASURES)
    df = X.add_pair_targets(rows, ctx.cfg, "train")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count(" Sort ") == 1
    assert "Python" not in plan and "PushedFilters: [IsNotNull(dispensing_date)" in plan


def test_train_dataset_shuffles_narrow_pair_rows_once(ctx):
    """One exchange by pair, none by the day alone; the item and name series are joined to sampled rows."""
    df = D.train_dataset(ctx.panel, ctx.calendar, ctx.doctors, ctx.cfg)
    plan = df._jdf.queryExecution().executedPlan().toString()
    by_key = re.findall(r"Exchange hashpartitioning\((.*?), \d+\), (\w+)", plan)
    keys = [(re.sub(r"#\d+L?", "", k), origin) for k, origin in by_key]
    assert [k for k, origin in keys if origin == "REPARTITION_BY_COL"] == ["yj_code, store_code"]
    # the prescribers' own aggregation and nothing else comes by pair
    assert sum(k == "yj_code, store_code" for k, _ in keys) == 2
    assert not any(k == "dispensing_date" for k, _ in keys)
    assert "Python" not in plan


def test_default_columns_reach_the_published_count():
    cfg = DemandConfig()
    calendar_and_recency = 12
    assert len(D.feature_columns(cfg)) + calendar_and_recency == 359
    assert CHECK.horizon % 7 == 0
