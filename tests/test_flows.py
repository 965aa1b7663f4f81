"""The weekly and daily flows over tables, each run twice with equal tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.operators import model as M
from demandspark.operators import panel as P
from demandspark.operators.quality import assert_filled
from demandspark.plans import pipelines as W
from demandspark.plans.queries import END, EXECUTION, context
from demandspark.sources import schemas
from demandspark.sources.tables import read_table, replace_table

CFG = DemandConfig(end=END, train_days=40, windows=(7,), lags=(1,), max_last_days=30)
BOOST = M.BoostParams(step=0.5, depth=2, leaves=4, bins=16, patience=1)


@pytest.fixture(scope="module")
def sources(spark, smoke):
    c = context(spark, smoke, CFG)
    d = c.data
    few = d.rx.where(F.col("yj_code") < "0013")
    pairs = d.srq.where(F.col("yj_id") < "ID0013")
    return W.Sources(few, pairs, d.drug, d.units, c.calendar)


@pytest.fixture(scope="module")
def warehouse(tmp_path_factory):
    return str(tmp_path_factory.mktemp("warehouse"))


@pytest.fixture(scope="module")
def built(sources, warehouse):
    W.update_panel(sources, CFG, warehouse)


@pytest.fixture
def panel(spark, built, warehouse):
    """Listed anew for each test, as updates replace files."""
    return W.load_panel(spark, CFG, warehouse)


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def frozen(spark, df):
    """A copy that later writes to the table can't change."""
    return spark.createDataFrame(df.toArrow())


def test_panel_is_typed_and_repeatable(spark, sources, warehouse, panel):
    before = frozen(spark, panel)
    assert {f.name: f.dataType for f in schemas.PANEL} == {f.name: f.dataType for f in before.schema}
    assert same(before, W.update_panel(sources, CFG, warehouse))
    with pytest.raises(ValueError, match="NULL"):
        assert_filled(before.withColumn("yj_code", F.lit(None).cast("string")), schemas.PANEL)


def test_facts_outside_the_assortment_drop_out(sources, panel):
    gone = sources.srq.where("soshiki_unit_id_store != 1003")
    pairs = P.assortment(gone, sources.drug, sources.units, CFG)
    rows = P.horizon_panel(sources.rx, pairs, sources.drug, CFG)
    assert rows.where("store_code = '000003'").isEmpty() and not panel.where("store_code = '000003'").isEmpty()


@pytest.mark.parametrize("label", ["raw", "scaled"])
def test_datasets_are_repeatable(spark, sources, warehouse, panel, label):
    subject = label == "raw"
    first = frozen(spark, W.build_train_dataset(sources, CFG, warehouse, f"t_{label}", label, subject))
    assert first.count() > 0 and ("AVG_num_visit_yj_store" in first.columns) == subject
    assert same(first, W.build_train_dataset(sources, CFG, warehouse, f"t_{label}", label, subject))
    today = W.build_predict_dataset(sources, CFG, warehouse, f"p_{label}", label)
    assert today.count() == panel.select(*CFG.pair).distinct().count()


@pytest.mark.parametrize("label", ["log", "diff"])
def test_train_and_publish(spark, sources, warehouse, panel, label):
    rows = W.build_train_dataset(sources, CFG, warehouse, label, label)
    path, name = f"{warehouse}/model_{label}", {"log": "exp042", "diff": "exp047"}[label]
    fit = W.train_model(rows, CFG, label, path, EXECUTION, warehouse, name, BOOST)
    assert fit.rounds >= 1
    found = read_table(spark, f"{warehouse}/evaluation_{name}", schemas.EVALUATION).collect()
    assert [r.execution_date for r in found] == [EXECUTION] and found[0].rmse > 0
    today = W.build_predict_dataset(sources, CFG, warehouse, f"now_{label}", label)
    tables = []
    for _ in range(2):
        W.publish_predictions(today, CFG, label, path, warehouse, name, panel)
        tables.append(frozen(spark, read_table(spark, f"{warehouse}/prediction_{name}", schemas.MODEL_PREDICTION)))
    assert same(*tables) and tables[0].count() == today.count() and tables[0].where("predicted_total_dose is null").isEmpty()
    if label == "log":
        spec = M.split(rows, "test")
        encoder, model = M.load_fit(spark, path)
        categories = [c for c in schemas.CATEGORICAL_FEATURES if c in set(rows.columns)]
        coded = M.apply_encoder(spec, encoder, categories)
        assert same(M.score(model, coded).select(*CFG.keys, "predicted_total_dose"), M.score(fit.model, coded).select(*CFG.keys, "predicted_total_dose"))
        # better than the training mean
        mean = M.split(rows, "train").agg(F.avg("total_dose_monthly")).first()[0]
        error = lambda df, p: df.agg(F.avg((F.col("total_dose_monthly") - p) ** 2)).first()[0]
        assert error(M.score(model, coded), F.col("predicted_total_dose")) < error(spec, F.lit(mean))


def test_classes_and_blend_are_repeatable(spark, warehouse, panel):
    classes = frozen(spark, W.update_abc(panel, CFG, warehouse))
    assert classes.count() > 0 and same(classes, W.update_abc(panel, CFG, warehouse))
    days = read_table(spark, f"{warehouse}/prediction_exp047", schemas.MODEL_PREDICTION).agg(F.min(CFG.day), F.max(CFG.day)).first()
    tables = []
    for _ in range(2):
        W.blend(spark, CFG, warehouse, days[0], date(days[1].year + 1, 1, 1))
        tables.append(frozen(spark, read_table(spark, f"{warehouse}/prediction", schemas.BLENDED_PREDICTION)))
    assert same(*tables) and tables[0].count() > 0


def test_replace_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5).withColumn("p", F.lit("a")), path, ["p"], ["id"])
    replace_table(spark.range(3).withColumn("p", F.lit("b")), path, ["p"], ["id"])
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect())) == [(0, "b"), (1, "b"), (2, "b")]
