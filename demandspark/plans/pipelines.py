"""The weekly training and daily prediction flows as plain functions over tables.

Each step reads and writes tables under one warehouse path; scheduling is left
to the caller.  ``calendar``, ``rx``, ``srq``, ``drug`` and ``units`` are any
DataFrames with the documented columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.config import DemandConfig
from demandspark.functions.stage import stage, staging
from demandspark.operators import abc as A
from demandspark.operators import dataset as D
from demandspark.operators import features as X
from demandspark.operators import model as M
from demandspark.operators import panel as P
from demandspark.operators import publish as B
from demandspark.operators import subject as S
from demandspark.operators.quality import assert_dense, assert_filled, assert_unique
from demandspark.sources import schemas
from demandspark.sources.files import write_csv
from demandspark.sources.tables import MONTH, read_table, refresh_range, replace_table


@dataclass(frozen=True)
class Sources:
    """Input tables of a run."""

    rx: DataFrame
    srq: DataFrame
    drug: DataFrame
    units: DataFrame
    calendar: DataFrame


def cleaned(step: Callable) -> Callable:
    """A step whose staged folders go when its tables are written."""

    @wraps(step)
    def run(*args, **kwargs):
        with staging(SparkSession.active()):
            return step(*args, **kwargs)

    return run


@cleaned
def update_panel(src: Sources, cfg: DemandConfig, warehouse: str) -> DataFrame:
    """Recompute the panel's span in place and return it."""
    pairs = stage(P.assortment(src.srq, src.drug, src.units, cfg), "pairs")
    panel = assert_filled(schemas.conform(P.horizon_panel(src.rx, pairs, src.drug, cfg), schemas.PANEL), schemas.PANEL)
    path = f"{warehouse}/panel"
    refresh_range(panel, path, cfg.day, cfg.panel_start, cfg.panel_end, cfg.keys, [cfg.location, cfg.item])
    return load_panel(src.rx.sparkSession, cfg, warehouse)


def with_month(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])


def load_panel(spark: SparkSession, cfg: DemandConfig, warehouse: str) -> DataFrame:
    """The panel's span, pruned by month directory and day."""
    table = read_table(spark, f"{warehouse}/panel", with_month(schemas.PANEL))
    month = F.col(MONTH).between(cfg.panel_start.strftime("%Y-%m"), cfg.panel_end.strftime("%Y-%m"))
    day = (F.col(cfg.day) >= F.lit(cfg.panel_start)) & (F.col(cfg.day) < F.lit(cfg.panel_end))
    return table.filter(month & day).drop(MONTH)


def panel_variant(panel: DataFrame, cfg: DemandConfig, label: str) -> DataFrame:
    """The panel with the columns a label needs."""
    variant = D.LABELS[label].variant
    if variant == X.DIFF:
        return P.diff_panel(panel, cfg)
    if variant == X.SCALED:
        return P.scaled_panel(panel, P.minmax_scaler(panel, cfg), cfg)
    return panel


def subject_aggregates(src: Sources, pairs: DataFrame, cfg: DemandConfig) -> DataFrame:
    return S.patient_agg(src.rx, pairs, cfg)


@cleaned
def build_train_dataset(
    src: Sources, cfg: DemandConfig, warehouse: str, name: str, label: str, use_subject: bool = False
) -> DataFrame:
    """Assemble, check and write one train dataset; returns the written table."""
    spark = src.rx.sparkSession
    panel = load_panel(spark, cfg, warehouse)
    assert_dense(panel, cfg.pair, cfg.day)
    variant = panel_variant(panel, cfg, label)
    if variant is not panel:
        variant = stage(variant, f"panel-{label}")
    doctors = X.doctor_feature(src.rx, cfg)
    subject = None
    if use_subject:
        pairs = stage(P.assortment(src.srq, src.drug, src.units, cfg), "pairs")
        subject = subject_aggregates(src, pairs, cfg)
    path = f"{warehouse}/train_dataset_{name}"
    rows = D.train_dataset(variant, src.calendar, doctors, cfg, label, subject)
    replace_table(
        rows.withColumn(MONTH, F.date_format(cfg.day, "yyyy-MM")), path, [MONTH], [cfg.location, cfg.item]
    )
    return assert_unique(spark.read.parquet(path).drop(MONTH), cfg.keys)


@cleaned
def build_predict_dataset(src: Sources, cfg: DemandConfig, warehouse: str, name: str, label: str) -> DataFrame:
    """Assemble, check and write the base day's prediction rows."""
    spark = src.rx.sparkSession
    variant = panel_variant(load_panel(spark, cfg, warehouse), cfg, label)
    if D.LABELS[label].variant != X.BASE:
        variant = stage(variant, f"panel-{label}")
    path = f"{warehouse}/predict_dataset_{name}"
    rows = D.predict_dataset(variant, src.calendar, X.doctor_feature(src.rx, cfg), cfg, label)
    replace_table(rows, path, cluster_by=[cfg.location, cfg.item])
    return assert_unique(spark.read.parquet(path), cfg.keys)


def numeric_features(df: DataFrame, exclude: set[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.dataType.typeName() in ("double", "long", "integer") and f.name not in exclude
    ]


@cleaned
def train_model(
    dataset: DataFrame,
    cfg: DemandConfig,
    label: str,
    path: str,
    execution: date,
    warehouse: str,
    name: str,
    params: M.BoostParams | None = None,
) -> M.Fit:
    """Encode, fit in two phases, evaluate on the test split, publish all results."""
    spark = dataset.sparkSession
    spec = D.LABELS[label]
    categories = [c for c in schemas.CATEGORICAL_FEATURES if c in set(dataset.columns)]
    encoder = M.fit_encoder(dataset, categories)
    coded = stage(M.apply_encoder(dataset, encoder, categories), "encoded")
    targets = {spec.column, "tanni_suryo", *UNSEEN_TARGETS}
    numeric = numeric_features(dataset, targets)
    codes = [f"{c}_code" for c in categories]
    fit = M.fit_two_phase(coded, [*numeric, *codes], spec.column, params, codes)
    M.save_fit(fit, encoder, path)
    scored = stage(M.score(fit.model, M.split(coded, "test")), "scored")
    back = "lag_total_dose_by_yj_store" if label == "diff" else None
    metrics = M.regression_metrics(scored, spec.column, "predicted_total_dose", name, back)
    write_csv(metrics, f"{path}/evaluation")
    write_csv(M.feature_importance(fit, spark), f"{path}/importance")
    write_csv(scored, f"{path}/predictions", [*cfg.keys, spec.column, "predicted_total_dose"])
    B.merge_evaluation(metrics, f"{warehouse}/evaluation_{name}", execution)
    return fit


# Panel targets that must never be model inputs.
UNSEEN_TARGETS = (
    "diff_total_dose_by_yj_store",
    "diff_total_dose_by_yj",
    "lag_total_dose_by_yj_store",
    "lag_total_dose_by_yj",
    "week",
)


@cleaned
def publish_predictions(
    dataset: DataFrame, cfg: DemandConfig, label: str, path: str, warehouse: str, name: str, panel: DataFrame | None = None
) -> None:
    """Score a predict dataset with a saved model, invert its label and upsert."""
    encoder, model = M.load_fit(dataset.sparkSession, path)
    categories = [c for c in schemas.CATEGORICAL_FEATURES if c in set(dataset.columns)]
    scored = M.score(model, M.apply_encoder(dataset, encoder, categories)).select(
        *cfg.keys, "predicted_total_dose", *(["total_dose_by_yj_store"] if label == "diff" else [])
    )
    scored = stage(scored, "predictions")
    preds = scored.select(*cfg.keys, "predicted_total_dose")
    if label == "log":
        final = B.inverse_log(preds, cfg)
    elif label == "raw":
        final = preds
    elif label == "diff":
        final = B.inverse_diff(preds, scored, cfg)
    else:
        final = B.inverse_minmax(preds, P.minmax_scaler(panel, cfg), cfg)
    B.merge_predictions(final, f"{warehouse}/prediction_{name}", cfg)


@cleaned
def update_abc(panel: DataFrame, cfg: DemandConfig, warehouse: str) -> DataFrame:
    """Refresh the ABC classes of the test range."""
    classes = schemas.conform(A.abc_class(panel, cfg), schemas.ABC)
    refresh_range(classes, f"{warehouse}/abc", cfg.day, cfg.abc_start, cfg.dataset_end, cfg.keys, [cfg.location])
    return read_table(panel.sparkSession, f"{warehouse}/abc", schemas.ABC)


@cleaned
def blend(spark: SparkSession, cfg: DemandConfig, warehouse: str, start: date, end: date) -> None:
    """Blend the diff and log models by class for prediction days ``[start, end)`` and upsert."""
    first = read_table(spark, f"{warehouse}/prediction_exp047", schemas.MODEL_PREDICTION)
    second = read_table(spark, f"{warehouse}/prediction_exp042", schemas.MODEL_PREDICTION)
    classes = read_table(spark, f"{warehouse}/abc", schemas.ABC)
    B.merge_blend(B.blend_predictions(first, second, classes, cfg, start, end), f"{warehouse}/prediction", cfg)
