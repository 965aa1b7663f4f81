"""From model output to published tables: inverse transforms, blend, upserts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.config import DemandConfig
from demandspark.functions.scalar import strict_greatest

PRED = "predicted_total_dose"


def _with_prediction(preds: DataFrame, cfg: DemandConfig, value) -> DataFrame:
    return preds.withColumn(PRED, strict_greatest(value, 0.0)).select(*cfg.keys, PRED)


def inverse_log(preds: DataFrame, cfg: DemandConfig) -> DataFrame:
    """``exp(p) - 1``, at least 0; NULL stays NULL."""
    return _with_prediction(preds, cfg, F.exp(PRED) - 1)


def inverse_minmax(preds: DataFrame, scaler: DataFrame, cfg: DemandConfig) -> DataFrame:
    """``p * (max - min) + min``, at least 0; pairs without a scaler give NULL."""
    low, high = F.col("min_total_dose_by_yj_store"), F.col("max_total_dose_by_yj_store")
    joined = preds.join(scaler, [k for k in cfg.keys if k in set(scaler.columns)], "left")
    return _with_prediction(joined, cfg, F.col(PRED) * (high - low) + low)


def inverse_diff(
    preds: DataFrame, base: DataFrame, cfg: DemandConfig, base_col: str = "total_dose_by_yj_store"
) -> DataFrame:
    """``p + base value``, at least 0.

    Publishing adds the base day's target; evaluation adds the stored lag
    (``base_col="lag_total_dose_by_yj_store"``).
    """
    joined = preds.join(base.select(*cfg.keys, F.col(base_col).alias("__base")), cfg.keys, "left")
    return _with_prediction(joined, cfg, F.col(PRED) + F.col("__base"))


def blend_predictions(
    diff_model: DataFrame,
    log_model: DataFrame,
    abc: DataFrame,
    cfg: DemandConfig,
    start: date,
    end: date,
    models: tuple[str, str] = ("exp047", "exp042"),
) -> DataFrame:
    """One prediction per key of days ``[start, end)``: the first model for class
    'a' of the previous day's classes, the second otherwise."""
    first, second = models
    day = cfg.day
    is_a = F.coalesce(F.col("model_abc_flag") == "a", F.lit(False))
    classes = abc.select(*cfg.pair, F.date_add(day, 1).alias(day), "model_abc_flag")
    bounded = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end))
    return (
        diff_model.filter(bounded)
        .select(*cfg.keys, F.col(PRED).alias("__first"))
        .join(log_model.select(*cfg.keys, F.col(PRED).alias("__second")), cfg.keys, "left")
        .join(classes, cfg.keys, "left")
        .select(
            *cfg.pair,
            F.col(day).alias("pred_exe_date"),
            F.lit(str(cfg.horizon)).alias("pred_period"),
            F.col(day).alias("pred_period_start"),
            F.date_add(day, cfg.horizon).alias("pred_period_end"),
            F.when(is_a, F.lit(first)).otherwise(F.lit(second)).alias("model_id"),
            F.when(is_a, F.col("__first")).otherwise(F.col("__second")).alias("predicted_values"),
        )
    )


def merge_predictions(preds: DataFrame, path: str, cfg: DemandConfig) -> None:
    """Upsert one model's predictions by key; only the value of a match changes."""
    from demandspark.sources.schemas import MODEL_PREDICTION
    from demandspark.sources.tables import merge_table

    merge_table(preds, path, MODEL_PREDICTION, cfg.keys, [PRED], cfg.day)


def merge_blend(blend: DataFrame, path: str, cfg: DemandConfig) -> None:
    """Upsert blended predictions by pair and execution day."""
    from demandspark.sources.schemas import BLENDED_PREDICTION
    from demandspark.sources.tables import merge_table

    merge_table(
        blend, path, BLENDED_PREDICTION, [*cfg.pair, "pred_exe_date"], ["model_id", "predicted_values"], "pred_exe_date"
    )


def evaluation_rows(metrics: DataFrame, execution: date) -> DataFrame:
    """Typed evaluation rows, columns taken by name."""
    return metrics.select(
        F.lit(execution).alias("execution_date"),
        "model_version",
        *[F.col(c).cast("double").alias(c) for c in ("rmse", "mae", "r2")],
    )


def merge_evaluation(metrics: DataFrame, path: str, execution: date) -> None:
    """Upsert evaluation metrics by execution day and model version."""
    from demandspark.sources.schemas import EVALUATION
    from demandspark.sources.tables import merge_table

    merge_table(
        evaluation_rows(metrics, execution),
        path,
        EVALUATION,
        ["execution_date", "model_version"],
        ["rmse", "mae", "r2"],
        "execution_date",
    )
