"""Typed schemas of the maintained tables; comments travel as field metadata."""

from __future__ import annotations

from pyspark.sql import types as T

# Master attributes carried through the panel, in output order (fixed names).
MASTER_TEXT = (
    "yakushu_zaigata_kubun_id",
    "general_name",
    "kikaku",
    "generic_kubun_id",
    "tanni_name",
)
MASTER_FLAGS = (
    "direct_sales_input_kubun_id",
    "tokutei_hoken_kubun_id",
    "keiryo_kongo_kanou_kubun_id",
    "kekkaku_yobou_flag",
    "high_risk_drug_flag",
    "dokuyakau_gekiyaku_kubun_id",
    "kisei_drug_kubun_id",
)
MASTER_COLUMNS = ("application_start_date", *MASTER_TEXT, "tanni_suryo", *MASTER_FLAGS)

PAIR_MEASURES = ("total_dose_by_yj_store", "total_price_by_yj_store", "nunique_patient_by_yj_store")
ITEM_MEASURES = ("total_dose_by_yj", "total_price_by_yj", "nunique_patient_by_yj")
MEASURES = (*PAIR_MEASURES, *ITEM_MEASURES)

CATEGORICAL_FEATURES = (
    "direct_sales_input_kubun_id",
    "doctors",
    "dokuyakau_gekiyaku_kubun_id",
    "day_type",
    "day_type_sequence",
    "general_name",
    "generic_kubun_id",
    "high_risk_drug_flag",
    "is_holiday",
    "keiryo_kongo_kanou_kubun_id",
    "kekkaku_yobou_flag",
    "kikaku",
    "kisei_drug_kubun_id",
    "store_code",
    "tanni_name",
    "tanni_suryo",
    "tokutei_hoken_kubun_id",
    "yakushu_zaigata_kubun_id",
    "yj_code",
)


def _f(name: str, kind: T.DataType, required: bool = False, comment: str = "") -> T.StructField:
    return T.StructField(name, kind, not required, {"comment": comment} if comment else {})


_S, _L, _D, _DT, _B = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.BooleanType()

CALENDAR = T.StructType(
    [
        _f("jst_date", _DT, True, "calendar day"),
        _f("is_holiday", _B, True, "weekend or public holiday"),
        _f("dayofweek", _L, True, "Sunday = 1"),
        _f("day_type", _S, True, "weekday, weekend or holiday name"),
        _f("day_type_sequence", _S, True, "day-off flags of the previous, this and the next day"),
    ]
)

PANEL = T.StructType(
    [
        _f("yj_code", _S, True, "item"),
        _f("store_code", _S, True, "location"),
        _f("dispensing_date", _DT, True, "day"),
        _f("dayofweek", _L, True),
        _f("dayofyear", _L, True),
        _f("day", _L, True),
        _f("week", _L, True),
        _f("application_start_date", _DT),
        *[_f(c, _S) for c in MASTER_TEXT],
        _f("tanni_suryo", _D),
        *[_f(c, _S) for c in MASTER_FLAGS],
        _f("days_from_application", _L, comment="application start minus day"),
        _f("nunique_patient_by_yj_store", _L, comment="distinct subjects of the day, item and location"),
        _f("nunique_patient_by_yj", _L, comment="distinct subjects of the day and item"),
        _f("total_dose_by_yj_store", _D, comment="forward-horizon quantity, item and location"),
        _f("total_dose_by_yj", _D, comment="forward-horizon quantity, item"),
        _f("total_price_by_yj_store", _D, comment="forward-horizon money, item and location"),
        _f("total_price_by_yj", _D, comment="forward-horizon money, item"),
    ]
)

DIFF_PANEL = T.StructType(
    [
        *PANEL.fields,
        *[
            _f(f"{p}_total_dose_by_{k}", _D)
            for p in ("lag", "diff")
            for k in ("yj_store", "yj")
        ],
    ]
)

ABC = T.StructType(
    [
        _f("yj_code", _S, True),
        _f("store_code", _S, True),
        _f("dispensing_date", _DT, True, "day the class is used for"),
        _f("sum_total_dose", _D, True),
        _f("count_prescription", _L, True),
        _f("total_dose_rank_by_yj", _D, True),
        _f("total_dose_rank_by_yj_store", _D, True),
        _f("count_rank_by_yj", _D, True),
        _f("count_rank_by_yj_store", _D, True),
        _f("model_abc_flag", _S, True),
        _f("data_abc_flag", _S, True),
    ]
)

MODEL_PREDICTION = T.StructType(
    [
        _f("yj_code", _S, True),
        _f("store_code", _S, True),
        _f("dispensing_date", _DT, True),
        _f("predicted_total_dose", _D),
    ]
)

BLENDED_PREDICTION = T.StructType(
    [
        _f("yj_code", _S, True),
        _f("store_code", _S, True),
        _f("pred_exe_date", _DT, True),
        _f("pred_period", _S, True),
        _f("pred_period_start", _DT, True),
        _f("pred_period_end", _DT, True),
        _f("model_id", _S, True),
        _f("predicted_values", _D),
    ]
)

EVALUATION = T.StructType(
    [
        _f("execution_date", _DT, True),
        _f("model_version", _S),
        _f("rmse", _D),
        _f("mae", _D),
        _f("r2", _D),
    ]
)

EVALUATION_FILE = T.StructType([f for f in EVALUATION.fields if f.name != "execution_date"])


def conform(df, schema: T.StructType):
    """Select and cast the columns of ``schema`` by name, attaching its comments."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])
