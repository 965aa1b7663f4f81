"""Encoding, boosted-tree fitting, scoring and evaluation as distributed jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.stage import running_totals, stage
from demandspark.operators.boost import Boosted, BoostParams, fit_phases, gain_importance

# Fixed replacement values for categories not shared by train and valid.
OTHER_TEXT = "other"
OTHER_NUMBER = -20000


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))


def split(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(F.col("split_flag") == flag)


def known_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, text, number)`` values that occur in both train and valid.

    One pass over the data for all columns: each row contributes its values with
    the split they come from, combined map-side.
    """

    def value(c: str):
        number = F.col(c).cast("double") if _is_numeric(df, c) else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if _is_numeric(df, c) else F.col(c)
        return F.struct(F.lit(c).alias("feature"), text.alias("text"), number.alias("number"))

    flags = df.filter(F.col("split_flag").isin("train", "valid"))
    return (
        flags.select("split_flag", F.explode(F.array(*[value(c) for c in columns])).alias("v"))
        .groupBy("v.feature", "v.text", "v.number")
        .agg(
            F.max(F.col("split_flag") == "train").alias("in_train"),
            F.max(F.col("split_flag") == "valid").alias("in_valid"),
        )
        .filter("in_train and in_valid and (text is not null or number is not null)")
        .select("feature", "text", "number")
    )


def fit_encoder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, text, number, code)``: dense codes in sort order, the
    replacement category included.

    Categories can be as many as the pairs (prescriber texts), so codes come
    from range-partitioned running counts, not from one sorted task.
    """
    spark = df.sparkSession
    others = spark.createDataFrame(
        [
            (c, None, float(OTHER_NUMBER)) if _is_numeric(df, c) else (c, OTHER_TEXT, None)
            for c in columns
        ],
        "feature string, text string, number double",
    )
    values = stage(known_categories(df, columns).unionByName(others).distinct(), "categories")
    one = {"rank": F.lit(1).cast("long")}
    texts = running_totals(values.filter("text is not null"), ["feature"], "text", one, "codes")
    numbers = running_totals(values.filter("number is not null"), ["feature"], "number", one, "codes")
    code = (F.col("rank") - 1).alias("code")
    return texts.select("feature", "text", F.lit(None).cast("double").alias("number"), code).unionByName(
        numbers.select("feature", F.lit(None).cast("string").alias("text"), "number", code)
    )


#: Bytes of a text that a dictionary is looked up by; longer ones go by their digest.
KEY_BYTES = 64


def lookup_key(value: Column) -> Column:
    """The text a value is looked up by: prescriber texts grow with the facts, their keys do not."""
    text = value.cast("string")
    return F.when(F.octet_length(text) > KEY_BYTES, F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))).otherwise(text)


#: Entries of a column's dictionary that one projection looks up, and that may be broadcast (some 100 bytes each).
LOOKUP_ROWS, BROADCAST_ROWS = 1_000, 100_000


def apply_encoder(df: DataFrame, encoder: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Append ``<column>_code``; NULL and unknown values take the replacement's code.

    Small dictionaries are maps in one projection of the rows, larger ones of a checked size
    broadcast joins, so that rows are not shuffled for either.  Columns with still larger ones share one
    join: their values are exploded, meet the dictionary by (feature, value), and come back to
    their row by its key.
    """
    fallback = F.coalesce((F.col("text") == OTHER_TEXT) | (F.col("number") == float(OTHER_NUMBER)), F.lit(False))
    encoder = stage(
        encoder.filter(F.col("feature").isin(*columns)).select("feature", lookup_key(F.coalesce("text", F.col("number").cast("string"))).alias("__v"), "code", fallback.alias("__other")), "encoder"
    )
    other = {r["feature"]: r["code"] for r in encoder.filter("__other").select("feature", "code").collect()}  # one a column
    sizes = {r["feature"]: r["count"] for r in encoder.groupBy("feature").count().collect()}
    tiny = [c for c in columns if sizes.get(c, 0) <= LOOKUP_ROWS]
    small = [c for c in columns if LOOKUP_ROWS < sizes.get(c, 0) <= BROADCAST_ROWS]
    large = [c for c in columns if sizes.get(c, 0) > BROADCAST_ROWS]
    key = lambda c: lookup_key(F.col(f"`{c}`").cast("double") if _is_numeric(df, c) else F.col(f"`{c}`"))
    code = lambda c, found: F.coalesce(found, F.lit(other[c])).cast("long")
    out = df
    if small:
        # the row rides along packed, so that each join copies one value
        out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__all"), *[key(c).alias(f"__k_{c}") for c in small])
        for c in small:
            codes = encoder.filter(F.col("feature") == c).select(F.col("__v").alias(f"__k_{c}"), F.col("code").alias(f"__code_{c}"))
            out = out.join(F.broadcast(codes), f"__k_{c}", "left")
        out = out.select("__all.*", *[f"__code_{c}" for c in small])
    if large:
        out = stage(out.withColumn("__row", F.monotonically_increasing_id()), "to-encode")
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), key(c).alias("__v")) for c in large])).alias("x")
        # NULLs have no code; they would only meet in one task
        found = out.select("__row", values).select("__row", "x.*").where("__v is not null").join(encoder.select("feature", "__v", "code"), ["feature", "__v"])
        wide = found.groupBy("__row").agg(*[F.max(F.when(F.col("feature") == c, F.col("code"))).alias(f"__code_{c}") for c in large])
        out = out.join(wide, "__row", "left").drop("__row")
    maps: dict[str, list] = {c: [] for c in tiny}
    for r in encoder.filter(F.col("feature").isin(*tiny)).select("feature", "__v", "code").collect() if tiny else ():  # LOOKUP_ROWS of a column
        maps[r["feature"]] += [F.lit(r["__v"]), F.lit(r["code"])]
    found = {c: F.try_element_at(F.create_map(*maps[c]), key(c)) if maps[c] else F.lit(None) for c in tiny} | {c: F.col(f"__code_{c}") for c in [*small, *large]}
    return out.withColumns({c + suffix: code(c, found[c]) for c in columns}).drop(*[f"__code_{c}" for c in [*small, *large]])


def encode_categories(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Fit on the frame's own train and valid splits and encode every row."""
    return apply_encoder(df, fit_encoder(df, columns), columns, suffix)


@dataclass(frozen=True)
class Fit:
    """A model, the features it was given, and the rounds that the validation split chose."""

    model: Boosted
    columns: tuple[str, ...]
    best: int

    @property
    def rounds(self) -> int:
        return self.model.rounds


def fit_two_phase(
    df: DataFrame, features: Sequence[str], label: str, params: BoostParams | None = None, categories: Sequence[str] = (), path: str | None = None
) -> Fit:
    """Find the number of rounds on the valid split, then refit on everything
    but the test split with rounds scaled by the row ratio.

    Rows between the splits (NULL flag) belong to the second fit only.  ``categories`` are the
    features that are codes of categories.  A fit under a ``path`` that was interrupted goes on.
    """
    rest = df.filter(F.coalesce(F.col("split_flag") != "test", F.lit(True)))
    model, best = fit_phases(rest, features, categories, label, params or BoostParams(), path)
    return Fit(model, tuple(features), best)


def score(model: Boosted, df: DataFrame) -> DataFrame:
    """Append the prediction; the original columns stay untouched."""
    return model.transform(df)


def save_fit(fit: Fit, encoder: DataFrame, path: str) -> None:
    """Write the encoder table and the fitted model under ``path``."""
    encoder.write.mode("overwrite").parquet(f"{path}/encoder")
    fit.model.save(encoder.sparkSession, f"{path}/model")


def load_fit(spark: SparkSession, path: str) -> tuple[DataFrame, Boosted]:
    return spark.read.parquet(f"{path}/encoder"), Boosted.load(spark, f"{path}/model")


def feature_importance(fit: Fit, spark: SparkSession) -> DataFrame:
    """Total gain per feature, descending; 0 for features without a split."""
    every = spark.createDataFrame([(c,) for c in fit.columns], "feature string")
    gains = gain_importance(fit.model.nodes(spark))
    return every.join(gains, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(F.col("importance").desc(), "feature")


def regression_metrics(
    df: DataFrame, label: str, prediction: str, model_version: str, add_back: str | None = None
) -> DataFrame:
    """One row of RMSE, MAE and R2; ``add_back`` is added to both sides first
    (the stored lag of a differenced label)."""
    offset = F.col(add_back) if add_back else F.lit(0.0)
    y, p = F.col(label) + offset, F.col(prediction) + offset
    sse = F.sum(F.pow(y - p, 2))
    sst = F.var_pop(y) * F.count(y)
    r2 = F.when(sst > 0, 1 - sse / F.when(sst > 0, sst)).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))
    return df.agg(
        F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"), F.avg(F.abs(y - p)).alias("mae"), r2.alias("r2")
    ).select(F.lit(model_version).alias("model_version"), "rmse", "mae", "r2")

