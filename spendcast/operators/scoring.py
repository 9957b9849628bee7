"""From predictions on the log scale to dollars, bands and segments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.config import FEATURE_COLS, SETTINGS, Settings
from spendcast.operators.quantiles import quantile_values

# Segment names of scored customers.
CHURNED, LOW, MID, WHALE = "Churned", "Low", "Mid", "Whale"


def dollars(log_prediction: Column, log_max: float = SETTINGS.log_pred_max) -> Column:
    return F.expm1(F.least(F.greatest(log_prediction, F.lit(0.0)), F.lit(float(log_max))))


def segment_of(amount: Column, settings: Settings = SETTINGS) -> Column:
    return (
        F.when(amount < settings.churned_below, CHURNED)
        .when(amount < settings.segment_low, LOW)
        .when(amount < settings.segment_high, MID)
        .otherwise(WHALE)
    )


def band_columns(amount: Column, settings: Settings = SETTINGS) -> dict[str, Column]:
    """Prediction with its band, in cents, and the segment of the unrounded amount."""
    return {
        "CLV_Predicted_90d": F.bround(amount, 2),
        "CLV_Low": F.bround(F.greatest(amount * (1 - settings.band), F.lit(0.0)), 2),
        "CLV_High": F.bround(amount * (1 + settings.band), 2),
        "Segment": segment_of(amount, settings),
    }


def hurdle_dollars(prob: Column, log_amount: Column, settings: Settings = SETTINGS) -> Column:
    """Probability times amount in dollars; zero when unlikely or tiny."""
    expected = prob * dollars(log_amount, settings.log_pred_max)
    return F.when((prob < settings.churn_threshold) | (expected < settings.min_dollars), 0.0).otherwise(expected)


def fit_defaults(train: DataFrame) -> dict[str, float]:
    """Train medians, the fill values for features a caller does not give."""
    return {c: q[0] for c, q in quantile_values(train, FEATURE_COLS, [0.5]).items()}


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Add missing features and fill nulls; further columns stay."""
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(defaults.get(c, 0.0))))
        if c in df.columns
        else F.lit(float(defaults.get(c, 0.0)))
        for c in FEATURE_COLS
    }
    return df.withColumns(filled)


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURE_COLS, outputCol="features").transform(df)


def score(model: Model, df: DataFrame, defaults: Mapping[str, float], settings: Settings = SETTINGS) -> DataFrame:
    """Score customers: the input as given, with prediction, band and segment appended. No shuffle.

    Features that were not given are added with their fill values.
    """
    given = df.withColumn("_given", F.struct(*df.columns))
    predicted = model.transform(assemble(fill_defaults(given, defaults)))
    amount = dollars(F.col("prediction"), settings.log_pred_max)
    appended = band_columns(amount, settings)
    added = [c for c in FEATURE_COLS if c not in df.columns]
    return predicted.withColumns(appended).select("_given.*", *added, *appended)


def preview(scored: DataFrame, rows: int = 50, key: str = "customer_id") -> DataFrame:
    """The first features and the outputs of the first rows by id."""
    outputs = ["CLV_Predicted_90d", "CLV_Low", "CLV_High", "Segment"]
    return scored.orderBy(key).select(key, *FEATURE_COLS[:5], *outputs).limit(rows)
