"""Segment tables, calibration, histograms and other report tables over (actual, predicted) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.config import SETTINGS
from spendcast.operators.metrics import metric_columns
from spendcast.operators.quantiles import exact_quantiles, quantile_values

# Segment names.
TOP, MID, LOW, ZERO, ALL = (
    "Top 20% Spenders",
    "Mid Spenders",
    "Low Spenders",
    "Zero-Spend (Churned)",
    "All Customers",
)


#: Values of the column that a histogram may be split by.
HISTOGRAM_GROUPS = 1000


def segment_thresholds(train: DataFrame, target: str = "Next_3M_Spend") -> tuple[float, float]:
    """P20 and P80 of positive spend; zero when nobody spends."""
    positive = train.filter(F.col(target) > 0)
    low, high = quantile_values(positive, [target], [0.2, 0.8]).get(target, [0.0, 0.0])
    return low, high


def segment_metrics(
    scored: DataFrame,
    thresholds: tuple[float, float],
    actual: str = "actual",
    predicted: str = "predicted",
    min_rows: int = SETTINGS.min_segment_rows,
) -> DataFrame:
    """Metrics per value segment and overall; segments below ``min_rows`` are left out."""
    low, high = (F.lit(float(t)) for t in thresholds)
    y = F.col(actual)
    member = F.array(
        F.when(y >= high, TOP),
        F.when((y > low) & (y < high), MID),
        F.when((y > 0) & (y <= low), LOW),
        F.when(y == 0, ZERO),
        F.lit(ALL),
    )
    metrics = {"WAPE": "WAPE%", "SMAPE": "SMAPE%"}
    grouped = (
        scored.select(F.explode(F.array_compact(member)).alias("Segment"), actual, predicted)
        .groupBy("Segment")
        .agg(
            F.count("*").alias("N"),
            *metric_columns(actual, predicted),
            F.avg(actual).alias("Avg_Actual"),
            F.avg(predicted).alias("Avg_Pred"),
        )
    )
    return grouped.filter(F.col("N") >= min_rows).withColumnsRenamed(metrics)


def calibration_curve(scored: DataFrame, prob: str = "prob_spend", actual: str = "actual", bins: int = 10) -> DataFrame:
    """Mean probability and observed rate per uniform, right-closed bin; empty bins are left out."""
    number = F.greatest(F.ceil(F.col(prob) * bins) - 1, F.lit(0))
    return scored.groupBy(number.cast("int").alias("bin")).agg(
        F.avg(prob).alias("mean_predicted"),
        F.avg((F.col(actual) > 0).cast("double")).alias("observed_rate"),
        F.count("*").alias("n"),
    )


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """Uniform bins between minimum and maximum, per value of ``by``; the last bin is closed.

    Empty bins are kept. A constant column gets bins half a unit around its value. ``by`` is a flag
    or segment with at most ``HISTOGRAM_GROUPS`` values (more raise), so the bounds, one row for
    each, are broadcast: rows are counted where they are and only counts are shuffled.
    """
    keyed = df.select((F.col(by) if by else F.lit(0)).alias("_by"), F.col(value).alias("_v")).filter("_v is not null")
    lone = F.col("_min") == F.col("_max")
    bounds = (
        keyed.groupBy("_by")
        .agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.count("*").alias("_n"))
        .select(
            F.col("_by").alias("_g"),
            F.when(lone, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
            F.when(lone, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"),
            "_n",
        )
    )
    if by:
        if bounds.limit(HISTOGRAM_GROUPS + 1).count() > HISTOGRAM_GROUPS:
            raise ValueError(f"{by} has more than {HISTOGRAM_GROUPS} values")
        placed = keyed.join(F.broadcast(bounds), F.col("_by").eqNullSafe(F.col("_g")))
    else:
        limits = bounds.select(F.struct("_lo", "_hi").alias("b")).scalar()
        placed = keyed.select(F.col("_by").alias("_g"), "_v", limits["_lo"].alias("_lo"), limits["_hi"].alias("_hi"))
    position = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)
    counted = (
        placed.select(F.col("_g").alias("_k"), F.least(position, F.lit(bins - 1)).cast("int").alias("_bin"))
        .groupBy("_k", "_bin")
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    frame = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    same = (F.col("bin") == F.col("_bin")) & (F.col("_g").eqNullSafe(F.col("_k")) if by else F.lit(True))
    filled = frame.join(counted, same, "left").fillna(0, ["n"])
    return filled.select(
        *([F.col("_g").alias(by)] if by else []),
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("left_edge"),
        "n",
        (F.col("n") / (F.col("_n") * width)).alias("density"),
    )


def residuals(scored: DataFrame, key: str = "customer_id") -> DataFrame:
    return scored.select(key, "log_predicted", (F.col("log_actual") - F.col("log_predicted")).alias("residual"))


def actual_vs_predicted(scored: DataFrame, key: str = "customer_id") -> DataFrame:
    return scored.select(
        key,
        "actual",
        "predicted",
        F.log1p("actual").alias("log_actual"),
        F.log1p("predicted").alias("log_predicted"),
    )


def predicted_spenders(scored: DataFrame, more_than: int = 20) -> DataFrame:
    """Rows with a positive prediction if there are more than ``more_than``, else all rows."""
    n = scored.agg(F.count_if(F.col("predicted") > 0).alias("n")).scalar()
    return scored.filter((F.col("predicted") > 0) | (n <= more_than))


def spender_count(scored: DataFrame, prob: str = "prob_spend", threshold: float = SETTINGS.churn_threshold) -> DataFrame:
    spends = F.col("actual") > 0
    return scored.agg(
        F.count("*").alias("customers"),
        F.count_if(spends).alias("actual_spenders"),
        F.count_if(~spends).alias("actual_non_spenders"),
        F.count_if(F.col(prob) >= threshold).alias("predicted_spenders"),
    )


def representatives(scored: DataFrame, key: str = "customer_id") -> DataFrame:
    """The spender with the highest, the most central and the lowest actual spend.

    Ties go to the lowest id. No rows below three customers.
    """
    spenders = scored.filter(F.col("actual") > 0)
    median = exact_quantiles(spenders, ["actual"], [0.5]).select(F.col("q")[0].alias("m")).scalar()
    keyed = spenders.select(key, "actual", F.abs(F.col("actual") - median).alias("_distance"))
    picks = keyed.agg(
        F.min_by(key, F.struct(-F.col("actual"), F.col(key))).alias("whale"),
        F.min_by(key, F.struct("_distance", key)).alias("mid"),
        F.min_by(key, F.struct("actual", key)).alias("low"),
        F.max("actual").alias("whale_actual"),
        F.min_by("actual", F.struct("_distance", key)).alias("mid_actual"),
        F.min("actual").alias("low_actual"),
    )
    enough = scored.agg(F.count("*").alias("n")).scalar() >= 3
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("profile"), F.col(name).alias(key), F.col(f"{name}_actual").alias("actual"))
            for name in ("whale", "mid", "low")
        ]
    )
    return picks.filter(F.col("whale").isNotNull() & enough).select(F.explode(rows).alias("r")).select("r.*")


def segment_counts(scored: DataFrame, segment: str = "Segment") -> DataFrame:
    return scored.groupBy(F.col(segment).alias("segment")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "segment")


def segment_totals(scored: DataFrame, segment: str = "Segment", value: str = "CLV_Predicted_90d") -> DataFrame:
    return scored.groupBy(F.col(segment).alias("segment")).agg(
        F.count("*").alias("customers"), F.avg(value).alias("mean_clv"), F.sum(value).alias("total_clv")
    )


def class_weights(kind: str, negatives: Column, positives: Column) -> tuple[Column, Column]:
    """Weights of non-spenders and spenders: n / (2 n_class), or max(1, n_neg / n_pos) for spenders, or 1."""
    one = F.lit(1.0)
    lone = (positives == 0) | (negatives == 0)
    if kind == "balanced":
        n = negatives + positives
        return F.when(lone, one).otherwise(n / (2 * negatives)), F.when(lone, one).otherwise(n / (2 * positives))
    if kind == "positive":
        return one, F.when(lone, one).otherwise(F.greatest(one, negatives / positives))
    return one, one


def class_balance(train: DataFrame, target: str = "Next_3M_Spend") -> DataFrame:
    """Spenders, non-spenders and the weight of a spender, at least one."""
    positive, negative = F.count_if(F.col(target) > 0), F.count_if(F.col(target) == 0)
    _, weight = class_weights("positive", negative, positive)
    return train.agg(positive.alias("n_positive"), negative.alias("n_negative"), weight.alias("positive_weight"))


def top_per_stage(importances: DataFrame, n: int = 14) -> DataFrame:
    """The ``n`` most important features of each stage."""
    order = Window.partitionBy("stage").orderBy(F.desc("importance"), "feature")
    return importances.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
