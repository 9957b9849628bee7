"""Ordering, eligibility, ensemble members and highlights over a leaderboard table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spendcast.config import SETTINGS

# Model names with a special role.
BASELINES = ["Naive Baseline (Mean)", "BTYD Statistical Baseline"]
ENSEMBLE = "Weighted Ensemble"

LOWER_IS_BETTER = ["Log_MAE", "Log_RMSE", "Dollar_RMSE", "Dollar_MAE", "SMAPE", "WAPE", "CV_MAE_Mean"]
HIGHER_IS_BETTER = ["Log_R2", "Dollar_R2"]


def _is_baseline() -> Column:
    return F.col("Model").isin(BASELINES)


def ordered(board: DataFrame) -> DataFrame:
    return board.orderBy("CV_MAE_Mean", "Model")


def with_note(board: DataFrame) -> DataFrame:
    """``*`` cannot be champion, ``†`` has no cross-validation of its own."""
    return board.withColumn("note", F.when(_is_baseline(), "*").when(F.col("Model") == ENSEMBLE, "†").otherwise(""))


def eligible(board: DataFrame, min_r2: float = SETTINGS.min_dollar_r2) -> DataFrame:
    return board.filter(~_is_baseline() & (F.col("Model") != ENSEMBLE) & (F.col("Dollar_R2") > min_r2))


def champion(board: DataFrame, min_r2: float = SETTINGS.min_dollar_r2) -> DataFrame:
    return ordered(eligible(board, min_r2)).limit(1)


def ensemble_members(board: DataFrame, min_r2: float = SETTINGS.min_dollar_r2, size: int = 3) -> DataFrame:
    """Up to ``size`` models by Dollar R2 with inverse Dollar MAE weights; none if fewer than two qualify.

    The board has one row per model, so the total over the members is a small aggregate.
    """
    top = (
        board.filter(~_is_baseline() & (F.col("Model") != ENSEMBLE) & (F.col("Dollar_R2") > min_r2))
        .orderBy(F.desc("Dollar_R2"), "Model")
        .limit(size)
        .withColumn("raw", 1 / (F.col("Dollar_MAE") + F.lit(1e-8)))
    )
    total = top.agg(F.struct(F.sum("raw").alias("sum"), F.count("*").alias("n")).alias("t")).scalar()
    return top.filter(total["n"] >= 2).select("Model", (F.col("raw") / total["sum"]).alias("weight"), "CV_MAE_Mean")


def with_best_flags(board: DataFrame) -> DataFrame:
    """``best_<metric>``: whether a row holds the best value of the column."""
    best = board.agg(
        F.struct(
            *[F.min(c).alias(c) for c in LOWER_IS_BETTER], *[F.max(c).alias(c) for c in HIGHER_IS_BETTER]
        ).alias("b")
    ).scalar()
    return board.withColumns({f"best_{c}": F.col(c) == best[c] for c in LOWER_IS_BETTER + HIGHER_IS_BETTER})
