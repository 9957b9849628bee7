"""Error metrics as single-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def r_squared(sse: Column, y: Column) -> Column:
    """1 - SSE/SST with a centred SST; for constant actuals 1 if exact, else 0."""
    sst = F.var_pop(y) * F.count(y)
    return F.when(sst > 0, 1 - sse / sst).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))


def metric_columns(actual: str | Column, predicted: str | Column) -> list[Column]:
    """RMSE, MAE, R2, WAPE and SMAPE. WAPE is null when the actuals sum to zero."""
    y = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    error = F.abs(y - p)
    sse = F.sum((y - p) * (y - p))
    size = F.sum(F.abs(y))
    return [
        F.sqrt(sse / F.count(y)).alias("RMSE"),
        F.avg(error).alias("MAE"),
        r_squared(sse, y).alias("R2"),
        F.when(size > 0, F.sum(error) / size * 100).alias("WAPE"),
        (F.avg(2 * error / (F.abs(y) + F.abs(p) + F.lit(1e-8))) * 100).alias("SMAPE"),
    ]


def metric_bundle(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("N"), *metric_columns(actual, predicted))


def dual_scale_metrics(df: DataFrame, by: Sequence[str] = (), log_actual: str = "log_actual",
                       log_predicted: str = "log_predicted", actual: str = "actual",
                       predicted: str = "predicted") -> DataFrame:
    """Leaderboard metrics: log-scale errors and dollar-scale errors in one pass."""
    log = {m: c for m, c in zip(("RMSE", "MAE", "R2"), metric_columns(log_actual, log_predicted))}
    dollar = dict(zip(("RMSE", "MAE", "R2", "WAPE", "SMAPE"), metric_columns(actual, predicted)))
    return df.groupBy(*by).agg(
        log["MAE"].alias("Log_MAE"),
        log["RMSE"].alias("Log_RMSE"),
        log["R2"].alias("Log_R2"),
        dollar["RMSE"].alias("Dollar_RMSE"),
        dollar["MAE"].alias("Dollar_MAE"),
        dollar["R2"].alias("Dollar_R2"),
        dollar["SMAPE"].alias("SMAPE"),
        dollar["WAPE"].alias("WAPE"),
    )
