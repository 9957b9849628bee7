"""Outlier caps fitted on train rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendcast.config import CAPPED_COLS, SETTINGS
from spendcast.operators.quantiles import exact_quantiles


def outlier_caps(base: DataFrame, quantile: float = SETTINGS.cap_quantile) -> DataFrame:
    """P99 of each capped feature over train rows: feature, cap."""
    train = base.filter(F.col("split") == "train")
    return exact_quantiles(train, CAPPED_COLS, [quantile]).select("feature", F.col("q")[0].alias("cap"))


def fit_caps(base: DataFrame, quantile: float = SETTINGS.cap_quantile) -> dict[str, float]:
    return {r["feature"]: r["cap"] for r in outlier_caps(base, quantile).collect()}


def apply_caps(base: DataFrame, caps: dict[str, float]) -> DataFrame:
    """Clip at the caps; Frequency is then rounded half to even."""
    capped = {c: F.least(F.col(c), F.lit(float(v))) for c, v in caps.items()}
    if "Frequency" in capped:
        capped["Frequency"] = F.bround(capped["Frequency"], 0)
    return base.withColumns(capped)
