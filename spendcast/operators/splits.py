"""Spend strata, the stratified customer split and stratified folds.

A hash of the id gives the shuffle order. Its first digits are a bucket number that is even by
construction, so exact positions inside a stratum need only counts per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.config import SETTINGS
from spendcast.operators.quantiles import exact_quantiles, quantile_values

BUCKET_DIGITS = 3


def shuffle_key(key: str = "customer_id", seed: int = SETTINGS.seed) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratum_edges(base: DataFrame, target: str = "Next_3M_Spend", strata: int = SETTINGS.strata) -> list[float]:
    """Inner edges of the quantile cut of ``log1p(target)``, equal edges merged."""
    logs = base.select(F.log1p(target).alias("log_spend"))
    probs = [i / strata for i in range(strata + 1)]
    edges = sorted(set(quantile_values(logs, ["log_spend"], probs).get("log_spend", [])))
    return edges[1:-1]


def with_stratum(base: DataFrame, edges: Sequence[float], target: str = "Next_3M_Spend") -> DataFrame:
    """Stratum = number of inner edges strictly below the value."""
    above = [(F.log1p(target) > F.lit(float(e))).cast("int") for e in edges]
    total = F.lit(0)
    for flag in above:
        total = total + flag
    return base.withColumn("stratum", total.cast("int"))


def with_fallback_stratum(base: DataFrame, target: str = "Next_3M_Spend") -> DataFrame:
    """Zero, up to the median of the positive values, above it."""
    median = (
        exact_quantiles(base.filter(F.col(target) > 0), [target], [0.5]).select(F.col("q")[0].alias("m")).scalar()
    )
    stratum = F.when(F.col(target) <= 0, 0).when(F.col(target) <= median, 1).otherwise(2)
    return base.withColumn("stratum", stratum.cast("int"))


def _bucketed(base: DataFrame, by: str, key: str, seed: int) -> DataFrame:
    hashed = base.select(key, by).withColumn("_hash", shuffle_key(key, seed))
    return hashed.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))


def _bucket_counts(bucketed: DataFrame, by: str) -> DataFrame:
    """Rows before each bucket. At most 4096 buckets per value of ``by``."""
    counts = bucketed.groupBy(by, "_bucket").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(by)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns(
        {"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_all": F.sum("_n").over(whole)}
    )


def stratified_split(
    base: DataFrame,
    by: str = "stratum",
    key: str = "customer_id",
    share: float = SETTINGS.train_share,
    seed: int = SETTINGS.seed,
) -> DataFrame:
    """Exactly ``floor(share * n)`` rows of each stratum, first in hash order, become train.

    Counts find the one bucket per stratum that holds the cut, only that bucket is ordered, and
    the cut itself (one row per stratum) is joined back. The rows are never shuffled.
    """
    bucketed = _bucketed(base, by, key, seed)
    wanted = F.floor(F.lit(float(share)) * F.col("_all"))
    cut_bucket = (
        _bucket_counts(bucketed, by)
        .filter((F.col("_before") < wanted) & (wanted <= F.col("_before") + F.col("_n")))
        .select(F.col(by).alias("_by"), F.col("_bucket").alias("_cut_bucket"), (wanted - F.col("_before")).alias("_k"))
    )
    inside = bucketed.join(
        F.broadcast(cut_bucket), (F.col(by) == F.col("_by")) & (F.col("_bucket") == F.col("_cut_bucket"))
    )
    order = Window.partitionBy("_by").orderBy("_hash", key)
    cut = (
        inside.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") == F.col("_k"))
        .select("_by", F.col("_hash").alias("_cut_hash"), F.col(key).alias("_cut_key"))
    )
    first = F.struct(shuffle_key(key, seed), F.col(key)) <= F.struct("_cut_hash", "_cut_key")
    return (
        base.join(F.broadcast(cut), F.col(by) == F.col("_by"), "left")
        .withColumn("split", F.when(F.col("_cut_hash").isNotNull() & first, "train").otherwise("test"))
        .drop("_by", "_cut_hash", "_cut_key")
    )


def stratified_folds(
    base: DataFrame, by: str, folds: int, key: str = "customer_id", seed: int = SETTINGS.seed
) -> DataFrame:
    """Add ``fold``: position in hash order inside each class, modulo ``folds``."""
    bucketed = _bucketed(base, by, key, seed)
    counts = _bucket_counts(bucketed, by).select(
        F.col(by).alias("_by"), F.col("_bucket").alias("_b"), "_before"
    )
    hashed = base.withColumn("_hash", shuffle_key(key, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    joined = hashed.join(F.broadcast(counts), (F.col(by) == F.col("_by")) & (F.col("_bucket") == F.col("_b")))
    inside = Window.partitionBy(by, "_bucket").orderBy("_hash", key)
    position = F.row_number().over(inside) + F.col("_before") - 1
    return joined.withColumn("fold", (position % folds).cast("int")).drop("_hash", "_bucket", "_by", "_b", "_before")


def fold_count(n_rows: int) -> int:
    return min(5, max(3, n_rows // 10))


def split_diagnostics(base: DataFrame, whale_edge: float, target: str = "Next_3M_Spend") -> DataFrame:
    """Per split: rows, share above the whole population's P80, zero share, mean and maximum."""
    spend = F.col(target)
    return base.groupBy("split").agg(
        F.count("*").alias("n"),
        F.avg((spend > whale_edge).cast("double")).alias("whale_share"),
        F.avg((spend == 0).cast("double")).alias("zero_share"),
        F.avg(spend).alias("mean_spend"),
        F.max(spend).alias("max_spend"),
    )


def target_summary(base: DataFrame, target: str = "Next_3M_Spend") -> DataFrame:
    logs = F.log1p(target)
    return base.groupBy("split").agg(
        F.avg(logs).alias("mean_log"),
        F.max(logs).alias("max_log"),
        F.avg(target).alias("mean_dollars"),
        F.max(target).alias("max_dollars"),
    )
