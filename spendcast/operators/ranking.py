"""Global running totals and ranks without a single-task window.

The rows are range-partitioned on the sort key and written once together with their range
number. Totals per range (one row per range) give each range its starting offset, and the only
window runs inside a range. Written, the range number is a plain column: a lost executor cannot
change it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.session import materialize

HEAVY_SHARE = 1000


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: dict[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<name>_cum`` (up to and with the row) and ``<name>_total`` for each of ``sums``.

    ``order`` has to be unique inside ``by``: pre-aggregate equal keys or add an id, so that a
    value shared by a third of the rows is either one row here or split by the id.
    """
    by = list(by)
    measured = df.withColumns({f"_m_{name}": column for name, column in sums.items()})
    ranged = materialize(
        measured.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    )
    per_range = ranged.groupBy(*by, "_range").agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_range").alias("_by_range"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(group).alias(f"{n}_total") for n in sums],
    )
    # One row per range, plus one per group boundary that falls inside a range.
    same = F.col("_range") == F.col("_by_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = (
        Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.withColumns({f"_l_{n}": F.sum(f"_m_{n}").over(inside) for n in sums})
    joined = local.join(F.broadcast(offsets), same)
    return joined.withColumns({f"{n}_cum": F.col(f"_l_{n}") + F.col(f"_o_{n}") for n in sums}).select(
        *df.columns, *[f"{n}_cum" for n in sums], *[f"{n}_total" for n in sums]
    )


def join_on_value(
    df: DataFrame, lookup: DataFrame, key: str, weight: str, total: str, spread_by: str
) -> DataFrame:
    """Left join of a per-value ``lookup`` where some values may own a large share of ``df``.

    ``lookup`` has one row per value with its row count ``weight`` and the ``total`` of all counts.
    At most ``HEAVY_SHARE`` values can own 1/HEAVY_SHARE of the rows each, so that part is
    broadcast. Rows found there match nothing in the other part and are spread evenly over its
    shuffle.
    """
    fields = [c for c in lookup.columns if c not in (key, weight, total)]
    is_heavy = F.col(weight) * HEAVY_SHARE >= F.col(total)
    heavy = lookup.filter(is_heavy).select(
        F.col(key).alias("_heavy_key"), F.struct(*fields).alias("_heavy"), F.lit(True).alias("_is_heavy")
    )
    light = lookup.filter(~is_heavy).select(
        F.col(key).alias("_light_key"), F.xxhash64(key).alias("_light_part"), F.struct(*fields).alias("_light")
    )
    # The second key follows from the first, except for heavy rows: there it follows from the row.
    # A constant salt would be folded away and leave one partition with all rows of a value.
    marked = df.join(F.broadcast(heavy), F.col(key) == F.col("_heavy_key"), "left").withColumn(
        "_part", F.when(F.col("_is_heavy"), F.xxhash64(spread_by)).otherwise(F.xxhash64(key))
    )
    joined = marked.join(
        light, (F.col(key) == F.col("_light_key")) & (F.col("_part") == F.col("_light_part")), "left"
    )
    return joined.select(
        *df.columns, *[F.coalesce(F.col(f"_heavy.{c}"), F.col(f"_light.{c}")).alias(c) for c in fields]
    )


def train_percentile(
    base: DataFrame, value: str = "Monetary", out: str = "Monetary_Percentile", key: str = "customer_id"
) -> DataFrame:
    """Percentile of ``value`` in the train distribution; ``base`` needs a ``split`` column.

    Train rows get their rank with ties averaged, other rows the share of train rows at or below
    their value. Both come from one running count over the distinct values.
    """
    is_train = (F.col("split") == "train").cast("bigint")
    counted = base.groupBy(value).agg(F.sum(is_train).alias("n_train"), F.count("*").alias("n_rows"))
    ranked = running_totals(counted, [F.col(value)], {"train": F.col("n_train"), "rows": F.col("n_rows")})
    lookup = ranked.select(
        value,
        "n_rows",
        "rows_total",
        ((F.col("train_cum") - (F.col("n_train") - 1) / 2) / F.col("train_total")).alias("_rank_train"),
        (F.col("train_cum") / F.col("train_total")).alias("_rank_other"),
    )
    joined = join_on_value(base, lookup, value, "n_rows", "rows_total", key)
    picked = F.when(F.col("split") == "train", F.col("_rank_train")).otherwise(F.col("_rank_other"))
    return joined.withColumn(out, picked).drop("_rank_train", "_rank_other")


def gain_curve(
    scored: DataFrame, actual: str = "actual", predicted: str = "predicted", key: str = "customer_id"
) -> DataFrame:
    """Customers from best to worst prediction with cumulative shares; ties go by id.

    No rows when the total is zero.
    """
    ranked = running_totals(
        scored.select(key, actual, predicted),
        [F.col(predicted).desc(), F.col(key)],
        {"actual": F.col(actual), "row": F.lit(1)},
    )
    last = F.greatest(F.col("row_total") - 1, F.lit(1))
    return ranked.filter(F.col("actual_total") > 0).select(
        key,
        actual,
        predicted,
        F.col("row_cum").alias("position"),
        (F.col("actual_cum") / F.col("actual_total")).alias("cum_actual"),
        ((F.col("row_cum") - 1) / last).alias("cum_population"),
        F.col("row_total").alias("n"),
    )


def lift_points(curve: DataFrame, shares: Sequence[float] = (0.10, 0.20, 0.40)) -> DataFrame:
    """Revenue share at row ``floor(n * share) + 1`` of the curve, one row more than the share itself."""
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    return (
        curve.withColumn("share", F.explode(wanted))
        .filter(F.col("position") == F.floor(F.col("n") * F.col("share")) + 1)
        .select("share", F.col("cum_actual").alias("lift"))
    )


def gain_positions(
    scored: DataFrame, base: DataFrame, predicted: str = "predicted", key: str = "customer_id"
) -> DataFrame:
    """Where predictions fall in the distribution of ``base``: share of base rows at or below."""
    both = base.select(key, predicted, F.lit("train").alias("split")).unionByName(
        scored.select(key, predicted, F.lit("scored").alias("split"))
    )
    return (
        train_percentile(both, predicted, "gain_position", key)
        .filter("split = 'scored'")
        .select(key, predicted, "gain_position")
    )
