"""Distinct counts over any span of months, from one mergeable sketch per customer and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Binary logarithm of the registers of a sketch: 4096 of them, 1.04 / sqrt(4096) = 1.6 % standard error.
LG_REGISTERS = 12


def standard_error(lg: int = LG_REGISTERS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (lg / 2)


def monthly_sketches(lines: DataFrame, column: str = "StockCode", lg: int = LG_REGISTERS) -> DataFrame:
    """Rows (customer_id, month, sketch) of the non-null values of ``column``, combined map-side.

    Written once by month, they answer for every window without a read of the lines.
    """
    month = F.trunc(F.to_date("InvoiceDate"), "month").alias("month")
    known = lines.filter(F.col(column).isNotNull())
    return known.groupBy("customer_id", month).agg(F.hll_sketch_agg(F.col(column), lg).alias("sketch"))


def distinct_estimates(sketches: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Estimated distinct values (customer_id, estimate) over the months from ``first`` to ``last``, both included.

    Customers without a value in the window have no row.
    """
    if first is not None:
        sketches = sketches.filter(F.col("month") >= F.lit(first).cast("date"))
    if last is not None:
        sketches = sketches.filter(F.col("month") <= F.lit(last).cast("date"))
    merged = sketches.groupBy("customer_id").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("customer_id", F.hll_sketch_estimate("sketch").alias("estimate"))
