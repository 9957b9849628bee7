"""Temporal split and per-customer history features.

Line items are first combined to day, invoice and product grain, so a customer who owns a
third of all rows is spread over many groups and only small partial results meet per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.config import MONEY_DIGITS, SETTINGS
from spendcast.operators.cleaning import canonical_id


def money(total: Column) -> Column:
    return F.round(total, MONEY_DIGITS)


def date_range(valid: DataFrame, horizon_days: int = SETTINGS.horizon_days) -> DataFrame:
    """One row: first and last time stamp and the split point."""
    horizon = F.make_dt_interval(F.lit(horizon_days))
    return valid.agg(F.min("InvoiceDate").alias("min_ts"), F.max("InvoiceDate").alias("max_ts")).withColumn(
        "split_ts", F.col("max_ts") - horizon
    )


def split_point(valid: DataFrame, horizon_days: int = SETTINGS.horizon_days) -> Column:
    """The split point as a scalar subquery: nothing is collected and no row is joined."""
    return date_range(valid, horizon_days).select("split_ts").scalar()


def history(transactions: DataFrame, split_ts: Column) -> DataFrame:
    """Rows before the split; of a table laid out by ``month`` only the months up to it are read."""
    rows = transactions.filter(F.col("InvoiceDate") < split_ts)
    return rows.filter(F.col("month") <= F.trunc(split_ts, "month")) if "month" in rows.columns else rows


def outcome(transactions: DataFrame, split_ts: Column) -> DataFrame:
    """Rows from the split on; of a table laid out by ``month`` only its month and later ones are read."""
    rows = transactions.filter(F.col("InvoiceDate") >= split_ts)
    return rows.filter(F.col("month") >= F.trunc(split_ts, "month")) if "month" in rows.columns else rows


def customers(transactions: DataFrame) -> DataFrame:
    return transactions.select("customer_id").distinct()


def days(hist: DataFrame) -> DataFrame:
    """Customer-day grain: spend, lines, first and last time of the day."""
    return hist.groupBy("customer_id", F.to_date("InvoiceDate").alias("day")).agg(
        F.min("InvoiceDate").alias("first_ts"),
        F.max("InvoiceDate").alias("last_ts"),
        F.count("*").alias("lines"),
        money(F.sum("TotalAmount")).alias("spend"),
    )


def day_gaps(day_rows: DataFrame) -> DataFrame:
    """Whole days between the last purchase of the previous active day and the first of this one.

    Gaps inside one day are shorter than 24 h and floor to zero, so day grain loses nothing and
    the window never sees more rows per customer than there are calendar days.
    """
    by_day = Window.partitionBy("customer_id").orderBy("day")
    elapsed = F.col("first_ts") - F.lag("last_ts").over(by_day)
    return day_rows.withColumn("gap", F.extract(F.lit("DAY"), elapsed).cast("bigint"))


def _gap_std() -> Column:
    """Sample deviation of all line-to-line gaps, from exact integer sums."""
    n = (F.sum("lines") - 1).cast("double")
    total = F.coalesce(F.sum("gap"), F.lit(0)).cast("double")
    squares = F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).cast("double")
    return F.when(n > 1, F.sqrt(F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1))).otherwise(0.0)


def rfm(day_rows: DataFrame, split_ts: Column) -> DataFrame:
    """Recency, Frequency, Monetary and T, plus the features that share the day grain.

    Frequency counts repeat days, Monetary is the mean spend of repeat days, Recency is the age
    at the last purchase and T the age at the split.
    """
    repeat_spend = F.when(F.col("gap").isNotNull(), F.col("spend"))
    return (
        day_gaps(day_rows)
        .groupBy("customer_id")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.count("*").alias("active_days"),
            F.coalesce(money(F.avg(repeat_spend)), F.lit(0.0)).alias("Monetary"),
            _gap_std().alias("Interpurchase_Std"),
        )
        .select(
            "customer_id",
            F.date_diff("last_day", "first_day").cast("double").alias("Recency"),
            (F.col("active_days") - 1).cast("double").alias("Frequency"),
            "Monetary",
            F.date_diff(F.to_date(split_ts), "first_day").cast("double").alias("T"),
            "Interpurchase_Std",
            F.col("active_days").cast("double").alias("Visit_Diversity"),
        )
    )


def baskets(hist: DataFrame) -> DataFrame:
    """Mean invoice size in items and largest invoice in money."""
    invoices = hist.groupBy("customer_id", "Invoice").agg(
        F.sum("Quantity").alias("items"), money(F.sum("TotalAmount")).alias("amount")
    )
    return invoices.groupBy("customer_id").agg(
        F.greatest(F.avg("items"), F.lit(0.0)).alias("Avg_Basket_Size"),
        F.greatest(F.max("amount"), F.lit(0.0)).alias("Max_Single_Order"),
    )


def products(hist: DataFrame) -> DataFrame:
    pairs = hist.select("customer_id", "StockCode").filter(F.col("StockCode").isNotNull()).distinct()
    return pairs.groupBy("customer_id").agg(F.count("*").cast("double").alias("Unique_Products"))


def return_rates(raw: DataFrame, split_ts: Column | None = None) -> DataFrame:
    """Share of a customer's raw invoices that hold a return.

    With ``split_ts`` only history counts; without it the whole raw table does.
    """
    rows = raw.select(
        canonical_id(F.col("Customer ID")).alias("customer_id"), "Invoice", "InvoiceDate", "Quantity"
    ).filter(F.col("customer_id").isNotNull() & F.col("Invoice").isNotNull())
    if split_ts is not None:
        rows = history(rows, split_ts)
    return _return_rates(rows.withColumn("returned", F.coalesce(F.col("Quantity") < 0, F.lit(False))))


def _return_rates(rows: DataFrame) -> DataFrame:
    invoices = rows.groupBy("customer_id", "Invoice").agg(F.max("returned").alias("returned"))
    return invoices.groupBy("customer_id").agg(
        (F.count_if("returned") / F.count("*")).cast("double").alias("Return_Rate")
    )


def targets(out: DataFrame) -> DataFrame:
    return out.groupBy("customer_id").agg(money(F.sum("TotalAmount")).alias("Next_3M_Spend"))


def with_target(features: DataFrame, target: DataFrame) -> DataFrame:
    """Every customer with history; no outcome spend means zero."""
    return (
        features.join(target, "customer_id", "left")
        .fillna(0.0, ["Next_3M_Spend"])
        .withColumn("log_target", F.log1p("Next_3M_Spend"))
    )


def derived(features: DataFrame) -> DataFrame:
    """Ratios on uncapped values."""
    span = F.greatest(F.col("T"), F.lit(1.0))
    return features.withColumns(
        {
            "Purchase_Rate": F.coalesce(F.col("Frequency") / span, F.lit(0.0)),
            "Days_Since_Purchase": F.greatest(F.col("T") - F.col("Recency"), F.lit(0.0)),
            "Revenue_Per_Day": F.coalesce(F.col("Monetary") / span, F.lit(0.0)),
        }
    )


def _check_scope(return_scope: str) -> None:
    if return_scope not in ("history", "all"):
        raise ValueError("return_scope is 'history' or 'all'")


def behaviour(
    transactions: DataFrame,
    split_ts: Column,
    raw: DataFrame | None = None,
    return_scope: str = "history",
) -> DataFrame:
    """All history features and the target, one row per customer.

    Each part ends in an aggregate on ``customer_id``, so the joins reuse that partitioning.
    """
    _check_scope(return_scope)
    returns = None if raw is None else return_rates(raw, split_ts if return_scope == "history" else None)
    return _behaviour(transactions, split_ts, returns)


def marked_behaviour(marked: DataFrame, split_ts: Column, return_scope: str = "history") -> DataFrame:
    """``behaviour`` from a table of ``cleaning.mark``: no part of it reads the raw rows again."""
    _check_scope(return_scope)
    rows = marked.filter(F.col("Invoice").isNotNull())
    returns = _return_rates(history(rows, split_ts) if return_scope == "history" else rows)
    return _behaviour(marked.filter("valid"), split_ts, returns)


def _behaviour(transactions: DataFrame, split_ts: Column, returns: DataFrame | None) -> DataFrame:
    hist = history(transactions, split_ts)
    frame = rfm(days(hist), split_ts)
    for part in (baskets(hist), products(hist)):
        frame = frame.join(part, "customer_id", "left")
    if returns is None:
        frame = frame.withColumn("Return_Rate", F.lit(0.0))
    else:
        frame = frame.join(returns, "customer_id", "left")
    frame = frame.fillna(0.0, ["Avg_Basket_Size", "Max_Single_Order", "Unique_Products", "Return_Rate"])
    return derived(with_target(frame, targets(outcome(transactions, split_ts))))
