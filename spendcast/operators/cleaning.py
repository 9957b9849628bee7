"""From raw transaction rows to clean ones, with an audit of what was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spendcast.sources.transactions import check_columns

DEDUP_KEY = ["Invoice", "StockCode", "customer_id", "InvoiceDate"]


def canonical_id(raw: Column) -> Column:
    """``'12345.0'`` to ``'12345'``; text that is no whole number becomes null."""
    number = raw.try_cast("double")
    whole = number.try_cast("bigint")
    return F.when(number == whole.cast("double"), whole.cast("string"))


def valid_rows(raw: DataFrame) -> DataFrame:
    """Rows with a usable customer, a positive price and a positive quantity, with their revenue.

    Not deduplicated: good enough wherever copies do not matter, such as the date range.
    """
    checked = check_columns(raw)
    stamp = F.col("InvoiceDate").cast("timestamp_ntz")
    return (
        checked.filter(F.col("Customer ID").isNotNull())
        .withColumns({"customer_id": canonical_id(F.col("Customer ID")), "InvoiceDate": stamp})
        .filter(F.col("customer_id").isNotNull())
        .filter(F.col("Price") > 0)
        .filter(F.col("Quantity") > 0)
        .withColumn("TotalAmount", F.col("Quantity").cast("double") * F.col("Price").cast("double"))
        .drop("Customer ID")
    )


def drop_copies(valid: DataFrame) -> DataFrame:
    """Keep the first row of each transaction key.

    First means lowest ``line_no`` where the source has one, then lowest quantity and price,
    so the survivor is always the same row. Spark cuts each key to one row per task before
    the shuffle (WindowGroupLimit), so a key with very many copies stays small.
    """
    order = [c for c in ("line_no", "Quantity", "Price") if c in valid.columns]
    window = Window.partitionBy(*DEDUP_KEY).orderBy(*order)
    return valid.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn", "line_no")


def clean(raw: DataFrame) -> DataFrame:
    return drop_copies(valid_rows(raw))


def mark(raw: DataFrame) -> DataFrame:
    """One row for each transaction key of a usable customer, from one pass over the raw rows.

    ``valid`` keys carry the quantity and revenue of the row that ``drop_copies`` would keep,
    ``returned`` ones have a row with a negative quantity; a key can be both or neither. ``month`` is
    the layout that later reads are filtered by.
    """
    checked = check_columns(raw)
    kept = (F.col("Price") > 0) & (F.col("Quantity") > 0)
    order = [F.col(c).alias(f"_{c}") for c in ("line_no", "Quantity", "Price") if c in checked.columns]
    rows = checked.select(
        "Invoice",
        "StockCode",
        canonical_id(F.col("Customer ID")).alias("customer_id"),
        F.col("InvoiceDate").cast("timestamp_ntz").alias("InvoiceDate"),
        F.when(kept, F.struct(*order)).alias("_row"),
        F.coalesce(F.col("Quantity") < 0, F.lit(False)).alias("returned"),
    )
    keys = rows.filter(F.col("customer_id").isNotNull()).groupBy(*DEDUP_KEY).agg(F.min("_row").alias("_row"), F.max("returned").alias("returned"))
    quantity, price = F.col("_row._Quantity"), F.col("_row._Price")
    return keys.select(
        *DEDUP_KEY,
        quantity.alias("Quantity"),
        (quantity.cast("double") * price.cast("double")).alias("TotalAmount"),
        F.col("_row").isNotNull().alias("valid"),
        "returned",
        F.trunc("InvoiceDate", "month").alias("month"),
    )


def audit(raw: DataFrame) -> DataFrame:
    """One row of counts: what each cleaning step removed.

    A single pass over the rows, combined map-side per key, then a total. Rows that pass all
    filters are counted under their key; all others share the null key.
    """
    checked = check_columns(raw)
    ident = canonical_id(F.col("Customer ID"))
    has_id = F.col("Customer ID").isNotNull()
    good_id = has_id & ident.isNotNull()
    priced = good_id & F.coalesce(F.col("Price") > 0, F.lit(False))
    kept = priced & F.coalesce(F.col("Quantity") > 0, F.lit(False))
    key = F.struct("Invoice", "StockCode", ident.alias("customer_id"), "InvoiceDate")
    per_key = (
        checked.select(
            F.when(kept, key).alias("key"),
            has_id.alias("has_id"),
            good_id.alias("good_id"),
            priced.alias("priced"),
            (priced & F.coalesce(F.col("Quantity") < 0, F.lit(False))).alias("returned"),
            kept.alias("kept"),
        )
        .groupBy("key")
        .agg(
            F.count("*").alias("n"),
            *[F.count_if(F.col(c)).alias(c) for c in ("has_id", "good_id", "priced", "returned", "kept")],
        )
    )
    return per_key.agg(
        F.sum("n").alias("initial_rows"),
        F.sum(F.col("n") - F.col("has_id")).alias("missing_id"),
        F.sum(F.col("has_id") - F.col("good_id")).alias("unusable_id"),
        F.sum(F.col("good_id") - F.col("priced")).alias("bad_price"),
        F.sum("returned").alias("returns"),
        F.sum(F.col("priced") - F.col("kept")).alias("bad_quantity"),
        (F.sum("kept") - F.count("key")).alias("copies"),
        F.count("key").alias("final_rows"),
    )
