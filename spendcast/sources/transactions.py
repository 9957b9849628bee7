"""Readers that yield transaction rows: CSV, parquet and adapters from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spendcast.config import FEATURE_COLS, TRANSACTION_COLS, TRANSACTION_SCHEMA
from spendcast.session import materialize


def check_columns(df: DataFrame) -> DataFrame:
    """Raise ``ValueError`` when a transaction column is missing. Looks at the schema only."""
    missing = sorted(set(TRANSACTION_COLS) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def read_transactions_csv(spark: SparkSession, path: str, timestamp_format: str | None = None) -> DataFrame:
    """Transactions from CSV. A missing path, a missing column or a malformed row raises.

    The header names the columns, in any order and among any others. ``timestamp_format`` is the
    pattern of the dates, such as ``M/d/yyyy H:mm``; without it they are ISO dates and times.
    ``line_no`` keeps the position in the file (file, block start, running id inside the
    block), so that "first row wins" in deduplication means first in the file.
    """
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1")
    layout = _transaction_layout(check_columns(reader.csv(path)).columns)  # reads the first line only
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    df = reader.schema(layout).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return check_columns(df.select(*TRANSACTION_COLS, _place().alias("line_no")))


def _transaction_layout(names: list[str]) -> StructType:
    known = {f.name: f for f in TRANSACTION_SCHEMA}
    return StructType([known.get(c, StructField(c, StringType())) for c in names])


def _place() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


#: Holds the whole line of a row that does not fit the layout.
TORN = "_torn_line"


def _tolerant(spark: SparkSession, path: str, layout: StructType, timestamp_format: str | None = None) -> DataFrame:
    """All lines with their ``place``, parsed once and written; those that do not fit ``layout`` come whole in ``TORN``."""
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("mode", "PERMISSIVE")
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    # Without pruning, so that a line is judged by all of its fields whatever is selected.
    reader = reader.option("columnNameOfCorruptRecord", TORN).option("columnPruning", False)
    df = reader.schema(StructType([*layout.fields, StructField(TORN, StringType())])).csv(path)
    return materialize(df.withColumn("place", _place()))


def split_transactions_csv(
    spark: SparkSession, path: str, timestamp_format: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """As :func:`read_transactions_csv`, with malformed lines apart instead of an error.

    Returns the transactions and the rejected lines (place, reason, column, value).
    """
    names = check_columns(spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)).columns
    df = _tolerant(spark, path, _transaction_layout(names), timestamp_format)
    rows = df.filter(F.col(TORN).isNull()).select(*TRANSACTION_COLS, F.col("place").alias("line_no"))
    return rows, df.filter(F.col(TORN).isNotNull()).select("place", *_torn_reason())


def _torn_reason() -> list[Column]:
    return [
        F.lit("does not fit the layout").alias("reason"), F.lit(None).cast("string").alias("column"), F.col(TORN).alias("value")
    ]


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions from parquet."""
    return check_columns(spark.read.parquet(path))


def read_scoring_csv(spark: SparkSession, path: str) -> DataFrame:
    """Customers to score: any subset of the features, any further columns, no fixed schema."""
    df = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    known = {c: F.col(c).try_cast("double") for c in df.columns if c in FEATURE_COLS}
    return df.withColumns(known) if known else df


def split_scoring_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`read_scoring_csv`, with the rows that cannot be scored as given apart.

    A line with too few or too many fields is rejected, and so is one with a feature that is neither
    empty nor a finite number. Returns the rows to score and one row (place, reason, column, value)
    for every fault, the value being the whole line where the line is torn. The file's columns
    cannot be named ``place`` or ``_torn_line``.
    """
    names = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path).columns
    df = _tolerant(spark, path, StructType([StructField(c, StringType()) for c in names]))
    features = [c for c in names if c in FEATURE_COLS]
    number = {c: F.col(c).try_cast("double") for c in features}
    finite = {c: F.coalesce(F.abs(n) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(n) for c, n in number.items()}
    faults = [
        F.when(F.col(c).isNotNull() & ~finite[c], F.struct(F.lit("not a number").alias("reason"), F.lit(c).alias("column"), F.col(c).alias("value")))
        for c in features
    ]
    own = F.filter(F.array(*faults), lambda x: x.isNotNull()) if faults else None
    whole = df.filter(F.col(TORN).isNull())
    good = whole.filter(F.size(own) == 0) if faults else whole
    rejected = df.filter(F.col(TORN).isNotNull()).select("place", *_torn_reason())
    if faults:
        rejected = rejected.union(whole.select("place", F.inline(own)))
    return good.withColumns(number).select(*names) if number else good.select(*names), rejected


def orders_as_transactions(
    spark: SparkSession,
    sf_dir: str,
    customer: Column | None = None,
    price: Column | None = None,
    quantity: Column | None = None,
) -> DataFrame:
    """Line items joined to their orders, as transactions. Returned lines get a negative quantity."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = F.concat(F.col("o_custkey").cast("string"), F.lit(".0")) if customer is None else customer
    price = F.col("l_extendedprice") / F.col("l_quantity") if price is None else price
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    quantity = signed if quantity is None else quantity
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").cast("string").alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        quantity.cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        price.cast("double").alias("Price"),
        customer.alias("Customer ID"),
        F.col("l_linenumber").alias("line_no"),
    )


def untidy_orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`orders_as_transactions`, with the faults of a raw retail export.

    Pending low-priority orders are guest orders (no id), pending unspecified ones carry a
    broken id, untaxed lines at full discount are write-offs at price zero, and undiscounted
    lines at the top tax rate have no quantity.
    """
    pending = F.col("o_orderstatus") == "P"
    customer = (
        F.when(pending & (F.col("o_orderpriority") == "5-LOW"), F.lit(None).cast("string"))
        .when(pending & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), F.lit("unknown"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
    )
    price = F.when((F.col("l_tax") == 0) & (F.col("l_discount") >= 0.1), F.lit(0.0)).otherwise(
        F.col("l_extendedprice") / F.col("l_quantity")
    )
    quantity = (
        F.when((F.col("l_tax") >= 0.08) & (F.col("l_discount") == 0), F.lit(None).cast("double"))
        .when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
    )
    return orders_as_transactions(spark, sf_dir, customer, price, quantity)


def events_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one-line invoices; times carry microseconds."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("Invoice"),
        F.col("event_type").alias("StockCode"),
        F.lit(1).alias("Quantity"),
        F.col("ts").alias("InvoiceDate"),
        F.col("value").alias("Price"),
        F.col("user_id").cast("string").alias("Customer ID"),
        F.lit(1).alias("line_no"),
    )
