import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendcast.config import TRANSACTION_SCHEMA
from spendcast.operators import cleaning
from spendcast.sources.transactions import check_columns, read_transactions_csv

NOON = dt.datetime(2020, 1, 1, 12)


def frame(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def test_canonical_ids(spark):
    given = [("12345",), ("12345.0",), ("abc",), (None,), ("1.5",)]
    out = spark.createDataFrame(given, "id string").select(cleaning.canonical_id(F.col("id"))).collect()
    assert [r[0] for r in out] == ["12345", "12345", None, None, None]


def test_missing_column_raises_without_a_job(spark):
    with pytest.raises(ValueError, match="Price"):
        check_columns(frame(spark, []).drop("Price"))


def test_filters_and_revenue(spark):
    rows = [
        ("1", "a", 2, NOON, 1.5, "7.0"),
        ("1", "b", 1, NOON, 0.0, "7.0"),
        ("1", "c", -1, NOON, 2.0, "7.0"),
        ("1", "d", None, NOON, 2.0, "7.0"),
        ("1", "e", 1, NOON, None, "7.0"),
        ("1", "f", 1, NOON, 2.0, None),
    ]
    out = cleaning.clean(frame(spark, rows)).collect()
    assert [(r.StockCode, r.customer_id, r.TotalAmount) for r in out] == [("a", "7", 3.0)]


def test_dedup_keeps_a_fixed_row_and_first_in_file_when_known(spark):
    rows = [("1", "a", 5, NOON, 1.0, "7"), ("1", "a", 3, NOON, 9.0, "7"), ("1", "a", 3, NOON, 2.0, "7")]
    kept = cleaning.clean(frame(spark, rows)).first()
    assert (kept.Quantity, kept.Price) == (3, 2.0)
    numbered = frame(spark, rows).withColumn("line_no", F.col("Price"))
    assert cleaning.clean(numbered).first().Price == 1.0


def test_csv_reader_keeps_file_order_and_fails_fast(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(
        "Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID\n"
        "1,a,5,2020-01-01 12:00:00,1.0,7.0\n1,a,3,2020-01-01 12:00:00,2.0,7.0\n2,b,1,2020-01-02 08:30:00,2.5,\n"
    )
    raw = read_transactions_csv(spark, str(good))
    assert raw.count() == 3
    assert cleaning.clean(raw).first().Quantity == 5
    bad = tmp_path / "bad.csv"
    bad.write_text("Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID\n1,a,many,2020-01-01 12:00:00,1.0,7\n")
    with pytest.raises(Exception):
        read_transactions_csv(spark, str(bad)).collect()
    with pytest.raises(Exception):
        read_transactions_csv(spark, str(tmp_path / "none.csv"))


def test_csv_in_the_published_layout(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    lines = ["Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country", '1,A,"x, y",2,12/1/2009 7:45,1.5,12345.0,UK']
    open(path, "w").write("\n".join(lines) + "\n")
    row = read_transactions_csv(spark, path, "M/d/yyyy H:mm").first()
    assert (row.Invoice, row.Quantity, str(row.InvoiceDate), row.Price) == ("1", 2, "2009-12-01 07:45:00", 1.5)
    open(path, "w").write("\n".join([*lines, "1,A,x,two,12/1/2009 7:45,1.5,1,UK"]) + "\n")
    with pytest.raises(Exception):
        read_transactions_csv(spark, path, "M/d/yyyy H:mm").collect()
    open(path, "w").write("Invoice,StockCode\n1,A\n")
    with pytest.raises(ValueError):
        read_transactions_csv(spark, path)
