"""Readers that set bad rows apart, and version numbers under writers at the same time."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from spendcast.operators import sketches
from spendcast.sources import tables, transactions


def test_scoring_rows_with_faults_are_set_apart(spark, tmp_path):
    file = tmp_path / "new.csv"
    file.write_text("id,Recency,Frequency\n1,5,2\n2,,1\n3,abc,NaN\n4,1\n5,1,2,3\n6,inf,1\n7,1e2,0\n")
    good, rejected = transactions.split_scoring_csv(spark, str(file))
    assert [tuple(r) for r in good.orderBy("id").collect()] == [("1", 5.0, 2.0), ("2", None, 1.0), ("7", 100.0, 0.0)]
    found = sorted((r.reason, r.column or "", r.value) for r in rejected.collect())
    assert found == [
        ("does not fit the layout", "", "4,1"), ("does not fit the layout", "", "5,1,2,3"),
        ("not a number", "Frequency", "NaN"), ("not a number", "Recency", "abc"), ("not a number", "Recency", "inf"),
    ]
    places = rejected.select("place.file", "place.row", "value").collect()
    assert all(r.file.endswith("new.csv") for r in places)
    assert [r.value for r in sorted(places, key=lambda r: r.row)][-1] == "inf"


def test_a_scoring_file_without_features_or_rows(spark, tmp_path):
    file = tmp_path / "new.csv"
    file.write_text("id,note\n")
    good, rejected = transactions.split_scoring_csv(spark, str(file))
    assert good.columns == ["id", "note"] and good.count() == rejected.count() == 0


def test_malformed_transactions_are_set_apart(spark, tmp_path):
    file = tmp_path / "raw.csv"
    head = "Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID"
    file.write_text(f"{head}\n1,a,2,2020-01-02 03:04:05,1.5,9.0\n2,b,two,2020-01-02 03:04:05,1.5,9.0\n3,c,1,someday,1,9\n4,d\n")
    rows, rejected = transactions.split_transactions_csv(spark, str(file))
    assert [(r.Invoice, r.Quantity, r.Price) for r in rows.collect()] == [("1", 2, 1.5)]
    assert sorted(r.value[0] for r in rejected.collect()) == ["2", "3", "4"]
    with pytest.raises(Exception):
        transactions.read_transactions_csv(spark, str(file)).collect()


def test_writers_at_the_same_time_get_versions_without_gaps(spark, tmp_path):
    path = str(tmp_path / "registry")
    register = lambda i: tables.register_champion(spark, path, "a/b champion", f"m{i}", {}, {"r2": 0.5})
    with ThreadPoolExecutor(6) as pool:
        got = sorted(pool.map(register, range(6)))
    assert got == [1, 2, 3, 4, 5, 6]
    known = tables.read_registry(spark, path).collect()
    assert sorted(r.version for r in known) == got and len({r.champion for r in known}) == 6


def test_a_failed_registration_gives_its_version_back(spark, tmp_path):
    path = str(tmp_path / "registry")
    with pytest.raises(ValueError):
        tables.register_champion(spark, path, "m", "x", {}, {"r2": "none"})
    version = tables.claim_version(spark, path, "m")
    tables.release_version(spark, path, "m", version)
    assert tables.register_champion(spark, path, "m", "x", {}, {}) == version == 1


def test_sketches_merge_over_months(spark):
    rows = spark.sql(
        "SELECT CAST(id % 3 AS STRING) AS customer_id, timestamp_ntz'2020-01-15' + make_interval(0, CAST(id % 5 AS INT)) AS InvoiceDate, "
        "IF(id % 7 = 0, NULL, CAST(id % 20000 AS STRING)) AS StockCode FROM range(60000)"
    )
    written = sketches.monthly_sketches(rows)
    assert written.count() == 15
    for first, last, days in ((None, None, None), ("2020-02-01", "2020-03-01", (1, 2))):
        own = rows if days is None else rows.filter(f"month(InvoiceDate) - 1 IN {days}")
        exact = {c: own.filter(f"customer_id = {c!r}").select("StockCode").dropna().distinct().count() for c in "012"}
        found = {r.customer_id: r.estimate for r in sketches.distinct_estimates(written, first, last).collect()}
        assert all(abs(found[c] - n) <= 3 * sketches.standard_error() * n for c, n in exact.items()) and found.keys() == exact.keys()
