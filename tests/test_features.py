import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from spendcast.config import TRANSACTION_SCHEMA
from spendcast.operators import cleaning, features

DAY = dt.timedelta(days=1)
START = dt.datetime(2020, 1, 1)


def lines(*rows):
    return [(str(i), code, q, ts, price, customer) for i, (customer, code, q, ts, price) in enumerate(rows)]


def behaviour(spark, rows, horizon=30):
    raw = spark.createDataFrame(rows, TRANSACTION_SCHEMA)
    rows = cleaning.clean(raw)
    out = features.behaviour(rows, features.split_point(rows, horizon), raw)
    return {r["customer_id"]: r for r in out.collect()}


def test_hand_made_customers(spark):
    end = START + 100 * DAY
    out = behaviour(
        spark,
        lines(
            ("1", "a", 1, START, 10.0),
            ("2", "a", 2, START, 5.0),
            ("2", "b", 1, START + DAY / 2, 1.0),
            ("3", "a", 1, START, 7.0),
            ("3", "a", 1, START + 10 * DAY, 9.0),
            ("4", "a", 1, START + 70 * DAY - dt.timedelta(seconds=1), 3.0),
            ("4", "a", 1, START + 70 * DAY, 8.0),
            ("5", "a", 1, end, 4.0),
        ),
    )
    assert "5" not in out
    one, same_day, two, edge = (out[k] for k in "1234")
    assert (one.Frequency, one.Monetary, one.Interpurchase_Std, one.T) == (0, 0, 0, 70)
    assert (same_day.Frequency, same_day.Visit_Diversity, same_day.Interpurchase_Std) == (0, 1, 0)
    assert (two.Recency, two.Frequency, two.Monetary, two.Interpurchase_Std) == (10, 1, 9, 0)
    assert two.Purchase_Rate == pytest.approx(1 / 70)
    assert edge.Next_3M_Spend == 8.0 and one.Next_3M_Spend == 0.0
    assert edge.T == 1


def test_history_on_the_split_day_itself(spark):
    end = START + 30 * DAY + dt.timedelta(hours=18)
    out = behaviour(spark, lines(("1", "a", 1, START + dt.timedelta(hours=3), 2.0), ("1", "a", 1, end, 2.0)))
    assert (out["1"]["T"], out["1"]["Purchase_Rate"]) == (0, 0)


def test_gap_deviation_equals_line_by_line_computation(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for c in ("1", "2", "3"):
        stamps = sorted(START + dt.timedelta(seconds=rng.randrange(60 * 86400)) for _ in range(40))
        stamps += stamps[:5]
        rows += [(c, str(i), 1, s, 1.0) for i, s in enumerate(stamps)]
        ordered = sorted(stamps)
        expected[c] = statistics.stdev((b - a).days for a, b in zip(ordered, ordered[1:]))
    rows.append(("9", "z", 1, START + 200 * DAY, 1.0))
    out = behaviour(spark, lines(*rows))
    for c, value in expected.items():
        assert out[c]["Interpurchase_Std"] == pytest.approx(value, abs=1e-9)


def test_returns_count_history_only_and_any_id_form(spark):
    raw = spark.createDataFrame(
        [
            ("A", "a", 1, START, 1.0, "1.0"),
            ("A", "b", -1, START, 1.0, "1"),
            ("B", "a", 1, START + DAY, 1.0, "1.0"),
            ("C", "a", -1, START + 90 * DAY, 1.0, "1.0"),
        ],
        TRANSACTION_SCHEMA,
    )
    split_ts = F.lit("2020-02-01").cast("timestamp_ntz")
    assert features.return_rates(raw, split_ts).first()["Return_Rate"] == 0.5
    assert features.return_rates(raw).first()["Return_Rate"] == pytest.approx(2 / 3)


def test_same_result_for_any_partitioning_and_with_a_hot_customer(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        customer = "7" if i % 3 == 0 else str(rng.randrange(40))
        rows.append((customer, str(rng.randrange(30)), rng.randrange(1, 9), START + DAY * rng.random() * 200, rng.random() * 50))
    raw = spark.createDataFrame(lines(*rows), TRANSACTION_SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            rows_ = cleaning.clean(raw.repartition(n))
            seen.append(sorted(features.behaviour(rows_, features.split_point(rows_, 30), raw).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def test_gaps_do_not_depend_on_the_session_time_zone(spark):
    # 8 March 2020 has 23 hours in New York; the gap is still one whole day
    rows = lines(
        ("1", "a", 1, dt.datetime(2020, 3, 7, 12), 1.0),
        ("1", "a", 1, dt.datetime(2020, 3, 8, 12), 1.0),
        ("1", "a", 1, dt.datetime(2020, 3, 11, 11, 59), 1.0),
        ("9", "z", 1, START + 200 * DAY, 1.0),
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = behaviour(spark, rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert out["1"]["Interpurchase_Std"] == pytest.approx(statistics.stdev([1, 2]))
