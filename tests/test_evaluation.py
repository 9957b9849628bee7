import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendcast.operators import caps, evaluation, leaderboard, metrics, scoring

SCHEMA = "customer_id string, actual double, predicted double"


def test_metrics_by_hand(spark):
    rng = random.Random(2)
    y, p = [rng.random() * 100 for _ in range(50)], [rng.random() * 100 for _ in range(50)]
    df = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(zip(y, p))], SCHEMA)
    r = metrics.metric_bundle(df, "actual", "predicted").first()
    y, p = np.array(y), np.array(p)
    assert r["RMSE"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r["R2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert r["WAPE"] == pytest.approx(np.sum(np.abs(y - p)) / y.sum() * 100)


def test_constant_actuals(spark):
    off = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.0, 0.0)], SCHEMA)
    exact = spark.createDataFrame([("a", 2.0, 2.0), ("b", 2.0, 2.0)], SCHEMA)
    first, second = (metrics.metric_bundle(d, "actual", "predicted").first() for d in (off, exact))
    assert first["R2"] == 0.0 and first["WAPE"] is None and second["R2"] == 1.0


def test_small_segments_are_left_out(spark):
    rows = [(str(i), 0.0, 1.0) for i in range(6)] + [(f"t{i}", 100.0, 90.0) for i in range(4)]
    out = evaluation.segment_metrics(spark.createDataFrame(rows, SCHEMA), (50.0, 80.0)).collect()
    assert {r["Segment"]: r["N"] for r in out} == {evaluation.ZERO: 6, evaluation.ALL: 10}


def test_calibration_edges_are_right_closed(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 0.1), ("c", 1.0, 1.0)], "id string, actual double, p double")
    assert {r["bin"]: r["n"] for r in evaluation.calibration_curve(df, "p").collect()} == {0: 2, 9: 1}


def test_histogram_equals_numpy_and_keeps_empty_bins(spark):
    values = [0.0, 0.1, 0.2, 5.0, 10.0, 10.0]
    out = evaluation.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 10).orderBy("bin").collect()
    counts, _ = np.histogram(values, 10)
    assert [r["n"] for r in out] == list(counts)
    density, _ = np.histogram(values, 10, density=True)
    assert [r["density"] for r in out] == pytest.approx(list(density))
    lone = evaluation.histogram(spark.createDataFrame([(3.0,)], "v double"), "v", 4)
    assert lone.agg(F.sum("n")).first()[0] == 1


def test_representatives(spark):
    rows = [("a", 5.0, 0.0), ("b", 5.0, 0.0), ("c", 1.0, 0.0), ("d", 3.0, 0.0), ("f", 2.0, 0.0), ("e", 0.0, 0.0)]
    out = {r["profile"]: r["customer_id"] for r in evaluation.representatives(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {"whale": "a", "mid": "d", "low": "c"}
    assert evaluation.representatives(spark.createDataFrame(rows[:2], SCHEMA)).isEmpty()


def test_predicted_spenders_falls_back_to_everyone(spark):
    few = spark.createDataFrame([(str(i), 0.0, float(i < 20)) for i in range(30)], SCHEMA)
    many = spark.createDataFrame([(str(i), 0.0, float(i < 21)) for i in range(30)], SCHEMA)
    assert evaluation.predicted_spenders(few).count() == 30
    assert evaluation.predicted_spenders(many).count() == 21


def test_hurdle_amount_is_zero_or_at_least_ten(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.random(), rng.random() * 14 - 1) for _ in range(400)], "p double, a double")
    for r in df.select("p", scoring.hurdle_dollars(F.col("p"), F.col("a")).alias("d")).collect():
        assert r["d"] == 0 or (r["d"] >= 10 and r["p"] >= 0.5)


def test_segments_and_bands(spark):
    df = spark.createDataFrame([(0.0,), (149.99,), (150.0,), (1200.0,)], "d double")
    out = df.withColumns(scoring.band_columns(F.col("d"))).orderBy("d").collect()
    assert [r["Segment"] for r in out] == ["Churned", "Low", "Mid", "Whale"]
    assert (out[2]["CLV_Low"], out[2]["CLV_High"]) == (127.5, 172.5)


def test_fill_defaults_keeps_other_columns(spark):
    df = spark.createDataFrame([(None, "x"), (3.0, "y")], "Recency double, note string")
    out = scoring.fill_defaults(df, {"Recency": 9.0, "T": 1.0, "Monetary": 2.0}).orderBy("note").collect()
    assert [(r["Recency"], r["Monetary"], r["note"], r["Prob_Alive"]) for r in out] == [
        (9.0, 2.0, "x", 0.0),
        (3.0, 2.0, "y", 0.0),
    ]


def test_frequency_is_rounded_half_to_even(spark):
    df = spark.createDataFrame([(9.0,), (1.0,)], "Frequency double")
    assert sorted(r[0] for r in caps.apply_caps(df, {"Frequency": 4.5}).collect()) == [1.0, 4.0]


def test_ensemble_needs_two_members(spark):
    rows = [("A", 0.5, 10.0, 1.0), ("B", 0.05, 5.0, 1.0), ("Naive Baseline (Mean)", 0.9, 1.0, 1.0)]
    board = spark.createDataFrame(rows, "Model string, Dollar_R2 double, Dollar_MAE double, CV_MAE_Mean double")
    assert leaderboard.ensemble_members(board).isEmpty()
    assert [r["Model"] for r in leaderboard.champion(board).collect()] == ["A"]
    members = leaderboard.ensemble_members(board, min_r2=0.0).collect()
    assert sum(m["weight"] for m in members) == pytest.approx(1.0)
    assert {m["Model"]: m["weight"] for m in members}["B"] == pytest.approx(2 / 3)


def test_histogram_counts_before_it_shuffles(spark):
    rows = spark.range(1000).select((F.col("id") % 7).cast("double").alias("v"), (F.col("id") % 2 == 0).alias("flag"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for by in (None, "flag"):
            plan = evaluation.histogram(rows, "v", 5, by=by)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
            counted = evaluation.histogram(rows, "v", 5, by=by)
            assert counted.agg(F.sum("n")).first()[0] == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    with pytest.raises(ValueError):
        evaluation.histogram(spark.range(2000).select("id", F.lit(1.0).alias("v")), "v", 5, by="id")
