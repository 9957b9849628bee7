import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from spendcast.functions.special import digamma, hyp2f1, lgamma, trigamma
from spendcast.operators import btyd


def test_lgamma_against_the_library(spark):
    xs = [1e-3, 0.1, 0.5, 1.0, 1.5, 2.0, 7.3, 100.0, 1e4]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", lgamma(F.col("x")).alias("y")).collect()
    for r in rows:
        assert r["y"] == pytest.approx(math.lgamma(r["x"]), abs=1e-9)


def test_digamma_and_trigamma(spark):
    """At one and one half by their constants, elsewhere by their steps and by differences of log-gamma."""
    euler = 0.5772156649015329
    fixed = {1.0: (-euler, math.pi**2 / 6), 0.5: (-euler - 2 * math.log(2), math.pi**2 / 2)}
    xs = [1e-3, 0.1, 0.5, 1.0, 2.7, 40.0, 1e5]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select(
        "x", digamma(F.col("x")).alias("d"), trigamma(F.col("x")).alias("t"), digamma(F.col("x") + 1).alias("d1"), trigamma(F.col("x") + 1).alias("t1")
    )
    for r in rows.collect():
        x = r["x"]
        assert r["d1"] - r["d"] == pytest.approx(1 / x, rel=1e-11) and r["t"] - r["t1"] == pytest.approx(1 / x**2, rel=1e-4 if x > 1e4 else 1e-10)
        if x in fixed:
            assert (r["d"], r["t"]) == pytest.approx(fixed[x], rel=1e-12)
        h = x * 1e-4
        assert r["d"] == pytest.approx((math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h), rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("kind", ["purchases", "values"])
def test_derivatives_equal_differences(spark, kind):
    if kind == "purchases":
        data = spark.createDataFrame(simulate(60, 0.6, 20.0, 0.8, 2.5)).withColumn("n", F.lit(2))
        (names, parts), at = btyd.purchase_terms("Frequency", F.col("Recency"), F.col("T")), np.array([0.7, 15.0, 0.9, 1.7])
        plain = btyd.purchase_loglik(*map(F.col, ("Frequency", "Recency", "T")), *map(F.lit, at.tolist()))
    else:
        data = spark.createDataFrame([(1.0, 20.0, 3), (4.0, 7.5, 1), (9.0, 100.0, 2)], "x double, m double, n int")
        (names, parts), at = btyd.value_terms("x", F.col("m")), np.array([2.1, 3.3, 12.0])
        plain = btyd.value_loglik(F.col("x"), F.col("m"), *map(F.lit, at.tolist()))
    h = 1e-4 * at
    points = [at] + [at + s * h[i] * np.eye(len(at))[i] for i in range(len(at)) for s in (1, -1)]
    rows = {r["id"]: r for r in btyd.derivatives(data, names, parts)(np.array(points)).collect()}
    whole = data.agg(F.sum(plain * F.col("n")) / F.sum("n")).first()[0]
    assert rows[0]["value"] == pytest.approx(whole, rel=1e-12)
    for i, name in enumerate(names):
        up, down = rows[1 + 2 * i], rows[2 + 2 * i]
        assert rows[0][f"d_{name}"] == pytest.approx((up["value"] - down["value"]) / (2 * h[i]), rel=1e-5, abs=1e-8)
        for other in names[i:]:
            slope = (up[f"d_{other}"] - down[f"d_{other}"]) / (2 * h[i])
            assert rows[0][f"d_{name}_{other}"] == pytest.approx(slope, rel=1e-5, abs=1e-8)


def direct_series(a, b, c, z):
    total = term = 1.0
    for n in range(5000):
        term *= (a + n) * (b + n) / ((c + n) * (n + 1)) * z
        total += term
        if abs(term) < 1e-17 * abs(total):
            break
    return total


@settings(max_examples=80, deadline=None)
@given(st.floats(0.1, 30), st.floats(0.1, 30), st.floats(0.2, 40), st.floats(0.0, 0.9))
def test_2f1_against_the_direct_series(a, b, c, z):
    got = float(hyp2f1(np.array([a]), np.array([b]), np.array([c]), np.array([z]))[0])
    assert got == pytest.approx(direct_series(a, b, c, z), rel=1e-7)


def simulate(n, r, alpha, a, b, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for rate, p, age in zip(rng.gamma(r, 1 / alpha, n), rng.beta(a, b, n), rng.integers(30, 400, n)):
        t = x = tx = 0
        while True:
            t += rng.exponential(1 / rate)
            if t > age:
                break
            x, tx = x + 1, t
            if rng.random() < p:
                break
        rows.append((float(x), float(tx), float(age)))
    return pd.DataFrame(rows, columns=["Frequency", "Recency", "T"])


def test_purchase_parameters_are_recovered(spark):
    k = btyd.fit_purchases(spark.createDataFrame(simulate(8000, 0.6, 20.0, 0.8, 2.5)), penalty=0.0)
    assert k.r == pytest.approx(0.6, rel=0.15) and k.alpha == pytest.approx(20.0, rel=0.2)
    assert k.a / (k.a + k.b) == pytest.approx(0.8 / 3.3, rel=0.2)


def test_value_parameters_are_recovered(spark):
    rng = np.random.default_rng(1)
    p, q, v = 6.0, 4.0, 15.0
    x = rng.integers(1, 12, 6000)
    mean = rng.gamma(p * x, 1 / (rng.gamma(q, 1 / v, 6000) * x))
    k = btyd.fit_values(spark.createDataFrame(pd.DataFrame({"Frequency": x.astype(float), "Monetary": mean})), penalty=0.0)
    assert k.p * k.v / (k.q - 1) == pytest.approx(p * v / (q - 1), rel=0.05)
    assert k.q == pytest.approx(q, rel=0.15)


def test_fitted_points_have_no_slope(spark):
    data = spark.createDataFrame(simulate(500, 0.6, 20.0, 0.8, 2.5)).withColumn("n", F.lit(1))
    k = btyd.fit_purchases(data.drop("n"), penalty=0.0)
    names, parts = btyd.purchase_terms("Frequency", F.col("Recency"), F.col("T"))
    row = btyd.derivatives(data, names, parts)(np.array([[k.r, k.alpha, k.a, k.b]])).first()
    assert max(abs(row[f"d_{n}"] * v) for n, v in zip(names, (k.r, k.alpha, k.a, k.b))) < 1e-6


def test_alive_is_a_probability_and_one_for_single_buyers(spark):
    rng = np.random.default_rng(2)
    age = rng.uniform(1, 500, 300)
    frame = pd.DataFrame({"x": rng.integers(0, 50, 300).astype(float), "tx": age * rng.random(300), "age": age})
    k = btyd.PurchaseParams(0.5, 30.0, 0.7, 2.0)
    rows = spark.createDataFrame(frame).select("x", btyd.prob_alive(F.col("x"), F.col("tx"), F.col("age"), k).alias("p"))
    for r in rows.collect():
        assert 0 <= r["p"] <= 1 and (r["x"] > 0 or r["p"] == 1)


def test_fit_without_repeat_buyers_raises(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "Frequency double, Monetary double")
    with pytest.raises(btyd.FitError):
        btyd.fit_values(df)


def test_no_repeats_at_a_plus_b_of_one(spark):
    base = spark.createDataFrame([(0.0, 0.0, 50.0), (2.0, 30.0, 50.0)], "x double, tx double, age double")
    near, at = (
        [r[0] for r in base.select(btyd.expected_purchases(F.col("x"), F.col("tx"), F.col("age"), k, 90.0)).collect()]
        for k in (btyd.PurchaseParams(r=0.8, alpha=50.0, a=0.4, b=b) for b in (0.6001, 0.6))
    )
    assert all(abs(p - q) < 1e-3 for p, q in zip(near, at))


def test_passes_of_a_fit_have_few_tasks(spark, monkeypatch):
    """Every pass of a fit has a task per piece of the counted inputs, not one per shuffle partition."""
    rows = spark.createDataFrame([(float(i % 3), float(i % 3) * 5, 30.0 + i % 7, 10.0 + i % 5) for i in range(200)], "Frequency double, Recency double, T double, Monetary double")
    pieces, found = [], btyd.derivatives
    monkeypatch.setattr(btyd, "derivatives", lambda data, *more: pieces.append((data.rdd.getNumPartitions(), sorted(map(tuple, data.collect())))) or found(data, *more))
    monkeypatch.setattr(btyd, "_minimise", lambda evaluate, start, tol: (start, 0.0))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        btyd.fit_purchases(rows)
        btyd.fit_values(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(pieces) == 2 and all(n <= 8 and sum(r[-1] for r in kept) > 0 for n, kept in pieces)
    assert sum(r[-1] for r in pieces[0][1]) == 200 and len(pieces[0][1]) == 21
