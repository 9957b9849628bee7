import random
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spendcast.operators import quantiles, ranking, splits


def skewed(spark, n=3000):
    rng = random.Random(1)
    values = [0.0 if i % 3 == 0 else float(rng.randrange(400)) for i in range(n)]
    rows = [(f"c{i}", v, float(i % 7), "train" if i % 5 else "test") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "customer_id string, Monetary double, actual double, split string"), rows


@pytest.fixture(params=[1, 4, 64])
def partitions(request, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("ordered", [100_000, 20])
def test_quantiles_equal_numpy(spark, partitions, ordered):
    df, rows = skewed(spark)
    probs = [0.0, 0.2, 0.5, 0.8, 0.99, 1.0]
    got = quantiles.quantile_values(df, ["Monetary", "actual"], probs, ordered)
    assert got["Monetary"] == pytest.approx(list(np.quantile([r[1] for r in rows], probs)), abs=1e-9)
    assert got["actual"] == pytest.approx(list(np.quantile([r[2] for r in rows], probs)), abs=1e-9)


def test_quantiles_of_many_unlike_values(spark):
    """Brackets are narrowed by further sketches before their values are ordered."""
    values = np.exp(4 * np.random.default_rng(3).normal(size=60_000))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(6)
    probs = [0.01, 0.5, 0.999]
    assert quantiles.quantile_values(df, ["v"], probs, ordered=50)["v"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_without_values_and_of_one(spark):
    df = spark.createDataFrame([(None, 3.0, 1.0), (None, None, 2.0)], "a double, b double, c double")
    assert quantiles.quantile_values(df, ["a", "b", "c"], [0.25, 1.0]) == {"b": [3.0, 3.0], "c": [1.25, 2.0]}
    assert quantiles.exact_quantiles(df.filter("c > 5"), ["b"], [0.5]).collect() == []


def test_a_missed_bracket_is_opened(spark, monkeypatch):
    """Limits that a sketch got wrong cost a further pass, not a wrong quantile."""
    df = spark.createDataFrame([(float(i),) for i in range(500)], "v double")
    wrong = iter([(400.0, 450.0), (10.0, 20.0)])

    def misled(self, found):
        low, high = next(wrong, found)
        return replace(self, low=low, high=high, outer=(self.low, self.high))

    monkeypatch.setattr(quantiles.Target, "narrowed", misled)
    assert quantiles.quantile_values(df, ["v"], [0.3, 0.7])["v"] == pytest.approx(np.quantile(np.arange(500.0), [0.3, 0.7]))


def test_no_value_is_dealt_by_range(spark):
    df, _ = skewed(spark)
    with_sketch = quantiles._survey(df.select(F.col("Monetary").cast("double")), [quantiles.Target("Monetary", 0.5)])
    assert with_sketch[0].low is not None and with_sketch[0].high is not None and with_sketch[0].inside == 3000


def test_percentiles_with_a_value_owning_a_third(spark, partitions):
    df, rows = skewed(spark)
    train = np.sort([r[1] for r in rows if r[3] == "train"])
    got = {r["customer_id"]: r["Monetary_Percentile"] for r in ranking.train_percentile(df).collect()}
    assert len(got) == len(rows)
    for name, value, _, split in rows:
        below, upto = np.searchsorted(train, value, "left"), np.searchsorted(train, value, "right")
        expected = (below + 1 + upto) / 2 / len(train) if split == "train" else upto / len(train)
        assert got[name] == pytest.approx(expected, abs=1e-12)


def test_percentile_ties_by_hand(spark):
    rows = [("a", 1.0, "train"), ("b", 2.0, "train"), ("c", 2.0, "train"), ("d", 5.0, "train")]
    rows += [("e", 0.0, "test"), ("f", 2.0, "test"), ("g", 9.0, "test")]
    df = spark.createDataFrame(rows, "customer_id string, Monetary double, split string")
    got = {r["customer_id"]: r["Monetary_Percentile"] for r in ranking.train_percentile(df).collect()}
    assert got == {"a": 0.25, "b": 0.625, "c": 0.625, "d": 1.0, "e": 0.0, "f": 0.75, "g": 1.0}


def test_gain_curve_orders_ties_by_id(spark, partitions):
    df, rows = skewed(spark)
    curve = ranking.gain_curve(df, "actual", "Monetary").orderBy("position").collect()
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r["customer_id"] for r in curve] == [r[0] for r in ordered]
    total = sum(r[2] for r in rows)
    assert [r["cum_actual"] for r in curve] == pytest.approx(list(np.cumsum([r[2] for r in ordered]) / total))
    assert curve[0]["cum_population"] == 0 and curve[-1]["cum_population"] == 1
    lift = {r["share"]: r["lift"] for r in ranking.lift_points(ranking.gain_curve(df, "actual", "Monetary")).collect()}
    assert lift[0.1] == pytest.approx(curve[int(len(rows) * 0.1)]["cum_actual"])


def test_no_gain_curve_without_spend(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.0, 2.0)], "customer_id string, actual double, predicted double")
    assert ranking.gain_curve(df).isEmpty()


def test_split_is_exact_complete_and_independent_of_partitions(spark):
    df, rows = skewed(spark)
    df = df.drop("split").withColumn("stratum", (F.col("Monetary") > 0).cast("int"))
    one = {r["customer_id"]: (r["stratum"], r["split"]) for r in splits.stratified_split(df.repartition(1)).collect()}
    many = {r["customer_id"]: (r["stratum"], r["split"]) for r in splits.stratified_split(df.repartition(16)).collect()}
    assert one == many and len(one) == len(rows)
    for stratum in (0, 1):
        sides = [s for k, s in one.values() if k == stratum]
        assert sides.count("train") == int(len(sides) * 0.8)


def test_strata_of_an_all_zero_target(spark):
    df = spark.createDataFrame([(str(i), 0.0) for i in range(10)], "customer_id string, Next_3M_Spend double")
    assert {r["stratum"] for r in splits.with_stratum(df, splits.stratum_edges(df)).collect()} == {0}


def test_folds_are_balanced_per_class(spark):
    df, _ = skewed(spark)
    folded = splits.stratified_folds(df.withColumn("z", F.col("Monetary") > 0), "z", 5)
    for r in folded.groupBy("z").pivot("fold", list(range(5))).count().collect():
        assert max(r[1:]) - min(r[1:]) <= 1


def test_a_heavy_value_is_spread_over_the_shuffle(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    rows = [(f"c{i}", 0.0 if i % 2 else float(i), "train") for i in range(4000)]
    df = spark.createDataFrame(rows, "customer_id string, Monetary double, split string")
    for name, value in zip(names, ("-1", "16", "false")):
        spark.conf.set(name, value)
    try:
        out = ranking.train_percentile(df).withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 4000 and max(sizes) < 600
