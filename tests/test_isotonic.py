import random

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from spendcast.operators import isotonic


def steps(found):
    return [(r["low"], r["high"], r["weight"], round(r["mean"], 12)) for r in found.orderBy("low").collect()]


def plain(rows):
    """The same by definition: the highest of the lowest means over spans around each point."""
    points = {}
    for p, y, w in rows:
        total, weight = points.get(p, (0.0, 0.0))
        points[p] = total + y * w, weight + w
    order, sums = sorted(points), [(0.0, 0.0)]
    for p in order:
        sums.append((sums[-1][0] + points[p][0], sums[-1][1] + points[p][1]))
    mean = lambda a, b: (sums[b + 1][0] - sums[a][0]) / (sums[b + 1][1] - sums[a][1])
    n = len(order)
    return {p: max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i, p in enumerate(order)}


def table(spark, rows):
    return spark.createDataFrame([(p, float(y), float(w)) for p, y, w in rows], "p double, y double, w double")


SHAPES = {
    "rising": lambda rng, p: int(rng.random() < p),
    "falling": lambda rng, p: 1 - p,  # everything becomes one block
    "noise": lambda rng, p: rng.randint(0, 1),
    "steep": lambda rng, p: p * p,  # nothing is pooled
}


@pytest.mark.parametrize("shape", SHAPES)
def test_ranges_join_to_the_whole_fit(spark, shape):
    rng = random.Random(3)
    rows = [(p := rng.randint(0, 60) / 60, SHAPES[shape](rng, p), rng.randint(1, 3)) for _ in range(150)]
    found = steps(isotonic.blocks(table(spark, rows), weight=F.col("w"), ranges=5, ends=2))
    expected = plain(rows)
    for p, mean in expected.items():
        held = [b[3] for b in found if b[0] <= p <= b[1]]
        assert held == [pytest.approx(mean, abs=1e-9)]
    means = [b[3] for b in found]
    assert means == sorted(set(means))
    assert sum(b[2] for b in found) == sum(w for *_, w in rows)


def test_model_equals_the_library_fit(spark):
    rng = random.Random(5)
    df = table(spark, [(p := rng.randint(0, 400) / 400, rng.random() < p * p, 1) for _ in range(1500)])
    ours = isotonic.model(isotonic.blocks(df, ranges=4))
    theirs = IsotonicRegression(featuresCol="p", labelCol="y").fit(df)
    probe = spark.createDataFrame([(i / 997,) for i in range(998)], "p double")
    answer = lambda m: [r[0] for r in m.setFeaturesCol("p").transform(probe).orderBy("p").select("prediction").collect()]
    assert answer(ours) == pytest.approx(answer(theirs), abs=1e-9)


def test_one_probability_for_all_rows_nulls_and_no_rows(spark):
    df = table(spark, [(0.3, 1, 1), (0.3, 0, 1), (0.3, 0, 1), (0.3, 1, 0)]).union(
        spark.createDataFrame([(None, 1.0, 1.0), (0.1, None, 1.0)], "p double, y double, w double")
    )
    assert steps(isotonic.blocks(df, weight=F.col("w"))) == [(0.3, 0.3, 3.0, round(1 / 3, 12))]
    assert steps(isotonic.blocks(df.filter("p > 1"))) == []
