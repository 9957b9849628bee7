"""Forests and boosted trees that are grown inside tasks, against Spark's own and against brute force."""

import numpy as np
import pyspark.ml.classification
import pyspark.ml.regression
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spendcast.models import trees, zoo
from spendcast.operators import scoring
from spendcast.config import FEATURE_COLS
from spendcast.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.random((300, len(FEATURE_COLS))), 1)
    y = 3 * x[:, 0] + (x[:, 1] > 0.5) * x[:, 2] + rng.normal(0, 0.1, 300)
    schema = ", ".join(f"{c} double" for c in FEATURE_COLS) + ", log_target double"
    made = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], schema)
    made = made.withColumns({"up": (F.col("log_target") > 1.8).cast("double"), "twice": F.when(F.col("log_target") > 1.8, 2.5).otherwise(1.0)})
    return materialize(scoring.assemble(made))


@pytest.mark.parametrize("least", [12, 30])
def test_boosted_trees_are_sparks(rows, least):
    """Few values a feature, so that both have the same bins; nothing is drawn at random, and sides of many rows leave no ties."""
    for name, package, label, how in (
        ("GBTRegressor", pyspark.ml.regression, "log_target", {}),
        ("GBTClassifier", pyspark.ml.classification, "up", {"weightCol": "twice"}),
    ):
        how = how | {"labelCol": label, "maxIter": 6, "maxDepth": 3, "minInstancesPerNode": least, "stepSize": 0.05}
        ours, theirs = getattr(trees, name)(**how).fit(rows), getattr(package, name)(**how).fit(rows)
        assert type(ours) is type(theirs) and ours.getNumTrees == 6
        assert ours.totalNumNodes == theirs.totalNumNodes and list(ours.treeWeights) == list(theirs.treeWeights)
        assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
        value = F.col("prediction") if label != "up" else vector_to_array("probability")[1]
        one, two = ([r[0] for r in m.transform(rows).orderBy("features").select(value).collect()] for m in (ours, theirs))
        assert one == pytest.approx(two, abs=1e-9)


def test_forests_learn_like_sparks(rows):
    for name, package, label in (("RandomForestRegressor", pyspark.ml.regression, "log_target"), ("RandomForestClassifier", pyspark.ml.classification, "up")):
        how = dict(labelCol=label, numTrees=40, maxDepth=6, minInstancesPerNode=3, seed=1)
        ours, theirs = getattr(trees, name)(**how).fit(rows), getattr(package, name)(**how).fit(rows)
        assert type(ours) is type(theirs) and ours.getNumTrees == 40 and len(ours.trees) == 40
        assert ours.totalNumNodes == pytest.approx(theirs.totalNumNodes, rel=0.15)
        miss = [m.transform(rows).agg(F.avg(F.abs(F.col(label) - F.col("prediction")))).first()[0] for m in (ours, theirs)]
        assert miss[0] == pytest.approx(miss[1], abs=0.05)


def test_trees_need_few_jobs_and_no_partition_changes_them(spark, rows):
    """A job per level would be hundreds of them."""
    boosted = zoo.build(300, 0.1)["XGBoost"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("trees", "count the jobs of a fit")
    one = boosted.fit(rows)
    jobs = len(tracker.getJobIdsForGroup("trees"))
    spark.sparkContext.setJobGroup("other", "")
    assert one.getNumTrees == 30 and 0 < jobs < 30
    two = boosted.fit(rows.repartition(7))
    assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]
    forest = zoo.build(300, 0.1)["Random Forest"]
    assert forest.fit(rows).toDebugString.split("\n")[1:] == forest.fit(rows.repartition(5)).toDebugString.split("\n")[1:]


def test_more_rows_than_a_task_may_hold_go_to_spark(rows, monkeypatch):
    monkeypatch.setattr(trees, "MOST_CELLS", 100)
    monkeypatch.setattr(trees._Grown, "_loaded", None)
    assert zoo.build(300, 0.01)["XGBoost"].fit(rows).getNumTrees == 3


def test_cuts_leave_equal_shares():
    assert trees.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert trees.thresholds(np.array([5.0, 5.0]), 32).tolist() == []
    cuts = trees.thresholds(np.arange(1000.0), 4)
    assert cuts.tolist() == [249.5, 499.5, 749.5]


def test_rows_without_a_number_are_refused(spark, rows):
    with pytest.raises(Exception, match="finite|NaN|Null"):
        trees.GBTRegressor(labelCol="log_target", maxIter=2).fit(rows.withColumn("log_target", F.lit(float("nan"))))


def _prepared(rows):
    from spendcast.plans import catalog, training

    spend = F.when(F.col("up") > 0, F.expm1("log_target")).otherwise(0.0)
    named = rows.withColumns({"Next_3M_Spend": spend, "log_target": F.log1p(spend), "n": F.monotonically_increasing_id()})
    table = materialize(named.withColumns({"customer_id": F.col("n").cast("string"), "split": F.when(F.col("n") % 5 == 0, "test").otherwise("train")}).drop("n"))
    return training.Prepared(table, (1.0, 2.0), {c: 0.5 for c in FEATURE_COLS}, {}, None, None, catalog.WIDE)


@pytest.mark.parametrize("name", ["feature_importance", "hurdle_predict", "single_score"])
def test_queries_train_all_trees(spark, rows, monkeypatch, name):
    """The published hurdle has 300 trees that classify and 500 that regress; a hundredth of them was trained."""
    from spendcast.models.hurdle import HurdleRegressor
    from spendcast.plans import catalog

    data, fitted, fit = _prepared(rows), [], HurdleRegressor._fit
    monkeypatch.setattr(catalog, "_trained", lambda spark, sf_dir: data)
    monkeypatch.setattr(HurdleRegressor, "_fit", lambda self, df: fitted.append(fit(self, df)) or fitted[-1])
    assert not getattr(catalog, name)(spark, "").isEmpty()
    assert [(m.classifier.getNumTrees, m.regressor.getNumTrees) for m in fitted] == [(300, 500)]


def test_the_leaderboard_trains_all_trees(spark, rows, monkeypatch):
    from spendcast.models import selection
    from spendcast.plans import catalog

    data, sizes = _prepared(rows), []
    monkeypatch.setattr(catalog, "_trained", lambda spark, sf_dir: data)
    monkeypatch.setattr(selection, "_fold_mae", lambda model, *rest: 1.0)

    def fit(model, *rest):
        parts = [model.classifier, model.regressor] if hasattr(model, "classifier") else [model]
        sizes.extend(p.getOrDefault(p.getParam(c)) for p in parts for c in ("numTrees", "maxIter") if "Pipeline" not in p.uid and p.hasParam(c))
        raise RuntimeError("sizes are enough")

    monkeypatch.setattr(selection, "_fit", fit)
    with pytest.raises(RuntimeError, match="all models failed"):
        catalog.train_leaderboard(spark, "")
    assert sorted(sizes) == [300] * 10 + [500] * 2


def test_a_failed_calibration_is_an_error(rows, monkeypatch):
    from spendcast.models.hurdle import HurdleRegressor
    from spendcast.operators import isotonic

    def fails(*rest, **more):
        raise RuntimeError("lost")

    monkeypatch.setattr(isotonic, "blocks", fails)
    model = HurdleRegressor(classifier=trees.GBTClassifier(maxIter=2), regressor=trees.GBTRegressor(maxIter=2), labelCol="log_target")
    with pytest.raises(RuntimeError, match="lost"):
        model.fit(rows)
