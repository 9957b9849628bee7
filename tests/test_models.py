import random
from dataclasses import replace

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from spendcast.config import FEATURE_COLS, SETTINGS
from spendcast.models import selection, zoo
from spendcast.models.ensemble import EnsembleModel
from spendcast.models.hurdle import HurdleModel, HurdleRegressor
from spendcast.operators import explain, scoring
from spendcast.session import materialize
from spendcast.sources import tables


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(7)
    rows = []
    for i in range(240):
        x = [rng.random() * 10 for _ in FEATURE_COLS]
        amount = 200 + 50 * x[2] if x[1] + rng.random() > 5 else 0.0
        rows.append((f"c{i}", *x, float(amount)))
    schema = "customer_id string, " + ", ".join(f"{c} double" for c in FEATURE_COLS) + ", Next_3M_Spend double"
    df = spark.createDataFrame(rows, schema).withColumn("log_target", F.log1p("Next_3M_Spend"))
    return materialize(scoring.assemble(df))


def hurdle(**kwargs):
    return HurdleRegressor(
        classifier=GBTClassifier(maxIter=4, maxDepth=3, seed=1),
        regressor=GBTRegressor(maxIter=4, maxDepth=3, seed=1),
        labelCol="log_target",
        **kwargs,
    )


@pytest.fixture(scope="module")
def fitted(customers):
    return hurdle(balance="positive").fit(customers)


def test_hurdle_output_is_zero_or_ten_dollars(fitted, customers):
    for r in fitted.transform(customers).select("prob_spend", F.expm1("prediction").alias("d")).collect():
        assert 0 <= r["prob_spend"] <= 1
        assert abs(r["d"]) < 1e-9 or r["d"] >= 10 - 1e-9


def test_hurdle_survives_saving(fitted, customers, spark, tmp_path):
    tables.save_bundle(spark, fitted, str(tmp_path / "bundle"), {"Recency": 2.0})
    loaded, meta = tables.load_bundle(spark, str(tmp_path / "bundle"))
    assert meta["feature_names"] == FEATURE_COLS and meta["defaults"] == {"Recency": 2.0}
    assert isinstance(loaded, HurdleModel)
    before, after = (m.transform(customers).select("customer_id", "prediction") for m in (fitted, loaded))
    assert sorted(before.collect()) == sorted(after.collect())
    with pytest.raises(FileNotFoundError):
        tables.load_bundle(spark, str(tmp_path / "nothing"))


def test_few_spenders_use_the_mean(customers):
    spenders = customers.filter("Next_3M_Spend > 0").limit(4)
    few = materialize(spenders.unionByName(customers.filter("Next_3M_Spend = 0")))
    model = hurdle().fit(few)
    assert model.regressor is None
    expected = few.filter("Next_3M_Spend > 0").agg(F.avg("log_target")).first()[0]
    assert model.getOrDefault(model.fallback) == pytest.approx(expected)


class Recorder(GBTClassifier):
    """Notes the class weights that it is fitted with."""

    def _fit(self, dataset):
        Recorder.seen = {r["_spends"]: r["_weight"] for r in dataset.select("_spends", "_weight").distinct().collect()}
        return super()._fit(dataset)


@pytest.mark.parametrize(
    "balance, spenders, others, expected",
    [("balanced", 4, 12, (16 / 24, 16 / 8)), ("positive", 4, 12, (1.0, 3.0)), ("positive", 9, 3, (1.0, 1.0)), ("none", 4, 12, (1.0, 1.0))],
)
def test_class_weights(customers, balance, spenders, others, expected):
    rows = customers.filter("Next_3M_Spend > 0").limit(spenders).unionByName(customers.filter("Next_3M_Spend = 0").limit(others))
    HurdleRegressor(
        classifier=Recorder(maxIter=1, maxDepth=1),
        regressor=LinearRegression(regParam=0.1),
        labelCol="log_target",
        balance=balance,
    ).fit(materialize(rows))
    assert (Recorder.seen[0.0], Recorder.seen[1.0]) == pytest.approx(expected)


def test_held_out_calibration(customers):
    out = hurdle(calibrationFraction=0.3).fit(customers).transform(customers)
    assert out.filter("prob_spend < 0 or prob_spend > 1").isEmpty()


def test_grid_reaches_both_stages(customers):
    model = hurdle()
    params = [{model.classifier.maxDepth: 1, model.regressor.maxIter: 2}, {model.classifier.maxDepth: 3}]
    tuned, chosen, scores = selection.tune("custom", model, customers, params=params, parallelism=4)
    assert len(scores) == 2 and chosen in [s[0] for s in scores]
    assert isinstance(tuned, HurdleModel)
    shallow = model.fit(customers, params[0])
    assert shallow.regressor.getNumTrees == 2


def test_grid_sizes(customers):
    models = zoo.build(200)
    sizes = {n: len(zoo.grid(n, m, 200)) for n, m in models.items()}
    # Sizes of the published grids; settings without a counterpart shrink the CatBoost ones.
    assert sizes["Random Forest"] == 54 and sizes["XGBoost"] == 216 and sizes["LightGBM"] == 72
    assert sizes["Two-Stage (Random Forest)"] == 32 and sizes["Two-Stage (XGBoost)"] == 32
    assert sizes["Two-Stage (LightGBM)"] == 16 and sizes["ElasticNet"] == 12 and sizes["Ridge (L2)"] == 4
    assert sizes["CatBoost"] == 12 and sizes["Two-Stage (CatBoost)"] == 16
    assert len(models) == 13


def test_benchmark_picks_an_eligible_model_and_skips_failures(customers):
    broken = LinearRegression(featuresCol="nothing", labelCol="log_target")
    candidates = {
        "Naive Baseline (Mean)": zoo.build(240)["Naive Baseline (Mean)"],
        "Broken": broken,
        "Forest": RandomForestRegressor(numTrees=5, maxDepth=4, seed=1, labelCol="log_target"),
        "Linear": LinearRegression(labelCol="log_target", regParam=0.1),
    }
    train, test = customers.filter("customer_id < 'c8'"), customers.filter("customer_id >= 'c8'")
    settings = replace(SETTINGS, min_dollar_r2=-100.0)
    result = selection.benchmark(train, test, candidates, settings=settings, parallelism=4)
    names = [r["Model"] for r in result.board.collect()]
    assert "Broken" not in names and "Weighted Ensemble" in names
    assert result.champion in ("Forest", "Linear")
    with pytest.raises(ValueError):
        selection.benchmark(train.limit(10), test, candidates)


def test_ensemble_is_the_weighted_mean(customers, spark, tmp_path):
    members = [
        RandomForestRegressor(numTrees=3, maxDepth=2, seed=s, labelCol="log_target").fit(customers) for s in (1, 2)
    ]
    ensemble = EnsembleModel(members, [3.0, 1.0], ["a", "b"])
    one, two = (
        {r["customer_id"]: r["prediction"] for r in m.transform(customers).collect()} for m in members
    )
    ensemble.write().save(str(tmp_path / "ensemble"))
    for model in (ensemble, EnsembleModel.load(str(tmp_path / "ensemble"))):
        for r in model.transform(customers).select("customer_id", "prediction").collect():
            assert r["prediction"] == pytest.approx((3 * one[r["customer_id"]] + two[r["customer_id"]]) / 4)


def test_shapley_values_sum_to_the_difference(fitted, customers):
    background = explain.background_rows(customers, 1)
    out = explain.shapley_values(fitted, customers.limit(5), background, permutations=3)
    sums = {r["customer_id"]: r["s"] for r in out.groupBy("customer_id").agg(F.sum("attribution").alias("s")).collect()}
    stage = fitted.regressor
    spark = customers.sparkSession
    base = spark.createDataFrame([tuple(background[0])], ", ".join(f"{c} double" for c in FEATURE_COLS))
    start = stage.transform(scoring.assemble(base)).first()["_log_amount"]
    for r in stage.transform(customers.limit(5)).select("customer_id", "_log_amount").collect():
        assert sums[r["customer_id"]] == pytest.approx(r["_log_amount"] - start, abs=1e-9)


def test_surrogate_recovers_a_linear_model(customers):
    linear = LinearRegression(labelCol="log_target").fit(customers)
    moments = explain.train_moments(customers)
    out = explain.local_surrogate(linear, customers.limit(2), moments, samples=400, ridge=1e-9)
    slopes = dict(zip(FEATURE_COLS, linear.coefficients))
    rows = out.collect()
    assert len(rows) == 2 * len(FEATURE_COLS)
    for r in rows:
        assert r["weight"] == pytest.approx(slopes[r["feature"]] * moments[r["feature"]][1], abs=1e-6)


def test_monotonicity_of_a_linear_model(customers):
    linear = LinearRegression(labelCol="log_target").fit(customers)
    slopes = dict(zip(FEATURE_COLS, linear.coefficients))
    for r in explain.monotonicity_audit(linear, customers.limit(20)).collect():
        assert r["violation_rate"] == (1.0 if slopes[r["feature"]] * r["sign"] < 0 else 0.0)


def test_importances_cover_both_stages(spark, fitted):
    rows = explain.feature_importance(spark, fitted).collect()
    assert {r["stage"] for r in rows} == {"classifier", "regressor"} and len(rows) == 32


def test_registry_versions_and_null_metrics(spark, tmp_path):
    path = str(tmp_path / "registry")
    versions = [tables.register_champion(spark, path, n, "m", {}, {"r2": 0.5}) for n in ("a", "a", "b")]
    assert versions == [1, 2, 1]
    runs = str(tmp_path / "runs")
    tables.log_runs(spark, runs, "e", [("m", {"p": 1}, {"wape": float("nan"), "mae": 2.0})])
    row = tables.read_runs(spark, runs).first()
    assert row["metrics"] == {"wape": None, "mae": 2.0} and row["params"] == {"p": "1"}
    assert tables.read_segment_metrics(spark, str(tmp_path / "none")) is None


def test_folds_keep_no_partitions_of_their_shuffle(spark, customers):
    """Every level of every tree is a pass with a task per partition, so few rows must not keep many."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        folded = selection.kept_folds(customers, 5)
        plain = selection.with_folds(customers, 5)
        assert folded.rdd.getNumPartitions() <= 8
        assert sorted(folded.select("customer_id", "fold").collect()) == sorted(plain.select("customer_id", "fold").collect())
        folded.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_forests_keep_the_node_of_every_row(customers):
    """Node ids are cached, which changes no tree."""
    models = zoo.build(240, 0.01)
    two = models["Two-Stage (Random Forest)"]
    assert all(m.getCacheNodeIds() for m in (models["Random Forest"], two.classifier, two.regressor))
    forest = models["Random Forest"]
    walked = forest.copy({forest.cacheNodeIds: False})
    assert forest.fit(customers).toDebugString.split("\n")[1:] == walked.fit(customers).toDebugString.split("\n")[1:]
