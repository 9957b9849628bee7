"""The candidate models and their tuning grids.

Boosted models of other libraries are expressed with gradient-boosted trees as Spark grows them. Those have no
monotone constraints; ``explain.monotonicity_audit`` measures violations instead. ``size`` scales
the number of trees and rounds, 1.0 being the published sizes.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder

from spendcast.config import SETTINGS
from spendcast.models.baselines import MeanRegressor, PurchaseValueModel
from spendcast.models.hurdle import HurdleRegressor
from spendcast.models.trees import GBTClassifier, GBTRegressor, RandomForestClassifier, RandomForestRegressor

LABEL = "log_target"


def _rounds(n: int, size: float) -> int:
    return max(1, round(n * size))


def _linear(reg: float, mix: float, max_iter: int = 100) -> Pipeline:
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    model = LinearRegression(
        featuresCol="scaled",
        labelCol=LABEL,
        regParam=reg,
        elasticNetParam=mix,
        maxIter=max_iter,
        standardization=False,
    )
    return Pipeline(stages=[scaler, model])


def _forest(kind, trees: int, depth: int, leaf: int, seed: int, share: str = "0.7"):
    # All trees of a forest grow at once; with cached node ids no row walks down every tree again at each level.
    return kind(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        featureSubsetStrategy=share,
        seed=seed,
        cacheNodeIds=True,
        checkpointInterval=10,
    )


def _boost(kind, rounds: int, depth: int, leaf: int, seed: int, sample: float = 1.0, share: str = "all"):
    return kind(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=0.05,
        subsamplingRate=sample,
        minInstancesPerNode=leaf,
        featureSubsetStrategy=share,
        seed=seed,
        checkpointInterval=10,
    )


def build(
    n_train: int, size: float = 1.0, seed: int = SETTINGS.seed, log_max: float = SETTINGS.log_pred_max
) -> dict[str, Estimator | Transformer]:
    """The thirteen candidates that are fitted on their own, by name; the ensemble is the fourteenth."""
    # Fixed values below: the published sizes, depths, leaf sizes, rates and penalties.
    few, many = _rounds(300, size), _rounds(500, size)

    def hurdle(classifier, regressor, balance):
        return HurdleRegressor(
            classifier=classifier, regressor=regressor, labelCol=LABEL, balance=balance, logMax=log_max
        )

    regressors = {
        "Random Forest": _forest(RandomForestRegressor, few, 8, 10, seed),
        "XGBoost": _boost(GBTRegressor, few, 4, 10, seed, 0.8, "0.8"),
        "LightGBM": _boost(GBTRegressor, few, 5, 20, seed, 0.8, "0.8"),
        "CatBoost": _boost(GBTRegressor, many, 6, 1, seed),
    }
    for model in regressors.values():
        model.setLabelCol(LABEL)
    return {
        "Naive Baseline (Mean)": MeanRegressor(labelCol=LABEL),
        "BTYD Statistical Baseline": PurchaseValueModel(),
        "Linear Regression": _linear(0.0, 0.0),
        "Ridge (L2)": _linear(10.0 / max(n_train, 1), 0.0),
        "ElasticNet": _linear(0.05, 0.5, 5000),
        **regressors,
        "Two-Stage (Random Forest)": hurdle(
            _forest(RandomForestClassifier, few, 6, 5, seed, "auto"),
            _forest(RandomForestRegressor, few, 8, 8, seed),
            "balanced",
        ),
        "Two-Stage (XGBoost)": hurdle(
            _boost(GBTClassifier, few, 4, 5, seed), _boost(GBTRegressor, few, 4, 8, seed, 0.8, "0.8"), "positive"
        ),
        "Two-Stage (LightGBM)": hurdle(
            _boost(GBTClassifier, few, 5, 15, seed), _boost(GBTRegressor, few, 5, 20, seed, 0.8, "0.8"), "positive"
        ),
        "Two-Stage (CatBoost)": hurdle(
            _boost(GBTClassifier, few, 4, 1, seed), _boost(GBTRegressor, many, 6, 1, seed), "positive"
        ),
    }


def params_of(model: Estimator | Transformer) -> dict[str, str]:
    """Parameters of a model and of its stages, columns left out, for the run log."""
    parts = {"": model}
    if isinstance(model, Pipeline):
        parts = {"": model.getStages()[-1]}
    elif isinstance(model, HurdleRegressor):
        parts |= {"classifier.": model.classifier, "regressor.": model.regressor}
    return {
        prefix + param.name: str(value)
        for prefix, part in parts.items()
        for param, value in part.extractParamMap().items()
        if not param.name.endswith("Col")
    }


# The published tuning grids under Spark's parameter names. Leaf counts are given as
# depths and column sampling as the feature subset; settings without a counterpart are left out.
GRIDS: dict[str, dict[str, list]] = {
    "Random Forest": {
        "numTrees": [300, 500],
        "maxDepth": [6, 8, 10],
        "minInstancesPerNode": [8, 12, 15],
        "featureSubsetStrategy": ["0.6", "0.7", "0.8"],
    },
    "XGBoost": {
        "maxIter": [300, 500],
        "stepSize": [0.03, 0.05, 0.08],
        "maxDepth": [3, 4, 5],
        "minInstancesPerNode": [8, 12, 15],
        "subsamplingRate": [0.7, 0.8],
        "featureSubsetStrategy": ["0.7", "0.8"],
    },
    "LightGBM": {
        "maxIter": [300, 500],
        "stepSize": [0.03, 0.05],
        "maxDepth": [4, 5, 6],
        "minInstancesPerNode": [15, 25, 40],
        "subsamplingRate": [0.7, 0.8],
    },
    "CatBoost": {"maxIter": [300, 500], "stepSize": [0.03, 0.05], "maxDepth": [4, 6, 8]},
    "Two-Stage (Random Forest)": {
        "classifier.numTrees": [300, 500],
        "classifier.maxDepth": [4, 6],
        "regressor.numTrees": [300, 500],
        "regressor.maxDepth": [6, 8],
        "regressor.minInstancesPerNode": [6, 10],
    },
    "Two-Stage (XGBoost)": {
        "classifier.maxIter": [300, 500],
        "classifier.maxDepth": [3, 4],
        "regressor.maxIter": [300, 500],
        "regressor.stepSize": [0.03, 0.05],
        "regressor.minInstancesPerNode": [6, 10],
    },
    "Two-Stage (LightGBM)": {
        "classifier.maxIter": [300, 500],
        "classifier.maxDepth": [4, 5],
        "regressor.maxIter": [300, 500],
        "regressor.minInstancesPerNode": [15, 25],
    },
    "Two-Stage (CatBoost)": {
        "classifier.maxIter": [200, 300],
        "classifier.maxDepth": [3, 4],
        "regressor.maxIter": [300, 500],
        "regressor.maxDepth": [4, 6],
    },
    "ElasticNet": {"regParam": [0.01, 0.05, 0.1, 0.5], "elasticNetParam": [0.2, 0.5, 0.8]},
    "Ridge (L2)": {"regParam": [1.0, 5.0, 10.0, 50.0]},
}


def grid(name: str, model: Estimator, n_train: int, size: float = 1.0) -> list[dict]:
    """The tuning grid of a model as parameter maps; empty where none is published."""
    builder = ParamGridBuilder()
    for path, values in GRIDS.get(name, {}).items():
        stage, _, param = path.rpartition(".")
        owner = getattr(model, stage) if stage else model
        if isinstance(owner, Pipeline):
            owner = owner.getStages()[-1]
        if param in ("numTrees", "maxIter"):
            values = sorted({_rounds(v, size) for v in values})
        elif name == "Ridge (L2)":
            values = [v / max(n_train, 1) for v in values]
        builder.addGrid(owner.getParam(param), values)
    return builder.build() if name in GRIDS else []
