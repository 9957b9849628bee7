"""Cross-validation, the leaderboard, champion selection and tuning."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Transformer
from pyspark.sql import DataFrame, functions as F

from spendcast.config import SETTINGS, Settings
from spendcast.models import zoo
from spendcast.models.ensemble import EnsembleModel, predict_columns
from spendcast.models.hurdle import HurdleRegressor
from spendcast.operators import leaderboard as board_ops
from spendcast.operators.metrics import dual_scale_metrics
from spendcast.operators.splits import fold_count, stratified_folds
from spendcast.session import materialize

logger = logging.getLogger(__name__)

BOARD_SCHEMA = (
    "Model string, Log_MAE double, Log_RMSE double, Log_R2 double, Dollar_RMSE double, Dollar_MAE double, "
    "Dollar_R2 double, SMAPE double, WAPE double, CV_MAE_Mean double, CV_MAE_Std double"
)


@dataclass
class Benchmark:
    board: DataFrame
    champion: str
    models: dict[str, Transformer]
    rows: list[dict] = field(default_factory=list)
    params: dict[str, dict] = field(default_factory=dict)

    @property
    def best(self) -> Transformer:
        return self.models[self.champion]


def _fit(model: Estimator | Transformer, rows: DataFrame, params: Mapping | None = None) -> Transformer:
    return model.fit(rows, dict(params or {})) if isinstance(model, Estimator) else model


def _fold_mae(
    model: Estimator | Transformer, train: DataFrame, fold: int, params: Mapping | None = None, label: str = zoo.LABEL
) -> float:
    fitted = _fit(model, train.filter(F.col("fold") != fold), params)
    held = fitted.transform(train.filter(F.col("fold") == fold))
    return held.agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae")).first()["mae"]


def _in_threads(work, tasks: Sequence, df: DataFrame, parallelism: int) -> list:
    """Run independent fits side by side; Spark runs their jobs concurrently."""
    pool = ThreadPool(max(1, min(parallelism, len(tasks))))
    try:
        return pool.map(inheritable_thread_target(df.sparkSession)(work), tasks, chunksize=1)
    finally:
        pool.close()


def with_folds(train: DataFrame, folds: int, label: str = zoo.LABEL, seed: int = SETTINGS.seed) -> DataFrame:
    flagged = train.withColumn("_spends", F.col(label) > 0)
    return stratified_folds(flagged, "_spends", folds, seed=seed).drop("_spends")


def kept_folds(train: DataFrame, folds: int, seed: int = SETTINGS.seed) -> DataFrame:
    """``with_folds`` written and cached: every level of every tree is a pass over it, with a task per partition.

    Cached by itself it would keep all partitions of its shuffle; a written table has as many as its size asks for.
    """
    return materialize(with_folds(train, folds, seed=seed)).cache()


def cross_validate(
    model: Estimator | Transformer,
    train: DataFrame,
    folds: int,
    params: Sequence[Mapping] = ({},),
    label: str = zoo.LABEL,
    parallelism: int = 2,
) -> list[tuple[float, float]]:
    """Mean and population deviation of the fold MAEs (log scale), one pair per parameter set.

    ``train`` needs a ``fold`` column and should be cached. Folds are plain filters.
    """
    tasks = [(i, k) for i in range(len(params)) for k in range(folds)]
    scores = _in_threads(
        lambda task: (task[0], _fold_mae(model, train, task[1], params[task[0]], label)), tasks, train, parallelism
    )
    maes = [[s for which, s in scores if which == i] for i in range(len(params))]
    return [(float(np.mean(m)), float(np.std(m))) for m in maes]


def evaluate_models(
    models: Mapping[str, Transformer],
    test: DataFrame,
    label: str = zoo.LABEL,
    dollars: str = "Next_3M_Spend",
    log_max: float = SETTINGS.log_pred_max,
) -> list[dict]:
    """All leaderboard metrics of all models from one pass over the test rows."""
    columns = {f"_p{i}": model for i, model in enumerate(models.values())}
    predicted = predict_columns(test, columns)
    names = F.array(
        *[F.struct(F.lit(name).alias("Model"), F.col(c).alias("p")) for name, c in zip(models, columns)]
    )
    clipped = F.least(F.greatest(F.col("x.p"), F.lit(0.0)), F.lit(float(log_max)))
    long = predicted.select(
        F.col(label).alias("log_actual"), F.col(dollars).alias("actual"), F.explode(names).alias("x")
    ).select("log_actual", "actual", F.col("x.Model").alias("Model"), clipped.alias("log_predicted"))
    rows = dual_scale_metrics(long.withColumn("predicted", F.expm1("log_predicted")), ["Model"]).collect()
    return [r.asDict() for r in rows]


def benchmark(
    train: DataFrame,
    test: DataFrame,
    candidates: Mapping[str, Estimator | Transformer] | None = None,
    size: float = 1.0,
    settings: Settings = SETTINGS,
    parallelism: int = 2,
) -> Benchmark:
    """Cross-validate and fit every candidate, add the ensemble, order the board, pick a champion.

    ``train`` and ``test`` carry ``features``, ``log_target`` and ``Next_3M_Spend`` and should be
    cached or written. A candidate that fails is logged and skipped.
    """
    n = train.count()
    if n < settings.min_train_rows:
        raise ValueError(f"only {n} training customers, at least {settings.min_train_rows} are needed")
    folds = fold_count(n)
    folded = kept_folds(train, folds, settings.seed)
    if candidates is None:
        candidates = zoo.build(n, size, settings.seed, settings.log_pred_max)
    fitted: dict[str, Transformer] = {}
    scores: dict[str, tuple[float, float]] = {}

    def one(task: tuple[str, int | None]):
        name, fold = task
        try:
            model = candidates[name]
            return task, _fit(model, folded) if fold is None else _fold_mae(model, folded, fold)
        except Exception as error:
            return task, error

    try:
        # two-stage models take longest and start first
        names = sorted(candidates, key=lambda n: not isinstance(candidates[n], HurdleRegressor))
        outcome = dict(_in_threads(one, [(n, k) for n in names for k in (None, *range(folds))], folded, parallelism))
        for name in candidates:
            results = {k: outcome[name, k] for k in (None, *range(folds))}
            errors = [r for r in results.values() if isinstance(r, Exception)]
            if errors:
                logger.warning("model %s failed: %s", name, errors[0])
                continue
            maes = [results[k] for k in range(folds)]
            scores[name] = float(np.mean(maes)), float(np.std(maes))
            fitted[name] = results[None]
        if not fitted:
            raise RuntimeError("all models failed")
        rows = [
            {**row, "CV_MAE_Mean": scores[row["Model"]][0], "CV_MAE_Std": scores[row["Model"]][1]}
            for row in evaluate_models(fitted, test, log_max=settings.log_pred_max)
        ]
    finally:
        folded.unpersist()
    spark = train.sparkSession
    board = spark.createDataFrame(rows, BOARD_SCHEMA)
    members = board_ops.ensemble_members(board, settings.min_dollar_r2).collect()
    if members:
        ensemble = EnsembleModel(
            [fitted[m["Model"]] for m in members], [m["weight"] for m in members], [m["Model"] for m in members]
        )
        row = evaluate_models({board_ops.ENSEMBLE: ensemble}, test, log_max=settings.log_pred_max)[0]
        row["CV_MAE_Mean"] = sum(m["weight"] * m["CV_MAE_Mean"] for m in members)
        row["CV_MAE_Std"] = 0.0
        rows.append(row)
        fitted[board_ops.ENSEMBLE] = ensemble
        board = board.unionByName(spark.createDataFrame([row], BOARD_SCHEMA))
    best = board_ops.champion(board, settings.min_dollar_r2).first()
    if best is None:
        raise RuntimeError("no model is eligible as champion")
    params = {name: zoo.params_of(candidates[name]) for name in fitted if name in candidates}
    return Benchmark(board_ops.ordered(board), best["Model"], fitted, rows, params)


def tune(
    name: str,
    model: Estimator,
    train: DataFrame,
    fitted: Model | None = None,
    params: Sequence[Mapping] | None = None,
    size: float = 1.0,
    settings: Settings = SETTINGS,
    parallelism: int = 2,
) -> tuple[Transformer, dict, list[tuple[dict, float]]]:
    """Grid search by fold MAE. Returns model, chosen parameters and the score of each set.

    The ensemble and models without a grid come back unchanged.
    """
    n = train.count()
    if name == board_ops.ENSEMBLE:
        return fitted, {}, []
    params = zoo.grid(name, model, n, size) if params is None else params
    if not params:
        return (_fit(model, train) if fitted is None else fitted), {}, []
    folds = fold_count(n)
    folded = kept_folds(train, folds, settings.seed)
    try:
        scores = cross_validate(model, folded, folds, params, parallelism=parallelism)
        best = min(range(len(params)), key=lambda i: scores[i][0])
        tuned = _fit(model, folded, params[best])
    finally:
        folded.unpersist()
    readable = [({f"{p.parent.split('_')[0]}.{p.name}": v for p, v in s.items()}, m[0]) for s, m in zip(params, scores)]
    return tuned, readable[best][0], readable
