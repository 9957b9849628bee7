"""Importances, sampled Shapley values, local surrogates and a monotonicity audit, as Spark jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from spendcast.config import EXPECTED_SIGNS, FEATURE_COLS, SETTINGS
from spendcast.models.hurdle import HurdleModel
from spendcast.operators.quantiles import quantile_values


def explained_stage(model: Transformer) -> tuple[Transformer, str]:
    """The regressor whose output is explained, and its prediction column."""
    if isinstance(model, PipelineModel):
        return explained_stage(model.stages[-1]) if len(model.stages) == 1 else (model, "prediction")
    if isinstance(model, HurdleModel) and model.regressor is not None:
        return model.regressor, "_log_amount"
    return model, "prediction"


def feature_importance(spark, model: Transformer) -> DataFrame:
    """stage, feature, importance for tree models; no rows for models without importances."""
    stages = {"model": model}
    if isinstance(model, HurdleModel):
        stages = {"regressor": model.regressor, "classifier": model.classifier}
    rows = [
        (stage, feature, float(value))
        for stage, part in stages.items()
        if hasattr(part, "featureImportances")
        for feature, value in zip(FEATURE_COLS, part.featureImportances.toArray())
    ]
    return spark.createDataFrame(rows, "stage string, feature string, importance double")


def _predict(df: DataFrame, values: Mapping[str, Column], model: Transformer) -> DataFrame:
    """Score ``df`` with the feature columns replaced by ``values``; the result is in ``_f``."""
    stage, output = explained_stage(model)
    assembled = VectorAssembler(inputCols=[f"_x_{c}" for c in FEATURE_COLS], outputCol="features").transform(
        df.withColumns({f"_x_{c}": values[c] for c in FEATURE_COLS})
    )
    return stage.transform(assembled).withColumn("_f", F.col(output))


def background_rows(train: DataFrame, rows: int = 50, seed: int = SETTINGS.seed, key: str = "customer_id") -> list[list[float]]:
    """A fixed number of train rows in hash order, to compare against."""
    order = F.xxhash64(F.col(key), F.lit(seed))
    return [list(r) for r in train.orderBy(order, key).limit(rows).select(*FEATURE_COLS).collect()]


def shapley_values(
    model: Transformer,
    customers: DataFrame,
    background: Sequence[Sequence[float]],
    permutations: int = 8,
    seed: int = SETTINGS.seed,
    key: str = "customer_id",
) -> DataFrame:
    """Sampled Shapley values: customer, feature, attribution.

    Each (feature order, background row) pair is a walk from the background row to the customer,
    one feature per step. Steps are exploded, scored by one ``transform``, and each score enters
    the feature before it with plus and the feature after it with minus. The walks of a customer
    are born in one task, so the sum is combined before the shuffle and 16 rows leave it.
    """
    rng = np.random.default_rng(seed)
    d = len(FEATURE_COLS)
    walks = []
    for i in range(permutations):
        order = rng.permutation(d)
        place = np.empty(d, dtype=int)
        place[order] = np.arange(d)
        base = background[int(rng.integers(len(background)))]
        places = ", ".join(str(int(p)) for p in place)
        bases = ", ".join(f"{float(v)!r}D" for v in base)
        orders = ", ".join(str(int(o)) for o in order)
        walks.append(f"named_struct('place', array({places}), 'base', array({bases}), 'order', array({orders}))")
    steps = (
        customers.select(key, *FEATURE_COLS)
        .withColumn("_walk", F.expr(f"explode(array({', '.join(walks)}))"))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )
    values = {
        c: F.when(F.col("_walk.place")[i] < F.col("_step"), F.col(c)).otherwise(F.col("_walk.base")[i])
        for i, c in enumerate(FEATURE_COLS)
    }
    scored = _predict(steps, values, model)
    index = F.col("_step")
    parts = F.array(
        F.when(index > 0, F.struct(F.get("_walk.order", index - 1).alias("i"), F.col("_f").alias("v"))),
        F.when(index < d, F.struct(F.get("_walk.order", index).alias("i"), (-F.col("_f")).alias("v"))),
    )
    names = F.array(*[F.lit(c) for c in FEATURE_COLS])
    return (
        scored.select(key, F.explode(F.array_compact(parts)).alias("_part"))
        .groupBy(key, F.get(names, F.col("_part.i")).alias("feature"))
        .agg((F.sum("_part.v") / permutations).alias("attribution"))
    )


def mean_abs(attributions: DataFrame) -> DataFrame:
    """Cohort view: mean absolute attribution per feature."""
    return attributions.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("importance"))


def train_moments(train: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each feature; a constant feature gets deviation 1."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in FEATURE_COLS], *[F.stddev_pop(c).alias(f"s_{c}") for c in FEATURE_COLS]
    ).first()
    return {c: (float(row[f"m_{c}"]), float(row[f"s_{c}"] or 1.0)) for c in FEATURE_COLS}


def _gaussian(key: str, sample: Column, feature: int, seed: int) -> Column:
    """A standard normal number fixed by customer, sample and feature (Box-Muller on hashes)."""

    def uniform(which: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.col(key), sample, F.lit(feature), F.lit(which), F.lit(seed)), 11)
        return (bits.cast("double") + 0.5) / float(2**53)

    return F.sqrt(-2 * F.ln(uniform(0))) * F.cos(2 * np.pi * uniform(1))


def local_surrogate(
    model: Transformer,
    customers: DataFrame,
    moments: Mapping[str, tuple[float, float]],
    samples: int = 500,
    ridge: float = 1.0,
    seed: int = SETTINGS.seed,
    key: str = "customer_id",
) -> DataFrame:
    """Weights of a weighted ridge regression around each customer: customer, feature, weight.

    Samples are Gaussian with train moments, the first one is the customer. Weights fall with
    the distance in standard units. Spark builds the sums of the normal equations; each customer's
    sums are one row of fixed size, solved in Arrow batches.
    """
    d = len(FEATURE_COLS)
    width = 0.75 * np.sqrt(d)
    drawn = customers.select(key, *FEATURE_COLS).withColumn(
        "_s", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))
    )
    standard, raw = [], {}
    distance = F.lit(0.0)
    for i, c in enumerate(FEATURE_COLS):
        mean, deviation = moments[c]
        own = (F.col(c) - mean) / deviation
        z = F.when(F.col("_s") == 0, own).otherwise(_gaussian(key, F.col("_s"), i, seed))
        drawn = drawn.withColumn(f"_z{i}", z)
        standard.append(f"_z{i}")
        raw[c] = F.col(f"_z{i}") * deviation + mean
        distance = distance + F.pow(F.col(f"_z{i}") - own, 2)
    kernel = F.sqrt(F.exp(-distance / float(width**2)))
    scored = _predict(drawn.withColumn("_w", kernel), raw, model)
    terms = [F.lit(1.0), *[F.col(c) for c in standard]]
    sums = [
        F.sum(F.col("_w") * terms[i] * terms[j]).alias(f"a_{i}_{j}") for i in range(d + 1) for j in range(i + 1)
    ] + [F.sum(F.col("_w") * terms[i] * F.col("_f")).alias(f"b_{i}") for i in range(d + 1)]
    equations = scored.groupBy(key).agg(*sums)
    key_type = customers.schema[key].dataType
    schema = StructType(
        [StructField(key, key_type), StructField("feature", StringType()), StructField("weight", DoubleType())]
    )
    features = list(FEATURE_COLS)

    def solve(batches):
        penalty = np.diag([0.0] + [ridge] * d)
        for rows in batches:
            a = np.empty((len(rows), d + 1, d + 1))
            for i in range(d + 1):
                for j in range(i + 1):
                    a[:, i, j] = a[:, j, i] = rows[f"a_{i}_{j}"]
            b = np.stack([rows[f"b_{i}"].to_numpy(float) for i in range(d + 1)], axis=1)
            weights = np.linalg.solve(a + penalty, b[:, :, None])[:, 1:, 0]
            yield pd.DataFrame(
                {key: rows[key].repeat(d), "feature": features * len(rows), "weight": weights.ravel()}
            )

    return equations.mapInPandas(solve, schema)


def agreement(attributions: DataFrame, weights: DataFrame, top: int = 12) -> DataFrame:
    """Both views of one customer side by side, each scaled to a maximum of one.

    Joined on the feature name; the ``top`` features by attribution. At most one row per feature.
    """
    shares = attributions.groupBy("feature").agg(F.sum(F.abs("attribution")).alias("a"))
    locals_ = weights.groupBy("feature").agg(F.sum(F.abs("weight")).alias("w"))
    best = shares.join(locals_, "feature", "left").fillna(0.0, ["w"]).orderBy(F.desc("a"), "feature").limit(top)
    peak = best.agg(F.struct(F.max("a").alias("a"), F.max("w").alias("w")).alias("m")).scalar()
    return best.select(
        "feature",
        (F.col("a") / (peak["a"] + F.lit(1e-8))).alias("shapley"),
        (F.col("w") / (peak["w"] + F.lit(1e-8))).alias("surrogate"),
    )


def monotonicity_audit(
    model: Transformer,
    customers: DataFrame,
    steps: int = 5,
    signs: Mapping[str, int] = EXPECTED_SIGNS,
    key: str = "customer_id",
) -> DataFrame:
    """Share of steps along each feature's quantiles that move the prediction the wrong way.

    Each customer is exploded to (feature, grid point) rows; a walk stays in one task until the
    scores are collected per (customer, feature), at most ``steps`` numbers.
    """
    audited = [c for c in FEATURE_COLS if signs.get(c, 0)]
    grid = quantile_values(customers, audited, [i / (steps - 1) for i in range(steps)])
    points = [
        f"named_struct('feature', '{c}', 'sign', {signs[c]}, 'step', {i}, 'value', {float(v)!r}D)"
        for c in audited
        for i, v in enumerate(grid[c])
    ]
    moved = customers.select(key, *FEATURE_COLS).withColumn("_g", F.expr(f"explode(array({', '.join(points)}))"))
    values = {c: F.when(F.col("_g.feature") == c, F.col("_g.value")).otherwise(F.col(c)) for c in FEATURE_COLS}
    scored = _predict(moved, values, model)
    walks = scored.groupBy(key, F.col("_g.feature").alias("feature"), F.col("_g.sign").alias("sign")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_g.step").alias("s"), F.col("_f").alias("f")))).alias("w")
    )
    wrong = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps - 1)),
        F.lit(0),
        lambda n, i: n
        + F.when(F.col("sign") * (F.get("w", i)["f"] - F.get("w", i - 1)["f"]) < -1e-12, 1).otherwise(0),
    )
    return walks.groupBy("feature", "sign").agg(
        (F.sum(wrong) / (F.count("*") * (steps - 1))).alias("violation_rate"),
        F.max((wrong > 0).cast("int")).alias("any_violation"),
        F.count("*").alias("customers"),
    )
