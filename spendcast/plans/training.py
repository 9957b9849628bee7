"""The training run and the evaluation report, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, functions as F

from spendcast.config import FEATURE_COLS, SETTINGS, Settings
from spendcast.models.hurdle import HurdleModel
from spendcast.models.selection import Benchmark, benchmark, tune
from spendcast.models import zoo
from spendcast.operators import btyd, caps, evaluation, explain, features, quantiles, ranking, splits
from spendcast.operators.cleaning import mark
from spendcast.operators.metrics import metric_bundle
from spendcast.operators.scoring import assemble
from spendcast.session import materialize
from spendcast.sources import tables


@dataclass(frozen=True)
class Prepared:
    """Everything fitted on train customers, and the feature table of all customers."""

    table: DataFrame
    thresholds: tuple[float, float]
    defaults: dict[str, float]
    caps: dict[str, float]
    purchases: btyd.PurchaseParams
    values: btyd.ValueParams
    settings: Settings

    @property
    def train(self) -> DataFrame:
        return self.table.filter("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.table.filter("split = 'test'")


def literal_split(transactions: DataFrame, horizon_days: int) -> Column:
    """The split point as a literal, so that scans of a written table can skip files."""
    stamp = features.date_range(transactions, horizon_days).first()["split_ts"]
    return F.lit(str(stamp)).cast("timestamp_ntz")


def marked_base(raw: DataFrame, settings: Settings = SETTINGS, return_scope: str = "history") -> DataFrame:
    """History features and target of every customer, over marked rows that are written by month."""
    marked = materialize(mark(raw), by=["month"])
    split_ts = literal_split(marked.filter("valid"), settings.horizon_days)
    return features.marked_behaviour(marked, split_ts, return_scope)


def customer_base(raw: DataFrame, settings: Settings = SETTINGS, return_scope: str = "history") -> DataFrame:
    """Uncapped history features, target, stratum and split; written once.

    The raw rows are read once: deduplicated and marked they are written by month, and the day,
    invoice, product, return and outcome scans read their columns of the months they need.
    """
    base = materialize(marked_base(raw, settings, return_scope))
    strata = splits.with_stratum(base, splits.stratum_edges(base, strata=settings.strata))
    return materialize(splits.stratified_split(strata, share=settings.train_share, seed=settings.seed))


def prepare(
    raw: DataFrame,
    settings: Settings = SETTINGS,
    return_scope: str = "history",
    purchases: btyd.PurchaseParams | None = None,
    values: btyd.ValueParams | None = None,
) -> Prepared:
    """From raw transactions to the assembled feature table. All statistics come from train rows.

    Parameters of an earlier fit can be given and are then not fitted again.
    """
    base = customer_base(raw, settings, return_scope)
    train = base.filter("split = 'train'")
    purchases = purchases or btyd.fit_purchases(train)
    values = values or btyd.fit_values(train)
    limits = caps.fit_caps(base, settings.cap_quantile)
    ranked = ranking.train_percentile(base)
    estimated = btyd.add_estimates(ranked, purchases, values, settings.horizon_days)
    table = materialize(assemble(caps.apply_caps(estimated, limits)))
    # Segment limits and fill values are train quantiles, from one pass.
    train = table.filter("split = 'train'").withColumn(
        "_positive", F.when(F.col("Next_3M_Spend") > 0, F.col("Next_3M_Spend"))
    )
    found = quantiles.quantile_values(train, [*FEATURE_COLS, "_positive"], [0.2, 0.5, 0.8])
    low, _, high = found.get("_positive", [0.0, 0.0, 0.0])
    defaults = {c: found.get(c, [0.0, 0.0, 0.0])[1] for c in FEATURE_COLS}
    return Prepared(table, (low, high), defaults, limits, purchases, values, settings)


def scored_frame(model: Transformer, rows: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """(actual, predicted) rows on both scales, with the stage-1 probability where there is one."""
    predicted = model.transform(rows)
    log_predicted = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(settings.log_pred_max))
    prob = [F.col("prob_spend")] if "prob_spend" in predicted.columns else []
    return predicted.select(
        *[c for c in rows.columns if c != "features"],
        F.col("Next_3M_Spend").alias("actual"),
        F.col("log_target").alias("log_actual"),
        log_predicted.alias("log_predicted"),
        F.expm1(log_predicted).alias("predicted"),
        *prob,
    )


def report(
    model: Transformer,
    data: Prepared,
    permutations: int = 8,
    samples: int = 500,
    background: int = 50,
) -> dict[str, DataFrame]:
    """All evaluation tables of a model on the test customers."""
    settings = data.settings
    scored = materialize(scored_frame(model, data.test, settings))
    spark = scored.sparkSession
    curve = ranking.gain_curve(scored)
    parts = {
        "log_metrics": metric_bundle(scored, "log_actual", "log_predicted"),
        "dollar_metrics": metric_bundle(scored, "actual", "predicted"),
        "segments": evaluation.segment_metrics(scored, data.thresholds, min_rows=settings.min_segment_rows),
        "actual_vs_predicted": evaluation.actual_vs_predicted(scored),
        "gain_curve": curve,
        "lift_points": ranking.lift_points(curve),
        "residuals": evaluation.residuals(scored),
        "residual_histogram": evaluation.histogram(evaluation.residuals(scored), "residual", 50),
    }
    importances = explain.feature_importance(spark, model)
    if importances.isEmpty():
        return parts
    # Profiles are drawn from predicted spenders, where there are enough of them.
    cohort = evaluation.predicted_spenders(scored)
    chosen = evaluation.representatives(cohort)
    rows = explain.background_rows(data.train, background, settings.seed)
    attributions = explain.shapley_values(model, cohort, rows, permutations, settings.seed)
    few = scored.join(F.broadcast(chosen.select("customer_id", "profile")), "customer_id")
    profiles = materialize(explain.shapley_values(model, few, rows, permutations, settings.seed))
    middle = chosen.filter("profile = 'mid'").select("customer_id")
    moments = explain.train_moments(data.train)
    local = materialize(
        explain.local_surrogate(model, few.filter("profile = 'mid'"), moments, samples, seed=settings.seed)
    )
    parts.update(
        importances=evaluation.top_per_stage(importances),
        cohort_attributions=explain.mean_abs(attributions),
        profile_attributions=profiles.join(F.broadcast(chosen), "customer_id"),
        attribution_agreement=explain.agreement(profiles.join(F.broadcast(middle), "customer_id"), local),
    )
    if isinstance(model, HurdleModel):
        spends = scored.withColumn("spends", F.col("actual") > 0)
        parts.update(
            calibration=evaluation.calibration_curve(scored),
            probability_histogram=evaluation.histogram(spends, "prob_spend", 40, by="spends"),
            spender_count=evaluation.spender_count(scored, threshold=settings.churn_threshold),
        )
    return parts


def train_champion(
    data: Prepared, names: Sequence[str] | None = None, size: float = 1.0, parallelism: int = 2
) -> tuple[Benchmark, Transformer, dict]:
    """Benchmark all candidates (or those in ``names``) and tune the champion.

    Returns the benchmark, the tuned model and the chosen parameters.
    """
    settings = data.settings
    train, test = data.train.cache(), data.test.cache()
    try:
        zoo_models = zoo.build(train.count(), size, settings.seed, settings.log_pred_max)
        candidates = {n: m for n, m in zoo_models.items() if names is None or n in names}
        result = benchmark(train, test, candidates, settings=settings, parallelism=parallelism)
        tuned, chosen, _ = tune(
            result.champion,
            candidates[result.champion],
            train,
            result.best,
            size=size,
            settings=settings,
            parallelism=parallelism,
        )
    finally:
        train.unpersist()
        test.unpersist()
    return result, tuned, chosen


def publish(
    path: str,
    data: Prepared,
    result: Benchmark,
    tuned: Transformer,
    chosen: dict,
    tables_of_report: dict[str, DataFrame],
    experiment: str = "spendcast",
) -> int:
    """Write the run log, the segment metrics, the model bundle and the registry entry.

    Returns the champion's version number.
    """
    spark = data.table.sparkSession
    names = ("CV_MAE_Mean", "CV_MAE_Std", "Log_MAE", "Log_R2", "Dollar_MAE", "Dollar_R2", "SMAPE", "WAPE")
    runs = [(r["Model"], result.params.get(r["Model"], {}), {n.lower(): r[n] for n in names}) for r in result.rows]
    tables.log_runs(spark, f"{path}/runs", experiment, runs)
    tables.write_segment_metrics(tables_of_report["segments"], f"{path}/segment_metrics")
    name = f"{experiment}_champion"
    version = tables.claim_version(spark, f"{path}/registry", name)
    bundle = f"bundle/v={version}"
    try:
        tables.save_bundle(spark, tuned, f"{path}/{bundle}", data.defaults)
    except Exception:
        tables.release_version(spark, f"{path}/registry", name, version)
        raise
    log, dollar = (tables_of_report[t].first() for t in ("log_metrics", "dollar_metrics"))
    params = {"n_features": len(FEATURE_COLS), "feature_names": FEATURE_COLS, "bundle": bundle, **chosen}
    final = {"dollar_r2": dollar["R2"], "dollar_mae": dollar["MAE"], "log_r2": log["R2"]}
    return tables.register_champion(spark, f"{path}/registry", name, result.champion, params, final, version)
