"""One query per operator over the order tables, used for checks and benchmarks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spendcast.config import CAPPED_COLS, FEATURE_COLS, SETTINGS
from spendcast.models import selection, zoo
from spendcast.models.baselines import MeanRegressor, PurchaseValueModel
from spendcast.models.ensemble import EnsembleModel, weighted_mean
from spendcast.operators import (
    btyd,
    caps,
    cleaning,
    evaluation,
    explain,
    features,
    isotonic,
    leaderboard,
    metrics,
    quantiles,
    ranking,
    scoring,
    sketches,
    splits,
)
from spendcast.plans import training
from spendcast.session import materialize, scratch_dir
from spendcast.sources import tables, transactions

Query = Callable[[SparkSession, str], DataFrame]

# Parameters at which the probabilistic operators are compared with SQL.
PURCHASES = btyd.PurchaseParams(r=0.8, alpha=150.0, a=0.9, b=2.5)
VALUES = btyd.ValueParams(p=2.1, q=3.3, v=60000.0, global_mean=150000.0)

# The order tables hold amounts far above the published clip and segment limits.
WIDE = replace(SETTINGS, log_pred_max=16.0, segment_low=50000.0, segment_high=150000.0, min_dollar_r2=-1000.0)

EVENT_HORIZON = 7


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# -- shared inputs ---------------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions.orders_as_transactions(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Clean rows, and the split point taken from the rows before deduplication."""
    raw = _raw(spark, sf_dir)
    return cleaning.clean(raw), features.split_point(cleaning.valid_rows(raw))


def _spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM and target per customer, written once. Clean rows are read twice, so they are written too."""
    rows = materialize(cleaning.clean(_raw(spark, sf_dir)))
    split_ts = training.literal_split(rows, SETTINGS.horizon_days)
    summary = features.rfm(features.days(features.history(rows, split_ts)), split_ts)
    target = features.targets(features.outcome(rows, split_ts))
    return materialize(features.derived(features.with_target(summary, target)))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _spend(spark, sf_dir)
    strata = splits.with_stratum(base, splits.stratum_edges(base))
    return materialize(splits.stratified_split(strata))


def _alive() -> Column:
    return F.round(btyd.prob_alive(F.col("Frequency"), F.col("Recency"), F.col("T"), PURCHASES), 9)


def _rate_value() -> Column:
    """A plain predictor: purchase rate times horizon times mean repeat-day spend."""
    return F.round(F.col("Purchase_Rate") * SETTINGS.horizon_days * F.col("Monetary"), 6)


def _scored_from(base: DataFrame) -> DataFrame:
    return base.select(
        "customer_id",
        F.col("Next_3M_Spend").alias("actual"),
        _rate_value().alias("predicted"),
        _alive().alias("prob_spend"),
        F.log1p("Next_3M_Spend").alias("log_actual"),
        F.log1p(_rate_value()).alias("log_predicted"),
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_from(_spend(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str) -> training.Prepared:
    """With the estimates of fixed parameters, as SQL has them."""
    return training.prepare(_raw(spark, sf_dir), WIDE, purchases=PURCHASES, values=VALUES)


def _trained(spark: SparkSession, sf_dir: str) -> training.Prepared:
    """With the estimates of parameters fitted to the train customers."""
    return training.prepare(_raw(spark, sf_dir), WIDE)


def _path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- sources, sinks, cleaning ----------------------------------------------------------------


def clean_transactions(spark, sf_dir):
    return cleaning.clean(transactions.untidy_orders_as_transactions(spark, sf_dir))


def cleaning_audit(spark, sf_dir):
    return cleaning.audit(transactions.untidy_orders_as_transactions(spark, sf_dir))


def dedup_transactions(spark, sf_dir):
    rows = cleaning.drop_copies(cleaning.valid_rows(_raw(spark, sf_dir)))
    per_customer = rows.groupBy("customer_id").agg(
        F.count("*").alias("lines"), F.sum("Quantity").alias("items"), features.money(F.sum("TotalAmount")).alias("spend")
    )
    return _round(per_customer, 4, "spend")


def csv_round_trip(spark, sf_dir):
    path = _path(spark, "transactions")
    raw = transactions.untidy_orders_as_transactions(spark, sf_dir)
    # lines of one invoice in order, so that the file position means what the line number meant
    ordered = raw.repartition("Invoice").sortWithinPartitions("Invoice", "line_no", "Quantity", "Price")
    tables.write_table(ordered.select(*transactions.TRANSACTION_COLS), path, "csv")
    rows = cleaning.clean(transactions.read_transactions_csv(spark, path))
    per_day = rows.groupBy(F.date_format("InvoiceDate", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("lines"), F.sum("Quantity").alias("items"), F.sum("TotalAmount").alias("spend")
    )
    return _round(per_day, 4, "spend")


def csv_published_layout(spark, sf_dir):
    """Eight columns in another order, dates as ``M/d/yyyy H:mm``."""
    path = _path(spark, "transactions")
    raw = transactions.untidy_orders_as_transactions(spark, sf_dir)
    ordered = raw.repartition("Invoice").sortWithinPartitions("Invoice", "line_no", "Quantity", "Price")
    given = ordered.select(
        F.lit("United Kingdom").alias("Country"), "Customer ID", "Price",
        F.date_format("InvoiceDate", "M/d/yyyy H:mm").alias("InvoiceDate"), "Quantity",
        F.concat(F.lit("Item, "), "StockCode").alias("Description"), "StockCode", "Invoice",
    )
    tables.write_table(given, path, "csv")
    rows = cleaning.clean(transactions.read_transactions_csv(spark, path, "M/d/yyyy H:mm"))
    per_day = rows.groupBy(F.date_format("InvoiceDate", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("lines"), F.sum("Quantity").alias("items"), F.sum("TotalAmount").alias("spend")
    )
    return _round(per_day, 4, "spend")


def parquet_round_trip(spark, sf_dir):
    path = _path(spark, "clean")
    rows, _ = _clean(spark, sf_dir)
    tables.write_transactions(rows, path)
    per_month = spark.read.parquet(path).groupBy(F.date_format("month", "yyyy-MM-dd").alias("month")).agg(
        F.count("*").alias("lines"), F.sum("Quantity").alias("items"), F.sum("TotalAmount").alias("spend")
    )
    return _round(per_month, 4, "spend")


def segment_metrics_round_trip(spark, sf_dir):
    path = _path(spark, "segments")
    tables.write_segment_metrics(segment_metrics(spark, sf_dir), path)
    return tables.read_segment_metrics(spark, path)


def scored_round_trip(spark, sf_dir):
    path = _path(spark, "scored")
    tables.write_scored(score_band(spark, sf_dir), path)
    return spark.read.parquet(path).select("customer_id", "CLV_Predicted_90d", "CLV_Low", "CLV_High", "Segment")


def scoring_input_csv(spark, sf_dir):
    path = _path(spark, "scoring")
    given = _spend(spark, sf_dir).select("customer_id", "Recency", "Frequency", F.lit("x").alias("note"))
    tables.write_table(given, path, "csv")
    read = scoring.fill_defaults(transactions.read_scoring_csv(spark, path), {"Monetary": 300.0, "Prob_Alive": 0.65})
    return read.select("customer_id", "note", *FEATURE_COLS)


def scoring_input_rejected(spark, sf_dir):
    """Every fault of a scoring file with short and long lines and with text in number columns."""
    path = _path(spark, "dirty_scoring")
    given = _spend(spark, sf_dir)
    kind = F.pmod(F.col("customer_id").cast("bigint"), F.lit(10))
    recency, frequency = (F.col(c).cast("bigint").cast("string") for c in ("Recency", "Frequency"))
    line = F.concat_ws(
        ",", "customer_id",
        F.when(kind == 2, F.concat(recency, F.lit(" days"))).when(kind == 3, F.lit("?")).otherwise(recency),
        F.when(kind == 3, F.lit("n/a")).when(kind == 5, F.lit("")).otherwise(frequency),
        F.when(kind != 1, F.lit("x")), F.when(kind == 4, F.lit("more")),
    )
    # One column under the header of four, so that lines come out as they are.
    given.select(line.alias("customer_id,Recency,Frequency,note")).write.option("header", True).option("sep", ";").csv(path)
    good, rejected = transactions.split_scoring_csv(spark, path)
    faults = rejected.select("reason", "column", "value").groupBy("reason", "column", "value").agg(F.count("*").alias("n"))
    whole = good.agg(
        F.lit("accepted").alias("reason"), F.lit(None).cast("string").alias("column"),
        F.count("Frequency").cast("string").alias("value"), F.count("*").alias("n"),
    )
    return faults.union(whole)


def sketched_products(spark, sf_dir):
    """Distinct products per customer over two windows: exact counts, and whether merged sketches are within three errors."""
    rows, _ = _clean(spark, sf_dir)
    written = materialize(sketches.monthly_sketches(rows))
    out = None
    for name, first in (("ever", None), ("late", "1997-01-01")):
        lines = rows if first is None else rows.filter(F.col("InvoiceDate") >= F.lit(first).cast("timestamp_ntz"))
        exact = lines.groupBy("customer_id").agg(F.count_distinct("StockCode").alias("exact"))
        both = exact.join(sketches.distinct_estimates(written, first), "customer_id", "full")
        bound = F.ceil(F.col("exact") * F.lit(3 * sketches.standard_error()))
        near = F.coalesce(F.abs(F.col("estimate") - F.col("exact")) <= bound, F.lit(False))
        own = both.select("customer_id", F.lit(name).alias("window"), F.col("exact").alias("products"), near.alias("near"))
        out = own if out is None else out.union(own)
    return out


def bundle_round_trip(spark, sf_dir):
    path = _path(spark, "bundle")
    base = _split(spark, sf_dir)
    model = MeanRegressor(labelCol="log_target").fit(base.filter("split = 'train'"))
    tables.save_bundle(spark, model, path, {"Recency": 1.0})
    loaded, _ = tables.load_bundle(spark, path)
    return _round(loaded.transform(base.filter("split = 'test'")), 6, "prediction").select("customer_id", "prediction")


def run_log(spark, sf_dir):
    path = _path(spark, "runs")
    row = _board(spark, sf_dir).collect()
    runs = [(r["Model"], {"kind": "check"}, {"dollar_mae": r["Dollar_MAE"], "wape": r["WAPE"]}) for r in row]
    tables.log_runs(spark, path, "checks", runs)
    logged = tables.read_runs(spark, path)
    return logged.select(
        F.col("run").alias("model"),
        F.col("params")["kind"].alias("kind"),
        F.round(F.col("metrics")["dollar_mae"], 4).alias("dollar_mae"),
        F.round(F.col("metrics")["wape"], 6).alias("wape"),
    )


def champion_registry(spark, sf_dir):
    path = _path(spark, "registry")
    best = leaderboard.champion(_board(spark, sf_dir), WIDE.min_dollar_r2).first()
    for _ in range(2):
        tables.register_champion(
            spark, path, "champion", best["Model"], {"n_features": len(FEATURE_COLS)}, {"dollar_mae": best["Dollar_MAE"]}
        )
    return tables.read_registry(spark, path).select(
        "name",
        F.col("version").cast("bigint").alias("version"),
        "champion",
        F.round(F.col("metrics")["dollar_mae"], 4).alias("dollar_mae"),
    )


# -- split and history features --------------------------------------------------------------


def date_range(spark, sf_dir):
    return features.date_range(cleaning.valid_rows(_raw(spark, sf_dir)))


def temporal_split(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    side = F.when(F.col("InvoiceDate") < split_ts, "history").otherwise("outcome")
    return rows.groupBy(side.alias("side")).agg(
        F.count("*").alias("lines"), F.min("InvoiceDate").alias("first_ts"), F.max("InvoiceDate").alias("last_ts")
    )


def history_customers(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    return features.customers(features.history(rows, split_ts))


def rfm_summary(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    summary = features.rfm(features.days(features.history(rows, split_ts)), split_ts)
    return summary.select("customer_id", "Recency", "Frequency", "Monetary", "T")


def rfm_with_target(spark, sf_dir):
    out = _spend(spark, sf_dir).select(
        "customer_id", "Recency", "Frequency", "Monetary", "T", "Next_3M_Spend", "log_target"
    )
    return _round(out, 9, "log_target")


def interpurchase_std(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    summary = features.rfm(features.days(features.history(rows, split_ts)), split_ts)
    return _round(summary.select("customer_id", "Interpurchase_Std"), 6, "Interpurchase_Std")


def interpurchase_std_events(spark, sf_dir):
    valid = cleaning.valid_rows(transactions.events_as_transactions(spark, sf_dir))
    split_ts = features.split_point(valid, EVENT_HORIZON)
    summary = features.rfm(features.days(features.history(cleaning.drop_copies(valid), split_ts)), split_ts)
    return _round(
        summary.select("customer_id", "Interpurchase_Std", "Visit_Diversity", "T", "Recency"), 6, "Interpurchase_Std"
    )


def unique_products(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    return features.products(features.history(rows, split_ts))


def visit_diversity(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    return features.rfm(features.days(features.history(rows, split_ts)), split_ts).select(
        "customer_id", "Visit_Diversity"
    )


def avg_basket(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    out = features.baskets(features.history(rows, split_ts)).select("customer_id", "Avg_Basket_Size")
    return _round(out, 6, "Avg_Basket_Size")


def max_single_order(spark, sf_dir):
    rows, split_ts = _clean(spark, sf_dir)
    return features.baskets(features.history(rows, split_ts)).select("customer_id", "Max_Single_Order")


def return_rate(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    split_ts = features.split_point(cleaning.valid_rows(raw))
    return _round(features.return_rates(raw, split_ts), 9, "Return_Rate")


def return_rate_all(spark, sf_dir):
    return _round(features.return_rates(_raw(spark, sf_dir)), 9, "Return_Rate")


def behavior_features(spark, sf_dir):
    out = training.marked_base(_raw(spark, sf_dir))
    return _round(
        out,
        6,
        "Interpurchase_Std",
        "Avg_Basket_Size",
        "Return_Rate",
        "Purchase_Rate",
        "Revenue_Per_Day",
        "log_target",
    )


# -- strata, splits, percentiles, caps -------------------------------------------------------


def spend_strata(spark, sf_dir):
    base = _spend(spark, sf_dir)
    return _big(splits.with_stratum(base, splits.stratum_edges(base)).select("customer_id", "stratum"), "stratum")


def spend_strata_fallback(spark, sf_dir):
    return _big(splits.with_fallback_stratum(_spend(spark, sf_dir)).select("customer_id", "stratum"), "stratum")


def stratified_split(spark, sf_dir):
    return _big(_split(spark, sf_dir).select("customer_id", "stratum", "split"), "stratum")


def split_diagnostics(spark, sf_dir):
    base = _split(spark, sf_dir)
    edge = quantiles.quantile_values(base, ["Next_3M_Spend"], [0.8])["Next_3M_Spend"][0]
    out = splits.split_diagnostics(base, edge)
    return _round(_round(out, 9, "whale_share", "zero_share"), 4, "mean_spend", "max_spend")


def target_summary(spark, sf_dir):
    out = splits.target_summary(_split(spark, sf_dir))
    return _round(_round(out, 9, "mean_log", "max_log"), 4, "mean_dollars", "max_dollars")


def monetary_percentile_train(spark, sf_dir):
    out = ranking.train_percentile(_split(spark, sf_dir)).filter("split = 'train'")
    return _round(out.select("customer_id", "Monetary_Percentile"), 9, "Monetary_Percentile")


def monetary_percentile_test(spark, sf_dir):
    out = ranking.train_percentile(_split(spark, sf_dir)).filter("split = 'test'")
    return _round(out.select("customer_id", "Monetary_Percentile"), 9, "Monetary_Percentile")


def _base(spark, sf_dir):
    return training.customer_base(_raw(spark, sf_dir))


def outlier_caps(spark, sf_dir):
    return _round(caps.outlier_caps(_base(spark, sf_dir)), 4, "cap")


def capped_features(spark, sf_dir):
    base = _base(spark, sf_dir)
    out = caps.apply_caps(base, caps.fit_caps(base)).select("customer_id", *CAPPED_COLS)
    return _round(out, 6, "Monetary", "Avg_Basket_Size", "Max_Single_Order")


# -- probabilistic features ------------------------------------------------------------------


def prob_alive_fixed(spark, sf_dir):
    return _spend(spark, sf_dir).select("customer_id", _alive().alias("Prob_Alive"))


def _values(base: DataFrame) -> btyd.ValueParams:
    mean = btyd.repeat_buyers(base).agg(F.avg("Monetary")).first()[0]
    return replace(VALUES, global_mean=mean)


def gg_expected_value_fixed(spark, sf_dir):
    base = _spend(spark, sf_dir)
    value = btyd.expected_value(F.col("Frequency"), F.col("Monetary"), _values(base))
    return base.select("customer_id", F.round(value, 4).alias("Prob_Pred_Val"))


def bgnbd_loglik_fixed(spark, sf_dir):
    k = [F.lit(v) for v in (PURCHASES.r, PURCHASES.alpha, PURCHASES.a, PURCHASES.b)]
    loglik = btyd.purchase_loglik(F.col("Frequency"), F.col("Recency"), F.col("T"), *k)
    return _spend(spark, sf_dir).select("customer_id", F.round(loglik, 6).alias("loglik"))


def gg_loglik_fixed(spark, sf_dir):
    k = [F.lit(v) for v in (VALUES.p, VALUES.q, VALUES.v)]
    loglik = btyd.value_loglik(F.col("Frequency"), F.col("Monetary"), *k)
    return btyd.repeat_buyers(_spend(spark, sf_dir)).select("customer_id", F.round(loglik, 6).alias("loglik"))


def expected_purchases(spark, sf_dir):
    expected = btyd.expected_purchases(
        F.col("Frequency"), F.col("Recency"), F.col("T"), PURCHASES, SETTINGS.horizon_days
    )
    return _spend(spark, sf_dir).select("customer_id", F.round(expected, 8).alias("Prob_Pred_Txn"))


def btyd_baseline(spark, sf_dir):
    base = _spend(spark, sf_dir)
    estimated = btyd.add_estimates(base, PURCHASES, _values(base))
    return estimated.select("customer_id", F.round(btyd.baseline_log_prediction(), 8).alias("prediction"))


def naive_mean_baseline(spark, sf_dir):
    base = _split(spark, sf_dir)
    model = MeanRegressor(labelCol="log_target").fit(base.filter("split = 'train'"))
    return _round(model.transform(base).select("customer_id", "prediction"), 8, "prediction")


def ensemble_of_baselines(spark, sf_dir):
    """The ensemble model itself, over the two baselines that SQL can express."""
    base = _split(spark, sf_dir)
    mean = MeanRegressor(labelCol="log_target").fit(base.filter("split = 'train'"))
    estimated = btyd.add_estimates(base, PURCHASES, _values(base))
    ensemble = EnsembleModel([mean, PurchaseValueModel()], [0.7, 0.3], ["mean", "btyd"])
    return _round(ensemble.transform(estimated).select("customer_id", "prediction"), 7, "prediction")


def bgnbd_fit(spark, sf_dir):
    k = btyd.fit_purchases(_split(spark, sf_dir).filter("split = 'train'"))
    row = [(k.r, k.alpha, k.a, k.b, k.penalty, k.objective)]
    return spark.createDataFrame(row, "r double, alpha double, a double, b double, penalty double, objective double")


def gg_fit(spark, sf_dir):
    k = btyd.fit_values(_split(spark, sf_dir).filter("split = 'train'"))
    row = [(k.p, k.q, k.v, k.global_mean, k.penalty, k.objective)]
    return spark.createDataFrame(
        row, "p double, q double, v double, global_mean double, penalty double, objective double"
    )


# -- evaluation ------------------------------------------------------------------------------


def metric_bundle(spark, sf_dir):
    out = metrics.metric_bundle(_scored(spark, sf_dir), "actual", "predicted")
    return _round(out, 4, "RMSE", "MAE", "R2", "WAPE", "SMAPE")


def metric_bundle_log(spark, sf_dir):
    out = metrics.metric_bundle(_scored(spark, sf_dir), "log_actual", "log_predicted")
    return _round(out, 6, "RMSE", "MAE", "R2", "WAPE", "SMAPE")


def segment_metrics(spark, sf_dir):
    base = _split(spark, sf_dir)
    thresholds = evaluation.segment_thresholds(base.filter("split = 'train'"))
    out = evaluation.segment_metrics(_scored_from(base.filter("split = 'test'")), thresholds)
    return _round(out, 4, "RMSE", "MAE", "R2", "WAPE%", "SMAPE%", "Avg_Actual", "Avg_Pred")


def segment_thresholds(spark, sf_dir):
    low, high = evaluation.segment_thresholds(_split(spark, sf_dir).filter("split = 'train'"))
    return _round(spark.createDataFrame([(low, high)], "p20 double, p80 double"), 4, "p20", "p80")


def segment_counts(spark, sf_dir):
    return evaluation.segment_counts(score_band(spark, sf_dir))


def segment_totals(spark, sf_dir):
    return _round(evaluation.segment_totals(score_band(spark, sf_dir)), 4, "mean_clv", "total_clv")


def residuals(spark, sf_dir):
    return _round(evaluation.residuals(_scored(spark, sf_dir)), 8, "log_predicted", "residual")


def residual_mean(spark, sf_dir):
    out = evaluation.residuals(_scored(spark, sf_dir)).agg(F.avg("residual").alias("mean_residual"))
    return _round(out, 8, "mean_residual")


def predicted_spenders(spark, sf_dir):
    return evaluation.predicted_spenders(_scored(spark, sf_dir)).select("customer_id", "predicted")


def spender_count(spark, sf_dir):
    return evaluation.spender_count(_scored(spark, sf_dir), threshold=0.9)


def actual_vs_predicted(spark, sf_dir):
    out = evaluation.actual_vs_predicted(_scored(spark, sf_dir))
    return _round(out, 8, "log_actual", "log_predicted")


def prediction_preview(spark, sf_dir):
    amount = _rate_value()
    base = _spend(spark, sf_dir)
    filled = scoring.fill_defaults(base, {"Prob_Alive": 0.65})
    return scoring.preview(filled.withColumns(scoring.band_columns(amount, WIDE)))


def gain_curve(spark, sf_dir):
    out = ranking.gain_curve(_scored(spark, sf_dir))
    out = _big(out, "position", "n").select("customer_id", "position", "cum_actual", "cum_population", "n")
    return _round(out, 9, "cum_actual", "cum_population")


def lift_points(spark, sf_dir):
    return _round(ranking.lift_points(ranking.gain_curve(_scored(spark, sf_dir))), 9, "lift")


def gain_position(spark, sf_dir):
    base = _split(spark, sf_dir)
    test, train = (_scored_from(base.filter(F.col("split") == s)) for s in ("test", "train"))
    return _round(ranking.gain_positions(test, train), 9, "gain_position").select("customer_id", "gain_position")


def calibration_curve(spark, sf_dir):
    out = _big(evaluation.calibration_curve(_scored(spark, sf_dir)), "bin")
    return _round(out, 8, "mean_predicted", "observed_rate")


def isotonic_blocks(spark, sf_dir):
    spends = (F.col("actual") > 0).cast("double")
    found = isotonic.blocks(_scored(spark, sf_dir).withColumn("spends", spends), "prob_spend", "spends")
    return found.select("low", "high", F.col("weight").cast("bigint").alias("n"), F.round("mean", 9).alias("rate"))


def residual_histogram(spark, sf_dir):
    rounded = _round(evaluation.residuals(_scored(spark, sf_dir)), 9, "residual")
    return _round(_big(evaluation.histogram(rounded, "residual", 50), "bin"), 5, "left_edge", "density")


def probability_histogram(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("spends", (F.col("actual") > 0).cast("bigint"))
    out = _big(evaluation.histogram(rows, "prob_spend", 40, by="spends"), "bin")
    return _round(out, 5, "left_edge", "density")


def representative_customers(spark, sf_dir):
    return evaluation.representatives(_scored(spark, sf_dir))


# -- scoring ---------------------------------------------------------------------------------


def hurdle_combine(spark, sf_dir):
    amount = scoring.hurdle_dollars(F.col("prob_spend"), F.log1p("predicted"), WIDE)
    return _scored(spark, sf_dir).select("customer_id", F.round(F.log1p(amount), 8).alias("prediction"))


def fixed_segments(spark, sf_dir):
    return _scored(spark, sf_dir).select("customer_id", scoring.segment_of(F.col("predicted"), WIDE).alias("Segment"))


def score_band(spark, sf_dir):
    amount = scoring.dollars(F.col("log_predicted"), WIDE.log_pred_max)
    out = _scored(spark, sf_dir).withColumns(scoring.band_columns(F.round(amount, 6), WIDE))
    return out.select("customer_id", "CLV_Predicted_90d", "CLV_Low", "CLV_High", "Segment")


def default_fill(spark, sf_dir):
    """Medians of the train customers fill the amounts of customers without a repeat day."""
    base = _split(spark, sf_dir)
    medians = quantiles.quantile_values(base.filter("split = 'train'"), ["Recency", "Monetary"], [0.5])
    given = base.select(
        "customer_id",
        F.when(F.col("Frequency") > 0, F.col("Monetary")).alias("Monetary"),
        F.when(F.col("Frequency") > 0, F.col("Recency")).alias("Recency"),
    )
    out = scoring.fill_defaults(given, {c: round(q[0], 4) for c, q in medians.items()})
    return out.select("customer_id", "Monetary", "Recency", "Prob_Alive")


# -- model selection over plain predictors ---------------------------------------------------


def class_balance(spark, sf_dir):
    out = evaluation.class_balance(_split(spark, sf_dir).filter("split = 'train'"))
    return _round(out, 8, "positive_weight")


def stratified_folds(spark, sf_dir):
    train = _split(spark, sf_dir).filter("split = 'train'")
    return _big(selection.with_folds(train, 5).select("customer_id", "fold"), "fold")


def cv_summary(spark, sf_dir):
    train = materialize(selection.with_folds(_split(spark, sf_dir).filter("split = 'train'"), 5))
    mean, deviation = selection.cross_validate(MeanRegressor(labelCol="log_target"), train, 5)[0]
    return _round(
        spark.createDataFrame([(mean, deviation)], "cv_mae_mean double, cv_mae_std double"),
        7,
        "cv_mae_mean",
        "cv_mae_std",
    )


def _board(spark: SparkSession, sf_dir: str, **more: Column) -> DataFrame:
    """A leaderboard of plain predictors on all customers. Nothing is fitted, so CV is the log MAE."""
    base = _spend(spark, sf_dir)
    mean = base.agg(F.avg("log_target").alias("m")).scalar()
    predictors = {
        "Naive Baseline (Mean)": F.expm1(mean),
        "BTYD Statistical Baseline": _rate_value() * _alive(),
        "Rate x Value": _rate_value(),
        "Last Value": F.col("Monetary"),
        "Half Value": F.col("Monetary") / 2,
        "Revenue Rate": F.col("Revenue_Per_Day") * SETTINGS.horizon_days,
        **more,
    }
    named = F.array(*[F.struct(F.lit(n).alias("Model"), F.round(c, 6).alias("p")) for n, c in predictors.items()])
    long = base.select(F.col("Next_3M_Spend").alias("actual"), F.explode(named).alias("x")).select(
        "actual",
        F.log1p("actual").alias("log_actual"),
        F.col("x.Model").alias("Model"),
        F.col("x.p").alias("predicted"),
        F.log1p("x.p").alias("log_predicted"),
    )
    board = metrics.dual_scale_metrics(long, ["Model"])
    return materialize(
        board.withColumns({"CV_MAE_Mean": F.col("Log_MAE"), "CV_MAE_Std": F.lit(0.0)})
    )


_BOARD = ["Log_MAE", "Log_RMSE", "Log_R2", "Dollar_RMSE", "Dollar_MAE", "Dollar_R2", "SMAPE", "WAPE", "CV_MAE_Mean"]


def leaderboard_table(spark, sf_dir):
    board = _board(spark, sf_dir)
    members = leaderboard.ensemble_members(board, WIDE.min_dollar_r2)
    ensemble = members.agg(F.sum(F.col("weight") * F.col("CV_MAE_Mean")).alias("CV_MAE_Mean")).select(
        F.lit(leaderboard.ENSEMBLE).alias("Model"), "CV_MAE_Mean"
    )
    both = board.unionByName(ensemble, allowMissingColumns=True)
    return _round(leaderboard.with_note(leaderboard.ordered(both)), 4, *_BOARD).drop("CV_MAE_Std")


def leaderboard_select(spark, sf_dir):
    board = _board(spark, sf_dir)
    best = leaderboard.champion(board, WIDE.min_dollar_r2).select(
        "Model", F.lit("champion").alias("role"), F.lit(1.0).alias("weight")
    )
    members = leaderboard.ensemble_members(board, WIDE.min_dollar_r2).select(
        "Model", F.lit("member").alias("role"), "weight"
    )
    return _round(best.unionByName(members), 8, "weight")


def leaderboard_gate(spark, sf_dir):
    """Champion and members under the published gate. Four predictors know a share of the outcome; few others pass."""
    actual, rate = F.col("Next_3M_Spend"), _rate_value()
    share = {f"Knows {k} Tenths": (actual * k + rate * (10 - k)) / 10 for k in (2, 5, 7, 9)}
    board = _board(spark, sf_dir, **share)
    best = leaderboard.champion(board).select("Model", F.lit(1).alias("champion"))
    members = leaderboard.ensemble_members(board).select("Model", F.round("weight", 8).alias("weight"))
    out = board.select("Model", F.round("Dollar_R2", 6).alias("Dollar_R2"))
    passing = leaderboard.eligible(board).select("Model", F.lit(1).alias("eligible"))
    for part in (passing, best, members):
        out = out.join(part, "Model", "left")
    return out.select("Model", "Dollar_R2", *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in ("eligible", "champion")], F.coalesce("weight", F.lit(0.0)).alias("weight"))


def leaderboard_flags(spark, sf_dir):
    flagged = leaderboard.with_best_flags(_board(spark, sf_dir))
    flags = [c for c in flagged.columns if c.startswith("best_")]
    return flagged.select("Model", *[F.col(c).cast("bigint").alias(c) for c in flags])


def weighted_log_mean(spark, sf_dir):
    """The ensemble formula over two plain predictors: weights by inverse error, mean of logs."""
    rows = _scored(spark, sf_dir)
    first, second = F.col("log_predicted"), F.log1p(F.round(F.col("predicted") * F.col("prob_spend"), 6))
    mae = rows.agg(
        F.struct(
            F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("a"),
            F.avg(F.abs(F.col("actual") - F.round(F.col("predicted") * F.col("prob_spend"), 6))).alias("b"),
        ).alias("m")
    ).scalar()
    wa, wb = 1 / (mae["a"] + F.lit(1e-8)), 1 / (mae["b"] + F.lit(1e-8))
    return rows.select("customer_id", F.round(weighted_mean([first, second], [wa, wb]), 7).alias("prediction"))


# -- trained models --------------------------------------------------------------------------


def feature_table(spark, sf_dir):
    out = _prepared(spark, sf_dir).table.select("customer_id", "split", *FEATURE_COLS, "Next_3M_Spend")
    return _round(
        _round(out, 4, "Prob_Pred_Val"),
        6,
        "Monetary",
        "Max_Single_Order",
        "Prob_Pred_Txn",
        "Prob_Alive",
        "Interpurchase_Std",
        "Purchase_Rate",
        "Revenue_Per_Day",
        "Avg_Basket_Size",
        "Return_Rate",
        "Monetary_Percentile",
    )


def _candidates(n: int, *names: str) -> dict:
    models = zoo.build(n, log_max=WIDE.log_pred_max)
    return {name: models[name] for name in names}


def _hurdle(data: training.Prepared):
    train = data.train
    name = "Two-Stage (CatBoost)"
    return _candidates(train.count(), name)[name].fit(train)


def train_leaderboard(spark, sf_dir):
    data = _trained(spark, sf_dir)
    return selection.benchmark(data.train, data.test, settings=WIDE, parallelism=8).board


def hurdle_predict(spark, sf_dir):
    data = _trained(spark, sf_dir)
    return _hurdle(data).transform(data.test).select("customer_id", "prob_spend", "prediction")


def isotonic_calibration(spark, sf_dir):
    data = _trained(spark, sf_dir)
    scored = training.scored_frame(_hurdle(data), data.test, WIDE)
    return evaluation.calibration_curve(scored)


def grid_tuning(spark, sf_dir):
    data = _trained(spark, sf_dir)
    train = data.train
    name = "Ridge (L2)"
    model = _candidates(train.count(), name)[name]
    _, _, scores = selection.tune(name, model, train, settings=WIDE, parallelism=8)
    rows = [(", ".join(f"{k}={v:.6g}" for k, v in p.items()), mae) for p, mae in scores]
    return spark.createDataFrame(rows, "params string, cv_mae double")


def ensemble_predict(spark, sf_dir):
    """The best three of the models without boosting, all of published size, weighted by inverse error."""
    data = _trained(spark, sf_dir)
    models = zoo.build(data.train.count(), log_max=WIDE.log_pred_max)
    names = ("Linear Regression", "Ridge (L2)", "ElasticNet", "Random Forest", "Two-Stage (Random Forest)")
    found = selection.benchmark(data.train, data.test, {n: models[n] for n in names}, settings=WIDE, parallelism=8)
    return found.models[leaderboard.ENSEMBLE].transform(data.test).select("customer_id", "prediction")


def feature_importance(spark, sf_dir):
    return evaluation.top_per_stage(explain.feature_importance(spark, _hurdle(_trained(spark, sf_dir))))


def shapley_sampled(spark, sf_dir):
    data = _trained(spark, sf_dir)
    rows = explain.background_rows(data.train)
    return explain.mean_abs(explain.shapley_values(_hurdle(data), data.test, rows))


def _explained(spark, sf_dir):
    data = _trained(spark, sf_dir)
    model = _hurdle(data)
    chosen = evaluation.representatives(training.scored_frame(model, data.test, WIDE))
    return data, model, materialize(data.test.join(F.broadcast(chosen.select("customer_id", "profile")), "customer_id"))


def local_surrogate(spark, sf_dir):
    data, model, few = _explained(spark, sf_dir)
    return explain.local_surrogate(model, few, explain.train_moments(data.train))


def attribution_agreement(spark, sf_dir):
    data, model, few = _explained(spark, sf_dir)
    middle = few.filter("profile = 'mid'")
    attributions = materialize(explain.shapley_values(model, middle, explain.background_rows(data.train)))
    weights = materialize(explain.local_surrogate(model, middle, explain.train_moments(data.train)))
    return explain.agreement(attributions, weights)


def monotonicity_audit(spark, sf_dir):
    data = _trained(spark, sf_dir)
    return explain.monotonicity_audit(_hurdle(data), data.test)


def batch_score(spark, sf_dir):
    data = _trained(spark, sf_dir)
    given = data.test.select("customer_id", "Recency", "Frequency", "Monetary")
    return scoring.score(_hurdle(data), given, data.defaults, WIDE)


def single_score(spark, sf_dir):
    """The best customer by spend, scored alone and placed in the scored base."""
    data = _trained(spark, sf_dir)
    model = _hurdle(data)
    one = data.test.orderBy(F.desc("Next_3M_Spend"), "customer_id").limit(1).select("customer_id", *FEATURE_COLS)
    scored = scoring.score(model, one, data.defaults, WIDE).withColumnRenamed("CLV_Predicted_90d", "predicted")
    base = scoring.score(model, data.test.select("customer_id", *FEATURE_COLS), data.defaults, WIDE)
    return ranking.gain_positions(scored, base.withColumnRenamed("CLV_Predicted_90d", "predicted"))


def evaluation_report(spark, sf_dir):
    data = _trained(spark, sf_dir)
    parts = training.report(_hurdle(data), data)
    counted = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, t in parts.items()]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


_QUERIES: list[Query] = [
    clean_transactions,
    cleaning_audit,
    dedup_transactions,
    csv_round_trip,
    csv_published_layout,
    scoring_input_rejected,
    sketched_products,
    parquet_round_trip,
    segment_metrics_round_trip,
    scored_round_trip,
    scoring_input_csv,
    bundle_round_trip,
    run_log,
    champion_registry,
    date_range,
    temporal_split,
    history_customers,
    rfm_summary,
    rfm_with_target,
    interpurchase_std,
    interpurchase_std_events,
    unique_products,
    visit_diversity,
    avg_basket,
    max_single_order,
    return_rate,
    return_rate_all,
    behavior_features,
    spend_strata,
    spend_strata_fallback,
    stratified_split,
    split_diagnostics,
    target_summary,
    monetary_percentile_train,
    monetary_percentile_test,
    outlier_caps,
    capped_features,
    prob_alive_fixed,
    gg_expected_value_fixed,
    bgnbd_loglik_fixed,
    gg_loglik_fixed,
    expected_purchases,
    btyd_baseline,
    naive_mean_baseline,
    ensemble_of_baselines,
    bgnbd_fit,
    gg_fit,
    metric_bundle,
    metric_bundle_log,
    segment_metrics,
    segment_thresholds,
    segment_counts,
    segment_totals,
    residuals,
    residual_mean,
    predicted_spenders,
    spender_count,
    actual_vs_predicted,
    prediction_preview,
    gain_curve,
    lift_points,
    gain_position,
    calibration_curve,
    isotonic_blocks,
    residual_histogram,
    probability_histogram,
    representative_customers,
    hurdle_combine,
    fixed_segments,
    score_band,
    default_fill,
    class_balance,
    stratified_folds,
    cv_summary,
    leaderboard_table,
    leaderboard_select,
    leaderboard_flags,
    leaderboard_gate,
    weighted_log_mean,
    feature_table,
    train_leaderboard,
    hurdle_predict,
    isotonic_calibration,
    grid_tuning,
    ensemble_predict,
    feature_importance,
    shapley_sampled,
    local_surrogate,
    attribution_agreement,
    monotonicity_audit,
    batch_score,
    single_score,
    evaluation_report,
]


def all_queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}
