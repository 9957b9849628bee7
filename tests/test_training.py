import re
from dataclasses import replace

from pyspark.sql import functions as F

from spendcast.config import FEATURE_COLS, SETTINGS
from spendcast.operators import cleaning, explain, features, scoring
from spendcast.plans import training
from spendcast.session import materialize
from spendcast.sources import tables, transactions

WIDE = replace(SETTINGS, log_pred_max=16.0, min_dollar_r2=-1000.0)


def test_from_raw_rows_to_a_scored_bundle(spark, sf_dir, tmp_path):
    raw = transactions.orders_as_transactions(spark, sf_dir)
    data = training.prepare(raw, WIDE)
    assert data.table.select(*FEATURE_COLS).filter(" or ".join(f"{c} is null" for c in FEATURE_COLS)).isEmpty()
    result, tuned, chosen = training.train_champion(data, ["Ridge (L2)", "ElasticNet"], parallelism=4)
    assert result.champion in ("Ridge (L2)", "ElasticNet") and len(chosen) >= 1
    report = training.report(tuned, data, permutations=1, samples=50)
    out = str(tmp_path / "out")
    assert training.publish(out, data, result, tuned, chosen, report) == 1
    assert training.publish(out, data, result, tuned, chosen, report) == 2
    assert tables.read_runs(spark, f"{out}/runs").count() == 6
    assert tables.read_segment_metrics(spark, f"{out}/segment_metrics").filter("N >= 5").count() >= 1
    model, meta = tables.load_champion(spark, out, "spendcast_champion")
    first, _ = tables.load_champion(spark, out, "spendcast_champion", 1)
    assert type(first) is type(model) is type(tuned)
    assert explain.feature_importance(spark, model).collect() == explain.feature_importance(spark, tuned).collect()
    assert all(r.params for r in tables.read_runs(spark, f"{out}/runs").collect() if r.run != "Weighted Ensemble")
    given = data.test.select("customer_id", "Monetary", F.lit("kept").alias("note"))
    scored = scoring.score(model, given, meta["defaults"], WIDE)
    tables.write_scored(scored, f"{out}/scored")
    assert spark.read.parquet(f"{out}/scored").filter("note = 'kept'").count() == data.test.count()


def test_raw_rows_are_read_once_and_months_are_skipped(spark, sf_dir, monkeypatch):
    """The only job that reads the order tables writes the marked rows; later plans filter its months."""
    written = []
    monkeypatch.setattr(training, "materialize", lambda df, by=(): written.append(df) or materialize(df, by))
    base = training.marked_base(transactions.orders_as_transactions(spark, sf_dir), WIDE)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert len(written) == 1 and plan(written[0]).count("lineitem.parquet") == 1
    later = plan(base)
    assert "lineitem" not in later and "orders.parquet" not in later
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", later)
    assert len(filters) >= 5 and all("month" in f for f in filters)
    files = base.inputFiles()
    assert all("month=" in f for f in files) and len(set(files)) == len({f.rpartition("/")[0] for f in files})


def test_marked_rows_equal_cleaning_and_returns(spark, sf_dir):
    raw = transactions.untidy_orders_as_transactions(spark, sf_dir)
    raw = raw.unionByName(raw.filter("line_no < 3").withColumn("Quantity", F.lit(-1))).unionByName(raw.limit(50))
    marked, clean = cleaning.mark(raw), cleaning.clean(raw)
    columns = ["Invoice", "StockCode", "customer_id", "InvoiceDate", "Quantity", "TotalAmount"]
    ours, theirs = (sorted(map(tuple, df.select(*columns).collect())) for df in (marked.filter("valid"), clean))
    assert ours == theirs
    split_ts = training.literal_split(clean, 400)
    for scope in ("history", "all"):
        one, two = (
            sorted(df.collect()) for df in (features.marked_behaviour(marked, split_ts, scope), features.behaviour(clean, split_ts, raw, scope))
        )
        assert one == two and any(0 < r["Return_Rate"] < 1 for r in one)


def test_test_customers_never_change_train_features(spark, sf_dir):
    raw = transactions.orders_as_transactions(spark, sf_dir)
    base = training.customer_base(raw, WIDE)
    changed = base.withColumn("Monetary", F.when(F.col("split") == "test", F.col("Monetary") * 9).otherwise(F.col("Monetary")))
    from spendcast.operators import caps, ranking

    assert caps.fit_caps(base) == caps.fit_caps(changed)
    first, second = (
        sorted(ranking.train_percentile(b).filter("split = 'train'").select("customer_id", "Monetary_Percentile").collect())
        for b in (base, changed)
    )
    assert first == second


def test_intermediate_tables_can_be_deleted(spark, tmp_path):
    from spendcast.session import clear_scratch, materialize

    kept = materialize(spark.range(5)).inputFiles()
    assert clear_scratch(spark) > 0 and clear_scratch(spark) == 0
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in kept)
