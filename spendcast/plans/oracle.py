"""ANSI SQL for the catalog queries, to be run by an independent engine on the same tables."""

from __future__ import annotations

from spendcast.config import FEATURE_COLS, SETTINGS
from spendcast.plans.catalog import EVENT_HORIZON, PURCHASES, VALUES, WIDE

R, ALPHA, A, B = (f"CAST({v} AS DOUBLE)" for v in (PURCHASES.r, PURCHASES.alpha, PURCHASES.a, PURCHASES.b))
P, Q, V = (f"CAST({v} AS DOUBLE)" for v in (VALUES.p, VALUES.q, VALUES.v))


def _transactions(customer: str, price: str, quantity: str) -> str:
    return f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS Invoice, CAST(l_partkey AS VARCHAR) AS StockCode,
           CAST({quantity} AS INTEGER) AS Quantity, o_orderdate AS InvoiceDate,
           CAST({price} AS DOUBLE) AS Price, {customer} AS raw_id, l_linenumber AS line_no
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


_SIGNED = "CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END"
_TIDY = _transactions("CAST(o_custkey AS VARCHAR) || '.0'", "l_extendedprice / l_quantity", _SIGNED)
_UNTIDY = _transactions(
    """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
            ELSE CAST(o_custkey AS VARCHAR) || '.0' END""",
    """CASE WHEN l_tax = 0 AND l_discount >= CAST(0.1 AS DOUBLE) THEN 0
            ELSE l_extendedprice / l_quantity END""",
    f"""CASE WHEN l_tax >= CAST(0.08 AS DOUBLE) AND l_discount = 0 THEN NULL ELSE {_SIGNED} END""",
)
_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS Invoice, event_type AS StockCode, 1 AS Quantity, ts AS InvoiceDate,
           value AS Price, CAST(user_id AS VARCHAR) AS raw_id, 1 AS line_no
    FROM events"""


def _steps(source: str, horizon: int) -> list[tuple[str, str]]:
    return [
        ("raw", source),
        (
            "raw_ids",
            """SELECT *, CASE WHEN TRY_CAST(raw_id AS DOUBLE) = floor(TRY_CAST(raw_id AS DOUBLE))
                              THEN CAST(CAST(TRY_CAST(raw_id AS DOUBLE) AS BIGINT) AS VARCHAR) END AS customer_id
               FROM raw""",
        ),
        (
            "valid",
            """SELECT *, CAST(Quantity AS DOUBLE) * Price AS TotalAmount FROM raw_ids
               WHERE customer_id IS NOT NULL AND Price > 0 AND Quantity > 0""",
        ),
        (
            "clean",
            """SELECT Invoice, StockCode, Quantity, InvoiceDate, Price, customer_id, TotalAmount
               FROM (SELECT *, row_number() OVER (PARTITION BY Invoice, StockCode, customer_id, InvoiceDate
                                                  ORDER BY line_no, Quantity, Price) AS rn FROM valid)
               WHERE rn = 1""",
        ),
        (
            "span",
            f"""SELECT min(InvoiceDate) AS min_ts, max(InvoiceDate) AS max_ts,
                       max(InvoiceDate) - INTERVAL {horizon} DAY AS split_ts FROM valid""",
        ),
        ("hist", "SELECT clean.* FROM clean, span WHERE InvoiceDate < split_ts"),
        ("later", "SELECT clean.* FROM clean, span WHERE InvoiceDate >= split_ts"),
        (
            "days",
            """SELECT customer_id, CAST(InvoiceDate AS DATE) AS day, round(sum(TotalAmount), 6) AS spend
               FROM hist GROUP BY ALL""",
        ),
        (
            "ranked_days",
            "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY day) AS k FROM days",
        ),
        (
            "line_gaps",
            """SELECT customer_id, floor((epoch_us(InvoiceDate) - epoch_us(lag(InvoiceDate) OVER
                      (PARTITION BY customer_id ORDER BY InvoiceDate))) / 86400000000) AS gap FROM hist""",
        ),
        (
            "gap_std",
            """SELECT customer_id, coalesce(stddev_samp(gap), CAST(0 AS DOUBLE)) AS Interpurchase_Std
               FROM line_gaps GROUP BY customer_id""",
        ),
        (
            "rfm",
            """SELECT customer_id,
                      CAST(date_diff('day', min(day), max(day)) AS DOUBLE) AS Recency,
                      CAST(count(*) - 1 AS DOUBLE) AS Frequency,
                      coalesce(round(avg(spend) FILTER (WHERE k > 1), 6), CAST(0 AS DOUBLE)) AS Monetary,
                      CAST(date_diff('day', min(day), CAST((SELECT split_ts FROM span) AS DATE)) AS DOUBLE) AS T,
                      CAST(count(*) AS DOUBLE) AS Visit_Diversity
               FROM ranked_days GROUP BY customer_id""",
        ),
        ("target", "SELECT customer_id, round(sum(TotalAmount), 6) AS y FROM later GROUP BY customer_id"),
        (
            "spend",
            """SELECT rfm.*, coalesce(y, CAST(0 AS DOUBLE)) AS Next_3M_Spend,
                      ln(1 + coalesce(y, CAST(0 AS DOUBLE))) AS log_target,
                      Frequency / greatest(T, CAST(1 AS DOUBLE)) AS Purchase_Rate,
                      greatest(T - Recency, CAST(0 AS DOUBLE)) AS Days_Since_Purchase,
                      Monetary / greatest(T, CAST(1 AS DOUBLE)) AS Revenue_Per_Day
               FROM rfm LEFT JOIN target USING (customer_id)""",
        ),
        (
            "baskets",
            """SELECT customer_id, avg(items) AS Avg_Basket_Size, max(amount) AS Max_Single_Order
               FROM (SELECT customer_id, Invoice, sum(Quantity) AS items, round(sum(TotalAmount), 6) AS amount
                     FROM hist GROUP BY ALL) GROUP BY customer_id""",
        ),
        (
            "products",
            """SELECT customer_id, CAST(count(DISTINCT StockCode) AS DOUBLE) AS Unique_Products
               FROM hist GROUP BY customer_id""",
        ),
        (
            "returns",
            """SELECT customer_id, CAST(count(DISTINCT CASE WHEN Quantity < 0 THEN Invoice END) AS DOUBLE)
                      / count(DISTINCT Invoice) AS Return_Rate
               FROM raw_ids, span WHERE customer_id IS NOT NULL AND InvoiceDate < split_ts GROUP BY customer_id""",
        ),
        (
            "behaviour",
            """SELECT spend.*, Interpurchase_Std, Avg_Basket_Size, Max_Single_Order, Unique_Products,
                      coalesce(Return_Rate, CAST(0 AS DOUBLE)) AS Return_Rate
               FROM spend JOIN gap_std USING (customer_id) JOIN baskets USING (customer_id)
               JOIN products USING (customer_id) LEFT JOIN returns USING (customer_id)""",
        ),
        (
            "edges",
            """SELECT unnest(list_distinct(quantile_cont(log_target, [CAST(0 AS DOUBLE), CAST(0.2 AS DOUBLE),
                      CAST(0.4 AS DOUBLE), CAST(0.6 AS DOUBLE), CAST(0.8 AS DOUBLE), CAST(1 AS DOUBLE)]))) AS e
               FROM spend""",
        ),
        (
            "inner_edges",
            "SELECT e FROM edges WHERE e > (SELECT min(e) FROM edges) AND e < (SELECT max(e) FROM edges)",
        ),
        (
            "strata",
            """SELECT spend.*, (SELECT count(*) FROM inner_edges WHERE log_target > e) AS stratum FROM spend""",
        ),
        (
            "split",
            """SELECT * EXCLUDE (rn, n), CASE WHEN rn <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split
               FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(customer_id || ':42'), customer_id) AS rn,
                            count(*) OVER (PARTITION BY stratum) AS n FROM strata)""",
        ),
        (
            "percentiles",
            """SELECT *, CASE WHEN split = 'train'
                 THEN (rank() OVER (PARTITION BY split ORDER BY Monetary)
                       + (count(*) OVER (PARTITION BY split, Monetary) - 1) / CAST(2 AS DOUBLE))
                      / count(*) OVER (PARTITION BY split)
                 ELSE CAST((SELECT count(*) FROM split s WHERE s.split = 'train' AND s.Monetary <= split.Monetary) AS DOUBLE)
                      / (SELECT count(*) FROM split s WHERE s.split = 'train') END AS Monetary_Percentile
               FROM split""",
        ),
        (
            "alive",
            f"""SELECT *, CASE WHEN Frequency > 0 THEN
                 1 / (1 + {A} / ({B} + greatest(Frequency, CAST(1 AS DOUBLE)) - 1)
                          * pow(({ALPHA} + T) / ({ALPHA} + Recency), {R} + Frequency))
                 ELSE CAST(1 AS DOUBLE) END AS p_alive FROM split""",
        ),
        (
            "scored",
            """SELECT customer_id, split, Frequency, Monetary, Revenue_Per_Day, Next_3M_Spend AS actual,
                      round(Purchase_Rate * 90 * Monetary, 6) AS predicted, round(p_alive, 9) AS prob_spend,
                      log_target AS log_actual, ln(1 + round(Purchase_Rate * 90 * Monetary, 6)) AS log_predicted
               FROM alive""",
        ),
        (
            "thresholds",
            """SELECT quantile_cont(Next_3M_Spend, CAST(0.2 AS DOUBLE)) AS p20,
                      quantile_cont(Next_3M_Spend, CAST(0.8 AS DOUBLE)) AS p80
               FROM split WHERE split = 'train' AND Next_3M_Spend > 0""",
        ),
        (
            "caps",
            """SELECT quantile_cont(Frequency, CAST(0.99 AS DOUBLE)) AS f, quantile_cont(Monetary, CAST(0.99 AS DOUBLE)) AS m,
                      quantile_cont(Avg_Basket_Size, CAST(0.99 AS DOUBLE)) AS b,
                      quantile_cont(Max_Single_Order, CAST(0.99 AS DOUBLE)) AS o
               FROM split JOIN baskets USING (customer_id) WHERE split = 'train'""",
        ),
        (
            "bands",
            f"""SELECT customer_id, round_even(amount, 2) AS CLV_Predicted_90d,
                       round_even(greatest(amount * (1 - CAST({WIDE.band} AS DOUBLE)), CAST(0 AS DOUBLE)), 2) AS CLV_Low,
                       round_even(amount * (1 + CAST({WIDE.band} AS DOUBLE)), 2) AS CLV_High,
                       {_segment('amount')} AS Segment
                FROM (SELECT customer_id, round(exp(least(greatest(log_predicted, CAST(0 AS DOUBLE)),
                             CAST({WIDE.log_pred_max} AS DOUBLE))) - 1, 6) AS amount FROM scored)""",
        ),
        (
            "long",
            """SELECT actual, ln(1 + actual) AS log_actual, Model, round(p, 6) AS predicted, ln(1 + round(p, 6)) AS log_predicted
               FROM (SELECT actual, unnest([
                   {'Model': 'Naive Baseline (Mean)', 'p': exp((SELECT avg(log_actual) FROM scored)) - 1},
                   {'Model': 'BTYD Statistical Baseline', 'p': predicted * prob_spend},
                   {'Model': 'Rate x Value', 'p': predicted},
                   {'Model': 'Last Value', 'p': Monetary},
                   {'Model': 'Half Value', 'p': Monetary / 2},
                   {'Model': 'Revenue Rate', 'p': Revenue_Per_Day * 90}], recursive := true) FROM scored)""",
        ),
        (
            "board",
            f"""SELECT Model, {_metrics('log_actual', 'log_predicted', ('MAE', 'RMSE', 'R2'), 'Log_')},
                       {_metrics('actual', 'predicted', ('RMSE', 'MAE', 'R2'), 'Dollar_')},
                       {_metrics('actual', 'predicted', ('SMAPE', 'WAPE'))},
                       avg(abs(log_actual - log_predicted)) AS CV_MAE_Mean
                FROM long GROUP BY Model""",
        ),
        (
            "members",
            """SELECT Model, CV_MAE_Mean, w / sum(w) OVER () AS weight FROM
               (SELECT *, 1 / (Dollar_MAE + CAST(1e-8 AS DOUBLE)) AS w FROM board
                WHERE Model NOT IN ('Naive Baseline (Mean)', 'BTYD Statistical Baseline')
                ORDER BY Dollar_R2 DESC, Model LIMIT 3)""",
        ),
        (
            "curve",
            """SELECT customer_id, row_number() OVER o AS position, sum(actual) OVER o / sum(actual) OVER () AS cum_actual,
                      CAST(row_number() OVER o - 1 AS DOUBLE) / greatest(count(*) OVER () - 1, 1) AS cum_population,
                      count(*) OVER () AS n
               FROM scored WINDOW o AS (ORDER BY predicted DESC, customer_id ROWS UNBOUNDED PRECEDING)""",
        ),
        (
            "folds",
            """SELECT *, (row_number() OVER (PARTITION BY log_target > 0 ORDER BY md5(customer_id || ':42'), customer_id) - 1) % 5 AS fold
               FROM split WHERE split = 'train'""",
        ),
    ]


def _segment(amount: str) -> str:
    return f"""CASE WHEN {amount} < CAST({WIDE.churned_below} AS DOUBLE) THEN 'Churned'
                    WHEN {amount} < {WIDE.segment_low} THEN 'Low'
                    WHEN {amount} < {WIDE.segment_high} THEN 'Mid' ELSE 'Whale' END"""


def _metrics(y: str, p: str, names: tuple[str, ...], prefix: str = "", digits: int | None = None) -> str:
    forms = {
        "RMSE": f"sqrt(sum(({y} - {p}) * ({y} - {p})) / count(*))",
        "MAE": f"avg(abs({y} - {p}))",
        "R2": f"""CASE WHEN var_pop({y}) > 0 THEN 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*))
                       WHEN sum(({y} - {p}) * ({y} - {p})) = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END""",
        "WAPE": f"CASE WHEN sum(abs({y})) > 0 THEN sum(abs({y} - {p})) / sum(abs({y})) * 100 END",
        "SMAPE": f"avg(2 * abs({y} - {p}) / (abs({y}) + abs({p}) + CAST(1e-8 AS DOUBLE))) * 100",
    }
    rounded = {n: f"round({forms[n]}, {digits})" if digits is not None else forms[n] for n in names}
    return ", ".join(f'{form} AS "{prefix}{n}"' for n, form in rounded.items())


def _sql(select: str, source: str = _TIDY, horizon: int = 90) -> str:
    steps = ",\n".join(f"{name} AS ({body})" for name, body in _steps(source, horizon))
    return f"WITH {steps}\n{select}"


_SEGMENTS = " UNION ALL ".join(
    f"SELECT '{name}' AS Segment, actual, predicted FROM scored, thresholds WHERE split = 'test' AND {rule}"
    for name, rule in {
        "Top 20% Spenders": "actual >= p80",
        "Mid Spenders": "actual > p20 AND actual < p80",
        "Low Spenders": "actual > 0 AND actual <= p20",
        "Zero-Spend (Churned)": "actual = 0",
        "All Customers": "true",
    }.items()
)

_SEGMENT_METRICS = f"""SELECT Segment, count(*) AS N, {_metrics('actual', 'predicted', ('RMSE', 'MAE', 'R2'), '', 4)},
    round(CASE WHEN sum(abs(actual)) > 0 THEN sum(abs(actual - predicted)) / sum(abs(actual)) * 100 END, 4) AS "WAPE%",
    round(avg(2 * abs(actual - predicted) / (abs(actual) + abs(predicted) + CAST(1e-8 AS DOUBLE))) * 100, 4) AS "SMAPE%",
    round(avg(actual), 4) AS Avg_Actual, round(avg(predicted), 4) AS Avg_Pred
    FROM ({_SEGMENTS}) GROUP BY Segment HAVING count(*) >= 5"""


def _histogram(rows: str, bins: int, by: str | None) -> str:
    group = by or "'all'"
    return f"""
    , h_rows AS ({rows}),
    h_bounds AS (SELECT {group} AS g, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                        CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi, count(*) AS total
                 FROM h_rows GROUP BY ALL),
    h_counts AS (SELECT g, least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS b, count(*) AS n
                 FROM h_rows JOIN h_bounds ON g = {group} GROUP BY ALL),
    h_frame AS (SELECT *, unnest(range({bins})) AS bin FROM h_bounds)
    SELECT {'h_frame.g AS ' + by + ',' if by else ''} bin, round(lo + bin * ((hi - lo) / {bins}), 5) AS left_edge,
           coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * ((hi - lo) / {bins})), 5) AS density
    FROM h_frame LEFT JOIN h_counts ON h_frame.g = h_counts.g AND bin = b"""


def _per_group(key: str, alias: str) -> str:
    return f"""SELECT {key} AS {alias}, count(*) AS lines, CAST(sum(Quantity) AS BIGINT) AS items,
                      round(sum(TotalAmount), 4) AS spend FROM clean GROUP BY ALL"""


# 2F1 as its power series; every factor is positive at these parameters and z < 0.4.
_PURCHASES = f"""SELECT customer_id, round(({A} + {B} + Frequency - 1) / ({A} - 1)
      * (1 - pow(({ALPHA} + T) / ({ALPHA} + T + 90), {R} + Frequency) * f) * p_alive, {{digits}}) AS Prob_Pred_Txn
      FROM alive JOIN (SELECT customer_id, sum(
          exp(lgamma({R} + Frequency + n) - lgamma({R} + Frequency) + lgamma({B} + Frequency + n) - lgamma({B} + Frequency)
              - lgamma({A} + {B} + Frequency - 1 + n) + lgamma({A} + {B} + Frequency - 1) - lgamma(n + CAST(1 AS DOUBLE))
              + n * ln(90 / ({ALPHA} + T + 90)))) AS f FROM alive, range(0, 400) AS terms(n) GROUP BY customer_id)
      USING (customer_id)"""

_GLOBAL = "(SELECT avg(Monetary) FROM alive WHERE Frequency > 0 AND Monetary > 0)"
_VALUE = f"""CASE WHEN Frequency > 0 THEN {P} * ({V} + Monetary * Frequency) / ({P} * Frequency + {Q} - 1)
             ELSE {{mean}} END"""


def _defaults(given: dict[str, str]) -> str:
    return ", ".join(f"{given.get(c, 'CAST(0 AS DOUBLE)')} AS {c}" for c in FEATURE_COLS)


def statements() -> dict[str, str]:
    mean_train = "(SELECT avg(log_target) FROM split WHERE split = 'train')"
    rounded_board = ", ".join(
        f"round({c}, 4) AS {c}"
        for c in (
            "Log_MAE", "Log_RMSE", "Log_R2", "Dollar_RMSE", "Dollar_MAE", "Dollar_R2", "SMAPE", "WAPE", "CV_MAE_Mean",
        )
    )
    champion = """SELECT * FROM board WHERE Model NOT IN ('Naive Baseline (Mean)', 'BTYD Statistical Baseline')
                  ORDER BY CV_MAE_Mean, Model LIMIT 1"""
    low_best = ("Log_MAE", "Log_RMSE", "Dollar_RMSE", "Dollar_MAE", "SMAPE", "WAPE", "CV_MAE_Mean")
    flags = ", ".join(
        [f"CAST({c} = (SELECT min({c}) FROM board) AS BIGINT) AS best_{c}" for c in low_best]
        + [f"CAST({c} = (SELECT max({c}) FROM board) AS BIGINT) AS best_{c}" for c in ("Log_R2", "Dollar_R2")]
    )
    percentile = "SELECT customer_id, round(Monetary_Percentile, 9) AS Monetary_Percentile FROM percentiles WHERE split = "
    positives = "count(*) FILTER (WHERE Next_3M_Spend > 0)"
    negatives = "count(*) FILTER (WHERE Next_3M_Spend = 0)"
    hurdle_amount = f"""prob_spend * (exp(least(greatest(ln(1 + predicted), CAST(0 AS DOUBLE)), CAST({WIDE.log_pred_max} AS DOUBLE))) - 1)"""
    return {
        "clean_transactions": _sql(
            """SELECT * FROM clean""",
            _UNTIDY,
        ),
        "cleaning_audit": _sql(
            """SELECT count(*) AS initial_rows, count(*) FILTER (WHERE raw_id IS NULL) AS missing_id,
                      count(*) FILTER (WHERE raw_id IS NOT NULL AND customer_id IS NULL) AS unusable_id,
                      count(*) FILTER (WHERE customer_id IS NOT NULL AND NOT coalesce(Price > 0, false)) AS bad_price,
                      count(*) FILTER (WHERE customer_id IS NOT NULL AND Price > 0 AND Quantity < 0) AS returns,
                      count(*) FILTER (WHERE customer_id IS NOT NULL AND Price > 0 AND NOT coalesce(Quantity > 0, false)) AS bad_quantity,
                      (SELECT count(*) FROM valid) - (SELECT count(*) FROM clean) AS copies,
                      (SELECT count(*) FROM clean) AS final_rows FROM raw_ids""",
            _UNTIDY,
        ),
        "dedup_transactions": _sql(
            """SELECT customer_id, count(*) AS lines, CAST(sum(Quantity) AS BIGINT) AS items,
                      round(sum(TotalAmount), 4) AS spend FROM clean GROUP BY customer_id"""
        ),
        "csv_round_trip": _sql(_per_group("strftime(InvoiceDate, '%Y-%m-%d')", "day"), _UNTIDY),
        "csv_published_layout": _sql(_per_group("strftime(InvoiceDate, '%Y-%m-%d')", "day"), _UNTIDY),
        "parquet_round_trip": _sql(_per_group("strftime(InvoiceDate, '%Y-%m-01')", "month")),
        "segment_metrics_round_trip": _sql(_SEGMENT_METRICS),
        "scored_round_trip": _sql("SELECT * FROM bands"),
        "scoring_input_csv": _sql(
            f"""SELECT customer_id, 'x' AS note, {_defaults({'Recency': 'Recency', 'Frequency': 'Frequency',
                'Monetary': 'CAST(300 AS DOUBLE)', 'Prob_Alive': 'CAST(0.65 AS DOUBLE)'})} FROM spend"""
        ),
        "scoring_input_rejected": _sql(
            """SELECT * FROM (WITH given AS (
                 SELECT customer_id AS id, CAST(customer_id AS BIGINT) % 10 AS kind,
                        CAST(CAST(Recency AS BIGINT) AS VARCHAR) AS r, CAST(CAST(Frequency AS BIGINT) AS VARCHAR) AS f
                 FROM spend),
               faults AS (
                 SELECT 'does not fit the layout' AS reason, NULL AS "column", id || ',' || r || ',' || f AS value
                 FROM given WHERE kind = 1
                 UNION ALL SELECT 'does not fit the layout', NULL, id || ',' || r || ',' || f || ',x,more' FROM given WHERE kind = 4
                 UNION ALL SELECT 'not a number', 'Recency', r || ' days' FROM given WHERE kind = 2
                 UNION ALL SELECT 'not a number', 'Recency', '?' FROM given WHERE kind = 3
                 UNION ALL SELECT 'not a number', 'Frequency', 'n/a' FROM given WHERE kind = 3)
               SELECT reason, "column", value, count(*) AS n FROM faults GROUP BY ALL
               UNION ALL
               SELECT 'accepted', NULL, CAST(count(CASE WHEN kind <> 5 THEN 1 END) AS VARCHAR), count(*) FROM given
               WHERE kind NOT BETWEEN 1 AND 4)"""
        ),
        "sketched_products": _sql(
            """SELECT customer_id, 'ever' AS "window", count(DISTINCT StockCode) AS products, true AS near FROM clean GROUP BY customer_id
               UNION ALL
               SELECT customer_id, 'late', count(DISTINCT StockCode), true FROM clean
               WHERE InvoiceDate >= TIMESTAMP '1997-01-01' GROUP BY customer_id"""
        ),
        "bundle_round_trip": _sql(
            f"SELECT customer_id, round({mean_train}, 6) AS prediction FROM split WHERE split = 'test'"
        ),
        "run_log": _sql(
            """SELECT Model AS model, 'check' AS kind, round(Dollar_MAE, 4) AS dollar_mae, round(WAPE, 6) AS wape
               FROM board"""
        ),
        "champion_registry": _sql(
            f"""SELECT 'champion' AS name, CAST(v AS BIGINT) AS version, Model AS champion, round(Dollar_MAE, 4) AS dollar_mae
                FROM ({champion}), (SELECT unnest([1, 2]) AS v)"""
        ),
        "date_range": _sql("SELECT * FROM span"),
        "temporal_split": _sql(
            """SELECT CASE WHEN InvoiceDate < split_ts THEN 'history' ELSE 'outcome' END AS side, count(*) AS lines,
                      min(InvoiceDate) AS first_ts, max(InvoiceDate) AS last_ts FROM clean, span GROUP BY ALL"""
        ),
        "history_customers": _sql("SELECT DISTINCT customer_id FROM hist"),
        "rfm_summary": _sql(
            "SELECT customer_id, Recency, Frequency, Monetary, T FROM rfm"
        ),
        "rfm_with_target": _sql(
            """SELECT customer_id, Recency, Frequency, Monetary, T,
                      Next_3M_Spend, round(log_target, 9) AS log_target FROM spend"""
        ),
        "interpurchase_std": _sql(
            "SELECT customer_id, round(Interpurchase_Std, 6) AS Interpurchase_Std FROM gap_std"
        ),
        "interpurchase_std_events": _sql(
            """SELECT customer_id, round(Interpurchase_Std, 6) AS Interpurchase_Std, Visit_Diversity, T, Recency
               FROM gap_std JOIN rfm USING (customer_id)""",
            _EVENTS,
            EVENT_HORIZON,
        ),
        "unique_products": _sql("SELECT * FROM products"),
        "visit_diversity": _sql("SELECT customer_id, Visit_Diversity FROM rfm"),
        "avg_basket": _sql("SELECT customer_id, round(Avg_Basket_Size, 6) AS Avg_Basket_Size FROM baskets"),
        "max_single_order": _sql("SELECT customer_id, Max_Single_Order FROM baskets"),
        "return_rate": _sql("SELECT customer_id, round(Return_Rate, 9) AS Return_Rate FROM returns"),
        "return_rate_all": _sql(
            """SELECT customer_id, round(CAST(count(DISTINCT CASE WHEN Quantity < 0 THEN Invoice END) AS DOUBLE)
                      / count(DISTINCT Invoice), 9) AS Return_Rate
               FROM raw_ids WHERE customer_id IS NOT NULL GROUP BY customer_id"""
        ),
        "behavior_features": _sql(
            """SELECT customer_id, Recency, Frequency, Monetary, T, Visit_Diversity,
                      Next_3M_Spend, round(log_target, 6) AS log_target,
                      round(Purchase_Rate, 6) AS Purchase_Rate, Days_Since_Purchase,
                      round(Revenue_Per_Day, 6) AS Revenue_Per_Day, round(Interpurchase_Std, 6) AS Interpurchase_Std,
                      round(Avg_Basket_Size, 6) AS Avg_Basket_Size, Max_Single_Order,
                      Unique_Products, round(Return_Rate, 6) AS Return_Rate FROM behaviour"""
        ),
        "spend_strata": _sql("SELECT customer_id, stratum FROM strata"),
        "spend_strata_fallback": _sql(
            """SELECT customer_id, CAST(CASE WHEN Next_3M_Spend <= 0 THEN 0
                      WHEN Next_3M_Spend <= (SELECT quantile_cont(Next_3M_Spend, CAST(0.5 AS DOUBLE)) FROM spend
                                             WHERE Next_3M_Spend > 0) THEN 1 ELSE 2 END AS BIGINT) AS stratum
               FROM spend"""
        ),
        "stratified_split": _sql("SELECT customer_id, stratum, split FROM split"),
        "split_diagnostics": _sql(
            """SELECT split, count(*) AS n,
                      round(avg(CASE WHEN Next_3M_Spend > edge THEN CAST(1 AS DOUBLE) ELSE 0 END), 9) AS whale_share,
                      round(avg(CASE WHEN Next_3M_Spend = 0 THEN CAST(1 AS DOUBLE) ELSE 0 END), 9) AS zero_share,
                      round(avg(Next_3M_Spend), 4) AS mean_spend, round(max(Next_3M_Spend), 4) AS max_spend
               FROM split, (SELECT quantile_cont(Next_3M_Spend, CAST(0.8 AS DOUBLE)) AS edge FROM split) GROUP BY split"""
        ),
        "target_summary": _sql(
            """SELECT split, round(avg(log_target), 9) AS mean_log, round(max(log_target), 9) AS max_log,
                      round(avg(Next_3M_Spend), 4) AS mean_dollars, round(max(Next_3M_Spend), 4) AS max_dollars
               FROM split GROUP BY split"""
        ),
        "monetary_percentile_train": _sql(percentile + "'train'"),
        "monetary_percentile_test": _sql(percentile + "'test'"),
        "outlier_caps": _sql(
            """SELECT unnest(['Frequency', 'Monetary', 'Avg_Basket_Size', 'Max_Single_Order']) AS feature,
                      unnest([round(f, 4), round(m, 4), round(b, 4), round(o, 4)]) AS cap FROM caps"""
        ),
        "capped_features": _sql(
            """SELECT customer_id, round_even(least(Frequency, f), 0) AS Frequency,
                      round(least(Monetary, m), 6) AS Monetary, round(least(Avg_Basket_Size, b), 6) AS Avg_Basket_Size,
                      round(least(Max_Single_Order, o), 6) AS Max_Single_Order
               FROM split JOIN baskets USING (customer_id), caps"""
        ),
        "prob_alive_fixed": _sql("SELECT customer_id, round(p_alive, 9) AS Prob_Alive FROM alive"),
        "gg_expected_value_fixed": _sql(
            f"SELECT customer_id, round({_VALUE.format(mean=_GLOBAL)}, 4) AS Prob_Pred_Val FROM alive"
        ),
        "bgnbd_loglik_fixed": _sql(
            f"""SELECT customer_id, round(lgamma({R} + Frequency) - lgamma({R}) + {R} * ln({ALPHA}) + lgamma({A} + {B})
                  + lgamma({B} + Frequency) - lgamma({B}) - lgamma({A} + {B} + Frequency)
                  + CASE WHEN Frequency > 0 THEN greatest(u, w) + ln(exp(u - greatest(u, w)) + exp(w - greatest(u, w)))
                         ELSE u END, 6) AS loglik
                FROM (SELECT *, -({R} + Frequency) * ln({ALPHA} + T) AS u,
                             ln({A} / ({B} + greatest(Frequency, CAST(1 AS DOUBLE)) - 1))
                             - ({R} + Frequency) * ln({ALPHA} + Recency) AS w FROM spend)"""
        ),
        "gg_loglik_fixed": _sql(
            f"""SELECT customer_id, round(lgamma({P} * Frequency + {Q}) - lgamma({P} * Frequency) - lgamma({Q})
                  + {Q} * ln({V}) + ({P} * Frequency - 1) * ln(Monetary) + {P} * Frequency * ln(Frequency)
                  - ({P} * Frequency + {Q}) * ln({V} + Monetary * Frequency), 6) AS loglik
                FROM spend WHERE Frequency > 0 AND Monetary > 0"""
        ),
        "expected_purchases": _sql(_PURCHASES.format(digits=8)),
        "btyd_baseline": _sql(
            f"""SELECT customer_id, round(ln(1 + greatest(Prob_Pred_Txn * value, CAST(0 AS DOUBLE))), 8) AS prediction
                FROM ({_PURCHASES.format(digits=14)}) JOIN
                     (SELECT customer_id, {_VALUE.format(mean=_GLOBAL)} AS value FROM alive) USING (customer_id)"""
        ),
        "ensemble_of_baselines": _sql(
            f"""SELECT customer_id, round((CAST(0.7 AS DOUBLE) * {mean_train} + CAST(0.3 AS DOUBLE)
                         * ln(1 + greatest(Prob_Pred_Txn * value, CAST(0 AS DOUBLE)))) / (CAST(0.7 AS DOUBLE) + CAST(0.3 AS DOUBLE)), 7) AS prediction
                FROM ({_PURCHASES.format(digits=14)}) JOIN
                     (SELECT customer_id, {_VALUE.format(mean=_GLOBAL)} AS value FROM alive) USING (customer_id)"""
        ),
        "naive_mean_baseline": _sql(f"SELECT customer_id, round({mean_train}, 8) AS prediction FROM split"),
        "metric_bundle": _sql(
            f"SELECT count(*) AS N, {_metrics('actual', 'predicted', ('RMSE', 'MAE', 'R2', 'WAPE', 'SMAPE'), '', 4)} FROM scored"
        ),
        "metric_bundle_log": _sql(
            f"""SELECT count(*) AS N,
                {_metrics('log_actual', 'log_predicted', ('RMSE', 'MAE', 'R2', 'WAPE', 'SMAPE'), '', 6)} FROM scored"""
        ),
        "segment_metrics": _sql(_SEGMENT_METRICS),
        "segment_thresholds": _sql("SELECT round(p20, 4) AS p20, round(p80, 4) AS p80 FROM thresholds"),
        "segment_counts": _sql("SELECT Segment AS segment, count(*) AS n FROM bands GROUP BY Segment"),
        "segment_totals": _sql(
            """SELECT Segment AS segment, count(*) AS customers, round(avg(CLV_Predicted_90d), 4) AS mean_clv,
                      round(sum(CLV_Predicted_90d), 4) AS total_clv FROM bands GROUP BY Segment"""
        ),
        "residuals": _sql(
            """SELECT customer_id, round(log_predicted, 8) AS log_predicted,
                      round(log_actual - log_predicted, 8) AS residual FROM scored"""
        ),
        "residual_mean": _sql("SELECT round(avg(log_actual - log_predicted), 8) AS mean_residual FROM scored"),
        "predicted_spenders": _sql(
            """SELECT customer_id, predicted FROM scored
               WHERE predicted > 0 OR (SELECT count(*) FROM scored WHERE predicted > 0) <= 20"""
        ),
        "spender_count": _sql(
            """SELECT count(*) AS customers, count(*) FILTER (WHERE actual > 0) AS actual_spenders,
                      count(*) FILTER (WHERE NOT actual > 0) AS actual_non_spenders,
                      count(*) FILTER (WHERE prob_spend >= CAST(0.9 AS DOUBLE)) AS predicted_spenders FROM scored"""
        ),
        "actual_vs_predicted": _sql(
            """SELECT customer_id, actual, predicted,
                      round(log_actual, 8) AS log_actual, round(log_predicted, 8) AS log_predicted FROM scored"""
        ),
        "prediction_preview": _sql(
            f"""SELECT customer_id, Recency, Frequency, Monetary,
                       CAST(0 AS DOUBLE) AS Prob_Pred_Txn, CAST(0 AS DOUBLE) AS Prob_Pred_Val,
                       round_even(amount, 2) AS CLV_Predicted_90d,
                       round_even(greatest(amount * (1 - CAST({WIDE.band} AS DOUBLE)), CAST(0 AS DOUBLE)), 2) AS CLV_Low,
                       round_even(amount * (1 + CAST({WIDE.band} AS DOUBLE)), 2) AS CLV_High, {_segment('amount')} AS Segment
                FROM (SELECT *, round(Purchase_Rate * 90 * Monetary, 6) AS amount FROM spend) ORDER BY customer_id LIMIT 50"""
        ),
        "gain_curve": _sql(
            """SELECT customer_id, position, round(cum_actual, 9) AS cum_actual,
                      round(cum_population, 9) AS cum_population, n FROM curve"""
        ),
        "lift_points": _sql(
            """SELECT share, round(cum_actual, 9) AS lift FROM curve,
                      (SELECT unnest([CAST(0.1 AS DOUBLE), CAST(0.2 AS DOUBLE), CAST(0.4 AS DOUBLE)]) AS share)
               WHERE position = floor(n * share) + 1"""
        ),
        "gain_position": _sql(
            """SELECT customer_id, round(CAST((SELECT count(*) FROM scored t WHERE t.split = 'train'
                      AND t.predicted <= scored.predicted) AS DOUBLE)
                      / (SELECT count(*) FROM scored t WHERE t.split = 'train'), 9) AS gain_position
               FROM scored WHERE split = 'test'"""
        ),
        "calibration_curve": _sql(
            """SELECT CAST(greatest(ceil(prob_spend * 10) - 1, 0) AS BIGINT) AS bin,
                      round(avg(prob_spend), 8) AS mean_predicted,
                      round(avg(CASE WHEN actual > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END), 8) AS observed_rate,
                      count(*) AS n FROM scored GROUP BY ALL"""
        ),
        "isotonic_blocks": _sql(
            """SELECT min(p) AS low, max(p) AS high, CAST(sum(own) AS BIGINT) AS n, round(mean, 9) AS rate FROM (
                 WITH points AS (
                   SELECT prob_spend AS p, count(*) AS own, sum(CAST(actual > 0 AS BIGINT)) AS hits FROM scored GROUP BY 1),
                 sums AS (
                   SELECT *, row_number() OVER (ORDER BY p) AS k, CAST(sum(own) OVER (ORDER BY p) AS DOUBLE) AS n,
                          CAST(sum(hits) OVER (ORDER BY p) AS DOUBLE) AS t FROM points),
                 spans AS (
                   SELECT a.k AS i, b.k AS j, (b.t - a.t + a.hits) / (b.n - a.n + a.own) AS mean
                   FROM sums a JOIN sums b ON b.k >= a.k),
                 lowest AS (SELECT j, min(mean) OVER (PARTITION BY i ORDER BY j DESC) AS mean FROM spans)
                 SELECT p, own, m.mean FROM sums JOIN (SELECT j, max(mean) AS mean FROM lowest GROUP BY j) m ON m.j = sums.k)
               GROUP BY mean"""
        ),
        "residual_histogram": _sql(
            _histogram("SELECT round(log_actual - log_predicted, 9) AS v FROM scored", 50, None)
        ),
        "probability_histogram": _sql(
            _histogram("SELECT prob_spend AS v, CAST(actual > 0 AS BIGINT) AS spends FROM scored", 40, "spends")
        ),
        "representative_customers": _sql(
            """SELECT profile, customer_id, actual FROM (
                 SELECT 'whale' AS profile, customer_id, actual, row_number() OVER (ORDER BY actual DESC, customer_id) AS k
                 FROM scored WHERE actual > 0
                 UNION ALL SELECT 'low', customer_id, actual, row_number() OVER (ORDER BY actual, customer_id)
                 FROM scored WHERE actual > 0
                 UNION ALL SELECT 'mid', customer_id, actual, row_number() OVER (ORDER BY abs(actual - m), customer_id)
                 FROM scored, (SELECT quantile_cont(actual, CAST(0.5 AS DOUBLE)) AS m FROM scored WHERE actual > 0)
                 WHERE actual > 0) WHERE k = 1"""
        ),
        "hurdle_combine": _sql(
            f"""SELECT customer_id, round(ln(1 + CASE WHEN prob_spend < CAST(0.5 AS DOUBLE) OR {hurdle_amount} < 10
                THEN CAST(0 AS DOUBLE) ELSE {hurdle_amount} END), 8) AS prediction FROM scored"""
        ),
        "fixed_segments": _sql(f"SELECT customer_id, {_segment('predicted')} AS Segment FROM scored"),
        "score_band": _sql("SELECT * FROM bands"),
        "default_fill": _sql(
            """SELECT customer_id, CASE WHEN Frequency > 0 THEN Monetary ELSE round(m, 4) END AS Monetary,
                      CASE WHEN Frequency > 0 THEN Recency ELSE round(r, 4) END AS Recency, CAST(0 AS DOUBLE) AS Prob_Alive
               FROM split, (SELECT quantile_cont(Monetary, CAST(0.5 AS DOUBLE)) AS m,
                                   quantile_cont(Recency, CAST(0.5 AS DOUBLE)) AS r FROM split WHERE split = 'train')"""
        ),
        "class_balance": _sql(
            f"""SELECT {positives} AS n_positive, {negatives} AS n_negative,
                       round(CASE WHEN {positives} > 0 THEN greatest(CAST(1 AS DOUBLE), CAST({negatives} AS DOUBLE) / {positives})
                             ELSE CAST(1 AS DOUBLE) END, 8) AS positive_weight FROM split WHERE split = 'train'"""
        ),
        "stratified_folds": _sql("SELECT customer_id, fold FROM folds"),
        "cv_summary": _sql(
            """SELECT round(avg(mae), 7) AS cv_mae_mean, round(stddev_pop(mae), 7) AS cv_mae_std FROM (
                 SELECT fold, avg(abs(log_target - m)) AS mae FROM folds JOIN
                   (SELECT k, avg(log_target) AS m FROM folds, (SELECT unnest([0, 1, 2, 3, 4]) AS k) WHERE fold <> k GROUP BY k)
                 ON fold = k GROUP BY fold)"""
        ),
        "leaderboard_table": _sql(
            f"""SELECT Model, {rounded_board},
                       CASE WHEN Model IN ('Naive Baseline (Mean)', 'BTYD Statistical Baseline') THEN '*' ELSE '' END AS note
                FROM board UNION ALL
                SELECT 'Weighted Ensemble', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                       round(sum(weight * CV_MAE_Mean), 4), '†' FROM members"""
        ),
        "leaderboard_select": _sql(
            f"""SELECT Model, 'champion' AS role, CAST(1 AS DOUBLE) AS weight FROM ({champion})
                UNION ALL SELECT Model, 'member', round(weight, 8) FROM members"""
        ),
        "leaderboard_flags": _sql(f"SELECT Model, {flags} FROM board"),
        "leaderboard_gate": _sql(
            f"""SELECT Model, round(Dollar_R2, 6) AS Dollar_R2, CAST(eligible AS BIGINT) AS eligible,
                       CAST(eligible AND CV_MAE_Mean = min(CASE WHEN eligible THEN CV_MAE_Mean END) OVER () AS BIGINT) AS champion,
                       CASE WHEN member THEN round(w / sum(CASE WHEN member THEN w END) OVER (), 8) ELSE CAST(0 AS DOUBLE) END AS weight
                FROM (SELECT *, eligible AND count(CASE WHEN eligible THEN 1 END) OVER () >= 2
                                AND row_number() OVER (ORDER BY eligible DESC, Dollar_R2 DESC, Model) <= 3 AS member,
                             1 / (Dollar_MAE + CAST(1e-8 AS DOUBLE)) AS w
                      FROM (SELECT *, Dollar_R2 > CAST({SETTINGS.min_dollar_r2} AS DOUBLE)
                                      AND Model NOT IN ('Naive Baseline (Mean)', 'BTYD Statistical Baseline') AS eligible
                            FROM (WITH known AS (
                                    SELECT Model, actual, log_actual, predicted, log_predicted FROM long UNION ALL
                                    SELECT 'Knows ' || k || ' Tenths', actual, log_actual, p, ln(1 + p) FROM
                                      (SELECT k, actual, log_actual, round((actual * k + predicted * (10 - k)) / 10, 6) AS p
                                       FROM long, (SELECT unnest([2, 5, 7, 9]) AS k) WHERE Model = 'Rate x Value'))
                                  SELECT Model, {_metrics('actual', 'predicted', ('MAE', 'R2'), 'Dollar_')},
                                         avg(abs(log_actual - log_predicted)) AS CV_MAE_Mean
                                  FROM known GROUP BY Model)))"""
        ),
        "weighted_log_mean": _sql(
            """SELECT customer_id, round((log_predicted / (ma + CAST(1e-8 AS DOUBLE))
                      + ln(1 + round(predicted * prob_spend, 6)) / (mb + CAST(1e-8 AS DOUBLE)))
                      / (1 / (ma + CAST(1e-8 AS DOUBLE)) + 1 / (mb + CAST(1e-8 AS DOUBLE))), 7) AS prediction
               FROM scored, (SELECT avg(abs(actual - predicted)) AS ma,
                                    avg(abs(actual - round(predicted * prob_spend, 6))) AS mb FROM scored)"""
        ),
        "feature_table": _sql(
            f"""SELECT customer_id, split, Recency, round_even(least(Frequency, f), 0) AS Frequency,
                       round(least(Monetary, m), 6) AS Monetary, round(txn.Prob_Pred_Txn, 6) AS Prob_Pred_Txn,
                       round({_VALUE.format(mean='CAST(' + str(VALUES.global_mean) + ' AS DOUBLE)')}, 4) AS Prob_Pred_Val,
                       round(p_alive, 6) AS Prob_Alive, round(Interpurchase_Std, 6) AS Interpurchase_Std,
                       round(Purchase_Rate, 6) AS Purchase_Rate, Days_Since_Purchase,
                       round(Revenue_Per_Day, 6) AS Revenue_Per_Day, Unique_Products, Visit_Diversity,
                       round(least(behaviour.Avg_Basket_Size, b), 6) AS Avg_Basket_Size, round(Return_Rate, 6) AS Return_Rate,
                       round(Monetary_Percentile, 6) AS Monetary_Percentile,
                       round(least(behaviour.Max_Single_Order, o), 6) AS Max_Single_Order,
                       Next_3M_Spend
                FROM alive JOIN (SELECT customer_id, Interpurchase_Std, Avg_Basket_Size, Max_Single_Order,
                                        Unique_Products, Return_Rate FROM behaviour) behaviour USING (customer_id)
                JOIN (SELECT customer_id, Monetary_Percentile FROM percentiles) USING (customer_id)
                JOIN ({_PURCHASES.format(digits=14)}) txn USING (customer_id), caps"""
        ),
    }
