"""Feature contract, transaction schema and run settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The feature contract. Order matters for the assembled vector.
FEATURE_COLS = [
    "Recency",
    "Frequency",
    "Monetary",
    "Prob_Pred_Txn",
    "Prob_Pred_Val",
    "Prob_Alive",
    "Interpurchase_Std",
    "Purchase_Rate",
    "Days_Since_Purchase",
    "Revenue_Per_Day",
    "Unique_Products",
    "Visit_Diversity",
    "Avg_Basket_Size",
    "Return_Rate",
    "Monetary_Percentile",
    "Max_Single_Order",
]

# Features capped at the train P99.
CAPPED_COLS = ["Frequency", "Monetary", "Avg_Basket_Size", "Max_Single_Order"]

# Expected direction of the prediction in each feature (features not listed are free).
EXPECTED_SIGNS = {
    "Frequency": 1,
    "Monetary": 1,
    "Prob_Pred_Txn": 1,
    "Prob_Pred_Val": 1,
    "Prob_Alive": 1,
    "Purchase_Rate": 1,
    "Days_Since_Purchase": -1,
    "Revenue_Per_Day": 1,
    "Unique_Products": 1,
    "Visit_Diversity": 1,
    "Return_Rate": -1,
    "Monetary_Percentile": 1,
    "Max_Single_Order": 1,
}

TRANSACTION_COLS = ["Invoice", "StockCode", "Quantity", "InvoiceDate", "Price", "Customer ID"]

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.StringType()),
    ]
)

# Money is rounded here after every sum, so a result does not depend on the order
# in which executors add doubles up.
MONEY_DIGITS = 6


@dataclass(frozen=True)
class Settings:
    """Constants of a training run. The defaults are the published ones."""

    horizon_days: int = 90
    seed: int = 42
    train_share: float = 0.80
    strata: int = 5
    cap_quantile: float = 0.99
    log_pred_max: float = 12.0
    churn_threshold: float = 0.50
    min_dollars: float = 10.0
    min_train_rows: int = 50
    min_segment_rows: int = 5
    min_dollar_r2: float = 0.10
    band: float = 0.15
    segment_low: float = 150.0
    segment_high: float = 1200.0
    churned_below: float = 0.01


SETTINGS = Settings()
