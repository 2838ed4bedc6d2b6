"""Schemas, column layouts and fixed values, declared once.

The reference declares the event schema three times; here there is one copy.
Columns are declared nullable: ``from_json`` and the file stream source make
every field nullable anyway, and "required" is enforced with a predicate
(see ``operators.ingest.split_valid``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's for equal results ---------
# Rule tags, parameters and defaults (fixed values):
FRAUD_TYPE_HIGH_AMOUNT = "high_amount"      # gold high-amount table tag
FRAUD_TYPE_VELOCITY = "velocity"            # gold velocity table tag
RULE_HIGH_AMOUNT = "HIGH_AMOUNT"            # consolidated rule name
RULE_HIGH_VELOCITY = "HIGH_VELOCITY"        # consolidated rule name
HIGH_AMOUNT_THRESHOLD = 20000.0             # strict: amount > threshold
VELOCITY_WINDOW = "60 seconds"              # tumbling, epoch aligned
VELOCITY_MIN_EXCLUSIVE = 5                  # strict: count > 5
VELOCITY_WATERMARK = "2 minutes"
# Risk score by number of distinct triggered rules (fixed values):
# 1 rule -> 0.30, 2 rules -> 0.60, 3 or more -> 0.90
RISK_SCORE_BY_RULES = ((1, 0.30), (2, 0.60), (3, 0.90))
# Value domains of the event contract (simulator lists, fixed values):
MERCHANT_DOMAIN = ["amazon", "walmart", "target", "bestbuy", "flipkart"]
LOCATION_DOMAIN = ["India", "USA", "Canada", "UK", "Germany"]
# --- end of fixed values -------------------------------------------------------

EVENT_FIELDS = [
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("merchant_id", T.StringType()),
    ("transaction_amount", T.DoubleType()),
    ("transaction_time", T.StringType()),
    ("device_id", T.StringType()),
    ("location", T.StringType()),
    ("is_international", T.BooleanType()),
]

EVENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in EVENT_FIELDS])

BRONZE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType(), True),
    T.StructField("ingestion_time", T.TimestampType(), True),
])

SILVER_SCHEMA = T.StructType(
    list(EVENT_SCHEMA.fields) + [T.StructField("ingestion_time", T.TimestampType(), True)]
)

EVENT_COLS = [n for n, _ in EVENT_FIELDS]
TXN_COLS = EVENT_COLS + ["ingestion_time"]          # the 9 silver columns
HIT_COLS = TXN_COLS + ["triggered_rule"]            # standardised rule hit

HIGH_AMOUNT_COLS = TXN_COLS + ["high_amount_flag", "intl_flag", "is_fraud", "fraud_type"]
VELOCITY_COLS = ["user_id", "window", "count", "fraud_type"]
FRAUD_UNION_COLS = TXN_COLS + ["triggered_rules"]

# Required fields for schema enforcement (all of the event contract).
REQUIRED_FIELDS = tuple(EVENT_COLS)

# Partition column added to lake tables so jobs can prune and overwrite by day.
EVENT_DATE = "event_date"
# Partition column of bronze: the day a record was ingested.
INGEST_DATE = "ingest_date"
