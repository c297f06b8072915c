"""Declared table contracts and fixed domain values.

Every table of the pipeline has one declared ``StructType`` here; nothing is
inferred at read time.  Writes resolve columns by name against these.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

D = DoubleType()
S = StringType()
L = LongType()

ID = "TransactionID"
LABEL = "isFraud"
AMOUNT = "TransactionAmt"
EVENT_TIME = "kafka_timestamp"

# Message fields carried on the wire (a projection of the full record).
MESSAGE_SCHEMA = StructType(
    [
        StructField("TransactionID", D),
        StructField("isFraud", D),
        StructField("TransactionDT", D),
        StructField("TransactionAmt", D),
        StructField("ProductCD", S),
        StructField("card1", D),
        StructField("card2", D),
        StructField("card4", S),
        StructField("card6", S),
        StructField("P_emaildomain", S),
        StructField("C1", D),
        StructField("C2", D),
        StructField("D1", D),
    ]
)
MESSAGE_COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields]
STRING_COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields if f.dataType == S]

BRONZE_SCHEMA = StructType(MESSAGE_SCHEMA.fields + [StructField(EVENT_TIME, TimestampType())])
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

SILVER_SCHEMA = StructType(
    [StructField(ID, IntegerType())]
    + [f for f in BRONZE_SCHEMA.fields if f.name != ID]
    + [StructField("risk_label", S), StructField("row_hash", S)]
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

GOLD_CARD_SCHEMA = StructType(
    [
        StructField("card4", S),
        StructField("total_transactions", L),
        StructField("fraud_count", D),
        StructField("avg_transaction_amt", D),
        StructField("avg_fraud_amt", D),
        StructField("fraud_rate_pct", D),
    ]
)
GOLD_EMAIL_SCHEMA = StructType(
    [
        StructField("P_emaildomain", S),
        StructField("total_transactions", L),
        StructField("fraud_count", D),
        StructField("fraud_rate_pct", D),
        StructField("avg_transaction_amt", D),
    ]
)
GOLD_TIER_SCHEMA = StructType(
    [StructField("amount_tier", S)] + GOLD_EMAIL_SCHEMA.fields[1:]
)
GOLD_SUMMARY_SCHEMA = StructType(
    [
        StructField("total_transactions", L),
        StructField("fraud_count", L),
        StructField("legit_count", L),
        StructField("fraud_rate_pct", D),
        StructField("avg_transaction_amt", D),
        StructField("avg_fraud_amt", D),
    ]
)

# Internal: per-group partial sums behind incremental gold (one row per group
# and silver batch).
GOLD_PARTIALS_SCHEMA = StructType(
    [StructField(c, S) for c in ("gset", "card4", "P_emaildomain", "amount_tier")]
    + [StructField("n", L), StructField("fraud_sum", D), StructField("fraud_n", L),
       StructField("amt_sum", D), StructField("amt_n", L),
       StructField("fraud_amt_sum", D), StructField("fraud_amt_n", L)]
)

# Internal: silver's survivors by bucket of the id, with the batch whose survivor each replaces (and what
# gold summed of that one), and the messages without a usable id, with their text.
BUCKET = StructField("bucket", IntegerType())
SUMMED = [StructField("card4", S), StructField("P_emaildomain", S), StructField(AMOUNT, D), StructField(LABEL, D)]
SURVIVORS_SCHEMA = StructType(
    [*SILVER_SCHEMA.fields, StructField("raw_id", D), StructField("nulls", L),
     StructField("of_batch", S), StructField("was", StructType(SUMMED)), BUCKET]
)
QUARANTINE_SCHEMA = StructType(BRONZE_SCHEMA.fields + [StructField("raw", S), StructField("reason", S)])

TABLES: dict[str, StructType] = {
    "bronze_transactions": BRONZE_SCHEMA,
    "silver_transactions": SILVER_SCHEMA,
    "gold_fraud_by_card_network": GOLD_CARD_SCHEMA,
    "gold_fraud_by_email_domain": GOLD_EMAIL_SCHEMA,
    "gold_fraud_by_amount_tier": GOLD_TIER_SCHEMA,
    "gold_overall_summary": GOLD_SUMMARY_SCHEMA,
    "gold_partials": GOLD_PARTIALS_SCHEMA,
    "silver_survivors": SURVIVORS_SCHEMA,
    "silver_quarantine": QUARANTINE_SCHEMA,
}
# Tables of named batches of which only committed ones are read, and those cut into buckets of the id.
COMMITTED = ["silver_survivors", "gold_partials"]
BUCKETED = ["silver_survivors"]

# --- fixed values (must equal the reference's for identical results) -------
# Defaults for missing text fields in silver, and the sentinel text the
# replay's zero-fill produces for missing strings.
UNKNOWN = "unknown"
SENTINEL = "0"
STRING_DEFAULTS = {"P_emaildomain": UNKNOWN, "card4": UNKNOWN, "card6": UNKNOWN}
# Spend tiers: upper-inclusive bounds, in order, and the label of everything above.
TIER_BOUNDS = [25, 50, 100, 200, 500, 1000]
TIER_LABELS = ["$0-25", "$25-50", "$50-100", "$100-200", "$200-500", "$500-1K", "$1K+"]
# Risk labels and the status names of the tier breakdown.
FRAUD, LEGIT = "FRAUD", "LEGIT"
STATUS_FRAUD, STATUS_LEGIT = "Flagged as Fraud", "Legitimate"
# Verdict texts of the scorer and its threshold.
THRESHOLD = 0.5
VERDICT_HIGH = "HIGH RISK — DO NOT APPROVE"
VERDICT_LOW = "LOW RISK — SAFE TO APPROVE"
# Email choices offered by the scoring form; anything else is "Other".
FORM_EMAILS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "protonmail.com"]
FORM_OTHER = "Other"
# Sizes of the dashboard's top-k panels.
TOP_EMAIL_DOMAINS = 20
TOP_HEATMAP_DOMAINS = 6
TOP_HOTSPOTS = 12
TOP_FLAGGED = 10
LEGIT_SAMPLE = 1000
MIN_CARD_TYPE_ROWS = 10
HISTOGRAM_CAP = 500.0
HISTOGRAM_WIDTH = 10.0
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
# What the scoring form fills in for fields that a request lacks: numbers, texts, and for categories that
# it does not ask for the code itself.
REQUEST_DEFAULTS = {
    "TransactionAmt": 250.0, "card1": 9000.0, "card2": 300.0, "card3": 150.0, "card5": 226.0,
    "card4": "unknown", "card6": "unknown", "P_emaildomain": "unknown",
    "addr1": 315.0, "addr2": 87.0, "dist1": 0.0,
    "C1": 1.0, "C2": 1.0, "C3": 0.0, "C4": 0.0, "C5": 0.0, "C6": 1.0, "C7": 0.0, "C8": 0.0, "C9": 0.0,
    "C10": 0.0, "C11": 1.0, "C12": 0.0, "C13": 1.0, "C14": 1.0,
    "D1": 10.0, "D2": 0.0, "D3": 0.0, "D4": 0.0, "D5": 0.0,
}
REQUEST_CODES = {
    "ProductCD": 2.0, "R_emaildomain": 0.0,
    "M1": 1.0, "M2": 1.0, "M3": 1.0, "M4": 1.0, "M5": 1.0, "M6": 1.0, "M7": 0.0, "M8": 0.0, "M9": 0.0,
}
# The full feature matrix, in order, and which of it are categories.
FEATURES = [
    "TransactionAmt", "ProductCD", "card1", "card2", "card3", "card4", "card5", "card6",
    "addr1", "addr2", "dist1", "P_emaildomain", "R_emaildomain",
    *[f"C{k}" for k in range(1, 15)], *[f"D{k}" for k in range(1, 6)], *[f"M{k}" for k in range(1, 10)],
]
CATEGORICAL = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", *[f"M{k}" for k in range(1, 10)]]
# Rows of the capped replay.
CAPPED_ROWS = 10_000
# Why a message is in the quarantine.
REJECT_MALFORMED, REJECT_NO_ID, REJECT_RANGE = "malformed", "no id", "id out of range"
# --- end of fixed values ---------------------------------------------------

NUMERIC_FEATURES = [c for c in FEATURES if c not in CATEGORICAL]
# The features that a message carries (the others come from tables it refers to).
MESSAGE_FEATURES = [c for c in FEATURES if c in MESSAGE_COLUMNS]
# A scoring request as the form sends it.
REQUEST_SCHEMA = StructType(
    [StructField(ID, IntegerType()), StructField("amount", D), StructField("card_network", S), StructField("card_category", S),
     StructField("email", S), StructField("addresses", D), StructField("cards", D), StructField("days_since", D),
     StructField("card1", D), StructField("card2", D)]
)
