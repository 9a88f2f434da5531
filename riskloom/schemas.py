"""Entity schemas and closed value sets.

One declaration per entity; the wire schema of the stream and the quality
expectations are derived from these so they cannot disagree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The closed value sets of the data model.
COUNTRIES = ["AU", "CA", "DE", "GB", "IN", "SG", "US"]
CUSTOMER_SEGMENTS = ["business", "premium", "retail"]
MERCHANT_CATEGORIES = [
    "crypto", "dining", "electronics", "fashion", "gaming", "grocery", "other", "travel",
]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
CURRENCIES = ["EUR", "GBP", "INR", "USD"]
PAYMENT_METHODS = ["bank_transfer", "card", "wallet"]
DECISIONS = ["approve", "review", "block"]


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from "name type, name type"; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CUSTOMERS = _struct(
    "customer_id string, account_created_at timestamp_ntz, customer_segment string,"
    " home_country string, home_city string"
)
MERCHANTS = _struct(
    "merchant_id string, merchant_category string, country string, created_at timestamp_ntz"
)
DEVICES = _struct(
    "device_id string, customer_id string, device_type string, first_seen_at timestamp_ntz"
)
TRANSACTIONS = _struct(
    "transaction_id string, customer_id string, merchant_id string, device_id string,"
    " timestamp timestamp_ntz, amount double, currency string, payment_method string,"
    " country string, city string, ip_country string"
)
GROUND_TRUTH = _struct(
    "transaction_id string, fraud_probability_true double, fraud_label int,"
    " confirmed_fraud_at timestamp_ntz"
)
FEATURES = _struct(
    "transaction_id string, customer_id string, merchant_id string, timestamp timestamp_ntz,"
    " amount double, payment_method string, hour_of_day bigint, is_night int,"
    " is_cross_border int, amount_vs_customer_p95 double, txn_count_1h bigint,"
    " txn_count_24h bigint, is_new_device int, device_age_days double,"
    " customer_device_count_so_far bigint, merchant_fraud_rate_hist double,"
    " is_new_country_for_customer int, ip_country_mismatch int"
)

ENTITIES = {
    "customers": CUSTOMERS,
    "merchants": MERCHANTS,
    "devices": DEVICES,
    "transactions": TRANSACTIONS,
    "ground_truth": GROUND_TRUTH,
    "features": FEATURES,
}

ID_COLUMNS = ["transaction_id", "customer_id", "merchant_id", "timestamp"]
FEATURE_COLUMNS = FEATURES.fieldNames()
FLAG_COLUMNS = [
    "is_night", "is_cross_border", "is_new_device", "is_new_country_for_customer",
    "ip_country_mismatch",
]
MODEL_INPUTS = [c for c in FEATURE_COLUMNS if c not in ID_COLUMNS]
NUMERIC_FEATURES = [c for c in MODEL_INPUTS if c != "payment_method"]

# Flags travel as JSON 0/1: a boolean wire type would read them as null.
# The instant travels as text and is cast after parsing.
_WIRE = {
    T.TimestampNTZType(): T.StringType(),
    T.LongType(): T.IntegerType(),
}
FEATURE_WIRE = T.StructType(
    [T.StructField(f.name, _WIRE.get(f.dataType, f.dataType)) for f in FEATURES]
)
