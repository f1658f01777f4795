"""Entity schemas and value domains.

Fixed values: the field lists, their order and types, and the allowed-value
lists below must equal the ones the layered jobs were specified with; they are
written out as plain text in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT, I, B = T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.BooleanType()


def _schema(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- fixed values: raw feed schemas (field order matters) -------------------
CUSTOMERS = _schema([
    ("customer_id", S), ("first_name", S), ("last_name", S), ("email", S),
    ("phone", S), ("dni", S), ("date_of_birth", DT), ("registration_date", DT),
    ("city", S), ("district", S), ("country", S), ("customer_segment", S),
    ("risk_score", D), ("account_balance", D), ("credit_limit", D),
    ("is_active", B), ("created_at", DT),
])

MERCHANTS = _schema([
    ("merchant_id", S), ("merchant_name", S), ("category", S), ("mcc_code", I),
    ("city", S), ("country", S), ("is_verified", B), ("registration_date", DT),
])

TRANSACTIONS = _schema([
    ("transaction_id", S), ("customer_id", S), ("merchant_id", S),
    ("transaction_date", S), ("amount", D), ("currency", S),
    ("transaction_type", S), ("channel", S), ("device_id", S),
    ("ip_address", S), ("location_lat", D), ("location_lon", D),
    ("card_type", S), ("card_last_4", I), ("status", S), ("is_fraud", B),
    ("fraud_reason", S), ("processing_fee", D), ("created_at", DT),
])

# ---- fixed values: silver projections (column order) ------------------------
SILVER_CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone", "dni",
    "date_of_birth", "registration_date", "city", "district", "country",
    "customer_segment", "risk_score", "account_balance", "credit_limit",
    "is_active", "created_at", "processed_timestamp",
]
SILVER_MERCHANT_COLUMNS = [
    "merchant_id", "merchant_name", "category", "mcc_code",
    "city", "country", "is_verified", "registration_date", "processed_timestamp",
]
SILVER_TRANSACTION_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "transaction_date",
    "amount", "currency", "transaction_type", "channel", "device_id",
    "ip_address", "location_lat", "location_lon", "card_type", "card_last_4",
    "status", "is_fraud", "fraud_reason", "processing_fee",
    "created_at", "processed_timestamp",
]

# ---- fixed values: allowed values -------------------------------------------
CUSTOMER_SEGMENTS = ["VIP", "Premium", "Standard", "Basic"]
MERCHANT_CATEGORIES = [
    "Retail", "Restaurants", "Online Services", "Transportation",
    "Utilities", "Health & Pharmacies", "Education", "Entertainment",
    "Financial Services",
]
TRANSACTION_STATUSES = ["pending", "completed", "failed", "cancelled"]
CURRENCIES = ["PEN", "USD"]
CHANNELS = ["online", "mobile", "atm", "branch", "pos", "agent"]

# ---- fixed values: source tags ----------------------------------------------
JSON_SOURCE_TAG = "azure_json"
CSV_SOURCE_TAG = "azure_csv"

# Option (M6): card_last_4 as text keeps leading zeros ("0123"); the default
# int type turns it into 123, which the 4-digit rule then flags.
TRANSACTIONS_CARD_TEXT = T.StructType([
    T.StructField(f.name, S, True) if f.name == "card_last_4" else f for f in TRANSACTIONS.fields
])
