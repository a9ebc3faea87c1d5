"""Declared schemas and fixed constants.

Every operator checks its input against these declarations before any job
runs (schema checks are free: they read `df.schema`, not data).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference pipeline's values for results
# to agree; they are stated here once, in natural order.
# ---------------------------------------------------------------------------
NO_PRIOR_TRANSACTION = -1.0          # seconds_since_prev_txn for a first transaction
NIGHT_START_HOUR = 23                # night is hour >= 23 ...
NIGHT_END_HOUR = 5                   # ... or hour <= 5 (inclusive)
SATURDAY = 5                         # Monday = 0; weekend is day_of_week >= 5
ONE_HOUR_SECONDS = 3600
ONE_DAY_SECONDS = 86400
MAX_RECENT_EVENTS = 100              # events kept in online customer state
DEFAULT_TEST_FRACTION = 0.2
DEFAULT_VALIDATION_FRACTION = 0.25
MIN_LABELLED_ROWS = 10
DEFAULT_FALSE_POSITIVE_COST = 5.0
DEFAULT_FALSE_NEGATIVE_COST = 100.0
BOOTSTRAP_RESAMPLES = 1000
BOOTSTRAP_CONFIDENCE = 0.95
BOOTSTRAP_SEED = 0
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
PSI_EPSILON = 1e-6
DEFAULT_N_BINS = 10
MAX_CATEGORICAL_CARDINALITY = 10
KS_PSEUDO_SAMPLE_SIZE = 1000
ADDITIVITY_TOLERANCE = 1e-4
TOP_K_ATTRIBUTIONS = 5
MAX_AMOUNT = 1_000_000.0
COUNTRY_CODE_LENGTH = 2
FEATURE_PREFIX_IMPORTANCE = "shap_importance__"

MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()

# Raw transaction contract (REQUIRED unless noted).
RAW_FIELDS = [
    ("transaction_id", T.StringType(), False, "Unique transaction identifier"),
    ("customer_id", T.StringType(), False, "Cardholder identifier; the entity key"),
    ("event_time", TS, False, "Transaction event time, UTC"),
    ("amount", MONEY, False, "Transaction amount"),
    ("merchant_id", T.StringType(), False, "Merchant identifier"),
    ("merchant_category", T.StringType(), False, "Merchant category"),
    ("country", T.StringType(), False, "Country of the transaction"),
    ("customer_home_country", T.StringType(), False, "Home country of the customer"),
    ("card_present", T.BooleanType(), False, "False for card-not-present transactions"),
    ("is_fraud", T.LongType(), True, "Label: 1 fraud, 0 genuine, null unlabelled"),
]

ID_COLUMNS = ("transaction_id", "customer_id")
EVENT_TIME = "event_time"
LABEL = "is_fraud"
AMOUNT = "amount"

# Engineered features, in model order.
FEATURE_FIELDS = [
    ("amount_log", T.DoubleType(), "log1p of the amount"),
    ("hour_of_day", T.LongType(), "Hour of the event, 0-23"),
    ("day_of_week", T.LongType(), "Day of week, Monday = 0"),
    ("is_night", T.BooleanType(), "Hour >= 23 or <= 5"),
    ("is_weekend", T.BooleanType(), "Saturday or Sunday"),
    ("is_foreign", T.BooleanType(), "Country differs from home country"),
    ("card_not_present", T.BooleanType(), "Card not present"),
    ("seconds_since_prev_txn", T.DoubleType(), "Seconds since previous transaction, -1 if none"),
    ("txn_count_1h", T.LongType(), "Transactions in the trailing hour, incl. this one"),
    ("txn_count_24h", T.LongType(), "Transactions in the trailing day, incl. this one"),
    ("amount_sum_24h", T.DoubleType(), "Amount in the trailing day, incl. this one"),
    ("customer_amount_mean_prior", T.DoubleType(), "Mean of strictly earlier amounts"),
    ("amount_vs_customer_mean", T.DoubleType(), "Amount over the prior mean"),
]
FEATURES = [f[0] for f in FEATURE_FIELDS]
ONLINE_FEATURES = [
    "seconds_since_prev_txn",
    "txn_count_1h",
    "txn_count_24h",
    "amount_sum_24h",
    "customer_amount_mean_prior",
]
FEATURE_TABLE_KEYS = ["transaction_id", "customer_id", "event_time", "is_fraud", "amount"]

PREDICTION_LOG_FIELDS = [
    ("transaction_id", T.StringType(), False),
    ("customer_id", T.StringType(), False),
    ("event_time", TS, False),
    ("variant", T.StringType(), False),
    ("fraud_probability", T.DoubleType(), False),
    ("threshold", T.DoubleType(), False),
    ("is_flagged", T.BooleanType(), False),
    ("base_value", T.DoubleType(), False),
    ("top_features", T.StringType(), False),
    ("latency_ms", T.DoubleType(), True),
]


class SchemaValidationError(ValueError):
    """Input does not satisfy a declared contract."""


def _struct(fields) -> T.StructType:
    out = []
    for f in fields:
        name, dtype, nullable = f[0], f[1], f[2] if isinstance(f[2], bool) else True
        comment = f[-1] if isinstance(f[-1], str) else ""
        out.append(T.StructField(name, dtype, nullable, metadata={"comment": comment} if comment else {}))
    return T.StructType(out)


RAW_SCHEMA = _struct(RAW_FIELDS)
FEATURE_SCHEMA = T.StructType(
    [T.StructField(n, t, False, metadata={"comment": c}) for n, t, c in FEATURE_FIELDS]
)
ONLINE_FEATURE_SCHEMA = T.StructType([f for f in FEATURE_SCHEMA.fields if f.name in ONLINE_FEATURES])
PREDICTION_LOG_SCHEMA = _struct(PREDICTION_LOG_FIELDS)


def feature_table_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    """5 key columns + 13 features, in declared order."""
    keys = {f.name: f for f in RAW_SCHEMA.fields}
    fields = []
    for name in FEATURE_TABLE_KEYS:
        f = keys[name]
        dtype = id_type if name in ID_COLUMNS else f.dataType
        fields.append(T.StructField(name, dtype, f.nullable, f.metadata))
    return T.StructType(fields + list(FEATURE_SCHEMA.fields))


def feature_definition(name: str) -> T.StructField:
    """The declared field of one online feature; unknown names raise."""
    if name not in ONLINE_FEATURES:
        raise KeyError(f"unknown online feature {name!r}")
    return FEATURE_SCHEMA[name]


def require_columns(df_columns, required, what: str = "frame") -> None:
    missing = sorted(set(required) - set(df_columns))
    if missing:
        raise SchemaValidationError(f"{what}: no column {', '.join(missing)}")
