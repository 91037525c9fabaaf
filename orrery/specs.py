"""Fixed values and table schemas.

Everything under "Fixed values" must equal the values the reference
behaviour is defined by (ranges, canonical names, unit spellings,
thresholds, issue codes and messages).  They are stated once, here, in
their natural order; every operator reads them from this module.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------

IDENTIFIER_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9_.-]{1,63}$"
NULL_SPIKE_THRESHOLD = 0.2
ALLOWED_EVENT_TYPES = ("metric", "event")
ALLOWED_ANOMALY_LABELS = ("normal", "anomaly", "unknown")
REQUIRED_FIELDS = ("timestamp", "service_name", "host_id", "metric_name", "metric_value")

# raw metric name -> (lower, upper) closed interval
METRIC_RANGES = {
    "cpu_pct": (0.0, 100.0),
    "memory_pct": (0.0, 100.0),
    "latency_ms": (0.0, 600000.0),
    "packet_drop_pct": (0.0, 100.0),
    "error_rate": (0.0, 1.0),
    "throughput_rps": (0.0, 10000000.0),
    "request_failures": (0.0, 10000000.0),
}

# raw metric name -> (canonical name, canonical unit)
METRIC_CANONICAL = {
    "cpu_pct": ("cpu_utilization", "ratio"),
    "memory_pct": ("memory_utilization", "ratio"),
    "packet_drop_pct": ("packet_drop_ratio", "ratio"),
    "error_rate": ("error_rate", "ratio"),
    "latency_ms": ("latency_ms", "ms"),
    "throughput_rps": ("throughput_rps", "rps"),
    "request_failures": ("request_failures", "count"),
}

# canonical metric name -> value used when a series has no earlier value
METRIC_DEFAULTS = {
    "cpu_utilization": 0.0,
    "memory_utilization": 0.0,
    "packet_drop_ratio": 0.0,
    "error_rate": 0.0,
    "latency_ms": 0.0,
    "throughput_rps": 0.0,
    "request_failures": 0.0,
}

# unit spellings (compared after trim + lower)
PERCENT_UNITS = ("percent", "pct", "%")
SECOND_UNITS = ("s", "sec", "second", "seconds")
MICROSECOND_UNITS = ("us", "microsecond", "microseconds")
PER_MINUTE_UNITS = ("per_min", "rpm")

PACKET_DROP_BURST_THRESHOLD = 0.01
SUMMARY_SEPARATOR = " | "

DERIVED_FEATURES = (
    "event_count",
    "event_frequency",
    "request_error_ratio",
    "cpu_throughput_imbalance",
    "short_term_latency_drift",
    "packet_drop_burst_count",
)

EXCLUDED_FEATURE_COLUMNS = (
    "window_start",
    "window_minutes",
    "service_name",
    "host_id",
    "event_summaries",
    "target_next_latency_ms",
    "target_next_throughput_rps",
    "is_anomaly",
)

REGRESSION_TARGETS = ("target_next_latency_ms", "target_next_throughput_rps")
ROLLING_SUFFIXES = ("roll_mean", "roll_std", "roll_min", "roll_max", "roll_slope")
FEATURE_GROUP_ORDER = (
    "base_metrics",
    "rolling_stats",
    "imputation_flags",
    "normalized_scores",
    "derived_operational",
)
THRESHOLD_STEPS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
MAPE_EPSILON = 2.220446049250313e-16
PREVIEW_KEYS = (
    "cpu_utilization",
    "memory_utilization",
    "latency_ms",
    "throughput_rps",
    "packet_drop_ratio",
    "error_rate",
    "request_failures",
    "request_error_ratio",
    "event_count",
    "packet_drop_burst_count",
)

# validation issue codes and messages
MSG_MISSING = "Missing required field '{field}'"
MSG_TIMESTAMP = "Timestamp must be ISO-8601 parseable"
MSG_SERVICE = "service_name contains unsupported characters"
MSG_HOST = "host_id contains unsupported characters"
MSG_VALUE = "metric_value must be numeric"
MSG_RANGE = "{metric} must be between {lower!r} and {upper!r}"
MSG_EVENT_TYPE = "event_type must be 'metric' or 'event'"
MSG_LABEL = "anomaly_label must be normal, anomaly, or unknown"

STATUS_INGESTED = "ingested"
STATUS_SKIPPED = "skipped_existing_checksum"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_FIELDS = (
    "timestamp",
    "service_name",
    "host_id",
    "metric_name",
    "metric_value",
    "unit",
    "event_type",
    "event_summary",
    "anomaly_label",
)

# every raw field is read as text: typing happens in validation
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in RAW_FIELDS])

CURATED_COLUMNS = (
    "timestamp",
    "service_name",
    "host_id",
    "metric_name",
    "metric_value",
    "unit",
    "event_type",
    "event_summary",
    "anomaly_label",
    "source_type",
    "source_file",
    "record_fingerprint",
)

ISSUE_STRUCT = T.StructType(
    [
        T.StructField("code", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
    ]
)

OBSERVATION_STRUCT = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("metric_value", T.DoubleType(), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("event_summary", T.StringType(), True),
    ]
)

HISTORY_STRUCT = T.StructType(
    [T.StructField(name, T.DoubleType(), True) for name in METRIC_DEFAULTS]
    + [T.StructField("event_count", T.IntegerType(), True)]
)

WINDOW_REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("service_name", T.StringType(), True),
        T.StructField("host_id", T.StringType(), True),
        T.StructField("window_start", T.StringType(), True),
        T.StructField("window_minutes", T.IntegerType(), True),
        T.StructField("rolling_window_size", T.IntegerType(), True),
        T.StructField("observations", T.ArrayType(OBSERVATION_STRUCT), True),
        T.StructField("history", T.ArrayType(HISTORY_STRUCT), True),
    ]
)


def range_message(metric: str) -> str:
    lower, upper = METRIC_RANGES[metric]
    return MSG_RANGE.format(metric=metric, lower=lower, upper=upper)
