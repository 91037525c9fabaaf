"""Record validation (B1-B8) and null-spike profile.

One projection per row: every check is a column expression and the issues
of a row are an ARRAY<STRUCT<code, message>> in the reference's order, so
a row may carry several issues (Q5) and any issue rejects it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fingerprint, is_identifier, parse_float, py_strip, with_parsed_iso
from ..specs import (
    ALLOWED_ANOMALY_LABELS,
    ALLOWED_EVENT_TYPES,
    CURATED_COLUMNS,
    METRIC_RANGES,
    MSG_EVENT_TYPE,
    MSG_HOST,
    MSG_LABEL,
    MSG_MISSING,
    MSG_SERVICE,
    MSG_TIMESTAMP,
    MSG_VALUE,
    NULL_SPIKE_THRESHOLD,
    REQUIRED_FIELDS,
    range_message,
)


def _field(name: str, default: str) -> Column:
    """get_string(): absent/None -> default, then str().strip()."""
    return py_strip(F.coalesce(F.col(name), F.lit(default)))


def _issue(cond: Column, code: str, message: Column | str) -> Column:
    msg = message if isinstance(message, Column) else F.lit(message)
    return F.when(cond, F.struct(F.lit(code).alias("code"), msg.alias("message")))


def validate(raw: DataFrame) -> DataFrame:
    """Raw records -> records + ``issues`` array + ``ts`` (UTC instant).

    Keeps ``source_file``, ``source_ordinal``, ``row_number``.  Normalised
    values are only meaningful when ``issues`` is empty.
    """
    base = raw.select(
        "source_file",
        "source_ordinal",
        "row_number",
        _field("timestamp", "").alias("_ts_raw"),
        _field("service_name", "").alias("service_name"),
        _field("host_id", "").alias("host_id"),
        _field("metric_name", "").alias("metric_name"),
        _field("unit", "").alias("unit"),
        _field("event_type", "metric").alias("event_type"),
        _field("event_summary", "").alias("event_summary"),
        F.lower(_field("anomaly_label", "unknown")).alias("anomaly_label"),
        parse_float(F.col("metric_value")).alias("_value"),
    )
    staged = with_parsed_iso(base, F.col("_ts_raw"), text="_ts_text", ts="_ts").withColumn(
        "_num", F.coalesce(F.col("_value"), F.lit(0.0)))
    value = F.col("_num")
    metric = F.col("metric_name")
    range_bad = None
    range_msg = None
    for name, (lower, upper) in METRIC_RANGES.items():
        bad = (metric == name) & ~value.between(F.lit(lower), F.lit(upper))
        range_bad = bad if range_bad is None else (range_bad | bad)
        range_msg = (F.when(metric == name, F.lit(range_message(name))) if range_msg is None
                     else range_msg.when(metric == name, F.lit(range_message(name))))
    checks = [
        _issue(F.col("_ts_raw") == "", "missing_field", MSG_MISSING.format(field="timestamp")),
        _issue(F.col("service_name") == "", "missing_field", MSG_MISSING.format(field="service_name")),
        _issue(F.col("host_id") == "", "missing_field", MSG_MISSING.format(field="host_id")),
        _issue(metric == "", "missing_field", MSG_MISSING.format(field="metric_name")),
        _issue(F.col("_ts_text").isNull(), "invalid_timestamp", MSG_TIMESTAMP),
        _issue((F.col("service_name") != "") & ~is_identifier(F.col("service_name")), "invalid_service_name", MSG_SERVICE),
        _issue((F.col("host_id") != "") & ~is_identifier(F.col("host_id")), "invalid_host_id", MSG_HOST),
        _issue(F.col("_value").isNull(), "invalid_metric_value", MSG_VALUE),
        _issue(range_bad, "invalid_metric_range", range_msg),
        _issue(~F.col("event_type").isin(*ALLOWED_EVENT_TYPES), "invalid_event_type", MSG_EVENT_TYPE),
        _issue(~F.col("anomaly_label").isin(*ALLOWED_ANOMALY_LABELS), "invalid_anomaly_label", MSG_LABEL),
    ]
    issues = F.filter(F.array(*checks), lambda x: x.isNotNull())
    with_issues = staged.withColumn("issues", issues)
    ok = F.size("issues") == 0
    text = F.col("_ts_text")
    return with_issues.select(
        "source_file",
        "source_ordinal",
        "row_number",
        F.when(ok, text).otherwise(F.lit("")).alias("timestamp"),
        F.col("_ts").alias("ts"),
        "service_name",
        "host_id",
        "metric_name",
        value.alias("metric_value"),
        "unit",
        "event_type",
        "event_summary",
        "anomaly_label",
        F.col("event_type").alias("source_type"),
        F.when(ok, fingerprint(text, F.col("service_name"), F.col("host_id"), metric, value, F.col("event_type")))
        .alias("record_fingerprint"),
        "issues",
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("issues") == 0).drop("issues")


def validation_issues(validated: DataFrame) -> DataFrame:
    """One row per issue: (source_file, row_number, code, message)."""
    return validated.where(F.size("issues") > 0).select(
        "source_file", "row_number", F.explode("issues").alias("issue")
    ).select("source_file", "row_number", "issue.code", "issue.message")


def curated_view(records: DataFrame) -> DataFrame:
    return records.select(*CURATED_COLUMNS, "ts")


def null_spikes(raw: DataFrame, *, by: tuple[str, ...] = ("source_file",), fields: tuple[str, ...] = REQUIRED_FIELDS,
                threshold: float = NULL_SPIKE_THRESHOLD) -> DataFrame:
    """Per group and required field: share of absent/blank values, kept when >= threshold.

    One aggregation pass, then ``stack`` to long form (group, field, ratio).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for name in fields:
        blank = F.col(name).isNull() | (py_strip(F.col(name)) == "")
        aggs.append(F.sum(blank.cast("long")).alias(f"_b_{name}"))
    counts = raw.groupBy(*by).agg(*aggs)
    stack = "stack({n}, {pairs}) AS (field, blanks)".format(
        n=len(fields), pairs=", ".join(f"'{name}', `_b_{name}`" for name in fields))
    long = counts.select(*by, "_rows", F.expr(stack))
    return long.select(*by, "field", (F.col("blanks") / F.col("_rows")).alias("ratio")).where(
        F.col("ratio") >= F.lit(threshold))
