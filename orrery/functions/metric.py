"""Metric canonicalisation, unit conversion and record fingerprint.

All are CASE expressions over the 7-entry spec (constant-folded by
Catalyst), so no lookup join is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import (
    METRIC_CANONICAL,
    MICROSECOND_UNITS,
    PER_MINUTE_UNITS,
    PERCENT_UNITS,
    SECOND_UNITS,
)
from .text import py_strip


def _case(key: Column, mapping: dict[str, str], default: Column) -> Column:
    expr = None
    for raw, value in mapping.items():
        expr = (F.when(key == raw, F.lit(value)) if expr is None else expr.when(key == raw, F.lit(value)))
    return expr.otherwise(default) if expr is not None else default


def unit_key(unit: Column) -> Column:
    """Unit as compared by the conversion rules: strip + lower, absent = ''."""
    return F.lower(py_strip(F.coalesce(unit, F.lit(""))))


def canonical_name(name: Column) -> Column:
    """``name`` is the stripped metric name."""
    return _case(name, {k: v[0] for k, v in METRIC_CANONICAL.items()}, name)


def canonical_unit(name: Column, unit_norm: Column) -> Column:
    """``unit_norm`` is :func:`unit_key` of the unit."""
    return _case(name, {k: v[1] for k, v in METRIC_CANONICAL.items()}, unit_norm)


def convert_value(name: Column, unit_norm: Column, value: Column) -> Column:
    """Value in the canonical unit; any other unit passes unchanged."""
    target = canonical_unit(name, unit_norm)
    given = unit_norm
    return (
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when((target == "ratio") & given.isin(*PERCENT_UNITS), value / F.lit(100.0))
        .when((target == "ms") & given.isin(*SECOND_UNITS), value * F.lit(1000.0))
        .when((target == "ms") & given.isin(*MICROSECOND_UNITS), value / F.lit(1000.0))
        .when((target == "rps") & given.isin(*PER_MINUTE_UNITS), value / F.lit(60.0))
        .otherwise(value)
    )


def fixed10(value: Column) -> Column:
    """Python's f"{v:.10f}" (nan / inf spelled as Python does)."""
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .otherwise(F.format_string("%.10f", value))
    )


def fingerprint(timestamp_text: Column, service: Column, host: Column, metric_name: Column,
                value: Column, event_type: Column) -> Column:
    """SHA-256 hex of 'ts|service|host|metric|%.10f|event_type'."""
    payload = F.concat_ws("|", timestamp_text, service, host, metric_name, fixed10(value), event_type)
    return F.sha2(payload, 256)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
