"""Shared stages of the driver-table plans: raw -> validated -> curated -> cleaned -> features.

Each function takes (spark, sf_dir) and returns a lazy DataFrame over the
whole driver tables; query definitions in :mod:`orrery.plans.catalog`
compose them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import first_wins, flag_first_wins
from ..operators.series import clean, clean_flags, discover_metrics, window_features  # noqa: F401
from ..operators.validate import validate
from ..session import limit_methods
from ..sources.adapter import raw_telemetry

WINDOW_MINUTES = 60
ROLLING_WINDOW = 3
# the two halves of the incremental-ingest check (a one-day overlap)
FIRST_BATCH_BEFORE = "2024-01-16"
SECOND_BATCH_FROM = "2024-01-15"


def raw(spark: SparkSession, sf: str) -> DataFrame:
    limit_methods(spark)
    return raw_telemetry(spark, sf)


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return validate(raw(spark, sf))


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return flag_first_wins(validated(spark, sf))


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return first_wins(validated(spark, sf))


def cleaned_flags(spark: SparkSession, sf: str, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    return clean_flags(curated(spark, sf), window_minutes=window_minutes)


def cleaned(spark: SparkSession, sf: str, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    return clean(curated(spark, sf), window_minutes=window_minutes)


def metrics_of(spark: SparkSession, sf: str) -> list[str]:
    return discover_metrics(cleaned(spark, sf))


def features(spark: SparkSession, sf: str, window_minutes: int = WINDOW_MINUTES,
             rolling_window_size: int = ROLLING_WINDOW, metrics: list[str] | None = None, counted: bool = False) -> DataFrame:
    # metrics=None: discovered from the checkpointed (window x metric) aggregate
    return window_features(cleaned(spark, sf, window_minutes), metrics=metrics, window_minutes=window_minutes,
                           rolling_window_size=rolling_window_size, counted=counted)


def ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def output(df: DataFrame) -> DataFrame:
    """Report form: integers as BIGINT, timestamps as 'yyyy-MM-dd HH:mm:ss' text."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = ts_text(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)
