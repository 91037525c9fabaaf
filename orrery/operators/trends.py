"""Trends over the window features: change, variance, long drift, event frequency and stability over time ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import KEYS


def trend_features(features: DataFrame, metrics: Sequence[str], *, frame: int = 3, long_frame: int = 25) -> DataFrame:
    """Per window of a series and metric: value of the window before, change and change rate against it (null in the first
    window; the rate is 0 where the value before is 0), variance of the last ``frame`` windows, and distance from the mean
    of the last ``long_frame`` (an hourly window and a day before it; null until there are so many)."""
    order = Window.partitionBy(*KEYS).orderBy("window_start")
    short, far = order.rowsBetween(1 - frame, 0), order.rowsBetween(1 - long_frame, 0)
    columns = []
    for m in metrics:
        value, before = F.col(m), F.lag(m).over(order)
        columns += [before.alias(f"{m}_lag"), F.round(value - before, 6).alias(f"{m}_change"),
                    F.round(F.when(before == 0, F.lit(0.0)).otherwise((value - before) / before), 6).alias(f"{m}_change_rate"),
                    F.round(F.var_pop(value).over(short), 6).alias(f"{m}_roll_variance"),
                    F.when(F.count(value).over(far) == long_frame, F.round(value - F.avg(value).over(far), 6)).alias(f"{m}_long_drift")]
    return features.select(*KEYS, "window_start", *columns)


def event_frequency(features: DataFrame, component: Sequence[str] = ("service_name",)) -> DataFrame:
    """Events of each component and day: their number, the windows observed, and events per window."""
    day = features.groupBy(*component, F.to_date("window_start").alias("day")).agg(
        F.sum("event_count").alias("events"), F.count(F.lit(1)).alias("windows"))
    return day.withColumn("events_per_window", F.round(F.col("events") / F.col("windows"), 6))


def stability(features: DataFrame, metric: str, component: Sequence[str] = ("service_name",)) -> DataFrame:
    """Mean, deviation and coefficient of variation (0 for a mean of 0) of a metric by component and day."""
    mean, deviation = F.avg(metric), F.stddev_pop(metric)
    return features.groupBy(*component, F.to_date("window_start").alias("day")).agg(
        F.round(mean, 6).alias("mean"), F.round(deviation, 6).alias("deviation"),
        F.round(F.when(mean == 0, F.lit(0.0)).otherwise(deviation / mean), 6).alias("variation"))
