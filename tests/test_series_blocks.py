"""Long series cut into time blocks give the rows of the whole-series plan."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orrery.operators.series import fill_gaps, series_features

METRICS = ["error_rate", "latency_ms", "packet_drop_ratio", "throughput_rps"]


@pytest.fixture(scope="module")
def windows(spark):
    rng, rows = random.Random(1), []
    for series, span in (("a", 700), ("b", 90), ("c", 1), ("d", 64)):
        for i in sorted(rng.sample(range(span), max(1, span // 3))):
            # long bursts, long gaps, and values that are often missing
            burst = 0.5 if (i // 150) % 2 == 0 and series != "b" else 0.0
            values = [rng.random() if rng.random() < 0.3 else None, float(rng.randint(1, 900)) if rng.random() < 0.5 else None,
                      burst if rng.random() < 0.8 else None, float(i) if rng.random() < 0.1 else None]
            rows.append(("svc", series, datetime(2024, 1, 30, 7) + timedelta(minutes=5 * i), rng.randint(0, 2), rng.randint(0, 1), f"s{i}", *values))
    schema = "service_name string, host_id string, window_start timestamp_ntz, event_count int, is_anomaly int, event_summaries string, "
    return spark.createDataFrame(rows, schema + ", ".join(f"_mean_{m} double" for m in METRICS)).cache()


def features(windows, rolling, **blocks):
    grid = fill_gaps(windows, METRICS, window_minutes=5, **blocks)
    return series_features(grid, METRICS, window_minutes=5, rolling_window_size=rolling, **blocks)


@pytest.mark.parametrize("rolling, size", [(3, 16), (1, 1), (5, 5)])
def test_blocks_equal_the_whole_series(windows, rolling, size):
    whole, cut = features(windows, rolling), features(windows, rolling, block_windows=size)
    assert cut.columns == whole.columns
    order = ["host_id", "window_start"]
    assert cut.orderBy(*order).collect() == whole.orderBy(*order).collect()


def test_a_block_must_hold_a_frame(windows):
    with pytest.raises(ValueError):
        features(windows, 5, block_windows=4)


def test_one_series_runs_in_many_tasks(spark, windows):
    one = features(windows.where("host_id = 'a'"), 3, block_windows=64)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        used = one.select(F.spark_partition_id().alias("p"), "latency_ms_roll_mean").where("latency_ms_roll_mean >= 0")
        assert used.select("p").distinct().count() > 1
    finally:
        spark.conf.set(name, "true")
