"""Trend columns of a short series against values worked out by hand."""

from datetime import datetime, timedelta

from orrery.operators.trends import event_frequency, stability, trend_features


def test_trends_by_hand(spark):
    rows = [("s", "h", datetime(2024, 1, 1, 22) + timedelta(hours=i), i % 2, v) for i, v in enumerate([2.0, 4.0, 0.0, 6.0])]
    df = spark.createDataFrame(rows, "service_name string, host_id string, window_start timestamp_ntz, event_count int, latency_ms double")
    got = trend_features(df, ("latency_ms",), frame=2, long_frame=3).orderBy("window_start").collect()
    assert [(r.latency_ms_lag, r.latency_ms_change, r.latency_ms_change_rate) for r in got] == [
        (None, None, None), (2.0, 2.0, 1.0), (4.0, -4.0, -1.0), (0.0, 6.0, 0.0)]
    assert [r.latency_ms_roll_variance for r in got] == [0.0, 1.0, 4.0, 9.0]
    assert [r.latency_ms_long_drift for r in got] == [None, None, -2.0, 2.666667]
    assert [(str(r.day), r.events, r.windows, r.events_per_window) for r in event_frequency(df).orderBy("day").collect()] == [
        ("2024-01-01", 1, 2, 0.5), ("2024-01-02", 1, 2, 0.5)]
    assert [(r["mean"], r.deviation, r.variation) for r in stability(df, "latency_ms").orderBy("day").collect()] == [
        (3.0, 1.0, 0.333333), (3.0, 3.0, 1.0)]
    assert trend_features(df.limit(0), ("latency_ms",)).count() == 0
