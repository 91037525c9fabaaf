"""Features of runs (a present window and the gap after it) are those of the grid, and only what is read is computed."""

import random
from datetime import datetime, timedelta

import pytest

from orrery.operators import metrics as M
from orrery.operators.series import MAX_RUN_FRAME, expand_runs, fill_gaps, series_features, window_features
from orrery.plans import stages as S

METRICS = ["error_rate", "latency_ms", "packet_drop_ratio", "throughput_rps"]


@pytest.fixture(scope="module")
def windows(spark):
    rng, rows = random.Random(2), []
    for series, span in (("a", 400), ("b", 60), ("c", 1), ("d", 3)):
        for i in sorted(rng.sample(range(span), max(1, span // 3))):
            burst = 0.5 if (i // 100) % 2 == 0 and series != "b" else 0.0
            latency = rng.choice([1e12, 0.1, float("nan"), float("inf"), float(rng.randint(1, 900)), None])
            rows.append(("svc", series, datetime(2024, 2, 28, 20) + timedelta(minutes=5 * i), rng.randint(0, 2), rng.randint(0, 1), f"s{i}",
                         rng.choice([rng.random(), None, None]), latency, rng.choice([burst, burst, None]), rng.choice([float(i), None])))
    schema = "service_name string, host_id string, window_start timestamp_ntz, event_count int, is_anomaly int, event_summaries string, "
    return spark.createDataFrame(rows, schema + ", ".join(f"_mean_{m} double" for m in METRICS)).cache()


def texts(df):
    return sorted(str(r) for r in df.collect())  # NaN equals itself as text


@pytest.mark.parametrize("rolling", [1, 2, 3, 5, MAX_RUN_FRAME + 1])
def test_runs_give_the_features_of_the_grid(windows, rolling):
    options = {"window_minutes": 5, "rolling_window_size": rolling, "keep_values": True}
    grid = series_features(fill_gaps(windows, METRICS, window_minutes=5), METRICS, **options)
    runs = series_features(fill_gaps(windows, METRICS, window_minutes=5, as_runs=True), METRICS, **options)
    assert runs.dtypes == grid.dtypes
    assert texts(runs) == texts(grid)


def test_a_run_is_one_row_until_it_is_expanded(windows):
    runs = fill_gaps(windows, METRICS, window_minutes=5, as_runs=True)
    assert runs.count() == windows.count()
    assert texts(expand_runs(runs, METRICS, window_minutes=5)) == texts(fill_gaps(windows, METRICS, window_minutes=5))


def test_a_report_computes_only_what_it_reads(spark):
    rows = [(f"2024-01-01T00:{i:02d}:00Z", "s", "h", "error_rate", str(i / 100), "ratio", "metric", "", "normal") for i in range(0, 60, 7)]
    cleaned = S.clean(spark.createDataFrame(rows, "timestamp string, service_name string, host_id string, metric_name string, metric_value string, "
                                                  "unit string, event_type string, event_summary string, anomaly_label string"), window_minutes=1)
    features = window_features(cleaned, window_minutes=1)
    assert features.count() == 57 and features.where("error_rate_zscore is null").count() == 0
    plan = M.class_weights(features)._jdf.queryExecution().optimizedPlan().toString()
    assert "stddev" not in plan and "roll_" not in plan


def test_scored_rows_are_staged_without_keys(spark, tmp_path, monkeypatch):
    from orrery.plans import catalog as C

    kept = []
    real = C.staged_table
    monkeypatch.setattr(C, "staged_table", lambda df, name: kept.append(df.columns) or real(df, name))
    rows = [("s", "h", datetime(2024, 1, 1, i), 1 if i > 6 else 0, i / 40, i / 100) for i in range(12)]
    table = spark.createDataFrame(rows, "service_name string, host_id string, window_start timestamp_ntz, is_anomaly int, "
                                        "error_rate double, packet_drop_ratio double")
    monkeypatch.setattr(S, "features", lambda *_: table)
    got = {r.model_name: r for r in C.q_classification_metrics(spark, "").collect()}
    assert kept == [["model_name", "label", "prediction", "probability"]]
    # the drop rule gives 1.0 from the sixth row on: two of the seven negatives tie with all positives
    assert {m: (r.roc_auc, r.true_positive + r.false_negative) for m, r in got.items()} == {"error_rule": (1.0, 5), "drop_rule": (0.857143, 5)}
