"""Rows that stand for several equal windows give what the table of all windows gives; fewer rows are made."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orrery.ml import train as TR
from orrery.operators import metrics as M
from orrery.operators.series import window_features
from orrery.plans import catalog as C

MIN = 60


def cleaned(spark):
    """Two series with gaps of 1 to 40 windows, bursts of packet drops and an anomaly; one row comes twice."""
    start, rows = datetime(2024, 1, 1), []
    for host, gaps in (("a", (1, 2, 3, 4, 5, 40, 1, 1)), ("b", (6, 3, 2, 9)), ("c", ())):
        at = 0
        for i, gap in enumerate((*gaps, 1)):
            metric = ("latency_ms", "packet_drop_ratio", "error_rate", "throughput_rps")[i % 4]
            value = {"packet_drop_ratio": 0.09 if i < 4 else 0.0, "error_rate": 0.2}.get(metric, 10.0 + i)
            rows += [("s", host, start + timedelta(minutes=MIN * at), metric, value, "event" if i == 2 else "metric", "anomaly" if i == 2 else "normal", "")]
            at += gap
    rows.append(rows[0])
    return spark.createDataFrame(rows, "service_name string, host_id string, window_start timestamp_ntz, canonical_metric_name string, "
                                       "standardized_metric_value double, event_type string, anomaly_label string, event_summary string")


@pytest.mark.parametrize("frame", [1, 2, 3, 12])
def test_counted_rows_stand_for_all_windows(spark, frame):
    make = lambda **how: window_features(cleaned(spark), window_minutes=MIN, rolling_window_size=frame, **how)
    grid, counted = make(), make(counted=True)
    assert counted.columns == [*grid.columns, "_windows"]
    agree = [c for c in grid.columns if c != "window_start"]
    seen = lambda df, n: {tuple(r)[:-1]: r.n for r in df.groupBy(*agree).agg(n.alias("n")).collect()}
    assert seen(grid, F.count(F.lit(1))) == seen(counted, F.sum("_windows"))
    if frame <= 8:
        assert counted.count() < 0.7 * grid.count() and counted.agg(F.max("_windows")).first()[0] > 30


def test_confusion_and_columns_of_counted_rows(spark):
    grid = window_features(cleaned(spark), window_minutes=MIN)
    counted = window_features(cleaned(spark), window_minutes=MIN, counted=True)
    expect = sorted(M.confusion(C.rule_scored(grid)).collect())
    assert sorted(M.confusion(C.rule_scored(counted), windows="_windows").collect()) == expect
    assert sum(expect[0][1:]) == grid.count()
    empty = M.confusion(C.rule_scored(counted).where("label = 0 AND prediction = 0"), windows="_windows").first()
    assert (empty.true_positive, empty.false_negative) == (0, 0)  # as a count gives it, not null
    assert M.feature_columns(counted.drop("_windows")).collect() == M.feature_columns(grid).collect()


def test_training_rows_fill_their_tasks(spark):
    table = spark.range(1000).repartition(200)
    tasks = lambda rows: TR.in_tasks(table, rows).rdd.getNumPartitions()
    assert tasks(2_000_000) == 25  # 100 before: split statistics are shuffled by task
    assert [tasks(n) for n in (0, 62_833, 160_000, 640_000, 640_001)] == [1, 4, 8, 8, 9]  # draws follow tasks: as before up to 160,000 rows


def test_buffer_of_a_forest_of_all_features_leaves_its_trees_alone(spark):
    rows = spark.range(0, 3000, 1, 3).select((F.col("id") * 7 % 101).cast("double").alias("x"), (F.col("id") * 13 % 89).cast("double").alias("y"),
                                             (F.col("id") * F.col("id") % 97).cast("double").alias("label"))
    rows = TR.assembler(["x", "y"]).transform(rows)
    est = TR._regressor("random_forest_regressor", seed=7, memory_mb=TR.TREE_MEMORY_MB)
    assert est.getMaxMemoryInMB() == TR.ALL_FEATURES_MEMORY_MB > TR.TREE_MEMORY_MB
    est = est.setNumTrees(4)
    trees = lambda m: m.toDebugString.split("\n", 1)[1]
    assert trees(est.fit(rows)) == trees(est.setMaxMemoryInMB(1).fit(rows))
