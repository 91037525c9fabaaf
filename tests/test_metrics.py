"""Metric operators against brute force on small fixtures."""

import random

import pytest

from orrery.operators import metrics as M


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rng = random.Random(7)
    rows = [("m1", rng.choice([0.1, 0.2, 0.2, 0.5, 0.9]), rng.randint(0, 1)) for _ in range(300)]
    rows += [("m2", rng.random(), rng.randint(0, 1)) for _ in range(300)]
    rows += [("m3", 0.3, 1) for _ in range(5)]
    df = spark.createDataFrame(rows, "model_name string, probability double, label int")
    got = {r["model_name"]: r["roc_auc"] for r in M.roc_auc(df, buckets=8).collect()}
    for m in ("m1", "m2"):
        assert got[m] == pytest.approx(brute_auc([(s, y) for mm, s, y in rows if mm == m]), abs=1e-12)
    assert got["m3"] is None


def test_rates_and_zero_division(spark):
    rows = [("a", 1, 1), ("a", 0, 1), ("a", 0, 0), ("b", 0, 0)]
    df = spark.createDataFrame(rows, "model_name string, label int, prediction int")
    out = {r["model_name"]: r for r in M.rates(M.confusion(df)).collect()}
    assert out["a"]["precision"] == 0.5 and out["a"]["recall"] == 1.0
    assert out["a"]["f1"] == pytest.approx(2 / 3)
    assert out["b"]["precision"] == 0.0 and out["b"]["f1"] == 0.0
    assert out["a"]["false_positive_rate"] == 0.5


def test_regression_metrics(spark):
    rows = [("m", "t", 1.0, 1.5), ("m", "t", 2.0, 2.0), ("m", "t", 3.0, 2.0), ("c", "t", 2.0, 2.0), ("c", "t", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "model_name string, target string, label double, prediction double")
    out = {r["model_name"]: r for r in M.regression_metrics(df).collect()}
    assert out["m"]["mae"] == pytest.approx(0.5)
    assert out["m"]["rmse"] == pytest.approx((1.25 / 3) ** 0.5, abs=1e-6)
    assert out["m"]["r2"] == pytest.approx(1 - 1.25 / 2.0, abs=1e-6)
    assert out["c"]["r2"] == 1.0


def test_feature_groups_precedence(spark):
    df = spark.createDataFrame([(n, i) for i, n in enumerate(
        ["cpu_utilization", "cpu_utilization_was_imputed", "cpu_utilization_zscore", "cpu_utilization_roll_mean",
         "event_count", "request_error_ratio"])], "feature_name string, position int")
    got = {r["feature_name"]: r["group_name"] for r in M.feature_groups(df).collect()}
    assert got == {"cpu_utilization": "base_metrics", "cpu_utilization_was_imputed": "imputation_flags",
                   "cpu_utilization_zscore": "normalized_scores", "cpu_utilization_roll_mean": "rolling_stats",
                   "event_count": "derived_operational", "request_error_ratio": "derived_operational"}
