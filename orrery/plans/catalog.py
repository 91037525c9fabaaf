"""Query catalog for the driver contract: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole driver tables (through the events adapter)
and ends in :func:`stages.output` so integer / timestamp types match the
DuckDB oracle in :mod:`orrery.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import trends as TD
from ..operators.dedup import flag_first_wins, new_records, source_report
from ..operators.series import add_zscores, discover_metrics, fill_gaps, preprocess_report, series_features
from ..operators.validate import accepted, null_spikes, validation_issues
from ..specs import CURATED_COLUMNS, ROLLING_SUFFIXES
from ..session import staged_table
from . import stages as S

Query = Callable[[SparkSession, str], DataFrame]

# deterministic scoring rules standing in for a model in the metric checks:
# probability = least(1, metric * factor), predicted = probability >= 0.5
RULE_MODELS = (("error_rule", "error_rate", 5.0), ("drop_rule", "packet_drop_ratio", 20.0))
REGRESSION_BASELINES = (
    ("persistence", "target_next_latency_ms", "latency_ms"),
    ("persistence", "target_next_throughput_rps", "throughput_rps"),
    ("rolling_mean", "target_next_latency_ms", "latency_ms_roll_mean"),
    ("rolling_mean", "target_next_throughput_rps", "throughput_rps_roll_mean"),
)
WINDOW_KEYS = ("service_name", "host_id", "window_start")


# --- ingestion -------------------------------------------------------------

def q_adapter_raw(spark, sf):
    return S.output(S.raw(spark, sf))


def q_validate_accept(spark, sf):
    ok = accepted(S.validated(spark, sf))
    return S.output(ok.select("source_file", "row_number", *[c for c in CURATED_COLUMNS if c != "source_file"]))


def q_validation_issues(spark, sf):
    return S.output(validation_issues(S.validated(spark, sf)))


def q_issue_counts(spark, sf):
    issues = validation_issues(S.validated(spark, sf))
    return S.output(issues.groupBy("source_file", "code").agg(F.count(F.lit(1)).alias("issues")))


def q_fingerprint(spark, sf):
    ok = accepted(S.validated(spark, sf))
    return S.output(ok.select("source_file", "row_number", "timestamp", "metric_value", "record_fingerprint"))


def q_dedup_first_wins(spark, sf):
    cur = S.curated(spark, sf)
    return S.output(cur.select("source_file", "row_number", *[c for c in CURATED_COLUMNS if c != "source_file"]))


def q_dedup_report(spark, sf):
    return S.output(source_report(S.flagged(spark, sf)))


def q_incremental_anti_join(spark, sf):
    """Second batch ingested against the curated output of the first (one-day overlap)."""
    v = S.validated(spark, sf)
    first = new_records(flag_first_wins(v.where(F.col("ts") < F.lit(S.FIRST_BATCH_BEFORE).cast("timestamp_ntz"))))
    second = v.where(F.col("ts").isNull() | (F.col("ts") >= F.lit(S.SECOND_BATCH_FROM).cast("timestamp_ntz")))
    fresh = new_records(flag_first_wins(second, existing=first))
    return S.output(fresh.select("source_file", "row_number", "timestamp", "service_name", "host_id", "metric_name",
                                 "metric_value", "record_fingerprint"))


def q_null_spikes(spark, sf):
    return S.output(null_spikes(S.raw(spark, sf)))


def q_null_spikes_by_host(spark, sf):
    return S.output(null_spikes(S.raw(spark, sf), by=("source_file", "host_id")))


# --- cleaning and windows --------------------------------------------------

def q_canonical_units(spark, sf):
    cl = S.cleaned(spark, sf)
    return S.output(cl.select("record_fingerprint", "metric_name", "canonical_metric_name", "standardized_unit",
                              F.round("standardized_metric_value", 6).alias("standardized_metric_value")))


def q_window_floor(spark, sf):
    cl = S.cleaned(spark, sf)
    return S.output(cl.select("record_fingerprint", "timestamp", "window_start"))


def _windows(spark, sf):
    from ..operators.series import resample_long, widen

    long = staged_table(resample_long(S.cleaned(spark, sf)), "windows-long")
    metrics = discover_metrics(long)
    return widen(long, metrics), metrics


def q_window_resample(spark, sf):
    w, metrics = _windows(spark, sf)
    return S.output(w.select(*WINDOW_KEYS, *[F.round(f"_mean_{m}", 6).alias(m) for m in metrics]))


def q_event_rollup(spark, sf):
    w, _ = _windows(spark, sf)
    return S.output(w.select(*WINDOW_KEYS, "event_count", "is_anomaly",
                             F.round(F.col("event_count") / F.lit(float(S.WINDOW_MINUTES)), 6).alias("event_frequency")))


def q_event_summaries(spark, sf):
    w, _ = _windows(spark, sf)
    return S.output(w.where(F.col("event_summaries") != "").select(*WINDOW_KEYS, "event_summaries"))


def q_window_grid(spark, sf):
    w, metrics = _windows(spark, sf)
    grid = fill_gaps(w, metrics, window_minutes=S.WINDOW_MINUTES)
    present = F.greatest(*[F.col(f"_mean_{m}").isNotNull().cast("int") for m in metrics], F.lit(0))
    return S.output(grid.select(*WINDOW_KEYS, present.alias("has_metrics"), "event_count"))


def _base_features(spark, sf):
    w, metrics = _windows(spark, sf)
    grid = fill_gaps(w, metrics, window_minutes=S.WINDOW_MINUTES, as_runs=True)
    return series_features(grid, metrics, window_minutes=S.WINDOW_MINUTES, rolling_window_size=S.ROLLING_WINDOW), metrics


def q_locf(spark, sf):
    f, metrics = _base_features(spark, sf)
    return S.output(f.select(*WINDOW_KEYS, *[c for m in metrics for c in (m, f"{m}_was_imputed")]))


def q_rolling_stats(spark, sf):
    f, metrics = _base_features(spark, sf)
    return S.output(f.select(*WINDOW_KEYS, *[f"{m}_{s}" for m in metrics for s in ROLLING_SUFFIXES if s != "roll_slope"]))


def q_trend_features(spark, sf):
    f, _ = _base_features(spark, sf)
    return S.output(TD.trend_features(f, ("latency_ms", "throughput_rps")))


def _by_day(df):
    return S.output(df.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


def q_component_events(spark, sf):
    return _by_day(TD.event_frequency(_base_features(spark, sf)[0]))


def q_stability_ranges(spark, sf):
    return _by_day(TD.stability(_base_features(spark, sf)[0], "latency_ms"))


def q_rolling_slope(spark, sf):
    f, metrics = _base_features(spark, sf)
    return S.output(f.select(*WINDOW_KEYS, *[f"{m}_roll_slope" for m in metrics]))


def q_lead_targets(spark, sf):
    f, _ = _base_features(spark, sf)
    return S.output(f.select(*WINDOW_KEYS, "target_next_latency_ms", "target_next_throughput_rps"))


def q_burst(spark, sf):
    f, _ = _base_features(spark, sf)
    return S.output(f.select(*WINDOW_KEYS, "packet_drop_ratio", "packet_drop_burst_count"))


def q_derived_features(spark, sf):
    f, _ = _base_features(spark, sf)
    return S.output(f.select(*WINDOW_KEYS, "event_frequency", "request_error_ratio", "cpu_throughput_imbalance",
                             "short_term_latency_drift"))


def q_zscores(spark, sf):
    f, metrics = _base_features(spark, sf)
    z = add_zscores(f, metrics)
    return S.output(z.select(*WINDOW_KEYS, *[f"{m}_zscore" for m in metrics]))


def q_window_features(spark, sf):
    return S.output(S.features(spark, sf))


def q_preprocess_report(spark, sf):
    flags = S.cleaned_flags(spark, sf)
    f, metrics = _base_features(spark, sf)
    return S.output(preprocess_report(flags, f, metrics))


# --- features for models and metric checks ---------------------------------

def _equal_windows_once(spark, sf) -> DataFrame:
    """The features without repeats of equal windows: enough to know which columns have a value in every row."""
    return S.features(spark, sf, counted=True).drop("_windows")


def q_feature_columns(spark, sf):
    return S.output(M.feature_columns(_equal_windows_once(spark, sf)))


def q_feature_groups(spark, sf):
    return S.output(M.feature_groups(M.feature_columns(_equal_windows_once(spark, sf))))


def q_class_weights(spark, sf):
    return S.output(M.class_weights(S.features(spark, sf)))


def rule_scored(features: DataFrame) -> DataFrame:
    """Long scored table of the deterministic rule models (one pass, no union)."""
    models = F.array(*[
        F.struct(F.lit(name).alias("model_name"), F.least(F.lit(1.0), F.col(metric) * F.lit(factor)).alias("probability"))
        for name, metric, factor in RULE_MODELS])
    counted = ["_windows"] if "_windows" in features.columns else []
    out = features.select(*WINDOW_KEYS, F.col("is_anomaly").alias("label"), *counted, F.inline(models))
    return out.withColumn("prediction", (F.col("probability") >= F.lit(0.5)).cast("int"))


def regression_scored(features: DataFrame) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(name).alias("model_name"), F.lit(target).alias("target"), F.col(target).alias("label"),
                 F.col(pred).alias("prediction"))
        for name, target, pred in REGRESSION_BASELINES])
    return features.select(*WINDOW_KEYS, F.inline(rows)).where(F.col("label").isNotNull())


def _scored_once(spark, sf) -> DataFrame:
    """What the metrics read of the rule-scored table, written once: confusion counts and AUC both read it."""
    return staged_table(rule_scored(S.features(spark, sf)).select("model_name", "label", "prediction", "probability"), "rule-scored")


def _rule_confusion(spark, sf) -> DataFrame:
    return M.confusion(rule_scored(S.features(spark, sf, counted=True)), windows="_windows")


def q_confusion(spark, sf):
    return S.output(_rule_confusion(spark, sf))


def q_classification_metrics(spark, sf):
    return S.output(M.classification_metrics(_scored_once(spark, sf)))


def q_roc_auc(spark, sf):
    return S.output(M.roc_auc(_scored_once(spark, sf)))


def q_threshold_sweep(spark, sf):
    return S.output(M.threshold_sweep(_scored_once(spark, sf)))


def q_service_stability(spark, sf):
    return S.output(M.service_stability(rule_scored(S.features(spark, sf))))


def q_fpr(spark, sf):
    m = M.rates(_rule_confusion(spark, sf))
    return S.output(m.select("model_name", F.round("false_positive_rate", 6).alias("false_positive_rate")))


def q_regression_metrics(spark, sf):
    return S.output(M.regression_metrics(regression_scored(S.features(spark, sf))))


def q_classification_errors(spark, sf):
    return S.output(M.classification_errors(rule_scored(S.features(spark, sf))))


def q_regression_errors(spark, sf):
    return S.output(M.regression_errors(regression_scored(S.features(spark, sf))))


def q_cluster_summary(spark, sf):
    f = S.features(spark, sf)
    assigned = f.withColumn("cluster", F.least(F.floor(F.col("cpu_utilization") * 3.0), F.lit(2)).cast("int"))
    return S.output(M.cluster_summary(assigned))


QUERIES: dict[str, Query] = {
    "q_adapter_raw": q_adapter_raw,
    "q_validate_accept": q_validate_accept,
    "q_validation_issues": q_validation_issues,
    "q_issue_counts": q_issue_counts,
    "q_fingerprint": q_fingerprint,
    "q_dedup_first_wins": q_dedup_first_wins,
    "q_dedup_report": q_dedup_report,
    "q_incremental_anti_join": q_incremental_anti_join,
    "q_null_spikes": q_null_spikes,
    "q_null_spikes_by_host": q_null_spikes_by_host,
    "q_canonical_units": q_canonical_units,
    "q_window_floor": q_window_floor,
    "q_window_resample": q_window_resample,
    "q_event_rollup": q_event_rollup,
    "q_event_summaries": q_event_summaries,
    "q_window_grid": q_window_grid,
    "q_locf": q_locf,
    "q_rolling_stats": q_rolling_stats,
    "q_rolling_slope": q_rolling_slope,
    "q_trend_features": q_trend_features,
    "q_component_events": q_component_events,
    "q_stability_ranges": q_stability_ranges,
    "q_lead_targets": q_lead_targets,
    "q_burst": q_burst,
    "q_derived_features": q_derived_features,
    "q_zscores": q_zscores,
    "q_window_features": q_window_features,
    "q_preprocess_report": q_preprocess_report,
    "q_feature_columns": q_feature_columns,
    "q_feature_groups": q_feature_groups,
    "q_class_weights": q_class_weights,
    "q_confusion": q_confusion,
    "q_classification_metrics": q_classification_metrics,
    "q_roc_auc": q_roc_auc,
    "q_threshold_sweep": q_threshold_sweep,
    "q_service_stability": q_service_stability,
    "q_fpr": q_fpr,
    "q_regression_metrics": q_regression_metrics,
    "q_classification_errors": q_classification_errors,
    "q_regression_errors": q_regression_errors,
    "q_cluster_summary": q_cluster_summary,
}
