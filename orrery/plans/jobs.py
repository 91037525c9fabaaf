"""End-to-end jobs (spark-submit entry points): ingest, features, train, evaluate, score.

Each job reads and writes tables under an output root; stages hand over
through written tables, which also cut lineage (a lost executor only
recomputes from the last written table).  Layout::

    <out>/bronze/run=...               raw records of the run, untyped (A9)
    <out>/quarantine/run=...           lines that could not be read, with their place (A3)
    <out>/curated/run=.../event_date=  accepted, de-duplicated records (A10)
    <out>/validation_issues/run=...    one row per issue (B8)
    <out>/ingest_reports/run=...       one row per source path (A12, D6, B10)
    <out>/ingest_manifest/run=...      checksum of every ingested file, the run's commit record (A15)
    <out>/cleaned, <out>/features      preprocessing output (A11)
    <out>/models/<name>, <out>/model_registry     trained models (A13, M10)
    <out>/evaluation/<table>           evaluation tables (V1-V8)
    <out>/predictions                  scoring log (A14)
"""

from __future__ import annotations

import hashlib
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml import evaluate as E
from ..ml import train as TR
from ..operators import metrics as M
from ..operators.dedup import flag_first_wins, prune_existing, source_report
from ..operators.series import clean_flags, preprocess_report, window_features
from ..operators.validate import null_spikes, validate, validation_issues
from ..sources.files import file_checksums
from ..sources.telemetry import read_telemetry
from ..specs import CURATED_COLUMNS, STATUS_INGESTED, STATUS_SKIPPED
from .score import build_request_features, log_predictions, score_requests


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


# --- ingest ------------------------------------------------------------------

COUNTS = ("total_rows_seen", "rows_written", "duplicate_rows", "validation_errors", "rejected_rows")


def _part(run_id: str) -> str:
    """Folder of a run within a table; hashed, so that no id is read back as a number or a date."""
    return "run=r" + hashlib.sha256(run_id.encode()).hexdigest()[:24]


def _write_part(df: DataFrame, table: str, run_id: str, by: str | None = None) -> DataFrame:
    """Replace the run's part of a table; returns the part as written."""
    path = f"{table}/{_part(run_id)}"
    writer = df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema.add("run_id", "string")).parquet(path)


def _other_runs(spark: SparkSession, table: str, run_id: str) -> DataFrame | None:
    """What other runs wrote; None if the table is not there."""
    return spark.read.parquet(table).where(F.col("run_id") != run_id).drop("run") if _exists(spark, table) else None


def ingest_job(spark: SparkSession, inputs: list[str], out: str, *, run_id: str,
               sql_table: str = "telemetry") -> DataFrame:
    """Ingest files once each (checksum manifest), validate, de-duplicate, add to curated.

    Every table has a part for each run, which the run replaces; it reads
    the parts of other runs only.  A run that is started again, after a crash
    or not, therefore leaves what one run leaves.  The manifest part is the
    commit record and is written last.  Of inputs with equal content the
    first is ingested.  Lines that cannot be read are kept with their place
    under ``quarantine`` and count as rejected rows.
    """
    if not inputs:
        raise ValueError("At least one input source is required")
    inputs = list(dict.fromkeys(inputs))
    sums = file_checksums(spark, inputs)
    manifest = _other_runs(spark, f"{out}/ingest_manifest", run_id)
    known = set()
    if manifest is not None:
        known = {r["checksum"] for r in sums.join(manifest.select("checksum"), "checksum", "left_semi").select("checksum").collect()}
    fresh, skipped = {}, {}
    for r in sorted(sums.collect(), key=lambda r: r["source_ordinal"]):  # one row per input file
        again = r["checksum"] in known or r["checksum"] in fresh.values()
        (skipped if again else fresh)[r["path"]] = r["checksum"]
    rows = [(p, os.path.basename(p.rstrip("/")), i, c, STATUS_INGESTED) for i, (p, c) in enumerate(fresh.items())]
    rows += [(p, os.path.basename(p.rstrip("/")), len(fresh) + i, c, STATUS_SKIPPED) for i, (p, c) in enumerate(skipped.items())]
    sources = spark.createDataFrame(rows, "path string, source_file string, source_ordinal int, checksum string, status string")
    none = F.create_map().cast("map<string,double>")
    if fresh:
        raw = read_telemetry(spark, list(fresh), sql_table=sql_table)
        bronze = _write_part(raw, f"{out}/bronze", run_id).drop("run_id")
        unreadable = bronze.where(F.col("corrupt_record").isNotNull()).select("source_file", "source_ordinal", "row_number", "corrupt_record")
        _write_part(unreadable, f"{out}/quarantine", run_id)
        validated = validate(bronze)
        existing = _other_runs(spark, f"{out}/curated", run_id)
        if existing is not None:
            existing = prune_existing(existing, validated.where(F.size("issues") == 0))
        flagged = _write_part(flag_first_wins(validated, existing), f"{out}/_staging", run_id).drop("run_id")
        _write_part(flagged.where("is_written").select(*CURATED_COLUMNS, "ts", F.to_date("ts").alias("event_date")),
                    f"{out}/curated", run_id, "event_date")
        _write_part(validation_issues(flagged), f"{out}/validation_issues", run_id)
        spikes = null_spikes(bronze, by=("source_ordinal",)).groupBy("source_ordinal").agg(
            F.map_from_entries(F.collect_list(F.struct("field", "ratio"))).alias("null_spikes"))
        counts = source_report(flagged, ("source_ordinal",)).join(spikes, "source_ordinal", "left")
        report = sources.join(counts, "source_ordinal", "left")
    else:
        report = sources.withColumns({c: F.lit(0).cast("long") for c in COUNTS}).withColumn("null_spikes", none)
    report = report.select("source_file", "path", "status", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
                           F.coalesce("null_spikes", none).alias("null_spikes"), "checksum")
    report = _write_part(report, f"{out}/ingest_reports", run_id)
    # the commit record: a crash before this point leaves the files to be read again
    _write_part(sources.where(F.col("status") == STATUS_INGESTED).select("checksum", "source_file", "path"), f"{out}/ingest_manifest", run_id)
    return report


# --- features ----------------------------------------------------------------

def features_job(spark: SparkSession, curated_path: str, out: str, *, window_minutes: int = 1,
                 rolling_window_size: int = 3) -> DataFrame:
    curated = spark.read.parquet(curated_path)
    flags = clean_flags(curated, window_minutes=window_minutes)
    (flags.where(~F.col("_dropped")).drop("_dropped", "_bad_value")
     .repartition("service_name", "host_id").sortWithinPartitions("service_name", "host_id", "timestamp",
                                                                   "canonical_metric_name")
     .write.mode("overwrite").parquet(f"{out}/cleaned"))
    cleaned = spark.read.parquet(f"{out}/cleaned")
    features = window_features(cleaned, window_minutes=window_minutes, rolling_window_size=rolling_window_size)
    (features.sortWithinPartitions("service_name", "host_id", "window_start")
     .write.mode("overwrite").parquet(f"{out}/features"))
    written = spark.read.parquet(f"{out}/features")
    metrics = [c[: -len("_was_imputed")] for c in written.columns if c.endswith("_was_imputed")]
    report = preprocess_report(flags, written, metrics).select(
        "*", F.lit(window_minutes).alias("window_minutes"), F.lit(rolling_window_size).alias("rolling_window_size"),
        F.array(*[F.lit(m) for m in sorted(metrics)]).alias("metric_names"))
    report.write.mode("overwrite").parquet(f"{out}/preprocessing_report")
    return spark.read.parquet(f"{out}/preprocessing_report")


# --- train -------------------------------------------------------------------

def train_job(spark: SparkSession, features_path: str, out: str, *, test_size: float = 0.4, seed: int = 42,
              classifiers=TR.CLASSIFIER_NAMES, regressors=TR.REGRESSOR_NAMES, unsupervised: bool = True) -> DataFrame:
    features = spark.read.parquet(features_path)
    n = features.limit(TR.MIN_ROWS).count()
    if n < TR.MIN_ROWS:
        raise ValueError("At least four feature rows are required for model training")
    columns = TR.select_feature_columns(features)
    prepared = TR.prepare(features, columns, test_size=test_size, seed=seed)
    rows = []
    cls = TR.fit_classifiers(prepared, columns, names=classifiers, seed=seed)
    reg = TR.fit_regressors(features, columns, names=regressors, test_size=test_size, seed=seed)
    test = TR.with_split(features, test_size=test_size, seed=seed).where(F.col("split") == "test")
    if cls:
        metrics = {r["model_name"]: r.asDict() for r in M.classification_metrics(TR.score_classifiers(cls, test)).collect()}
    else:
        metrics = {}
    for tm in cls:
        path = f"{out}/models/{tm.name}"
        tm.model.write().overwrite().save(path)
        rows.append(("classification", tm.name, tm.target, path, columns, tm.train_rows, tm.test_rows,
                     {k: v for k, v in metrics.get(tm.name, {}).items() if isinstance(v, float)}))
    if reg:
        rmetrics = {(r["model_name"], r["target"]): r.asDict()
                    for r in M.regression_metrics(TR.score_regressors(reg, test)).collect()}
    else:
        rmetrics = {}
    for tm in reg:
        path = f"{out}/models/{tm.name}_{tm.target}"
        tm.model.write().overwrite().save(path)
        m = rmetrics.get((tm.name, tm.target), {})
        rows.append(("regression", tm.name, tm.target, path, columns, tm.train_rows, tm.test_rows,
                     {k: v for k, v in m.items() if isinstance(v, float)}))
    if unsupervised:
        forest = TR.fit_isolation_forest(prepared, seed=seed)
        forest_path = f"{out}/models/isolation_forest"
        forest.write.mode("overwrite").parquet(forest_path)
        scored = E.scored_isolation_forest(spark.read.parquet(forest_path), prepared)
        iso = M.classification_metrics(scored, with_auc=False).first().asDict()
        n_all = prepared.count()
        rows.append(("unsupervised", "isolation_forest", "unsupervised", forest_path, columns, n_all, 0,
                     {k: v for k, v in iso.items() if isinstance(v, float)}))
        km, k = TR.fit_kmeans(prepared, seed=seed)
        if km is not None:
            km_path = f"{out}/models/kmeans"
            km.write().overwrite().save(km_path)
            sil = TR.silhouette(E.kmeans_assign(km, prepared))
            rows.append(("unsupervised", "kmeans", "unsupervised", km_path, columns, n_all, 0,
                         {"silhouette_score": float(sil), "cluster_count": float(k)}))
    registry = spark.createDataFrame(rows, "task string, model_name string, target string, path string, "
                                           "feature_columns array<string>, train_rows long, test_rows long, "
                                           "metrics map<string,double>")
    registry.write.mode("overwrite").parquet(f"{out}/model_registry")
    return spark.read.parquet(f"{out}/model_registry")


def load_models(spark: SparkSession, registry_path: str, task: str) -> list[TR.TrainedModel]:
    """Registry rows of one task -> loaded pipeline models (small: one row per model)."""
    rows = spark.read.parquet(registry_path).where(F.col("task") == task).collect()
    return [TR.TrainedModel(r["model_name"], r["target"], PipelineModel.load(r["path"]), list(r["feature_columns"]),
                            r["train_rows"], r["test_rows"]) for r in rows]


# --- evaluate ----------------------------------------------------------------

def evaluate_job(spark: SparkSession, features_path: str, registry_path: str, out: str, *, repeats: int = 25) -> dict:
    """All rows are scored (M11); every table is written under <out>/evaluation."""
    features = spark.read.parquet(features_path)
    target = f"{out}/evaluation"
    cls = load_models(spark, registry_path, "classification")
    reg = load_models(spark, registry_path, "regression")
    written = {}

    def save(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{target}/{name}")
        written[name] = f"{target}/{name}"

    if cls:
        save("classification_scored", TR.score_classifiers(cls, features))
        scored = spark.read.parquet(written["classification_scored"])
        save("classification_metrics", M.classification_metrics(scored))
        save("threshold_sweeps", M.threshold_sweep(scored))
        save("classification_errors", M.classification_errors(scored))
        save("service_stability", M.service_stability(scored))
        save("classification_ablation", E.ablation(cls, features))
    if reg:
        save("regression_scored", TR.score_regressors(reg, features))
        rscored = spark.read.parquet(written["regression_scored"])
        save("regression_metrics", M.regression_metrics(rscored))
        save("regression_errors", M.regression_errors(rscored))
        save("regression_ablation", E.ablation(reg, features))
    if cls or reg:
        save("feature_importance", E.importances(spark, cls + reg))
        timing = [(tm.name, tm.target, *E.benchmark_scoring(tm, features, repeats=repeats).values()) for tm in cls + reg]
        save("operational", spark.createDataFrame(timing, "model_name string, target string, batch_latency_ms_mean double, "
                                                          "batch_latency_ms_p95 double, batch_latency_ms_min double, "
                                                          "batch_latency_ms_max double, throughput_rows_per_sec double"))
    return written


# --- score -------------------------------------------------------------------

def score_job(spark: SparkSession, requests: DataFrame, registry_path: str, out: str) -> DataFrame:
    """W1-W3 for a DataFrame of S6 requests; valid requests are scored and logged, others quarantined."""
    feats = build_request_features(requests)
    (feats.where(F.col("request_issue").isNotNull()).select("service_name", "host_id", "window_start", "request_issue")
     .write.mode("append").parquet(f"{out}/rejected_requests"))
    valid = feats.where(F.col("request_issue").isNull()).drop("window_start").withColumnRenamed(
        "window_start_normalized", "window_start")
    scored = score_requests(valid, load_models(spark, registry_path, "classification"),
                            load_models(spark, registry_path, "regression"))
    log_predictions(scored, f"{out}/predictions")
    return scored
