"""Model metrics over a long scored table.

A scored table has one row per (model, window): ``model_name``, ``label``
(0/1 or a real target), ``prediction`` and optionally ``probability``.
Every metric is a ``groupBy`` with partial aggregation; nothing is
collected per model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..specs import DERIVED_FEATURES, EXCLUDED_FEATURE_COLUMNS, MAPE_EPSILON, THRESHOLD_STEPS
from .prefix import prefix_sums


def _div0(num, den):
    """num / den, 0 when den is 0 (sklearn zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def confusion(scored: DataFrame, by: tuple[str, ...] = ("model_name",), label: str = "label",
              prediction: str = "prediction", also: Sequence[Column] = (), windows: str | None = None) -> DataFrame:
    """Tn, fp, fn, tp with labels [0, 1], and the aggregates of ``also``; a row counts as ``windows`` rows if that column is named."""
    y, p = F.col(label), F.col(prediction)

    def count(where: Column) -> Column:
        return F.count_if(where) if windows is None else F.coalesce(F.sum(F.when(where, F.col(windows))), F.lit(0).cast("long"))

    return scored.groupBy(*by).agg(
        count((y == 0) & (p == 0)).alias("true_negative"),
        count((y == 0) & (p == 1)).alias("false_positive"),
        count((y == 1) & (p == 0)).alias("false_negative"),
        count((y == 1) & (p == 1)).alias("true_positive"),
        *also,
    )


def rates(conf: DataFrame, by: tuple[str, ...] = ("model_name",)) -> DataFrame:
    """D9 + D13 from confusion counts: accuracy, precision, recall, f1, false-positive rate."""
    tn, fp, fn, tp = (F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive"))
    n = tn + fp + fn + tp
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    staged = conf.select(*by, "true_negative", "false_positive", "false_negative", "true_positive",
                         _div0(tp + tn, n).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
                         (fp / F.greatest(fp + tn, F.lit(1))).alias("false_positive_rate"))
    p, r = F.col("precision"), F.col("recall")
    return staged.withColumn("f1", _div0(2 * p * r, p + r))


def score_levels(scored: DataFrame, by: tuple[str, ...], label: str = "label", score: str = "probability") -> DataFrame:
    """(group, score, _pos, _neg): labels 1 and 0 of each score level; all that the metrics below need to know."""
    y = F.col(label)
    return scored.groupBy(*by, score).agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))


def roc_auc(scored: DataFrame, by: tuple[str, ...] = ("model_name",), label: str = "label",
            score: str = "probability", buckets: int | None = None) -> DataFrame:
    """Exact, tie-aware ROC-AUC per group (Mann-Whitney); NULL for one class.

    AUC = sum over score levels of pos * (negatives below + negatives tied / 2) / (P * N).
    "Negatives below" is a prefix sum over the sorted levels, so no group is
    sorted in one task (``buckets``: ranges of levels, by default the shuffle partitions).
    """
    return auc_of_levels(score_levels(scored, by, label, score), by, score, buckets)


def auc_of_levels(levels: DataFrame, by: tuple[str, ...], score: str = "probability", buckets: int | None = None) -> DataFrame:
    ranked = prefix_sums(levels.where(F.col(score).isNotNull()), by, (score,), {"_neg": "_below"}, buckets)
    agg = ranked.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    return agg.select(*by, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                  F.col("_u") / (F.col("_p") * F.col("_n"))).alias("roc_auc"))


def classification_metrics(scored: DataFrame, by: tuple[str, ...] = ("model_name",), *, with_auc: bool = True) -> DataFrame:
    """D8-D10, D13 in one table, rounded to 6 places as the reports are."""
    out = rates(confusion(scored, by), by)
    if with_auc and "probability" in scored.columns:
        out = out.join(roc_auc(scored, by), list(by), "left")
    else:
        out = out.withColumn("roc_auc", F.lit(None).cast("double"))
    return out.select(*by, *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")],
                      "true_negative", "false_positive", "false_negative", "true_positive",
                      F.round("false_positive_rate", 6).alias("false_positive_rate"))


def threshold_sweep(scored: DataFrame, by: tuple[str, ...] = ("model_name",),
                    thresholds: tuple[float, ...] = THRESHOLD_STEPS) -> DataFrame:
    """predicted = probability >= t for t in 0.1..0.9; AUC repeated per row.

    Rows are counted once, by score level; thresholds and AUC are sums over the levels.
    """
    levels = materialize(score_levels(scored, by), "levels")
    hit = [F.col("probability") >= F.lit(float(t)) for t in thresholds]
    count = lambda side, where: F.coalesce(F.sum(F.when(where, F.col(side))), F.lit(0))
    counts = levels.groupBy(*by).agg(F.array(*[F.struct(
        F.lit(float(t)).alias("threshold"), count("_neg", ~h).alias("true_negative"), count("_neg", h).alias("false_positive"),
        count("_pos", ~h).alias("false_negative"), count("_pos", h).alias("true_positive"))
        for t, h in zip(thresholds, hit, strict=True)]).alias("_at"))
    m = rates(counts.select(*by, F.inline("_at")), (*by, "threshold"))
    auc = auc_of_levels(levels, by)
    return m.join(auc, list(by), "left").select(
        *by, "threshold", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")])


def service_stability(scored: DataFrame, by: tuple[str, ...] = ("model_name",)) -> DataFrame:
    """Per-service accuracy."""
    correct = (F.col("label") == F.col("prediction")).cast("double")
    return scored.groupBy(*by, "service_name").agg(F.round(F.avg(correct), 6).alias("accuracy"))


def regression_metrics(scored: DataFrame, by: tuple[str, ...] = ("model_name", "target")) -> DataFrame:
    """D11 + D12: MAE, RMSE, R2 (sklearn conventions for a constant target), MAPE."""
    y, yhat = F.col("label"), F.col("prediction")
    e = yhat - y
    agg = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("_mse"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(MAPE_EPSILON))).alias("mape"),
    )
    r2 = F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
        1 - F.col("_sse") / F.col("_sst"))
    return agg.select(*by, "rows", F.round("mae", 6).alias("mae"), F.round(F.sqrt("_mse"), 6).alias("rmse"),
                      F.round(r2, 6).alias("r2"), F.round("mape", 6).alias("mape"))


def classification_errors(scored: DataFrame) -> DataFrame:
    """V2: one row per (model, window)."""
    return scored.select(
        "model_name", "window_start", "service_name", "host_id",
        F.col("label").cast("int").alias("true_label"), F.col("prediction").cast("int").alias("predicted_label"),
        F.round("probability", 6).alias("predicted_probability"),
        (F.col("label") == F.col("prediction")).cast("int").alias("correct"))


def regression_errors(scored: DataFrame) -> DataFrame:
    """V3: actual, predicted, residual, absolute error."""
    e = F.col("prediction") - F.col("label")
    return scored.select(
        "model_name", "target", "window_start", "service_name", "host_id",
        F.round("label", 6).alias("actual"), F.round("prediction", 6).alias("predicted"),
        F.round(e, 6).alias("residual"), F.round(F.abs(e), 6).alias("absolute_error"))


def cluster_summary(assigned: DataFrame, cluster: str = "cluster", label: str = "is_anomaly") -> DataFrame:
    """Size and anomaly rate per cluster."""
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"),
                                         F.round(F.avg(F.col(label).cast("double")), 6).alias("anomaly_rate"))


def class_weights(features: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """D17 + K9: balanced weights n / (classes * n_c)."""
    counts = features.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(F.sum("rows").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return counts.crossJoin(F.broadcast(totals)).select(
        label, "rows", F.round(F.col("_n") / (F.col("_k") * F.col("rows")), 6).alias("weight"))


def feature_columns(features: DataFrame) -> DataFrame:
    """Numeric columns with a value in every row, minus the 8 excluded.

    One aggregation pass counts NULLs of every candidate column; the
    column list itself comes from the schema (bounded by the table width).
    """
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    candidates = [(i, c) for i, (c, t) in enumerate(features.dtypes)
                  if c not in EXCLUDED_FEATURE_COLUMNS and (t in numeric or t.startswith("decimal"))]
    nulls = features.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c)
                           for _, c in candidates])
    stack = "stack({n}, {pairs}) AS (feature_name, position, null_rows)".format(
        n=len(candidates), pairs=", ".join(f"'{c}', {pos}, `{c}`" for pos, (_, c) in enumerate(candidates)))
    long = nulls.select(F.expr(stack)).where(F.col("null_rows") == 0)
    order = Window.orderBy("position")  # one row per column: width-bounded
    return long.select("feature_name", (F.row_number().over(order) - 1).alias("position"))


#: V4: (pattern, group) in order of precedence; the last pattern takes every name.
FEATURE_GROUP_PATTERNS = (
    (r"_was_imputed$", "imputation_flags"),
    (r"_zscore$", "normalized_scores"),
    (r"_roll_", "rolling_stats"),
    (f"^({'|'.join(DERIVED_FEATURES)})$", "derived_operational"),
    (r"", "base_metrics"),
)


def feature_group_of(name):
    """The group of the first pattern found in the name."""
    found = [F.when(name.rlike(pattern), F.lit(group)) for pattern, group in FEATURE_GROUP_PATTERNS]
    return F.coalesce(*found)


def feature_groups(columns: DataFrame) -> DataFrame:
    """(feature_name, position, group_name); empty groups simply have no rows."""
    return columns.withColumn("group_name", feature_group_of(F.col("feature_name")))
