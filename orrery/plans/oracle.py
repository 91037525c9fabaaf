"""DuckDB oracle SQL for every SQL-expressible query of the catalog.

The SQL is an independent formulation over the same driver views (events
etc.): an explicit grid join instead of the gap explode, gaps-and-islands
for the burst counter, ROW_NUMBER for first-wins, a plain window prefix
sum for the AUC.  Column names and types match :mod:`orrery.plans.catalog`.
"""

from __future__ import annotations

from ..specs import (
    DERIVED_FEATURES,
    EXCLUDED_FEATURE_COLUMNS,
    METRIC_CANONICAL,
    METRIC_DEFAULTS,
    METRIC_RANGES,
    MICROSECOND_UNITS,
    PER_MINUTE_UNITS,
    PERCENT_UNITS,
    SECOND_UNITS,
    range_message,
)
from ..sources import adapter as A
from . import stages as S
from .catalog import REGRESSION_BASELINES, RULE_MODELS

METRICS = sorted(METRIC_DEFAULTS)
W = S.WINDOW_MINUTES
K = S.ROLLING_WINDOW


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


_RANGE_BAD = " ".join(
    f"WHEN {_q(m)} THEN NOT (coalesce(v, 0.0::DOUBLE) BETWEEN {lo}::DOUBLE AND {hi}::DOUBLE)"
    for m, (lo, hi) in METRIC_RANGES.items())
_RANGE_MSG = " ".join(f"WHEN {_q(m)} THEN {_q(range_message(m))}" for m in METRIC_RANGES)
_CANON = " ".join(f"WHEN {_q(m)} THEN {_q(c)}" for m, (c, _) in METRIC_CANONICAL.items())
_CUNIT = " ".join(f"WHEN {_q(m)} THEN {_q(u)}" for m, (_, u) in METRIC_CANONICAL.items())

BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type AS et, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
),
src AS (
  SELECT *, {_q(A.PRIMARY_SOURCE)} AS source_file, 0 AS source_ordinal FROM ev
  UNION ALL
  SELECT *, {_q(A.REPLAY_SOURCE)} AS source_file, 1 AS source_ordinal FROM ev WHERE event_id % {A.REPLAY_EVERY} = 0
),
raw AS (
  SELECT
    CASE WHEN event_id % {A.BAD_TIMESTAMP_EVERY} = 0 THEN 'bad-timestamp'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp,
    CASE WHEN event_id % {A.BAD_SERVICE_EVERY} = 0 THEN 'bad service'
         ELSE 'svc-' || CAST(user_id % {A.SERVICE_COUNT} AS VARCHAR) END AS service_name,
    CASE WHEN event_id % {A.BLANK_HOST_EVERY} = 0 THEN '' ELSE 'host-' || CAST(user_id AS VARCHAR) END AS host_id,
    CASE et WHEN 'click' THEN CASE WHEN k < 50 THEN 'cpu_pct' ELSE 'memory_pct' END
            WHEN 'view' THEN 'throughput_rps' WHEN 'purchase' THEN 'latency_ms'
            WHEN 'signup' THEN 'packet_drop_pct'
            WHEN 'error' THEN CASE WHEN k < 30 THEN 'request_failures' ELSE 'error_rate' END END AS metric_name,
    CASE WHEN event_id % {A.TEXT_VALUE_EVERY} = 0 THEN 'oops' ELSE printf('%.4f',
      CASE et WHEN 'view' THEN value * 10.0::DOUBLE WHEN 'signup' THEN value / 50.0::DOUBLE
              WHEN 'error' THEN CASE WHEN k < 30 THEN floor(value) ELSE value / 500.0::DOUBLE END
              ELSE value END) END AS metric_value,
    CASE et WHEN 'click' THEN 'percent' WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'rpm' ELSE 'rps' END
            WHEN 'purchase' THEN CASE k % 3 WHEN 0 THEN 'ms' WHEN 1 THEN 's' ELSE 'us' END
            WHEN 'signup' THEN 'pct' WHEN 'error' THEN CASE WHEN k < 30 THEN 'count' ELSE 'ratio' END END AS unit,
    CASE WHEN et = 'error' THEN 'event' ELSE 'metric' END AS event_type,
    CASE WHEN et = 'error' THEN 'err-' || CAST(k % 10 AS VARCHAR) ELSE '' END AS event_summary,
    CASE WHEN event_id % {A.BAD_LABEL_EVERY} = 0 THEN 'weird' WHEN k = 0 THEN 'unknown'
         WHEN et = 'error' AND value > 100 THEN 'anomaly' ELSE 'normal' END AS anomaly_label,
    source_file, CAST(source_ordinal AS BIGINT) AS source_ordinal, CAST(event_id + 2 AS BIGINT) AS row_number
  FROM src
),
p AS (
  SELECT *,
    TRY_CAST(metric_value AS DOUBLE) AS v,
    CASE WHEN regexp_full_match(timestamp, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d{{1,6}})?Z')
         THEN TRY_CAST(replace(replace(timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP) END AS tsu,
    lower(anomaly_label) AS label_l
  FROM raw
),
chk AS (
  SELECT *,
    CASE WHEN tsu IS NULL THEN NULL ELSE strftime(tsu, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN strftime(tsu, '%f') <> '000000' THEN '.' || strftime(tsu, '%f') ELSE '' END || '+00:00' END AS ts_text,
    (timestamp = '') AS i1, (service_name = '') AS i2, (host_id = '') AS i3, (metric_name = '') AS i4,
    (tsu IS NULL) AS i5,
    (service_name <> '' AND NOT regexp_full_match(service_name, '[A-Za-z0-9][A-Za-z0-9_.-]{{1,63}}')) AS i6,
    (host_id <> '' AND NOT regexp_full_match(host_id, '[A-Za-z0-9][A-Za-z0-9_.-]{{1,63}}')) AS i7,
    (v IS NULL) AS i8,
    coalesce(CASE metric_name {_RANGE_BAD} ELSE false END, false) AS i9,
    (event_type NOT IN {_in(("metric", "event"))}) AS i10,
    (label_l NOT IN {_in(("normal", "anomaly", "unknown"))}) AS i11
  FROM p
),
val AS (
  SELECT *,
    CAST(i1 AS INT) + CAST(i2 AS INT) + CAST(i3 AS INT) + CAST(i4 AS INT) + CAST(i5 AS INT) + CAST(i6 AS INT)
      + CAST(i7 AS INT) + CAST(i8 AS INT) + CAST(i9 AS INT) + CAST(i10 AS INT) + CAST(i11 AS INT) AS n_issues,
    coalesce(v, 0.0::DOUBLE) AS value0
  FROM chk
),
acc AS (
  SELECT *, sha256(ts_text || '|' || service_name || '|' || host_id || '|' || metric_name || '|'
                   || printf('%.10f', value0) || '|' || event_type) AS fp
  FROM val WHERE n_issues = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fp ORDER BY source_ordinal, row_number) AS rn FROM acc
),
cur AS (SELECT * FROM ranked WHERE rn = 1),
issues AS (
  SELECT source_file, row_number, 'missing_field' AS code, 'Missing required field ''timestamp''' AS message FROM val WHERE i1
  UNION ALL SELECT source_file, row_number, 'missing_field', 'Missing required field ''service_name''' FROM val WHERE i2
  UNION ALL SELECT source_file, row_number, 'missing_field', 'Missing required field ''host_id''' FROM val WHERE i3
  UNION ALL SELECT source_file, row_number, 'missing_field', 'Missing required field ''metric_name''' FROM val WHERE i4
  UNION ALL SELECT source_file, row_number, 'invalid_timestamp', 'Timestamp must be ISO-8601 parseable' FROM val WHERE i5
  UNION ALL SELECT source_file, row_number, 'invalid_service_name', 'service_name contains unsupported characters' FROM val WHERE i6
  UNION ALL SELECT source_file, row_number, 'invalid_host_id', 'host_id contains unsupported characters' FROM val WHERE i7
  UNION ALL SELECT source_file, row_number, 'invalid_metric_value', 'metric_value must be numeric' FROM val WHERE i8
  UNION ALL SELECT source_file, row_number, 'invalid_metric_range', CASE metric_name {_RANGE_MSG} END FROM val WHERE i9
  UNION ALL SELECT source_file, row_number, 'invalid_event_type', 'event_type must be ''metric'' or ''event''' FROM val WHERE i10
  UNION ALL SELECT source_file, row_number, 'invalid_anomaly_label', 'anomaly_label must be normal, anomaly, or unknown' FROM val WHERE i11
),
cl AS (
  SELECT fp AS record_fingerprint, ts_text AS timestamp, tsu AS ts, date_trunc('hour', tsu) AS window_start,
    service_name, host_id, metric_name,
    CASE metric_name {_CANON} ELSE metric_name END AS canonical_metric_name,
    CASE metric_name {_CUNIT} ELSE lower(trim(unit)) END AS standardized_unit,
    lower(trim(unit)) AS unit_l, value0 AS raw_value, event_type, event_summary, label_l AS anomaly_label
  FROM cur
),
cl2 AS (
  SELECT *,
    CASE WHEN standardized_unit = 'ratio' AND unit_l IN {_in(PERCENT_UNITS)} THEN raw_value / 100.0::DOUBLE
         WHEN standardized_unit = 'ms' AND unit_l IN {_in(SECOND_UNITS)} THEN raw_value * 1000.0::DOUBLE
         WHEN standardized_unit = 'ms' AND unit_l IN {_in(MICROSECOND_UNITS)} THEN raw_value / 1000.0::DOUBLE
         WHEN standardized_unit = 'rps' AND unit_l IN {_in(PER_MINUTE_UNITS)} THEN raw_value / 60.0::DOUBLE
         ELSE raw_value END AS standardized_metric_value
  FROM cl
),
win AS (
  SELECT service_name, host_id, window_start,
    CAST(count_if(event_type = 'event') AS BIGINT) AS event_count,
    max(CASE WHEN anomaly_label = 'anomaly' THEN 1 ELSE 0 END) AS is_anomaly,
    coalesce(array_to_string(list_sort(list_distinct(list(event_summary) FILTER (WHERE event_summary <> ''))), ' | '), '')
      AS event_summaries,
    {", ".join(f"avg(CASE WHEN canonical_metric_name = {_q(m)} THEN standardized_metric_value END) AS mean_{m}" for m in METRICS)}
  FROM cl2 GROUP BY service_name, host_id, window_start
),
bounds AS (SELECT service_name, host_id, min(window_start) AS lo, max(window_start) AS hi FROM win GROUP BY service_name, host_id),
grid AS (
  SELECT service_name, host_id, unnest(generate_series(lo, hi, INTERVAL {W} MINUTE)) AS window_start FROM bounds
),
g AS (
  SELECT grid.service_name, grid.host_id, grid.window_start,
    coalesce(win.event_count, 0) AS event_count, coalesce(win.is_anomaly, 0) AS is_anomaly,
    coalesce(win.event_summaries, '') AS event_summaries,
    {", ".join(f"win.mean_{m}" for m in METRICS)}
  FROM grid LEFT JOIN win USING (service_name, host_id, window_start)
),
locf AS (
  SELECT *,
    {", ".join(f"coalesce(mean_{m}, last_value(mean_{m} IGNORE NULLS) OVER wr, 0.0::DOUBLE) AS v_{m}" for m in METRICS)},
    {", ".join(f"CASE WHEN mean_{m} IS NULL THEN 1 ELSE 0 END AS {m}_was_imputed" for m in METRICS)}
  FROM g
  WINDOW wr AS (PARTITION BY service_name, host_id ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
roll AS (
  SELECT *,
    {", ".join(f'''round(v_{m}, 6) AS {m},
    round(avg(v_{m}) OVER w3, 6) AS {m}_roll_mean,
    round(stddev_pop(v_{m}) OVER w3, 6) AS {m}_roll_std,
    round(min(v_{m}) OVER w3, 6) AS {m}_roll_min,
    round(max(v_{m}) OVER w3, 6) AS {m}_roll_max,
    round(CASE WHEN count(v_{m}) OVER w3 > 1
               THEN (v_{m} - first_value(v_{m}) OVER w3) / (count(v_{m}) OVER w3 - 1) ELSE 0.0::DOUBLE END, 6) AS {m}_roll_slope'''
                for m in METRICS)},
    lead(round(v_latency_ms, 6)) OVER wo AS target_next_latency_ms,
    lead(round(v_throughput_rps, 6)) OVER wo AS target_next_throughput_rps
  FROM locf
  WINDOW w3 AS (PARTITION BY service_name, host_id ORDER BY window_start ROWS BETWEEN {K - 1} PRECEDING AND CURRENT ROW),
         wo AS (PARTITION BY service_name, host_id ORDER BY window_start)
),
isl AS (
  SELECT *, sum(CASE WHEN packet_drop_ratio > 0.01::DOUBLE THEN 0 ELSE 1 END) OVER (
      PARTITION BY service_name, host_id ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM roll
),
base AS (
  SELECT *,
    CAST({W} AS BIGINT) AS window_minutes,
    round(event_count / {float(W)}::DOUBLE, 6) AS event_frequency,
    round(CASE WHEN error_rate <> 0 THEN error_rate WHEN throughput_rps <> 0 THEN request_failures / throughput_rps
               ELSE 0.0::DOUBLE END, 6) AS request_error_ratio,
    round(CASE WHEN throughput_rps <> 0 THEN cpu_utilization / throughput_rps ELSE 0.0::DOUBLE END, 9) AS cpu_throughput_imbalance,
    round(latency_ms - latency_ms_roll_mean, 6) AS short_term_latency_drift,
    CASE WHEN packet_drop_ratio > 0.01::DOUBLE THEN sum(CASE WHEN packet_drop_ratio > 0.01::DOUBLE THEN 1 ELSE 0 END) OVER (
      PARTITION BY service_name, host_id, island ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      ELSE 0 END AS packet_drop_burst_count
  FROM isl
),
zst AS (
  SELECT {", ".join(f"avg({m}) AS mu_{m}, stddev_pop({m}) AS sd_{m}" for m in METRICS)} FROM base
),
feat AS (
  SELECT base.*,
    {", ".join(f"CASE WHEN coalesce(sd_{m}, 0) = 0 THEN 0.0::DOUBLE ELSE round(({m} - mu_{m}) / sd_{m}, 6) END AS {m}_zscore"
               for m in METRICS)}
  FROM base CROSS JOIN zst
),
sc AS (
  {" UNION ALL ".join(
      f"SELECT service_name, host_id, window_start, is_anomaly AS label, {_q(name)} AS model_name, "
      f"least(1.0::DOUBLE, {metric} * {factor}::DOUBLE) AS probability FROM feat"
      for name, metric, factor in RULE_MODELS)}
),
scored AS (SELECT *, CASE WHEN probability >= 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction FROM sc),
rscored AS (
  {" UNION ALL ".join(
      f"SELECT service_name, host_id, window_start, {_q(name)} AS model_name, {_q(target)} AS target, "
      f"{target} AS label, {pred} AS prediction FROM feat WHERE {target} IS NOT NULL"
      for name, target, pred in REGRESSION_BASELINES)}
)
"""

FEATURE_ORDER = (
    ["window_start", "window_minutes", "service_name", "host_id", "event_count", "event_frequency", "event_summaries",
     "is_anomaly", "target_next_latency_ms", "target_next_throughput_rps"]
    + [f"{m}{s}" for m in METRICS for s in ("", "_was_imputed", "_roll_mean", "_roll_std", "_roll_min", "_roll_max",
                                            "_roll_slope")]
    + ["request_error_ratio", "cpu_throughput_imbalance", "short_term_latency_drift", "packet_drop_burst_count"]
    + [f"{m}_zscore" for m in METRICS]
)
INT_COLUMNS = {"window_minutes", "event_count", "is_anomaly", "packet_drop_burst_count"} | {
    f"{m}_was_imputed" for m in METRICS}
WS = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"
KEYS = f"service_name, host_id, {WS}"


def _feature_select(cols) -> str:
    out = []
    for c in cols:
        if c == "window_start":
            out.append(WS)
        elif c in INT_COLUMNS:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def _with(select: str) -> str:
    return f"WITH {BASE}\n{select}"


def _rates(src: str, by: str) -> str:
    return f"""
SELECT {by}, tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive,
  CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
  fp / greatest(fp + tn, 1.0) AS false_positive_rate
FROM (
  SELECT {by}, CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) AS tn, CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count_if(label = 1 AND prediction = 0) AS DOUBLE) AS fn, CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp,
    CAST(count(*) AS DOUBLE) AS n
  FROM {src} GROUP BY {by})"""


def _with_f1(rates_sql: str) -> str:
    return f"SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM ({rates_sql})"


AUC = """
SELECT model_name, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
  THEN sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) END AS roc_auc
FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name ORDER BY probability
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT model_name, probability, count_if(label = 1) AS pos, count_if(label = 0) AS neg
        FROM scored GROUP BY model_name, probability))
GROUP BY model_name"""


def _feature_columns_sql() -> str:
    cands = [c for c in FEATURE_ORDER if c not in EXCLUDED_FEATURE_COLUMNS]
    parts = " UNION ALL ".join(
        f"SELECT {_q(c)} AS feature_name, {i} AS pos, count(*) - count({c}) - count_if(isnan({c}::DOUBLE)) AS nulls FROM feat"
        for i, c in enumerate(cands))
    return (f"SELECT feature_name, CAST(row_number() OVER (ORDER BY pos) - 1 AS BIGINT) AS position FROM ({parts}) "
            f"WHERE nulls = 0")


def _group_case(col: str) -> str:
    return (f"CASE WHEN suffix({col}, '_was_imputed') THEN 'imputation_flags' "
            f"WHEN suffix({col}, '_zscore') THEN 'normalized_scores' "
            f"WHEN contains({col}, '_roll_') THEN 'rolling_stats' "
            f"WHEN {col} IN {_in(DERIVED_FEATURES)} THEN 'derived_operational' ELSE 'base_metrics' END")


def _null_spikes(by: str) -> str:
    fields = ("timestamp", "service_name", "host_id", "metric_name", "metric_value")
    parts = " UNION ALL ".join(
        f"SELECT {by}, {_q(f)} AS field, CAST(sum(CASE WHEN {f} IS NULL OR trim({f}) = '' THEN 1 ELSE 0 END) AS DOUBLE) "
        f"/ count(*) AS ratio FROM raw GROUP BY {by}" for f in fields)
    return f"SELECT * FROM ({parts}) WHERE ratio >= 0.2"


def half_up_round(sql: str) -> str:
    """Rewrite every round(x, n) as half-up rounding of x's shortest decimal text.

    That is Spark's round() on DOUBLE; DuckDB's own round() scales the
    binary value instead, which differs on near-ties (0.0040585 -> ...58 vs ...59).
    """
    out, i, token = [], 0, "round("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k, comma = 1, j + len(token), None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg = half_up_round(sql[j + len(token):comma])
        places = sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(CAST(CAST(({arg}) AS VARCHAR) AS DECIMAL(38, {places})) AS DOUBLE)")
        i = k


THRESHOLDS = "unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[])"

REQUEST_ORDER = tuple(METRIC_DEFAULTS)  # request features keep the reference's metric order
HIST = 3  # previous present windows carried as history


def _request_features_sql() -> str:
    ms = REQUEST_ORDER
    hist = ", ".join(
        f"list_filter([" + ", ".join(f"lag(mean_{m}, {i}) OVER w" for i in range(HIST, 0, -1))
        + f"], lambda x: x IS NOT NULL) AS h_{m}" for m in ms)
    lines = [f"""
, rq AS (
  SELECT service_name, host_id, window_start, event_count AS ev, {", ".join(f"mean_{m} AS o_{m}" for m in ms)}, {hist}
  FROM win WINDOW w AS (PARTITION BY service_name, host_id ORDER BY window_start)
),
rc AS (SELECT *, {", ".join(f"coalesce(o_{m}, h_{m}[-1], 0.0::DOUBLE) AS c_{m}, "
                            f"CASE WHEN o_{m} IS NULL THEN 1.0 ELSE 0.0 END AS i_{m}" for m in ms)} FROM rq),
rs AS (SELECT *, {", ".join(f"list_append(h_{m}, c_{m}) AS s_{m}" for m in ms)} FROM rc),
rr AS (SELECT *, {", ".join(f"list_slice(s_{m}, greatest(len(s_{m}) - {S.ROLLING_WINDOW - 1}, 1), len(s_{m})) AS r_{m}"
                            for m in ms)} FROM rs),
rm AS (SELECT *, {", ".join(f"list_reduce(r_{m}, lambda a, x: a + x) / len(r_{m}) AS rmu_{m}, "
                            f"list_reduce(s_{m}, lambda a, x: a + x) / len(s_{m}) AS smu_{m}" for m in ms)} FROM rr),
rf AS (SELECT *, {", ".join(
        f"sqrt(list_reduce(list_transform(r_{m}, lambda x: (x - rmu_{m}) * (x - rmu_{m})), lambda a, b: a + b) / len(r_{m})) AS rsd_{m}, "
        f"sqrt(list_reduce(list_transform(s_{m}, lambda x: (x - smu_{m}) * (x - smu_{m})), lambda a, b: a + b) / len(s_{m})) AS ssd_{m}"
        for m in ms)} FROM rm)
SELECT service_name, host_id, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS window_start,
  CAST({W} AS BIGINT) AS window_minutes, CAST({S.ROLLING_WINDOW} AS BIGINT) AS rolling_window_size,"""]
    cols = []
    for m in ms:
        cols += [
            f"round(c_{m}, 6) AS {m}", f"round(i_{m}, 6) AS {m}_was_imputed", f"round(rmu_{m}, 6) AS {m}_roll_mean",
            f"round(rsd_{m}, 6) AS {m}_roll_std", f"round(list_min(r_{m}), 6) AS {m}_roll_min",
            f"round(list_max(r_{m}), 6) AS {m}_roll_max",
            f"round(CASE WHEN len(r_{m}) > 1 THEN (r_{m}[-1] - r_{m}[1]) / (len(r_{m}) - 1) ELSE 0.0::DOUBLE END, 6) AS {m}_roll_slope",
            f"round(CASE WHEN len(s_{m}) <= 1 OR ssd_{m} = 0 THEN 0.0::DOUBLE ELSE (c_{m} - smu_{m}) / ssd_{m} END, 6) AS {m}_zscore",
        ]
    cols += [
        "round(CAST(ev AS DOUBLE), 6) AS event_count",
        f"round(CAST(ev AS DOUBLE) / {float(W)}::DOUBLE, 6) AS event_frequency",
        "round(CASE WHEN c_error_rate <> 0 THEN c_error_rate WHEN c_throughput_rps <> 0 "
        "THEN c_request_failures / c_throughput_rps ELSE 0.0::DOUBLE END, 6) AS request_error_ratio",
        "round(CASE WHEN c_throughput_rps <> 0 THEN c_cpu_utilization / c_throughput_rps ELSE 0.0::DOUBLE END, 6) "
        "AS cpu_throughput_imbalance",
        "round(c_latency_ms - rmu_latency_ms, 6) AS short_term_latency_drift",
        "round(CASE WHEN c_packet_drop_ratio > 0.01::DOUBLE THEN 1.0 ELSE 0.0 END, 6) AS packet_drop_burst_count",
    ]
    return lines[0] + "\n  " + ",\n  ".join(cols) + "\nFROM rf"


def _stream_series_sql() -> str:
    cols = ["event_count", "event_frequency", "is_anomaly"]
    cols += [f"{m}{x}" for m in METRICS for x in ("", "_was_imputed", "_roll_mean", "_roll_std", "_roll_min",
                                                    "_roll_max", "_roll_slope")]
    cols += ["request_error_ratio", "cpu_throughput_imbalance", "short_term_latency_drift", "packet_drop_burst_count"]
    sel = ", ".join(f"CAST(b.{c} AS BIGINT) AS {c}" if c in INT_COLUMNS else f"b.{c}" for c in cols)
    return f"""
SELECT b.service_name, b.host_id, strftime(b.window_start, '%Y-%m-%d %H:%M:%S') AS window_start, {sel}
FROM base b"""


SQL: dict[str, str] = {
    "q_stream_series": _with(_stream_series_sql()),
    "q_request_features": _with(_request_features_sql()),
    "q_stream_ingest": _with(
        "SELECT source_file, row_number, fp AS record_fingerprint, ts_text AS timestamp, service_name, host_id, "
        "metric_name, value0 AS metric_value, event_type FROM acc"),
    "q_stream_dedup": _with(
        "SELECT DISTINCT fp AS record_fingerprint, ts_text AS timestamp, service_name, host_id, metric_name, "
        "value0 AS metric_value, event_type FROM acc"),
    "q_stream_windows": _with(
        f"SELECT {KEYS}, event_count, CAST(is_anomaly AS BIGINT) AS is_anomaly, "
        + ", ".join(f"round(mean_{m}, 6) AS {m}" for m in METRICS)
        + " FROM win"),
    "q_adapter_raw": _with("SELECT * FROM raw"),
    "q_validate_accept": _with(
        "SELECT source_file, row_number, ts_text AS timestamp, service_name, host_id, metric_name, value0 AS metric_value, "
        "unit, event_type, event_summary, label_l AS anomaly_label, event_type AS source_type, fp AS record_fingerprint FROM acc"),
    "q_validation_issues": _with("SELECT * FROM issues"),
    "q_issue_counts": _with("SELECT source_file, code, CAST(count(*) AS BIGINT) AS issues FROM issues GROUP BY source_file, code"),
    "q_fingerprint": _with(
        "SELECT source_file, row_number, ts_text AS timestamp, value0 AS metric_value, fp AS record_fingerprint FROM acc"),
    "q_dedup_first_wins": _with(
        "SELECT source_file, row_number, ts_text AS timestamp, service_name, host_id, metric_name, value0 AS metric_value, "
        "unit, event_type, event_summary, label_l AS anomaly_label, event_type AS source_type, fp AS record_fingerprint FROM cur"),
    "q_dedup_report": _with(
        "SELECT v.source_file, CAST(count(*) AS BIGINT) AS total_rows_seen, "
        "CAST(count_if(v.n_issues = 0 AND r.rn = 1) AS BIGINT) AS rows_written, "
        "CAST(count_if(v.n_issues = 0 AND r.rn > 1) AS BIGINT) AS duplicate_rows, "
        "CAST(sum(v.n_issues) AS BIGINT) AS validation_errors, CAST(count_if(v.n_issues > 0) AS BIGINT) AS rejected_rows "
        "FROM val v LEFT JOIN ranked r USING (source_file, row_number) GROUP BY v.source_file"),
    "q_incremental_anti_join": _with(f"""
, b1 AS (SELECT fp FROM (SELECT fp, row_number() OVER (PARTITION BY fp ORDER BY source_ordinal, row_number) AS r1
                         FROM acc WHERE tsu < TIMESTAMP '{S.FIRST_BATCH_BEFORE}') WHERE r1 = 1),
b2 AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY source_ordinal, row_number) AS r2
       FROM acc WHERE tsu >= TIMESTAMP '{S.SECOND_BATCH_FROM}')
SELECT source_file, row_number, ts_text AS timestamp, service_name, host_id, metric_name, value0 AS metric_value,
       fp AS record_fingerprint
FROM b2 WHERE r2 = 1 AND fp NOT IN (SELECT fp FROM b1)"""),
    "q_null_spikes": _with(_null_spikes("source_file")),
    "q_null_spikes_by_host": _with(_null_spikes("source_file, host_id")),
    "q_canonical_units": _with(
        "SELECT record_fingerprint, metric_name, canonical_metric_name, standardized_unit, "
        "round(standardized_metric_value, 6) AS standardized_metric_value FROM cl2"),
    "q_window_floor": _with(f"SELECT record_fingerprint, timestamp, {WS} FROM cl2"),
    "q_window_resample": _with(f"SELECT {KEYS}, " + ", ".join(f"round(mean_{m}, 6) AS {m}" for m in METRICS) + " FROM win"),
    "q_event_rollup": _with(
        f"SELECT {KEYS}, event_count, CAST(is_anomaly AS BIGINT) AS is_anomaly, "
        f"round(event_count / {float(W)}::DOUBLE, 6) AS event_frequency FROM win"),
    "q_event_summaries": _with(f"SELECT {KEYS}, event_summaries FROM win WHERE event_summaries <> ''"),
    "q_window_grid": _with(
        f"SELECT {KEYS}, CAST(CASE WHEN " + " OR ".join(f"mean_{m} IS NOT NULL" for m in METRICS)
        + " THEN 1 ELSE 0 END AS BIGINT) AS has_metrics, CAST(event_count AS BIGINT) AS event_count FROM g"),
    "q_locf": _with(f"SELECT {KEYS}, " + ", ".join(
        f"{m}, CAST({m}_was_imputed AS BIGINT) AS {m}_was_imputed" for m in METRICS) + " FROM base"),
    "q_rolling_stats": _with(f"SELECT {KEYS}, " + ", ".join(
        f"{m}_{s}" for m in METRICS for s in ("roll_mean", "roll_std", "roll_min", "roll_max")) + " FROM base"),
    "q_rolling_slope": _with(f"SELECT {KEYS}, " + ", ".join(f"{m}_roll_slope" for m in METRICS) + " FROM base"),
    "q_trend_features": _with(f"SELECT {KEYS}, " + ", ".join(
        f"lag({m}) OVER o AS {m}_lag, round({m} - lag({m}) OVER o, 6) AS {m}_change, "
        f"round(CASE WHEN lag({m}) OVER o = 0 THEN 0.0::DOUBLE ELSE ({m} - lag({m}) OVER o) / lag({m}) OVER o END, 6) AS {m}_change_rate, "
        f"round(var_pop({m}) OVER (PARTITION BY service_name, host_id ORDER BY base.window_start ROWS 2 PRECEDING), 6) AS {m}_roll_variance, "
        f"CASE WHEN count({m}) OVER d = 25 THEN round({m} - avg({m}) OVER d, 6) END AS {m}_long_drift"
        for m in ("latency_ms", "throughput_rps")) + " FROM base WINDOW o AS (PARTITION BY service_name, host_id ORDER BY base.window_start), "
        "d AS (PARTITION BY service_name, host_id ORDER BY base.window_start ROWS 24 PRECEDING)"),
    "q_component_events": _with(
        "SELECT service_name, strftime(base.window_start, '%Y-%m-%d') AS day, CAST(sum(event_count) AS BIGINT) AS events, "
        "count(*) AS windows, round(sum(event_count)::DOUBLE / count(*), 6) AS events_per_window FROM base GROUP BY ALL"),
    "q_stability_ranges": _with(
        "SELECT service_name, strftime(base.window_start, '%Y-%m-%d') AS day, round(avg(latency_ms), 6) AS mean, "
        "round(stddev_pop(latency_ms), 6) AS deviation, round(CASE WHEN avg(latency_ms) = 0 THEN 0.0::DOUBLE "
        "ELSE stddev_pop(latency_ms) / avg(latency_ms) END, 6) AS variation FROM base GROUP BY 1, 2"),
    "q_lead_targets": _with(f"SELECT {KEYS}, target_next_latency_ms, target_next_throughput_rps FROM base"),
    "q_burst": _with(f"SELECT {KEYS}, packet_drop_ratio, CAST(packet_drop_burst_count AS BIGINT) AS packet_drop_burst_count FROM base"),
    "q_derived_features": _with(
        f"SELECT {KEYS}, event_frequency, request_error_ratio, cpu_throughput_imbalance, short_term_latency_drift FROM base"),
    "q_zscores": _with(f"SELECT {KEYS}, " + ", ".join(f"{m}_zscore" for m in METRICS) + " FROM feat"),
    "q_window_features": _with(f"SELECT {_feature_select(FEATURE_ORDER)} FROM feat"),
    "q_preprocess_report": _with(
        "SELECT (SELECT CAST(count(*) AS BIGINT) FROM cur) AS rows_read, (SELECT CAST(count(*) AS BIGINT) FROM cl2) AS cleaned_rows_written, "
        "CAST(0 AS BIGINT) AS dropped_rows, CAST(0 AS BIGINT) AS non_numeric_rows, "
        "(SELECT CAST(count(*) AS BIGINT) FROM base) AS window_rows_written, "
        "(SELECT CAST(sum(" + " + ".join(f"{m}_was_imputed" for m in METRICS) + ") AS BIGINT) FROM base) AS imputed_values"),
    "q_feature_columns": _with(_feature_columns_sql()),
    "q_feature_groups": _with(
        f"SELECT feature_name, position, {_group_case('feature_name')} AS group_name FROM ({_feature_columns_sql()})"),
    "q_class_weights": _with(
        "SELECT CAST(is_anomaly AS BIGINT) AS is_anomaly, CAST(rows AS BIGINT) AS rows, "
        "round(sum(rows) OVER () / (count(*) OVER () * rows), 6) AS weight "
        "FROM (SELECT is_anomaly, count(*) AS rows FROM feat GROUP BY is_anomaly)"),
    "q_confusion": _with(
        "SELECT model_name, CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS true_negative, "
        "CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS false_positive, "
        "CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS false_negative, "
        "CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS true_positive FROM scored GROUP BY model_name"),
    "q_classification_metrics": _with(
        "SELECT m.model_name, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        "round(f1, 6) AS f1, round(a.roc_auc, 6) AS roc_auc, CAST(true_negative AS BIGINT) AS true_negative, "
        "CAST(false_positive AS BIGINT) AS false_positive, CAST(false_negative AS BIGINT) AS false_negative, "
        "CAST(true_positive AS BIGINT) AS true_positive, round(false_positive_rate, 6) AS false_positive_rate "
        f"FROM ({_with_f1(_rates('scored', 'model_name'))}) m LEFT JOIN ({AUC}) a USING (model_name)"),
    "q_roc_auc": _with(AUC),
    "q_threshold_sweep": _with(
        "SELECT m.model_name, threshold, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, "
        "round(recall, 6) AS recall, round(f1, 6) AS f1, round(a.roc_auc, 6) AS roc_auc FROM ("
        + _with_f1(_rates(f"(SELECT model_name, label, threshold, CASE WHEN probability >= threshold THEN 1 ELSE 0 END "
                          f"AS prediction FROM scored CROSS JOIN (SELECT {THRESHOLDS} AS threshold))",
                          "model_name, threshold"))
        + f") m LEFT JOIN ({AUC}) a USING (model_name)"),
    "q_service_stability": _with(
        "SELECT model_name, service_name, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
        "FROM scored GROUP BY model_name, service_name"),
    "q_fpr": _with(f"SELECT model_name, round(false_positive_rate, 6) AS false_positive_rate FROM ({_rates('scored', 'model_name')})"),
    "q_regression_metrics": _with(
        "SELECT model_name, target, CAST(count(*) AS BIGINT) AS rows, round(avg(abs(prediction - label)), 6) AS mae, "
        "round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse, "
        "round(CASE WHEN var_pop(label) * count(*) = 0 THEN CASE WHEN sum((prediction - label) * (prediction - label)) = 0 "
        "THEN 1.0 ELSE 0.0 END ELSE 1 - sum((prediction - label) * (prediction - label)) / (var_pop(label) * count(*)) END, 6) AS r2, "
        "round(avg(abs(prediction - label) / greatest(abs(label), 2.220446049250313e-16)), 6) AS mape "
        "FROM rscored GROUP BY model_name, target"),
    "q_classification_errors": _with(
        f"SELECT model_name, {WS}, service_name, host_id, CAST(label AS BIGINT) AS true_label, "
        "CAST(prediction AS BIGINT) AS predicted_label, round(probability, 6) AS predicted_probability, "
        "CAST(CASE WHEN label = prediction THEN 1 ELSE 0 END AS BIGINT) AS correct FROM scored"),
    "q_regression_errors": _with(
        f"SELECT model_name, target, {WS}, service_name, host_id, round(label, 6) AS actual, round(prediction, 6) AS predicted, "
        "round(prediction - label, 6) AS residual, round(abs(prediction - label), 6) AS absolute_error FROM rscored"),
    "q_cluster_summary": _with(
        "SELECT CAST(least(floor(cpu_utilization * 3.0::DOUBLE), 2) AS BIGINT) AS cluster, CAST(count(*) AS BIGINT) AS size, "
        "round(avg(CAST(is_anomaly AS DOUBLE)), 6) AS anomaly_rate FROM feat GROUP BY 1"),
}
SQL = {name: half_up_round(text) for name, text in SQL.items()}
