"""Window features (preprocessing): B11, B12, K1-K7, D1-D5, D7, C3-C6, E1-E6.

Plan shape (one shuffle per arrow):

    cleaned --[hash (service, host, window, metric), partial agg]--> windows by metric
            --[hash (service, host)]--> windows -> runs (a present window and
            the gap after it) -> LOCF + lead + burst (one sort of the runs)
            -> rolling frames -> rows of the grid
    features --[global one-row agg]--> stats --scalar subquery--> z-scores

Raw rows are pre-aggregated per (service, host, window) before the series
shuffle, so a hot series only carries one row per window into its task:
its size is bounded by time span / window length, not by its row count.
Gaps are filled by exploding the distance to the next present window
(no grid join, no min/max pass), after the features are known: a window
that is filled in has the values of the run's present window, so only runs
are sorted and framed, and a frame is computed once for all windows of a
run that it does not reach out of.  Nothing is written for the z-scores:
a report that does not read them does not compute them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import canonical_name, canonical_unit, convert_value, floor_window, parse_float, py_strip, unit_key, with_parsed_iso
from ..specs import METRIC_DEFAULTS, PACKET_DROP_BURST_THRESHOLD, SUMMARY_SEPARATOR

KEYS = ("service_name", "host_id")
MAX_METRICS = 500
DEFAULT_MAX_WINDOWS_PER_SERIES = 10_000_000
#: Longest rolling frame that is computed on runs (one expression for each window of the frame).
MAX_RUN_FRAME = 8


def check_window_minutes(window_minutes: int, rolling_window_size: int = 3) -> None:
    if window_minutes < 1 or 60 % window_minutes != 0:
        # Q3: with 60 % w != 0 the reference's hour-anchored floor falls off
        # its own grid and rows vanish; only divisors of 60 are exact.
        raise ValueError("window_minutes must divide 60")
    if rolling_window_size < 1:
        raise ValueError("rolling_window_size must be >= 1")


def _text(name: str) -> Column:
    return py_strip(F.coalesce(F.col(name).cast("string"), F.lit("")))


def clean_flags(curated: DataFrame, *, window_minutes: int, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Curated rows -> cleaned rows (S4) plus ``_dropped`` (B11) and ``_bad_value`` (Q11)."""
    ts_text = _text("timestamp")
    value_type = dict(curated.dtypes).get("metric_value", "string")
    if value_type in ("double", "float", "int", "bigint", "decimal"):
        value = F.col("metric_value").cast("double")
        bad_value = F.lit(False)
    else:
        text = _text("metric_value")
        value = parse_float(F.col("metric_value"))
        bad_value = (text != "") & value.isNull()
    event_type = _text("event_type")
    label = F.lower(py_strip(F.coalesce(F.col("anomaly_label").cast("string"), F.lit("unknown"))))
    source_type = _text("source_type") if "source_type" in curated.columns else F.lit("")
    staged0 = curated.select(
        *passthrough,
        ts_text.alias("_ts_raw"),
        (F.col("ts").cast("timestamp_ntz") if "ts" in curated.columns else F.lit(None).cast("timestamp_ntz")).alias("_ts_in"),
        _text("service_name").alias("service_name"),
        _text("host_id").alias("host_id"),
        _text("metric_name").alias("metric_name"),
        unit_key(F.col("unit")).alias("_unit"),
        value.alias("_value"),
        bad_value.alias("_bad_value"),
        F.when(event_type == "", F.lit("metric")).otherwise(event_type).alias("event_type"),
        _text("event_summary").alias("event_summary"),
        F.when(label == "", F.lit("unknown")).otherwise(label).alias("anomaly_label"),
        F.when(source_type != "", source_type).when(event_type != "", event_type).otherwise(F.lit("metric")).alias("source_type"),
        (_text("source_file") if "source_file" in curated.columns else F.lit("")).alias("source_file"),
        (_text("record_fingerprint") if "record_fingerprint" in curated.columns else F.lit("")).alias("record_fingerprint"),
    )
    if "ts" in curated.columns:
        # curated tables written by this package carry the parsed UTC instant
        staged = staged0.withColumn("_ts_text", F.col("_ts_raw")).withColumn("_ts", F.col("_ts_in"))
    else:
        staged = with_parsed_iso(staged0, F.col("_ts_raw"), text="_ts_text", ts="_ts")
    missing = ((F.col("_ts_raw") == "") | (F.col("service_name") == "") | (F.col("host_id") == "")
               | (F.col("metric_name") == "") | F.col("_ts").isNull())
    metric = F.col("metric_name")
    return staged.select(
        *passthrough,
        F.col("_ts_text").alias("timestamp"),
        F.col("_ts").alias("ts"),
        floor_window(F.col("_ts"), window_minutes).alias("window_start"),
        "service_name",
        "host_id",
        "metric_name",
        canonical_name(metric).alias("canonical_metric_name"),
        convert_value(metric, F.col("_unit"), F.col("_value")).alias("standardized_metric_value"),
        canonical_unit(metric, F.col("_unit")).alias("standardized_unit"),
        "event_type",
        "event_summary",
        "anomaly_label",
        "source_type",
        "source_file",
        "record_fingerprint",
        (missing | F.col("_bad_value")).alias("_dropped"),
        F.col("_bad_value"),
    )


def clean(curated: DataFrame, *, window_minutes: int, passthrough: tuple[str, ...] = ()) -> DataFrame:
    flags = clean_flags(curated, window_minutes=window_minutes, passthrough=passthrough)
    return flags.where(~F.col("_dropped")).drop("_dropped", "_bad_value")


def discover_metrics(cleaned: DataFrame) -> list[str]:
    """D3: sorted distinct canonical names (bounded; refuses above MAX_METRICS)."""
    rows = cleaned.select("canonical_metric_name").distinct().limit(MAX_METRICS + 1).collect()
    if len(rows) > MAX_METRICS:
        raise ValueError(f"more than {MAX_METRICS} distinct metrics; pass the metric list explicitly")
    return sorted(r[0] for r in rows)


def resample(cleaned: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per present (service, host, window)."""
    name = F.col("canonical_metric_name")
    value = F.col("standardized_metric_value")
    return cleaned.groupBy(*KEYS, "window_start").agg(
        F.count_if(F.col("event_type") == "event").cast("int").alias("event_count"),
        F.max(F.when(F.col("anomaly_label") == "anomaly", 1).otherwise(0)).alias("is_anomaly"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("event_summary") != "", F.col("event_summary")))),
                     SUMMARY_SEPARATOR).alias("event_summaries"),
        *[F.avg(F.when(name == m, value)).alias(f"_mean_{m}") for m in metrics],
    )


def resample_long(cleaned: DataFrame) -> DataFrame:
    """D1/D2 in long form: one row per (service, host, window, metric), partial-aggregated.

    Much smaller than the cleaned rows; checkpointing it lets the metric list
    be discovered without recomputing ingestion.
    """
    return cleaned.groupBy(*KEYS, "window_start", "canonical_metric_name").agg(
        F.avg("standardized_metric_value").alias("_mean"),
        F.count_if(F.col("event_type") == "event").alias("_events"),
        F.max(F.when(F.col("anomaly_label") == "anomaly", 1).otherwise(0)).alias("_anomaly"),
        F.collect_set(F.when(F.col("event_summary") != "", F.col("event_summary"))).alias("_summaries"),
    )


def widen(long: DataFrame, metrics: list[str]) -> DataFrame:
    """Long windows -> the wide shape of :func:`resample` (one row per window).

    Partitioned by series, as the gap filling needs it: one shuffle for both.
    """
    name = F.col("canonical_metric_name")
    return long.repartition(*KEYS).groupBy(*KEYS, "window_start").agg(
        F.sum("_events").cast("int").alias("event_count"),
        F.max("_anomaly").alias("is_anomaly"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_summaries")))), SUMMARY_SEPARATOR)
        .alias("event_summaries"),
        *[F.max(F.when(name == m, F.col("_mean"))).alias(f"_mean_{m}") for m in metrics],
    )


def window_slot(ts: Column, window_minutes: int) -> Column:
    """Zone-free window index: minutes since 1970-01-01 divided by w."""
    minutes = (F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 1440
               + F.hour(ts) * 60 + F.minute(ts))
    return F.floor(minutes / F.lit(window_minutes)).cast("long")


def block_of(window_minutes: int, block_windows: int) -> Column:
    """Number of the time block of ``block_windows`` slots that a window lies in."""
    return F.floor(window_slot(F.col("window_start"), window_minutes) / F.lit(block_windows)).cast("long")


def across_blocks(blocks: DataFrame, **carried: Column) -> DataFrame:
    """(service, host, _block, carried...) of one row per block: window expressions over the blocks of a series.

    The only step that sees a series as a whole; it has one row per
    ``block_windows`` windows.
    """
    return blocks.select(*KEYS, "_block", *[c.alias(name) for name, c in carried.items()])


def blocks_in_order():
    return Window.partitionBy(*KEYS).orderBy("_block")


def blocks_before():
    return blocks_in_order().rowsBetween(Window.unboundedPreceding, -1)


def fill_gaps(windows: DataFrame, metrics: list[str], *, window_minutes: int,
              max_windows_per_series: int = DEFAULT_MAX_WINDOWS_PER_SERIES, block_windows: int | None = None,
              as_runs: bool = False) -> DataFrame:
    """D4 + C3: every window between a series' first and last present window.

    Each present window explodes into itself plus the missing windows up to
    the next present one; missing windows carry NULL metrics, no events.
    With ``block_windows`` a series is cut into time blocks, and only the
    first slot of each block goes to the one before it.  With ``as_runs`` a
    present window stays one row, with the number of windows in ``_gap``, for
    :func:`series_features`; :func:`expand_runs` gives the grid.
    """
    slot = window_slot(F.col("window_start"), window_minutes)
    if block_windows is None:
        order = Window.partitionBy(*KEYS).orderBy("window_start")
        gap = F.coalesce(F.lead(slot).over(order) - slot, F.lit(1))
        staged = windows.select("*", gap.alias("_gap"))
    else:
        windows = windows.withColumn("_block", block_of(window_minutes, block_windows))
        order = Window.partitionBy(*KEYS, "_block").orderBy("window_start")
        firsts = windows.groupBy(*KEYS, "_block").agg(F.min(slot).alias("_first"))
        after = across_blocks(firsts, _after=F.lead("_first").over(blocks_in_order()))
        gap = F.coalesce(F.coalesce(F.lead(slot).over(order), F.col("_after")) - slot, F.lit(1))
        staged = windows.join(after, [*KEYS, "_block"]).withColumn("_gap", gap).drop("_block", "_after")
    guarded = F.when(F.col("_gap") > max_windows_per_series,
                     F.raise_error(F.lit(f"series grid exceeds {max_windows_per_series} windows"))).otherwise(F.col("_gap"))
    runs = staged.withColumn("_gap", guarded.cast("long"))
    return runs if as_runs else expand_runs(runs, metrics, window_minutes=window_minutes)


def expand_runs(runs: DataFrame, metrics: list[str], *, window_minutes: int) -> DataFrame:
    """The grid of the runs of :func:`fill_gaps`."""
    exploded = runs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_gap") - 1)).alias("_k"))
    present = F.col("_k") == 0
    cols = [
        *KEYS,
        F.timestamp_add("MINUTE", F.col("_k") * window_minutes, F.col("window_start")).alias("window_start"),
        F.when(present, F.col("event_count")).otherwise(F.lit(0)).alias("event_count"),
        F.when(present, F.col("is_anomaly")).otherwise(F.lit(0)).alias("is_anomaly"),
        F.when(present, F.col("event_summaries")).otherwise(F.lit("")).alias("event_summaries"),
    ]
    cols += [F.when(present, F.col(f"_mean_{m}")).alias(f"_mean_{m}") for m in metrics]
    return exploded.select(*cols)


def series_features(grid: DataFrame, metrics: list[str], *, window_minutes: int, rolling_window_size: int,
                    keep_values: bool = False, block_windows: int | None = None, counted: bool = False) -> DataFrame:
    """E1-E6, K4-K7 on the gap-filled grid (no z-scores); ``keep_values`` adds the unrounded values as ``_v_<metric>``.

    With ``counted`` a row may stand for several equal windows of a series, ``_windows`` of them.

    With ``block_windows`` no task sees more than so many windows of a series
    (and the rolling frame): a segmented scan.  Each time block is summed up
    (last value of each metric, last window without a burst), the summaries
    are combined along the series, and what comes before a block is joined to
    its rows; the rows of the frame at a block's end, and its first row, are
    copied to the neighbouring block.

    A grid of runs (``_gap``) stays in runs until the features are known.
    """
    if "_gap" in grid.columns:
        if rolling_window_size <= MAX_RUN_FRAME and block_windows is None:
            return _features_of_runs(grid, metrics, window_minutes=window_minutes, rolling_window_size=rolling_window_size,
                                     keep_values=keep_values, counted=counted)
        grid = expand_runs(grid, metrics, window_minutes=window_minutes)
    if counted:
        rows = series_features(grid, metrics, window_minutes=window_minutes, rolling_window_size=rolling_window_size,
                               keep_values=keep_values, block_windows=block_windows)
        return rows.withColumn("_windows", F.lit(1).cast("long"))
    keys = KEYS if block_windows is None else (*KEYS, "_block")
    order = Window.partitionBy(*keys).orderBy("window_start")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolling = order.rowsBetween(-(rolling_window_size - 1), Window.currentRow)
    slot = window_slot(F.col("window_start"), window_minutes)
    if block_windows is not None:
        if block_windows < rolling_window_size:
            raise ValueError("a block must hold a rolling frame")
        grid = grid.withColumn("_block", block_of(window_minutes, block_windows))
        last = grid.groupBy(*keys).agg(*[F.max_by(f"_mean_{m}", F.when(F.col(f"_mean_{m}").isNotNull(), slot)).alias(f"_mean_{m}") for m in metrics],
                                       F.min(slot).alias("_first"))
        grid = grid.join(across_blocks(last, _start=F.min("_first").over(Window.partitionBy(*KEYS)), **{
            f"_before_{m}": F.last(f"_mean_{m}", ignorenulls=True).over(blocks_before()) for m in metrics}), list(keys))

    # Last observation carried forward (unrounded), else the default
    locf = grid.select(
        *keys, "window_start", "event_count", "is_anomaly", "event_summaries", *(["_start"] if block_windows else []),
        *[F.coalesce(F.col(f"_mean_{m}"), F.last(f"_mean_{m}", ignorenulls=True).over(running),
                     *([F.col(f"_before_{m}")] if block_windows else []),
                     F.lit(float(METRIC_DEFAULTS.get(m, 0.0)))).alias(f"_v_{m}") for m in metrics],
        *[F.col(f"_mean_{m}").isNull().cast("int").alias(f"{m}_was_imputed") for m in metrics],
    )

    def r6(c: Column) -> Column:
        return F.round(c, 6)

    def metric_or_zero(m: str) -> Column:
        return r6(F.col(f"_v_{m}")) if m in metrics else F.lit(0.0)

    per_metric = []
    for m in metrics:
        v = F.col(f"_v_{m}")
        n = F.count(v).over(rolling)
        slope = F.when(n > 1, (v - F.first(v).over(rolling)) / (n - 1)).otherwise(F.lit(0.0))
        per_metric += [
            r6(v).alias(m),
            F.col(f"{m}_was_imputed"),
            r6(F.avg(v).over(rolling)).alias(f"{m}_roll_mean"),
            r6(F.stddev_pop(v).over(rolling)).alias(f"{m}_roll_std"),
            r6(F.min(v).over(rolling)).alias(f"{m}_roll_min"),
            r6(F.max(v).over(rolling)).alias(f"{m}_roll_max"),
            r6(slope).alias(f"{m}_roll_slope"),
        ]

    # E5: consecutive windows with packet-drop ratio above the threshold;
    # the grid is contiguous, so the run length is slot - last non-burst slot
    burst_flag = metric_or_zero("packet_drop_ratio") > F.lit(PACKET_DROP_BURST_THRESHOLD)
    last_break = F.max(F.when(~burst_flag, slot)).over(running)
    if block_windows is None:
        break_before = F.min(slot).over(running) - 1
    else:
        from ..session import materialize

        locf = materialize(locf, "locf")  # read for the breaks and for the features
        breaks = locf.groupBy(*keys).agg(F.max(F.when(~burst_flag, slot)).alias("_break"))
        locf = locf.join(across_blocks(breaks, _break=F.max("_break").over(blocks_before())), list(keys))
        break_before = F.coalesce(F.col("_break"), F.col("_start") - 1)
        place = F.pmod(slot, F.lit(block_windows))
        near = F.array(F.struct(F.col("_block").alias("_block"), F.lit(True).alias("_own")),
                       F.when(place >= block_windows - (rolling_window_size - 1), F.struct((F.col("_block") + 1).alias("_block"), F.lit(False).alias("_own"))),
                       F.when(place == 0, F.struct((F.col("_block") - 1).alias("_block"), F.lit(False).alias("_own"))))
        locf = locf.withColumn("_near", F.explode(F.filter(near, lambda x: x.isNotNull()))).drop("_block").select("*", "_near.*").drop("_near")
        # copies must not end a burst of the block that they are copied to
        last_break = F.max(F.when(~burst_flag & F.col("_own"), slot)).over(running)
    burst = F.when(burst_flag, slot - F.coalesce(last_break, break_before)).otherwise(F.lit(0))

    def lead_of(m: str) -> Column:
        return F.lead(r6(F.col(f"_v_{m}"))).over(order) if m in metrics else F.lit(None).cast("double")

    stage = locf.select(
        *([] if block_windows is None else ["_own"]),
        "window_start",
        F.lit(window_minutes).alias("window_minutes"),
        *KEYS,
        "event_count",
        r6(F.col("event_count") / F.lit(float(window_minutes))).alias("event_frequency"),
        "event_summaries",
        "is_anomaly",
        lead_of("latency_ms").alias("target_next_latency_ms"),
        lead_of("throughput_rps").alias("target_next_throughput_rps"),
        *per_metric,
        *([f"_v_{m}" for m in metrics] if keep_values else []),
        burst.cast("int").alias("packet_drop_burst_count"),
    )

    # K4-K6 and E6 read the rounded metric values (Q8)
    def col_or_zero(name: str, present: bool) -> Column:
        return F.col(name) if present else F.lit(0.0)

    thr = col_or_zero("throughput_rps", "throughput_rps" in metrics)
    err = col_or_zero("error_rate", "error_rate" in metrics)
    fail = col_or_zero("request_failures", "request_failures" in metrics)
    cpu = col_or_zero("cpu_utilization", "cpu_utilization" in metrics)
    lat = col_or_zero("latency_ms", "latency_ms" in metrics)
    lat_mean = col_or_zero("latency_ms_roll_mean", "latency_ms" in metrics)
    ratio = F.when(err != 0, err).otherwise(F.when(thr != 0, fail / thr).otherwise(F.lit(0.0)))
    if block_windows is not None:
        stage = stage.where("_own").drop("_own")
    head = [c for c in stage.columns if c != "packet_drop_burst_count"]
    return stage.select(
        *head,
        r6(ratio).alias("request_error_ratio"),
        F.round(F.when(thr != 0, cpu / thr).otherwise(F.lit(0.0)), 9).alias("cpu_throughput_imbalance"),
        r6(lat - lat_mean).alias("short_term_latency_drift"),
        "packet_drop_burst_count",
    )


def _features_of_runs(runs: DataFrame, metrics: list[str], *, window_minutes: int, rolling_window_size: int,
                      keep_values: bool, counted: bool = False) -> DataFrame:
    """:func:`series_features` of runs: the same columns and rows.

    With ``counted`` windows of a run that agree in every column but
    ``window_start`` are one row, the first of them, with their number in
    ``_windows``: those beyond the first frames that are neither the last
    (its next window is in another run) nor in a burst (which counts on).

    Windows of a run differ only in their distance ``_k`` from its present
    window.  A frame of R windows reaches out of the run for the first R - 1
    of them alone, so a run has at most R different frames (``_s``: the first
    R - 1 windows one by one, then all others at once).  The values before a
    run come from the R - 1 runs before it.
    """
    frame = rolling_window_size - 1
    order = Window.partitionBy(*KEYS).orderBy("window_start")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def r6(c: Column) -> Column:
        return F.round(c, 6)

    def rounded(m: str) -> Column:
        return F.col(f"_r_{m}") if m in metrics else F.lit(0.0)

    # E1 on the present windows: last observation carried forward (unrounded), else the default
    locf = runs.select(
        *KEYS, "window_start", "event_count", "is_anomaly", "event_summaries", "_gap",
        window_slot(F.col("window_start"), window_minutes).alias("_slot"),
        *[F.coalesce(F.col(f"_mean_{m}"), F.last(f"_mean_{m}", ignorenulls=True).over(running),
                     F.lit(float(METRIC_DEFAULTS.get(m, 0.0)))).alias(f"_v_{m}") for m in metrics],
        *[F.col(f"_mean_{m}").isNull().cast("int").alias(f"_imputed_{m}") for m in metrics],
    ).withColumns({
        "_frequency": r6(F.col("event_count") / F.lit(float(window_minutes))),
        **{f"_r_{m}": r6(F.col(f"_v_{m}")) for m in metrics}})
    # E5: a run without burst ends one at its last window
    locf = locf.withColumn("_burst", rounded("packet_drop_ratio") > F.lit(PACKET_DROP_BURST_THRESHOLD))
    leads = [m for m in ("latency_ms", "throughput_rps") if m in metrics]
    staged = locf.select(
        "*",
        F.min("_slot").over(running).alias("_first"),
        F.max(F.when(~F.col("_burst"), F.col("_slot") + F.col("_gap") - 1)).over(running).alias("_break"),
        *[F.lead(f"_r_{m}").over(order).alias(f"_next_{m}") for m in leads],
        *[F.lag("_gap", i).over(order).alias(f"_gap_{i}") for i in range(1, frame + 1)],
        *[F.lag(f"_{kind}_{m}", i).over(order).alias(f"_{kind}{i}_{m}") for i in range(1, frame + 1) for m in metrics for kind in "vr"])

    def before(kind: str, m: str, j: int) -> Column:
        """Value ``j`` windows before the run (null before the series): of the nearest run that reaches so far back."""
        reach, found = F.lit(0), []
        for i in range(1, j + 1):
            reach = reach + F.col(f"_gap_{i}")
            found.append(F.when(reach >= j, F.col(f"_{kind}{i}_{m}")))
        return F.coalesce(*found)

    # K4-K6 read the rounded metric values (Q8); they are the same in all windows of a run
    thr, err, fail, cpu = (rounded(m) for m in ("throughput_rps", "error_rate", "request_failures", "cpu_utilization"))
    ratio = F.when(err != 0, err).otherwise(F.when(thr != 0, fail / thr).otherwise(F.lit(0.0)))
    carried = ["window_start", *KEYS, "event_count", "is_anomaly", "event_summaries", "_gap", "_slot", "_first", "_break", "_burst", "_frequency",
               *[f"_next_{m}" for m in leads], *[f"_{kind}_{m}" for m in metrics for kind in ("v", "r", "imputed")]]
    staged = staged.select(
        *carried, r6(ratio).alias("request_error_ratio"),
        F.round(F.when(thr != 0, cpu / thr).otherwise(F.lit(0.0)), 9).alias("cpu_throughput_imbalance"),
        *[before(kind, m, j).alias(f"_{kind}b{j}_{m}") for j in range(1, frame + 1) for m in metrics for kind in "vr"],
        F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("_gap"), F.lit(rolling_window_size)) - 1)).alias("_s"))
    s = F.col("_s")

    def in_frame(kind: str, m: str, j: int) -> Column:
        """Value ``j`` windows before window ``_s`` of the run."""
        value = F.when(s >= j, F.col(f"_{kind}_{m}"))
        for back in range(1, j):
            value = value.when(s == back, F.col(f"_{kind}b{j - back}_{m}"))
        return value.otherwise(F.col(f"_{kind}b{j}_{m}"))

    # The frame's values from the oldest on; the first are null at the head of a series
    n = F.col("_n")
    carried = [*carried, "_s", "request_error_ratio", "cpu_throughput_imbalance"]
    staged = staged.select(
        *carried, F.least(F.col("_slot") + s - F.col("_first") + 1, F.lit(rolling_window_size)).alias("_n"),
        *[in_frame(kind, m, j).alias(f"_{kind}f{j}_{m}") for j in range(1, frame + 1) for m in metrics for kind in "vr"])

    def frame_of(kind: str, m: str) -> list[Column]:
        return [*[F.col(f"_{kind}f{j}_{m}") for j in range(frame, 0, -1)], F.col(f"_{kind}_{m}")]

    def total(values: list[Column]) -> Column:
        out = F.lit(0.0)
        for v in values:
            out = out + F.coalesce(v, F.lit(0.0))
        return out

    # running mean and sum of squared deviations (Welford), as stddev_pop updates them: equal values give exactly 0
    mean, squares = ({m: F.lit(0.0) for m in metrics} for _ in range(2))
    for place, j in enumerate(range(frame, -1, -1)):
        delta = {m: frame_of("v", m)[place] - mean[m] for m in metrics}
        staged = staged.withColumns({f"_d{j}_{m}": delta[m] for m in metrics})
        count = n - j
        staged = staged.withColumns({
            **{f"_m{j}_{m}": F.when(count > 0, mean[m] + F.col(f"_d{j}_{m}") / count).otherwise(F.lit(0.0)) for m in metrics},
            **{f"_q{j}_{m}": F.when(count > 0, squares[m] + F.col(f"_d{j}_{m}") * (F.col(f"_d{j}_{m}") - F.col(f"_d{j}_{m}") / count))
               .otherwise(F.lit(0.0)) for m in metrics}})
        mean, squares = {m: F.col(f"_m{j}_{m}") for m in metrics}, {m: F.col(f"_q{j}_{m}") for m in metrics}
    zero = F.lit(0.0)
    rolled = {}
    for m in metrics:
        v, oldest = F.col(f"_v_{m}"), F.coalesce(*frame_of("v", m))
        rolled[f"{m}_roll_mean"] = r6(total(frame_of("v", m)) / n)
        rolled[f"{m}_roll_std"] = F.when(squares[m] == 0, zero).otherwise(r6(F.sqrt(squares[m] / n)))
        # rounding keeps the order
        rolled[f"{m}_roll_min"] = F.least(*frame_of("r", m)) if frame else F.col(f"_r_{m}")
        rolled[f"{m}_roll_max"] = F.greatest(*frame_of("r", m)) if frame else F.col(f"_r_{m}")
        rolled[f"{m}_roll_slope"] = F.when((n <= 1) | (v - oldest == 0), zero).otherwise(r6((v - oldest) / (n - 1)))
    staged = staged.withColumns(rolled)
    drift = r6(rounded("latency_ms") - (F.col("latency_ms_roll_mean") if "latency_ms" in metrics else zero))
    repeats = F.when(s < frame, F.lit(1)).otherwise(F.col("_gap") - frame)
    firsts = F.sequence(s, s + repeats - 1)
    if counted:  # window s (it may be present), those between, the last
        end = s + repeats - 1
        firsts = F.when(F.col("_burst"), firsts).otherwise(F.array_distinct(F.array(s, F.least(s + 1, end), end)))
    staged = staged.select(*carried, *rolled, drift.alias("short_term_latency_drift"), *([repeats.alias("_repeats")] if counted else []),
                           F.explode(firsts).alias("_k"))

    # the rows of the grid
    k = F.col("_k")
    present, last = k == 0, k == F.col("_gap") - 1

    def lead_of(m: str) -> Column:
        return F.when(last, F.col(f"_next_{m}")).otherwise(F.col(f"_r_{m}")) if m in metrics else F.lit(None).cast("double")

    burst = F.when(F.col("_burst"), F.col("_slot") + k - F.coalesce(F.col("_break"), F.col("_first") - 1)).otherwise(F.lit(0))
    if counted:
        between = ~F.col("_burst") & (k == s + 1) & ~last
        windows = F.when(between, F.col("_repeats") - 2).otherwise(F.lit(1)).cast("long")
    return staged.select(
        F.timestamp_add("MINUTE", k * window_minutes, F.col("window_start")).alias("window_start"),
        F.lit(window_minutes).alias("window_minutes"),
        *KEYS,
        F.when(present, F.col("event_count")).otherwise(F.lit(0)).alias("event_count"),
        F.when(present, F.col("_frequency")).otherwise(zero).alias("event_frequency"),
        F.when(present, F.col("event_summaries")).otherwise(F.lit("")).alias("event_summaries"),
        F.when(present, F.col("is_anomaly")).otherwise(F.lit(0)).alias("is_anomaly"),
        lead_of("latency_ms").alias("target_next_latency_ms"),
        lead_of("throughput_rps").alias("target_next_throughput_rps"),
        *[c for m in metrics for c in (
            F.col(f"_r_{m}").alias(m), F.when(present, F.col(f"_imputed_{m}")).otherwise(F.lit(1)).alias(f"{m}_was_imputed"),
            *[F.col(f"{m}_roll_{part}") for part in ("mean", "std", "min", "max", "slope")])],
        *([f"_v_{m}" for m in metrics] if keep_values else []),
        "request_error_ratio",
        "cpu_throughput_imbalance",
        "short_term_latency_drift",
        burst.cast("int").alias("packet_drop_burst_count"),
        *([windows.alias("_windows")] if counted else []),
    )


def add_zscores(features: DataFrame, metrics: list[str], grid: DataFrame | None = None) -> DataFrame:
    """D7 + C6 + K6: global mean / population std per metric, one row as a scalar subquery (not run if no z-score is read).

    ``grid``: the rows of all windows, if ``features`` has fewer.
    """
    if not metrics:
        return features
    stats = (features if grid is None else grid).agg(F.struct(
        *[F.avg(m).alias(f"_mu_{m}") for m in metrics],
        *[F.stddev_pop(m).alias(f"_sd_{m}") for m in metrics],
    ).alias("_stats"))
    joined = features.withColumn("_stats", stats.scalar())
    z = [
        F.round(F.when(F.coalesce(F.col("_stats")[f"_sd_{m}"], F.lit(0.0)) == 0, F.lit(0.0))
                .otherwise((F.col(m) - F.col("_stats")[f"_mu_{m}"]) / F.col("_stats")[f"_sd_{m}"]), 6).alias(f"{m}_zscore")
        for m in metrics
    ]
    return joined.select(*features.columns, *z)


def window_features(cleaned: DataFrame, *, metrics: list[str] | None = None, window_minutes: int = 1,
                    rolling_window_size: int = 3,
                    max_windows_per_series: int = DEFAULT_MAX_WINDOWS_PER_SERIES,
                    materialize: bool = False, block_windows: int | None = None, counted: bool = False) -> DataFrame:
    """Full S5 feature table from cleaned rows; ``block_windows`` cuts long series into time blocks (a day of minutes: 1440).

    ``counted``: equal windows of a series may be one row, ``_windows`` (last column) is their number; for sums over the table.

    ``materialize`` writes the table without z-scores once (shared checkpoint folder), for callers that read it several times.
    """
    check_window_minutes(window_minutes, rolling_window_size)
    if metrics is None:
        # D3 needs the observed metric names before the wide plan: aggregate
        # to (window, metric) once, cut the lineage there (shared checkpoint
        # folder), read the names from that small table and widen it.
        from ..session import staged_table

        long = staged_table(resample_long(cleaned), "windows-long")
        metrics = discover_metrics(long)
        windows = widen(long, metrics)
    else:
        windows = resample(cleaned, sorted(metrics))
        metrics = sorted(metrics)
    grid = fill_gaps(windows, metrics, window_minutes=window_minutes, max_windows_per_series=max_windows_per_series,
                     block_windows=block_windows, as_runs=block_windows is None)
    base = series_features(grid, metrics, window_minutes=window_minutes, rolling_window_size=rolling_window_size,
                           block_windows=block_windows)
    if materialize:
        from ..session import staged_table

        base = staged_table(base, "features-base")
    if not counted:
        return add_zscores(base, metrics)
    rows = series_features(grid, metrics, window_minutes=window_minutes, rolling_window_size=rolling_window_size,
                           block_windows=block_windows, counted=True)
    with_z = add_zscores(rows, metrics, base)
    return with_z.select(*[c for c in with_z.columns if c != "_windows"], "_windows")


def preprocess_report(flags: DataFrame, features: DataFrame, metrics: list[str]) -> DataFrame:
    """D5 + B11: one row of run counts."""
    cleaned_counts = flags.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~F.col("_dropped")).alias("cleaned_rows_written"),
        F.count_if(F.col("_dropped")).alias("dropped_rows"),
        F.count_if(F.col("_bad_value")).alias("non_numeric_rows"),
    )
    imputed = sum((F.col(f"{m}_was_imputed").cast("long") for m in metrics), F.lit(0).cast("long"))
    window_counts = features.agg(
        F.count(F.lit(1)).alias("window_rows_written"),
        F.coalesce(F.sum(imputed), F.lit(0)).cast("long").alias("imputed_values"),
    )
    return cleaned_counts.crossJoin(window_counts)
