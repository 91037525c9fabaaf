"""Driver ``events`` table -> raw telemetry records (all-text, S1-shaped).

The driver tables carry no telemetry, so one deterministic projection turns
every event row into one raw record; the rules inject the invalid values
the validator must catch (bad timestamp, bad service, blank host, text
value, bad label) and a replay source repeats part of the rows so
de-duplication has work.  Every event row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import RAW_FIELDS

# Fixed values of the adapter (shared with the DuckDB oracle text)
BAD_TIMESTAMP_EVERY = 73
BAD_SERVICE_EVERY = 97
BLANK_HOST_EVERY = 89
TEXT_VALUE_EVERY = 79
BAD_LABEL_EVERY = 83
REPLAY_EVERY = 50
SERVICE_COUNT = 5
PRIMARY_SOURCE = "events.parquet"
REPLAY_SOURCE = "replay.parquet"


def events_to_raw(events: DataFrame, *, source_file: str = PRIMARY_SOURCE, source_ordinal: int = 0) -> DataFrame:
    eid = F.col("event_id")
    et = F.col("event_type")
    k = F.regexp_extract(F.col("props"), "([0-9]+)", 1).try_cast("int")
    value = F.col("value")
    metric_name = (
        F.when(et == "click", F.when(k < 50, "cpu_pct").otherwise("memory_pct"))
        .when(et == "view", F.lit("throughput_rps"))
        .when(et == "purchase", F.lit("latency_ms"))
        .when(et == "signup", F.lit("packet_drop_pct"))
        .when(et == "error", F.when(k < 30, "request_failures").otherwise("error_rate"))
    )
    number = (
        F.when(et == "view", value * 10.0)
        .when(et == "signup", value / 50.0)
        .when(et == "error", F.when(k < 30, F.floor(value).cast("double")).otherwise(value / 500.0))
        .otherwise(value)
    )
    unit = (
        F.when(et == "click", F.lit("percent"))
        .when(et == "view", F.when(k % 2 == 0, "rpm").otherwise("rps"))
        .when(et == "purchase", F.when(k % 3 == 0, "ms").when(k % 3 == 1, "s").otherwise("us"))
        .when(et == "signup", F.lit("pct"))
        .when(et == "error", F.when(k < 30, "count").otherwise("ratio"))
    )
    label = (
        F.when(eid % BAD_LABEL_EVERY == 0, F.lit("weird"))
        .when(k == 0, F.lit("unknown"))
        .when((et == "error") & (value > 100), F.lit("anomaly"))
        .otherwise(F.lit("normal"))
    )
    cols = {
        "timestamp": F.when(eid % BAD_TIMESTAMP_EVERY == 0, F.lit("bad-timestamp"))
        .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        "service_name": F.when(eid % BAD_SERVICE_EVERY == 0, F.lit("bad service"))
        .otherwise(F.concat(F.lit("svc-"), (F.col("user_id") % SERVICE_COUNT).cast("string"))),
        "host_id": F.when(eid % BLANK_HOST_EVERY == 0, F.lit(""))
        .otherwise(F.concat(F.lit("host-"), F.col("user_id").cast("string"))),
        "metric_name": metric_name,
        "metric_value": F.when(eid % TEXT_VALUE_EVERY == 0, F.lit("oops")).otherwise(F.format_string("%.4f", number)),
        "unit": unit,
        "event_type": F.when(et == "error", F.lit("event")).otherwise(F.lit("metric")),
        "event_summary": F.when(et == "error", F.concat(F.lit("err-"), (k % 10).cast("string"))).otherwise(F.lit("")),
        "anomaly_label": label,
    }
    return events.select(
        *[cols[name].alias(name) for name in RAW_FIELDS],
        F.lit(source_file).alias("source_file"),
        F.lit(source_ordinal).cast("int").alias("source_ordinal"),
        (eid + 2).alias("row_number"),
    )


SMALL_INPUT_BYTES = 1 << 30


def spread(df: DataFrame, key: str) -> DataFrame:
    """Small inputs (under 1 GiB, fewer scan partitions than task slots) are hash-spread over the slots.

    Keeps a one-file table from running the whole narrow stage (validation
    regexes) on one core.  Larger inputs are never reshuffled: they already
    scan as many splits, and moving them would cost more than it saves.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(slots, key) if size <= SMALL_INPUT_BYTES else df


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events once, plus the replayed share as a second source."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet")
                    .select("event_id", "ts", "user_id", "event_type", "value", "props"), "event_id")
    primary = events_to_raw(events)
    # the replay source repeats every REPLAY_EVERY-th event (row_number = event_id + 2); deriving it from
    # the primary projection builds the expression tree once, the filter still reaches the scan
    replay = (primary.where((F.col("row_number") - 2) % REPLAY_EVERY == 0)
              .withColumn("source_file", F.lit(REPLAY_SOURCE))
              .withColumn("source_ordinal", F.lit(1).cast("int")))
    return primary.unionByName(replay)
