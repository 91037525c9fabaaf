"""Helpers shared by the corpus operators: tables, staged Parquet, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.session import scratch_path

Batch = TypeVar("Batch")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, *, row_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like a checkpoint, but later readers prune columns.
    Task retries leave no partial file: Spark's committer publishes a task's
    output once.  ``row_group`` bounds the bytes that a task's writer holds
    (Parquet's default is 128 MiB); tables of whole texts take a small one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if row_group:
        writer = writer.option("parquet.block.size", str(row_group))
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within the block Python functions get at most ``rows`` rows at once, so that wide rows stay small in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Within the block the session has this setting."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released(batches: Iterator[Batch]) -> Iterator[Batch]:
    """``batches``, after which Arrow's free memory goes back: a worker waits for its next task without the last one's buffers."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()


def text_slices(texts: Sequence[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` characters each, at least one row."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def ranked(df: DataFrame, group: str, order: Sequence[str], name: str = "ranked") -> DataFrame:
    """``df``, staged, with ``pos`` (place within its ``group`` by ``order``, from 0) and ``size`` (rows of the group).

    Rows are spread by ranges of (group, order), so a large group lies in many
    partitions; a row number among equal rows splits those as well.  The
    window runs over one row per partition and group, not over the rows.
    ``group`` must not be null.
    """
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), name)
    keys = [group, *order, "_row"]
    local = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staged(spread.withColumn("_part", F.spark_partition_id()).withColumn("_local", local).drop("_row"), name)
    parts = placed.groupBy("_part", group).agg(F.min("_local").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole, earlier = Window.partitionBy(group), Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", group, F.sum("_n").over(whole).alias("size"),
                         (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(parts, ["_part", group]).withColumn("pos", F.col("_shift") + F.col("_local")).drop("_part", "_local", "_shift")


def rows_with_ids(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Those of ``rows`` whose ``column`` is in ``ids`` (same column), for wide rows with dense ids of 0 or more, none null.

    The ids become stored bitmaps, one for 32,768 neighbouring ids: a bit for
    a row is little enough to be broadcast, so the rows stay where they are read.
    """
    number, place = F.bitmap_bucket_number(F.col(column)), F.bitmap_bit_position(F.col(column))
    maps = staged(ids.groupBy(number.alias("_number")).agg(F.bitmap_construct_agg(place).alias("_bits")), "bitmaps")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    has = F.get(F.array(*[byte.bitwiseAND(1 << i) > 0 for i in range(8)]), (place % 8).cast("int"))
    return rows.join(maps, number == F.col("_number")).filter(has).select(*rows.columns)


def connected_components(nodes: DataFrame, edges: DataFrame, *, node: str = "id",
                         left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges``, itself included.

    Alternating large-star and small-star rounds (Kiveris et al., "Connected
    Components in MapReduce and Beyond"): each round is two grouped minima
    and joins, the number of rounds is logarithmic in the longest path.
    The per-node minimum is a map-side combined aggregation joined back on
    the node, so a node with very many links is never gathered into one row,
    and the joins may be split by adaptive execution.  Nodes and edge ends
    must not be null.
    """
    spark = edges.sparkSession

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        # each node u, its smaller (small star) or larger (large star) neighbours v, and u's least neighbour m
        both = pairs.select(F.col("u"), F.col("v")) if small else pairs.select("u", "v").union(
            pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = both.join(least, "u")
        if small:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v")))
        else:
            out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.filter(F.col("u") != F.col("v")).distinct()

    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter(
        F.col("u") != F.col("v")).distinct()
    current = staged(pairs, "cc")
    before = _fingerprint(current)
    while before[0]:
        current = staged(star(star(current, small=False), small=True), "cc")
        now = _fingerprint(current)
        if now == before:
            break
        before = now
    labels = current.groupBy(F.col("u").alias(node)).agg(F.min("v").alias("_least"))
    return nodes.select(node).join(labels, node, "left").select(node, F.coalesce("_least", node).alias("component"))


def _fingerprint(pairs: DataFrame) -> tuple:
    """Row count and an order-free hash of a pair table: equal before and after a round at its fixed point."""
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
