"""Raw telemetry readers: CSV, JSON Lines, JSON array, Parquet, SQLite.

Every reader returns the same shape: the nine raw fields as STRING (NULL =
key absent / None), ``corrupt_record`` (text of an unreadable line), plus ``source_file`` (base name), ``source_ordinal``
(position in the input list) and ``row_number`` (ordinal within the file,
counted from 2 as the reference does for every format).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..specs import RAW_FIELDS
from .csv_lines import read_records

CSV_SUFFIXES = (".csv",)
JSONL_SUFFIXES = (".jsonl", ".ndjson")
JSON_SUFFIXES = (".json",)
SQLITE_SUFFIXES = (".sqlite", ".sqlite3", ".db")
PARQUET_SUFFIXES = (".parquet",)
CORRUPT = "_corrupt_record"  # text of a line that is no JSON object


def detect_format(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix in CSV_SUFFIXES:
        return "csv"
    if suffix in JSONL_SUFFIXES:
        return "jsonl"
    if suffix in JSON_SUFFIXES:
        return "json"
    if suffix in SQLITE_SUFFIXES:
        return "sqlite"
    if suffix in PARQUET_SUFFIXES:
        return "parquet"
    raise ValueError(f"Unsupported input type for {os.path.basename(path)}")


def with_row_ordinals(df: DataFrame, *, start: int = 2) -> DataFrame:
    """Ordinal of each row within its source, a file or a directory of part files.

    Rows of one split are contiguous; splits are ordered by file path and byte
    offset, so ordinals are unique over a directory too.  The window runs over
    the per-split counts (one row per input split), not over the rows, and
    its offsets are joined back on the split.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = tagged.groupBy("_file", "_pid", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_file", "_block", "_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_pid", "_block", "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    joined = tagged.join(offsets, ["_file", "_pid", "_block"])
    return joined.withColumn("row_number", F.col("_offset") + (F.col("_mid") - F.col("_first")) + F.lit(start)).drop(
        "_file", "_block", "_pid", "_mid", "_first", "_offset")


def _project(df: DataFrame, present: list[str], *, blank_present: bool) -> DataFrame:
    cols = []
    for name in RAW_FIELDS:
        if name in present:
            c = F.col(f"`{name}`").cast("string")
            # CSV: a blank cell of a header column is '' in the reference, NULL in Spark
            cols.append((F.coalesce(c, F.lit("")) if blank_present else c).alias(name))
        else:
            cols.append(F.lit(None).cast("string").alias(name))
    corrupt = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    return df.select(*cols, corrupt.alias("corrupt_record"), "row_number")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Records as RFC 4180 writes them: doubled quotes, line breaks inside quotes, plain backslashes; large files in many tasks."""
    df = read_records(spark, path)
    return _project(df, [c for c in df.columns if c != "row_number"], blank_present=True)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One record a line; a line that cannot be read keeps its text in ``corrupt_record``, with all fields null."""
    schema = ", ".join(f"`{name}` STRING" for name in (*RAW_FIELDS, CORRUPT))
    df = spark.read.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).json(path)
    df = with_row_ordinals(df)
    return _project(df, list(RAW_FIELDS), blank_present=False)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    first = spark.read.text(path).where(F.trim("value") != "").select(F.substring(F.trim("value"), 1, 1).alias("c")).limit(1).collect()
    if first and first[0]["c"] != "[":
        raise ValueError(f"Expected a JSON array in {os.path.basename(path)}")
    schema = ", ".join(f"`{name}` STRING" for name in RAW_FIELDS)
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    df = with_row_ordinals(df)
    return _project(df, list(RAW_FIELDS), blank_present=False)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    df = with_row_ordinals(df)
    return _project(df, [c for c in df.columns if c in RAW_FIELDS], blank_present=False)


def read_sqlite(spark: SparkSession, path: str, *, sql_table: str = "telemetry") -> DataFrame:
    from .sqlite import register_sqlite_source

    register_sqlite_source(spark)
    df = spark.read.format("sqlite_table").option("path", path).option("table", sql_table).load()
    present = [c for c in df.columns if c in RAW_FIELDS]
    return _project(df, present, blank_present=False)


def read_source(spark: SparkSession, path: str, *, fmt: str | None = None, sql_table: str = "telemetry",
                source_ordinal: int = 0) -> DataFrame:
    fmt = fmt or detect_format(path)
    reader = {
        "csv": read_csv,
        "jsonl": read_jsonl,
        "json": read_json_array,
        "parquet": read_parquet,
    }.get(fmt)
    if fmt == "sqlite":
        df = read_sqlite(spark, path, sql_table=sql_table)
    elif reader is None:
        raise ValueError(f"Unsupported input type for {os.path.basename(path)}")
    else:
        df = reader(spark, path)
    return df.select(
        *RAW_FIELDS,
        "corrupt_record",
        F.lit(os.path.basename(path.rstrip("/"))).alias("source_file"),
        F.lit(source_ordinal).cast("int").alias("source_ordinal"),
        F.col("row_number").cast("long").alias("row_number"),
    )


def read_telemetry(spark: SparkSession, paths: list[str], *, sql_table: str = "telemetry") -> DataFrame:
    """UNION ALL of every input, in input order (H1)."""
    if not paths:
        raise ValueError("At least one input source is required")
    frames = [read_source(spark, p, sql_table=sql_table, source_ordinal=i) for i, p in enumerate(paths)]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
