"""CSV records of large files in parallel, line breaks inside quotes included (A2).

Spark reads such files whole, one task each.  Here the lines of a split are
read by themselves, and whether a line begins inside quotes follows from the
number of quotes before it: each task works out both cases for its split
(begins outside, begins inside), one row per split says how many quotes and
records it has in either case, a prefix over these rows picks the case, and
only the lines of records that go over several lines are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
LINE = ("file string, block bigint, line bigint, value string, quotes bigint, inside bigint, "
        "first0 bigint, first1 bigint, count0 bigint, count1 bigint")


def mark_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each split and say, for a split that begins outside (0) and inside (1) quotes: the line where
    the record begins (-1: in an earlier split) and how many records have begun, blank lines not counted."""
    split, line, odd = None, 0, 0
    first, count = [-1, -1], [0, 0]
    for batch in batches:
        files, blocks, values = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2)
        keys = list(zip(files, blocks.tolist(), strict=True))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if keys[a] != split:
                split, line, odd, first, count = keys[a], 0, 0, [-1, -1], [0, 0]
            text = values.slice(a, b - a)
            quotes = pc.count_substring(text, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            blank = pc.is_in(text, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
            inside = (odd + np.cumsum(quotes) - quotes) % 2
            at, columns = np.arange(line, line + b - a), []
            for case in (0, 1):
                starts = (inside == case) & ~blank
                columns.append(np.maximum.accumulate(np.concatenate([[first[case]], np.where(starts, at, -1)]))[1:])
                columns.append(count[case] + np.cumsum(starts))
                first[case], count[case] = int(columns[-2][-1]), int(columns[-1][-1])
            odd = int((odd + quotes.sum()) % 2)
            line += b - a
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(at), text,
                 *(pa.array(c, pa.int64()) for c in (quotes, inside, columns[0], columns[2], columns[1], columns[3]))],
                ["file", "block", "line", "value", "quotes", "inside", "first0", "first1", "count0", "count1"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Columns of the header (text) and ``row_number``, from 2 on over the data records of a file or directory.

    Each file begins with a header of the same columns.  Blank lines between
    records are no records.  A quote that is never closed makes the rest of
    its file one record.
    """
    names = spark.read.options(header=True, inferSchema=False, multiLine=True, **OPTIONS).csv(path).columns
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    marked = lines.mapInArrow(mark_lines, LINE)

    # one row per split: which case holds, and what comes before
    splits = marked.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"), *[
        F.max(c).alias(c) for c in ("first0", "first1", "count0", "count1")])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("case", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    own = lambda name: F.when(F.col("case") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    splits = splits.select("file", "block", "case", own("first").alias("first"), own("count").alias("count"))
    open_at = F.when(F.col("first") >= 0, F.struct("block", "first"))
    splits = splits.select("file", "block", "case", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"),
                           F.last(open_at, ignorenulls=True).over(before).alias("open"))
    files = splits.groupBy("file").agg((F.sum("count") - 1).alias("records"))
    earlier_files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.select("file", F.coalesce(F.sum("records").over(earlier_files), F.lit(0)).alias("base"))
    splits = splits.join(files, "file").drop("count")

    placed = marked.join(splits, ["file", "block"])
    begun = own("first")
    placed = placed.select(
        "file", "block", "line", "value", "base", "quotes", (F.col("inside") != F.col("case")).alias("within"),
        (F.col("earlier") + own("count")).alias("record"),
        F.when(begun >= 0, F.struct(F.col("block").alias("block"), begun.alias("first"))).otherwise(F.col("open")).alias("begin"))
    alone = ~F.col("within") & (F.col("quotes") % 2 == 0)
    blank = ~F.col("within") & F.col("value").isin("", "\r")
    single = placed.where(alone & ~blank).select("file", "base", "record", "value")
    several = placed.where(~alone).groupBy("file", "base", "record", "begin").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
    several = several.select("file", "base", "record", F.array_join(F.col("lines.value"), "\n").alias("value"))
    records = single.unionByName(several).where(F.col("record") > 1)  # the first record is the header
    parsed = F.from_csv(F.regexp_replace("value", "\r$", ""), ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names), OPTIONS)
    return records.select(parsed.alias("r"), (F.col("base") + F.col("record")).alias("row_number")).select("r.*", "row_number")
