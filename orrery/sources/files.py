"""File identity: SHA-256 checksums computed by Spark tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTENT_BYTES = (1 << 31) - 1  # a binary column holds no more


def file_checksums(spark: SparkSession, paths: list[str], *, content_bytes: int = CONTENT_BYTES) -> DataFrame:
    """(path, source_ordinal, checksum, length) for each input file.

    ``binaryFile`` hands each file to one task.  A file of more than
    ``content_bytes`` is known by its path, length and modification time
    instead; the length filter keeps its content from being read.
    """
    frames = []
    for ordinal, path in enumerate(paths):
        files = spark.read.format("binaryFile").load(path)
        place = F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")).cast("binary")
        for condition, identity in ((F.col("length") <= content_bytes, F.col("content")), (F.col("length") > content_bytes, place)):
            frames.append(files.where(condition).select(F.lit(path).alias("path"), F.lit(ordinal).alias("source_ordinal"),
                                                        F.sha2(identity, 256).alias("checksum"), "length"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
