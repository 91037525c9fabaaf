"""First-wins de-duplication (E7), incremental anti joins (C1, C2), per-source report.

The reference keeps the first copy of a fingerprint in input order (source
position, then row number) and drops fingerprints already curated.  Here:

1. ``groupBy(fingerprint).agg(min(order_key))`` -- a hash aggregate with a
   map-side partial step, so even a fingerprint holding a third of all rows
   collapses to one row per map task before the shuffle;
2. ``left_anti`` against curated fingerprints, pruned to the batch's date
   range (a fingerprint embeds its timestamp, so older dates cannot match);
3. the winners are found by an equi-join on (fingerprint, order_key): the
   order key is unique per row, so hot fingerprints spread over all join
   partitions instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# source ordinal in the high bits, row number below: a unique, ordered long
_ROW_BITS = 40


def order_key(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "_order", F.shiftleft(F.col("source_ordinal").cast("long"), _ROW_BITS) + F.col("row_number").cast("long"))


def prune_existing(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Curated fingerprints limited to the batch's event dates (one-row bound query)."""
    if "event_date" not in existing.columns:
        return existing.select("record_fingerprint")
    bounds = batch.where(F.col("ts").isNotNull()).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()[0]
    if bounds["lo"] is None:
        return existing.select("record_fingerprint").limit(0)
    return existing.where(F.col("event_date").between(bounds["lo"].date(), bounds["hi"].date())).select(
        "record_fingerprint")


def flag_first_wins(validated: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Adds ``is_written``: true for the first accepted copy of each new fingerprint.

    ``validated`` is the output of :func:`validate` (rejected rows keep
    ``is_written`` = false).
    """
    keyed = order_key(validated)
    ok = F.size("issues") == 0
    firsts = keyed.where(ok).groupBy("record_fingerprint").agg(F.min("_order").alias("_order"))
    if existing is not None:
        firsts = firsts.join(existing.select("record_fingerprint"), "record_fingerprint", "left_anti")
    winners = firsts.withColumn("is_written", F.lit(True))
    flagged = keyed.join(winners, ["record_fingerprint", "_order"], "left")
    return flagged.withColumn("is_written", F.coalesce(F.col("is_written"), F.lit(False))).drop("_order")


def first_wins(validated: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The winning copies only (curated rows), in one aggregation.

    ``min_by(row, order key)`` per fingerprint: a sort-based aggregate with a
    map-side partial step, so hot fingerprints collapse before the shuffle,
    and validation is evaluated once (no join back to the rows).
    """
    keyed = order_key(validated).where(F.size("issues") == 0).drop("issues")
    cols = [c for c in keyed.columns if c not in ("record_fingerprint", "_order")]
    firsts = keyed.groupBy("record_fingerprint").agg(F.min_by(F.struct(*cols), F.col("_order")).alias("_row"))
    if existing is not None:
        firsts = firsts.join(existing.select("record_fingerprint"), "record_fingerprint", "left_anti")
    return firsts.select("record_fingerprint", "_row.*")


def source_report(flagged: DataFrame, keys: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """Per source (``keys``: files of one name differ in ``source_ordinal``): rows seen, rows written, duplicates, issue count (issues, not rows), rejected rows."""
    ok = F.size("issues") == 0
    return flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_rows_seen"),
        F.sum(F.col("is_written").cast("long")).alias("rows_written"),
        F.sum((ok & ~F.col("is_written")).cast("long")).alias("duplicate_rows"),
        F.sum(F.size("issues").cast("long")).alias("validation_errors"),
        F.sum((~ok).cast("long")).alias("rejected_rows"),
    )


def new_records(batch_flagged: DataFrame) -> DataFrame:
    return batch_flagged.where("is_written").drop("issues", "is_written")
