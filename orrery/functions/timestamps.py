"""ISO-8601 timestamps: gate, parse, normalised text, UTC instant, window floor.

The reference parses with Python's ``datetime.fromisoformat`` (3.11+)
after turning a trailing ``Z`` into ``+00:00`` and re-emits
``isoformat()``.  Spark's casts accept more (``2026``, bare times) and less
(basic format), so a strict regex gate runs first and the cast only checks
calendar validity.  Everything stays a JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import py_strip

_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{8})"
_TIME = r"(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
_OFFSET = r"(?:[+-]\d{2}(?::?\d{2})?)"
GATE = rf"^{_DATE}(?:[T ]{_TIME}{_OFFSET}?)?\z"

# loose extractor, applied only to gated text
_PARTS = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:[T ](\d{2}):?(\d{2})?:?(\d{2})?(?:[.,](\d+))?([+-]\d{2}(?::?\d{2})?)?)?\z"
)


_JOINED = "$1|$2|$3|$4|$5|$6|$7|$8"


def with_parsed_iso(df: DataFrame, src: Column, *, text: str = "_ts_text", ts: str = "_ts") -> DataFrame:
    """Adds ``text`` and ``ts`` columns parsed from the raw timestamp ``src``.

    ``text`` is what ``fromisoformat(...).isoformat()`` prints (offset kept,
    ``Z`` printed as ``+00:00``, micro-seconds only when non-zero); ``ts`` is
    the UTC instant (a naive input counts as UTC).  Both are NULL when the
    text is not a valid ISO timestamp.  Built as staged projections so each
    regex runs once per row and no sub-expression is copied.
    """
    keep = df.columns
    raw = py_strip(src)
    a = df.withColumn("_iso_c", F.when(raw.rlike(r"Z\z"), F.concat(F.regexp_replace(raw, r"Z\z", ""), F.lit("+00:00")))
                      .otherwise(raw))
    c = F.col("_iso_c")
    b = a.withColumn("_iso_p", F.when(c.rlike(GATE), F.split(F.regexp_replace(c, _PARTS, _JOINED), "[|]")))
    p = F.col("_iso_p")

    def part(i: int) -> Column:
        return p.getItem(i)

    def or00(col: Column) -> Column:
        return F.when(col == "", F.lit("00")).otherwise(col)

    frac = part(6)
    off = part(7)
    off_digits = F.regexp_replace(off, "[+:-]", "")
    stage = b.select(
        *keep,
        part(0).alias("_iso_y"), part(1).alias("_iso_mo"), part(2).alias("_iso_d"),
        or00(part(3)).alias("_iso_h"), or00(part(4)).alias("_iso_mi"), or00(part(5)).alias("_iso_s"),
        F.when(frac == "", F.lit("000000")).otherwise(F.rpad(F.substring(frac, 1, 6), 6, "0")).alias("_iso_us"),
        off.alias("_iso_off"),
        F.substring(off_digits, 1, 2).try_cast("int").alias("_iso_oh"),
        F.when(F.length(off_digits) > 2, F.substring(off_digits, 3, 2)).otherwise(F.lit("00")).try_cast("int")
        .alias("_iso_om"),
    )
    y, mo, d, h, mi, s, us = (F.col(n) for n in ("_iso_y", "_iso_mo", "_iso_d", "_iso_h", "_iso_mi", "_iso_s", "_iso_us"))
    off, oh, om = F.col("_iso_off"), F.col("_iso_oh"), F.col("_iso_om")
    sign = F.when(F.substring(off, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    stage2 = stage.select(
        *keep,
        F.concat(y, F.lit("-"), mo, F.lit("-"), d, F.lit(" "), h, F.lit(":"), mi, F.lit(":"), s, F.lit("."), us)
        .try_cast("timestamp_ntz").alias("_iso_local"),
        F.when(off == "", F.lit(0)).otherwise(sign * (oh * 60 + om)).alias("_iso_offmin"),
        ((off == "") | ((oh <= 23) & (om <= 59))).alias("_iso_offok"),
        F.concat(y, F.lit("-"), mo, F.lit("-"), d, F.lit("T"), h, F.lit(":"), mi, F.lit(":"), s,
                 F.when(us != "000000", F.concat(F.lit("."), us)).otherwise(F.lit(""))).alias("_iso_body"),
        F.when(off == "", F.lit("")).otherwise(
            F.concat(F.when(sign < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(oh.cast("string"), 2, "0"), F.lit(":"),
                     F.lpad(om.cast("string"), 2, "0"))).alias("_iso_offtext"),
    )
    local = F.col("_iso_local")
    valid = local.isNotNull() & F.col("_iso_offok")
    offmin = F.col("_iso_offmin")
    offtext = F.when(offmin == 0, F.when(F.col("_iso_offtext") == "", F.lit("")).otherwise(F.lit("+00:00"))).otherwise(
        F.col("_iso_offtext"))
    # Emitted through a one-row generator: filters on the parsed values are
    # not pushed below a Generate, so they do not re-inline the whole parse
    # (Catalyst substitutes alias definitions at every projection it crosses).
    parsed = F.struct(
        F.when(valid, F.concat(F.col("_iso_body"), offtext)).alias(text),
        F.when(valid, F.timestamp_add("MINUTE", -offmin, local)).alias(ts),
    )
    return stage2.select(*keep, F.inline(F.array(parsed)))


def floor_window(ts: Column, minutes) -> Column:
    """Tumbling floor anchored to the hour: seconds dropped, minute -= minute % w.

    Zone-free on TIMESTAMP_NTZ (date_trunc would return a zoned TIMESTAMP).
    """
    minute = F.minute(ts)
    w = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), minute - (minute % w), F.lit(0))


def iso_seconds(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> 'yyyy-MM-ddTHH:mm:ss' text (used for keys in reports)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def utc_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ holding UTC wall time -> TIMESTAMP (instant), independent of the session zone.

    Streaming watermarks need TIMESTAMP; a plain cast would read the value in
    the session zone.
    """
    secs = (F.second(ts) + F.date_format(ts, "SSSSSS").cast("int") / F.lit(1_000_000.0)).cast("decimal(8,6)")
    return F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), secs, F.lit("UTC"))
