"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets share out the whole size by weight, each at most ``max_epochs`` times
its source's size.  A source gives whole epochs first; the rest is a weighted
sample without replacement: every document draws an exponential key scaled by
its quality weight, keys are sorted within the source, and a prefix sum of
sizes is cut at the rest of the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import staged

SEED = "mix-1"
DRAW_BITS = 52
BUCKETS = 4096  # per source; only the bucket that the budget ends in is sorted row by row


def size_column(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def quality_column(text: Column) -> Column:
    """Quality weight of a text from 0.25 to 1: a quarter, plus three quarters of the share of ASCII letters, other
    letters and marks above U+007F, and white space among its UTF-8 bytes (an empty or null text: 0.25)."""
    total = F.octet_length(text)
    marks = F.length(text) - F.length(F.translate(text, "!\"#$%&()*+/0123456789:;<=>?@[\\]^_`{|}~", ""))
    share = F.when(F.coalesce(total, F.lit(0)) > 0, 1 - marks / total).otherwise(F.lit(0.0))
    return F.lit(0.25) + F.lit(0.75) * share


def draw_column(key: Column) -> Column:
    """Uniform draw in (0, 1) from the key's text, the same on every run: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(float(2 ** DRAW_BITS))


def targets(totals: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) of a (source, source_size) table.

    Sources in code point order, null last, weigh ``cycle`` in turn.  With f
    the common factor, a source's target is min(max_epochs * size, weight *
    f): sorted by the factor at which each reaches its cap, the capped
    sources are a prefix, found by one window over the sources (one row per
    source).
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    # binary collation of UTF-8 text is code point order
    rows = totals.withColumn("weight", F.get(weights, (F.row_number().over(order) - 1) % len(cycle)))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    rows = rows.withColumn("cap", cap).withColumn("full_at", F.col("cap") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rows = rows.withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("all_size", F.sum("source_size").over(whole).cast("double"))
    rows = rows.withColumn("all_weight", F.sum("weight").over(whole))
    # the factor if exactly the sources before this one are capped; the first at which this one stays below its cap holds
    rows = rows.withColumn("factor", (F.col("all_size") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
    factor = F.min(F.when(F.col("factor") < F.col("full_at"), F.struct("full_at", "factor"))).over(whole)["factor"]
    target = F.when(factor.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * factor))
    return rows.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
        weight: Column | None = None, max_epochs: int = 3, buckets: int = BUCKETS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, size, source_size, target, taken) and the columns ``carry`` of every row of ``docs``.

    ``weight`` is a positive quality weight (default: ``quality_column`` of
    the text).  ``taken`` is size times the number of copies: the whole
    epochs of its source, one more if the document is sampled.  The document
    that the budget ends in is taken if that ends nearer to the target.
    Null texts and texts without a word have size 0 and take 0; a null source
    is a source of its own, the last.  Draws come from the key (null: one
    draw for all); ties are ordered by key, size and text hash, so equal rows
    in a tie differ in nothing but which is named.  Other columns are
    ignored.  An empty table gives an empty result.

    The bucket sums are stored, so that their size is known when the rows are
    joined with them: rows are shuffled in the bucket that a budget ends in
    only, and ``carry`` may hold whole texts.

    Sorting within a source: a key's bucket is its rank range; bucket sums
    (map-side combined, at most ``buckets`` rows per source) find the bucket
    in which the budget ends, and only that bucket's rows are sorted, so a
    source with a third of all rows is never in one task.
    """
    body = F.col(text).cast("string")
    carried = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(F.col(key).alias("k"), F.col(source).cast("string").alias("source"), size_column(body).alias("size"),
                       (quality_column(body) if weight is None else weight).alias("w"), F.xxhash64(body).alias("h"),
                       *(F.col(c).alias(own) for c, own in zip(carry, carried, strict=True)))
    rows = rows.withColumn("e", -F.log(draw_column(F.col("k"))) / F.col("w"))
    # e is exponential for weight 1: 1 - exp(-e) spreads it evenly; e grows with the bucket
    rows = rows.withColumn("b", F.least(F.floor((1 - F.exp(-F.col("e"))) * buckets), F.lit(buckets - 1)).cast("int"))
    sums = rows.groupBy("source", "b").agg(F.sum("size").alias("n"))
    goal = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), max_epochs=max_epochs)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    goal = goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    by_bucket = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(by_bucket), F.lit(0)))
    goal = goal.withColumnRenamed("source", "goal_source")
    bounds = sums.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        F.col("source").alias("bound_source"), F.col("b").alias("bound_b"), "n", "before", "source_size", "target",
        "epochs", "rest")
    bounds = staged(bounds, "mix-bounds")
    placed = rows.join(bounds, F.col("source").eqNullSafe(F.col("bound_source")) & (F.col("b") == F.col("bound_b")))
    ends_here = (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest"))
    inner = Window.partitionBy("source", "b").orderBy("e", "k", "size", "h", *carried).rowsBetween(Window.unboundedPreceding, -1)
    clear = placed.filter(~ends_here).withColumn("more", (F.col("before") + F.col("n") <= F.col("rest")).cast("bigint"))
    last = placed.filter(ends_here).withColumn("upto", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    last = last.withColumn("more", (F.col("upto") + F.col("size") / 2 <= F.col("rest")).cast("bigint")).drop("upto")
    taken = clear.unionByName(last)
    return taken.select(F.col("k").alias(key), "size", "source_size", "target",
                        (F.col("size") * (F.col("epochs") + F.col("more"))).alias("taken"),
                        *(F.col(own).alias(c) for c, own in zip(carry, carried, strict=True)))
