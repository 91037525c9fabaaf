"""Near-duplicate documents by ProbMinHash on weighted word shingles.

A text is its multiset of five-word shingles (lower case, words between white
space; a shorter text is one shingle).  For each shingle a Poisson process
whose rate is its count sends arrivals to random registers; a register keeps
the shingle that arrives first, and processes stop once they are later than
every register.  Two signatures agree in a register with the probability
Jaccard similarity of the texts.  Registers are banded; documents that share
a band are compared with pivots, and every proposed pair is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import arrow_batches, connected_components, released, staged, text_slices

WORDS, SIMILAR = 5, 0.8
REGISTERS, BANDS, ROWS = 128, 50, 8  # a pair at 0.9 misses all bands with probability below 1e-6, one at 0.8 with 0.01
FINE_REGISTERS = 1024  # registers of the sketches with which documents of open buckets are compared
PAIRS = 0x5555555555555555
FIRST_BANDS = 5  # bands whose buckets are compared first: most documents that belong together meet there
FEW_SHINGLES = 40  # distinct shingles below which a sketch is not trusted
BATCH_ROWS = 1000  # rows that Python holds at once: whole texts, or two shingle sets each
SLICE_CHARS = 1 << 18  # characters whose shingles are made together, one text at least
PIVOTS = 256  # documents of a bucket that become pivots in one round

_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, elementwise (arithmetic modulo 2 ** 64)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes with counts; known words are kept in a table that is emptied when it has grown past a bound."""

    def __init__(self, words: int = WORDS, keep: int = 100_000):
        self.words, self.keep, self.known = words, keep, {}

    def of(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the distinct shingle hashes, ascending, and their counts; none without a word."""
        split = [t.lower().split() if t else [] for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > self.keep:
            self.known = {}
            new = set().union(*split)
        for w in new:
            self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
        sizes = [len(s) for s in split]
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.uint64, sum(sizes))
        out, at = [], 0
        for n in sizes:
            own = flat[at:at + n]
            at += n
            k = min(self.words, n)
            h = np.zeros(n - k + 1 if n else 0, np.uint64)
            for i in range(k):
                h = mix64(h ^ own[i:n - k + 1 + i])
            out.append(np.unique(h, return_counts=True))
        return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """(sets x registers) uint64: the first shingle to arrive at each register; all zero for an empty set."""
    count = len(sets)
    sizes = np.array([len(h) for h, _ in sets], np.int64)
    first = np.full(count * registers, np.inf)
    out = np.zeros(count * registers, np.uint64)
    row = np.repeat(np.arange(count), sizes)
    shingle = np.concatenate([h for h, _ in sets]) if count else np.empty(0, np.uint64)
    rate = np.concatenate([c for _, c in sets]).astype(float) if count else np.empty(0)
    time, stream = np.zeros(len(row)), shingle
    while len(row):
        stream = mix64(stream)
        uniform = ((stream >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(uniform) / rate
        place = row * registers + (mix64(stream ^ _M1) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        out[place[won]] = shingle[won]
        # an arrival that is later than the slowest register of its text can change nothing, nor can its successors
        latest = first.reshape(count, registers).max(axis=1)
        live = time < latest[row]
        row, shingle, rate, time, stream = row[live], shingle[live], rate[live], time[live], stream[live]
    return out.reshape(count, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over shared d of 1 / sum over d' of max(a[d'] / a[d], b[d'] / b[d]); 0 if either is empty.  Hashes ascend."""
    (ha, ca), (hb, cb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    hit = hb[at] == ha
    xa, xb = ca[hit].astype(np.uint64), cb[at[hit]].astype(np.uint64)
    only_a, only_b = float(ca.sum() - xa.sum()), float(cb.sum() - xb.sum())
    # the inner sum depends on the two counts of d alone, and few pairs of counts occur
    pairs, times = np.unique(xa << np.uint64(32) | xb, return_counts=True)
    count_a, count_b = (pairs >> np.uint64(32)).astype(float), (pairs & np.uint64(0xFFFFFFFF)).astype(float)
    total = 0.0
    for wa, wb, n in zip(count_a, count_b, times, strict=True):
        shared = (np.maximum(count_a / wa, count_b / wb) * times).sum()
        total += n / (only_a / wa + only_b / wb + shared)
    return float(total)


def sketch_of(sig: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Two bits of every register of each signature, 32 registers in a bigint; null for texts of few distinct shingles.

    Registers that fall on the same few shingles do not differ independently,
    so such sketches say too little; their pairs are all verified.
    """
    two = mix64(sig)[:, :, None] >> np.array([0, 1], np.uint64) & np.uint64(1)
    bits = np.packbits(two.reshape(len(sig), -1).astype(np.uint8), axis=1).view(np.int64)
    ends = np.arange(0, bits.size + 1, bits.shape[1])
    whole = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bits.reshape(-1)))
    return whole.take(pa.array(np.arange(len(sig)), mask=sizes < FEW_SHINGLES))


def sizes_of(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.array([len(h) for h, _ in sets], np.int64)


def far(registers: int, similar: float) -> int:
    """Registers in which two sketches of similarity ``similar`` differ, four deviations above the expectation."""
    differ = 0.75 * (1 - similar)
    return int(registers * differ + 4 * (registers * differ * (1 - differ)) ** 0.5)


def band_table(texts: DataFrame, *, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """(id, bands: array<bigint>, sketch: array<bigint>) of (id, text) rows; no row for a text without a word.

    A band is a hash of ``rows`` registers drawn for it.  The sketch has two
    bits of each of the 128 registers: two texts of similarity s differ in
    about 96 * (1 - s) of these pairs of bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        draw = np.random.default_rng(17)
        chosen = np.stack([draw.permutation(REGISTERS)[:rows] for _ in range(bands)])
        salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in released(batches):
            texts = batch.column(1).to_pylist()
            for i, j in text_slices(texts, SLICE_CHARS):
                sets = shingler.of(texts[i:j])
                has = np.flatnonzero([len(h) > 0 for h, _ in sets])
                if not len(has):
                    continue
                sig = signatures([sets[k] for k in has], REGISTERS)
                key = np.broadcast_to(salt, (len(has), bands))
                for k in range(rows):
                    key = mix64(key ^ sig[:, chosen[:, k]])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(has) * bands + 1, bands), pa.int32()),
                                                 pa.array(key.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(has + i)), lists, sketch_of(sig, sizes_of(sets)[has])], ["id", "bands", "sketch"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, bands array<bigint>, sketch array<bigint>")


def fine_sketches(texts: DataFrame, *, words: int = WORDS) -> DataFrame:
    """(id, sketch) of (id, text) rows over ``FINE_REGISTERS`` registers; no row for a text without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in released(batches):
            body = batch.column(1).to_pylist()
            for i, j in text_slices(body, SLICE_CHARS):
                sets = shingler.of(body[i:j])
                has = np.flatnonzero([len(h) > 0 for h, _ in sets])
                if len(has):
                    sketch = sketch_of(signatures([sets[k] for k in has], FINE_REGISTERS), sizes_of(sets)[has])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(has + i)), sketch], ["id", "sketch"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, sketch array<bigint>")


def one_of(name: str) -> Column:
    """The value that all rows of a group have; null if they differ (a key with several texts)."""
    return F.when(F.min(name) == F.max(name), F.min(name)).alias(name)


def registers_apart(a: str, b: str, registers: int) -> Column:
    """Pairs of bits in which two sketch columns differ."""
    total = F.lit(0)
    for i in range(registers * 2 // 64):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(PAIRS)))
    return total


def verified(pairs: DataFrame, texts: DataFrame, same: DataFrame, *, similar: float = SIMILAR, words: int = WORDS) -> DataFrame:
    """Of (a, b) id pairs those whose exact probability Jaccard similarity is at least ``similar``.

    Shingle sets are made once for each text (of ``texts``, if ``same`` has it) that occurs in a pair, then
    joined to both ends; a text in very many pairs is a skewed join key that
    adaptive execution splits.
    """

    @F.pandas_udf("hashes binary, counts binary")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in released(batches):
            body, out = list(batch), []
            for i, j in text_slices(body, SLICE_CHARS):
                out += [(h.tobytes(), c.astype(np.uint32).tobytes()) for h, c in shingler.of(body[i:j])]
            yield pd.DataFrame(out, columns=["hashes", "counts"])

    @F.pandas_udf("double")
    def similarity(ha: pd.Series, ca: pd.Series, hb: pd.Series, cb: pd.Series) -> pd.Series:
        return pd.Series([probability_jaccard((np.frombuffer(a, np.uint64), np.frombuffer(x, np.uint32)),
                                              (np.frombuffer(b, np.uint64), np.frombuffer(y, np.uint32)))
                          for a, x, b, y in zip(ha, ca, hb, cb, strict=True)])

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    own = texts.join(ids, "id", "left_semi").join(same.select(F.col("rep").alias("id"), "digest"), ["id", "digest"], "left_semi")
    sets = own.select("id", shingles("text").alias("s"))
    sets = staged(sets.select("id", "s.hashes", "s.counts"), "shingles")
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"), F.col("counts").alias("ca"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"), F.col("counts").alias("cb"))
    # a row of the comparison holds two whole shingle sets
    scored = pairs.join(left, "a").join(right, "b").select("a", "b", similarity("ha", "ca", "hb", "cb").alias("similarity"))
    return scored.filter(F.col("similarity") >= similar)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", similar: float = SIMILAR,
                    bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """(key, class_id, kept) of every row of ``docs``: classes are connected by links of similarity >= ``similar``.

    ``class_id`` is the smallest key of the class, ``kept`` whether the row
    has that key.  Equal texts are one class before any comparison.  A text
    without a word (null, empty, white space) is a class of its own.  A null
    key has a null class and is kept.  A key that comes with several texts is
    one document that links with whatever any of them links with.  Other columns are ignored; an empty table gives an
    empty result.

    Candidates: the documents of a bucket (same band) are compared with a
    pivot, not with each other, and only if pivot and document are in
    different components.  The pivot is of the bucket's largest component,
    the document there that shares most buckets with others.  The
    first round takes the buckets of ``FIRST_BANDS`` bands, the next ones
    those of all bands whose documents are not yet in one component (others
    are done for good).  A bucket that stays open makes further pivots of its
    documents outside its largest component, some a round, each compared with
    the whole bucket, until it has none that has not been one.  So every link
    within a bucket that could join two components is tried, while a bucket
    of n similar documents costs n comparisons.  A comparison first looks at
    the bits in which the sketches differ, inside the join; only pairs that
    may reach the threshold leave it and are verified on their shingles.
    After the first round the documents of open buckets get longer sketches,
    and a pair leaves the join in the first band that its documents share.
    """
    body = F.col(text).cast("string")
    rows_in = docs.select(F.col(key).cast("bigint").alias("id"), body.alias("text"),
                          F.when(body.rlike(r"\S"), F.md5(body.cast("binary"))).alias("digest"))
    worded = rows_in.filter("id IS NOT NULL AND digest IS NOT NULL")
    same = staged(worded.groupBy("digest").agg(F.min("id").alias("rep")), "same-text")
    reps = same.select(F.col("rep").alias("id")).distinct()
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        # signatures are made where the texts are read, copies included: only bands and sketches are shuffled, never all texts
        banded = staged(band_table(worded, bands=bands, rows=rows, words=words).join(reps, "id", "left_semi"), "bands")
    member = banded.select("id", F.posexplode("bands").alias("band", "bucket"))
    sizes = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = staged(member.join(sizes, "bucket"), "buckets")
    central = member.groupBy("id").agg(F.sum("n").alias("shared")).join(banded.groupBy("id").agg(one_of("sketch")), "id")
    member = staged(member.select("bucket", "band", "id").join(central, "id"), "members")
    ids = member.select("id").distinct()
    component, links, served, tried, fine = ids.withColumn("component", F.col("id")), None, None, None, False
    central_first = Window.partitionBy("bucket").orderBy(F.desc("shared"), "id")
    while True:
        if served is None:
            open_rows = member.filter(F.col("band") < FIRST_BANDS).withColumn("component", F.col("id"))
        else:
            parts = member.select("bucket", "id").join(component, "id").groupBy("bucket").agg(
                F.min("component").alias("low"), F.max("component").alias("high"))
            mixed = parts.filter("low < high").select("bucket")
            member = member.join(mixed, "bucket", "left_semi")
            if not fine:
                fine, member = True, staged(member.drop("sketch"), "open-members")
                named = member.select("id").distinct()
                with arrow_batches(docs.sparkSession, BATCH_ROWS):
                    sharp = staged(fine_sketches(worded.join(reps, "id", "left_semi").join(named, "id", "left_semi"), words=words), "sketches")
                own = sharp.groupBy("id").agg(one_of("sketch")).join(
                    banded.join(named, "id", "left_semi").groupBy("id").agg(one_of("bands")), "id")
                member = member.join(own, "id")
            open_rows = staged(member.join(component, "id"), "open")
            member = open_rows.drop("component")  # a bucket in one component stays so
        pivot = F.struct("id", "component", "sketch", *(["bands"] if fine else []))
        counted = open_rows.groupBy("bucket", "component").agg(
            F.count(F.lit(1)).alias("rows"), F.max_by(pivot, F.struct("shared", -F.col("id"))).alias("p"), F.max("shared").alias("top"))
        largest = counted.groupBy("bucket").agg(F.max_by(F.struct("component", "p"), F.struct("rows", "top", "component")).alias("most"))
        columns = ("bucket", F.col("p.id").alias("pivot"), F.col("p.component").alias("pivot_component"), F.col("p.sketch").alias("pivot_sketch"),
                   *([F.col("p.bands").alias("pivot_bands")] if fine else []))
        if served is None:
            pivots = staged(largest.select("bucket", "most.p").select(*columns), "pivots")
        else:
            largest = staged(largest, "largest")
            had = served.select("bucket").distinct()
            pivots = staged(largest.join(had, "bucket", "left_anti").select("bucket", "most.p").select(*columns), "pivots")
            if pivots.isEmpty():
                # of two documents in different components one is outside the largest: those become pivots, the most central first
                again = open_rows.join(largest.select("bucket", F.col("most.component").alias("largest")), "bucket").filter("component <> largest")
                again = again.join(served.select("bucket", F.col("pivot").alias("id")), ["bucket", "id"], "left_anti")
                again = again.withColumn("at", F.row_number().over(central_first)).filter(F.col("at") <= PIVOTS)
                pivots = staged(again.select("bucket", pivot.alias("p")).select(*columns), "pivots")
            if pivots.isEmpty():
                break
        served = pivots.select("bucket", "pivot") if served is None else served.unionByName(pivots.select("bucket", "pivot"))
        registers = FINE_REGISTERS if fine else REGISTERS
        near = F.coalesce(registers_apart("sketch", "pivot_sketch", registers) <= far(registers, similar), F.lit(True))
        if fine:
            first_shared = F.array_position(F.zip_with("bands", "pivot_bands", lambda x, y: x == y), True) - 1
            near = near & F.coalesce(first_shared == F.col("band"), F.lit(True))
        joined = open_rows.join(pivots, "bucket").filter((F.col("component") != F.col("pivot_component")) & near)
        pairs = joined.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if pairs.isEmpty():
            continue
        with arrow_batches(docs.sparkSession, BATCH_ROWS):
            found = staged(verified(pairs, worded, same, similar=similar, words=words).select("a", "b"), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            component = staged(connected_components(ids, links), "components")
    of_text = same.join(component.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("class_id"))
    out = rows_in.select("id", "digest").join(of_text, "digest", "left")
    class_id = F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id"))
    return out.select(F.col("id").alias(key), class_id.alias("class_id"),
                      F.coalesce(class_id == F.col("id"), F.lit(True)).alias("kept"))
