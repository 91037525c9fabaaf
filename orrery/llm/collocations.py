"""Phrases whose words occur together more often than their parts would by chance.

Texts become word numbers once.  Then, for 2 to 5 words in turn: candidates
are windows of the corpus whose two overlapping shorter windows are frequent
(Apriori) and which hashed counts, and then counts that stop at the least
count, leave possible; they form double-array tries of bounded size, which
are broadcast one at a time; in each task numpy advances the states of all
text positions level by level and counts the accepting states, and Spark sums
the tasks' counts.  These are exact; the stopped counts before only leave out
what cannot be frequent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import arrow_batches, ranked, setting, staged
from orrery.llm.token_count import byte_balanced
from orrery.llm.trie import Trie

LONGEST, LEAST = 5, 100
SLICE_BYTES = 1 << 18  # text of one row of codes
VOCABULARY = 1 << 20  # words broadcast at once
TRIE = 1 << 20  # candidates of one trie
BLOCK = 1 << 16  # buckets of the hashed counts in one row
MOST_BUCKETS = 1 << 26  # a byte each in a task, a bit each in the broadcast
WORDS_A_BUCKET = 16
HELD = 1 << 21  # distinct windows that a task holds before it passes them on
UNDETERMINED = "und"

# 0 a byte of a word, 1 a space between words, 2 the end of a piece
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, fresh, per_text): all words with A-Z lower-cased, which of them begin a piece, and how many each text has."""
    texts = texts.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    kind = _KIND[raw]
    inside = kind == 0
    new = np.zeros(len(raw) + 1, bool)
    new[bounds] = True
    new = new[:-1] | ~np.concatenate([[False], inside])[:-1]
    starts = np.flatnonzero(new & inside)
    per_text = np.diff(np.searchsorted(starts, bounds))
    sizes = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
    ends = np.cumsum(kind == 2, dtype=np.int32)[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = ends[1:] != ends[:-1]
    begin = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    fresh[begin[per_text > 0]] = True
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[inside]])])
    return words, fresh, per_text


def keyed(langs: pa.Array, words: pa.Array, per_text: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct (language, word) as one text each, a tab in between (no word has one), and the number of each word's."""
    table, names = words.dictionary_encode(), langs.dictionary_encode()
    which = np.repeat(names.indices.to_numpy(zero_copy_only=False).astype(np.int64), per_text)
    wide = max(1, len(table.dictionary))
    pairs, numbers = np.unique(which * wide + table.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    keys = pc.binary_join_element_wise(names.dictionary.cast(pa.large_string()).take(pa.array(pairs // wide)),
                                               table.dictionary.take(pa.array(pairs % wide)), pa.scalar("\t", pa.large_string()))
    return keys, numbers


def word_counts(rows: DataFrame) -> DataFrame:
    """(key, f): occurrences of each word of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in byte_balanced(batch.column(1), 32 * SLICE_BYTES):
                part = batch.slice(i, j - i)
                words, _, per_text = words_of(part.column(1))
                keys, numbers = keyed(part.column(0), words, per_text)
                yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(np.bincount(numbers, minlength=len(keys)), pa.int64())],
                                                 ["key", "f"])

    return rows.mapInArrow(run, "key string, f bigint").groupBy("key").agg(F.sum("f").alias("f"))


def encode(rows: DataFrame, vocabulary: DataFrame, size: int, most: int) -> DataFrame:
    """Staged rows (codes): word numbers as little-endian 32-bit integers, -1 between pieces and for words not in the vocabulary.

    The vocabulary (key, pos) is broadcast in parts of ``most`` words; with
    more than one part, texts and codes so far go through a table between the
    parts, and the last one leaves the texts out.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("codes", F.lit(None).cast("binary"))
    parts = max(1, -(-size // most))
    for part in range(parts):
        own = vocabulary.filter((F.col("pos") >= part * most) & (F.col("pos") < (part + 1) * most)).select("key", "pos").toArrow()
        shared = spark.sparkContext.broadcast((own["key"].combine_chunks().cast(pa.large_string()), own["pos"].to_numpy()))
        last = part == parts - 1

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            known, numbers = shared.value
            numbers = np.append(numbers, -1).astype(np.int32)
            for batch in batches:
                for i, j in byte_balanced(batch.column(1), SLICE_BYTES):
                    some = batch.slice(i, j - i)
                    words, fresh, per_text = words_of(some.column(1))
                    keys, which = keyed(some.column(0), words, per_text)
                    at = pc.index_in(keys, value_set=known).fill_null(len(known)).to_numpy(zero_copy_only=False)
                    codes = numbers[at][which] if len(which) else np.empty(0, np.int32)
                    before = [b for b in some.column(2).to_pylist() if b]
                    if before:
                        codes = np.maximum(codes, np.frombuffer(b"".join(before), np.int32))
                    if last:
                        codes = np.append(np.insert(codes, np.flatnonzero(fresh), -1), -1).astype("<i4")
                        yield pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary())], ["codes"])
                    else:
                        upto = np.concatenate([[0], np.cumsum(per_text)]).tolist()
                        own = [codes[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(own, pa.binary())], ["lang", "text", "codes"])

        rows = staged(rows.mapInArrow(run, "codes binary" if last else "lang string, text string, codes binary"), "codes")
        shared.unpersist()
    return rows


def arrays_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")


def windows_of(codes: np.ndarray, trie: Trie | None, good: np.ndarray | None, offset: int, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, words): frequent windows and the word after each, where the window that ends in that word may be frequent too.

    Without a trie the windows are single words.  ``both``: all frequent
    windows are in this trie, so the second one is looked up as well.
    """
    number = np.full(len(codes) + 1, -1, np.int64)
    if trie is None:
        number[:-1], depth = codes, 1
    else:
        at, found = trie.walk(codes)
        keep = good[found]
        number[at[keep]], depth = found[keep], trie.depth
    after = np.concatenate([codes, np.full(depth + 1, -1, codes.dtype)])[depth:depth + len(codes) + 1]
    go = (number >= 0) & (after >= 0)
    if both:
        go[:-1] &= number[1:] >= 0
    at = np.flatnonzero(go)
    return number[at] + offset, after[at].astype(np.int64)


def bucket_of(windows: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each window: a multiplicative hash."""
    return ((windows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def blocks_of(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's counts as rows (block, counts) of BLOCK counts each, without blocks that are all zero."""
    for block in range(0, len(counts), BLOCK):
        some = counts[block:block + BLOCK]
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([some.tobytes()], pa.binary())], ["block", "counts"])


def summed(blocks: DataFrame, kind: type, finish: Callable[[int, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """Sums of the tasks' blocks: they are dealt by block and added up one row at a time; ``finish`` turns a sum into rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.empty(0, np.int64)
        for batch in batches:
            for own, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(counts, kind)
                if own != block:
                    if block is not None:
                        yield finish(block, total)
                    block, total = own, np.zeros(len(more), np.int64)
                total += more
        if block is not None:
            yield finish(block, total)

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(add, schema)


def likely_buckets(codes: DataFrame, shared, least: int, words: int, buckets: int) -> np.ndarray:
    """Bits of the buckets whose windows occur ``least`` times or more in all.

    A task's count stops at ``least``: a sum of stopped counts reaches it
    exactly when the sum of the true ones does.  A bit for each bucket comes
    to the driver.
    """
    kind = np.uint8 if least < 256 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(buckets, kind)
        for array in arrays_of(batches):
            number, word = windows_of(array, *shared.value)
            at, more = np.unique(bucket_of(number * words + word, buckets), return_counts=True)
            own[at] = np.minimum(own[at] + more, least)
        yield from blocks_of(own)

    def finish(block: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())],
                                          ["block", "bits"])

    out = summed(codes.mapInArrow(count, "block bigint, counts binary"), kind, finish, "block bigint, bits binary")
    bits = np.zeros(buckets // 8, np.uint8)
    for row in out.collect():
        bits[row["block"] // 8:(row["block"] + BLOCK) // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def possible(codes: DataFrame, shared, bits, least: int, words: int, buckets: int) -> DataFrame:
    """(window): number of the shorter window * words + next word, of the windows that occur ``least`` times or more.

    Counts of windows in likely buckets, stopped at ``least`` in each task as above.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for array in arrays_of(batches):
            number, word = windows_of(array, *shared.value)
            windows = number * words + word
            at = bucket_of(windows, buckets)
            windows, more = np.unique(windows[bits.value[at >> 3] >> (7 - (at & 7)) & 1 > 0], return_counts=True)
            both, place = np.unique(np.concatenate([held, windows]), return_inverse=True)
            held, counts = both, np.minimum(np.bincount(place, np.concatenate([counts, more]), len(both)), least).astype(np.int64)
            if len(held) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts, pa.int32())], ["window", "f"])
                held, counts = held[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts, pa.int32())], ["window", "f"])

    seen = codes.mapInArrow(run, "window bigint, f int").groupBy("window").agg(F.sum("f").alias("f"))
    return seen.filter(F.col("f") >= least).select("window")


def accepted(codes: DataFrame, shared, offset: int, size: int, least: int) -> DataFrame:
    """(pos, f): how often each candidate of a trie occurs, if ``least`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, counts = shared.value, np.zeros(size, np.int64)
        for array in arrays_of(batches):
            counts += np.bincount(trie.walk(array)[1], minlength=size)
        yield from blocks_of(counts)

    def finish(block: int, total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total >= least)
        return pa.RecordBatch.from_arrays([pa.array(at + block + offset, pa.int64()), pa.array(total[at], pa.int64())], ["pos", "f"])

    return summed(codes.mapInArrow(count, "block bigint, counts binary"), np.int64, finish, "pos bigint, f bigint")


def phrases(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
            vocabulary: int = VOCABULARY, most: int = TRIE) -> tuple[DataFrame, DataFrame]:
    """(frequent, totals): staged (lang, phrase, codes, f) of all phrases of 1 to ``longest`` words that occur ``least`` times
    or more in their language, and (lang, n), all word occurrences."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col(text).cast("string").alias("text"))
    with ExitStack() as stack:
        stack.enter_context(arrow_batches(spark, 1000))
        counts = staged(word_counts(rows), "words")
        split = lambda i: F.expr(f"substring_index(key, '\t', {i})")
        languages = F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)")
        totals = staged(counts.groupBy(languages.alias("lang")).agg(F.sum("f").alias("n")), "totals")
        level = ranked(counts.filter(F.col("f") >= least).withColumn("all", F.lit(0)), "all", ["key"], "vocabulary")
        level = staged(level.select("pos", "key", languages.alias("lang"), split(-1).alias("phrase"),
                                    F.array(F.col("pos").cast("int")).alias("codes"), "f"), "phrases")
        words = level.count()
        total, buckets = totals.agg(F.sum("n")).first()[0] or 0, BLOCK
        while buckets < MOST_BUCKETS and buckets * WORDS_A_BUCKET < total:
            buckets *= 2
        codes = encode(rows, level, words, vocabulary) if words else None
    single, levels = level, [level]
    with ExitStack() as stack:
        # a row has up to 100 KB: few rows at a time, in the reader and in Python
        stack.enter_context(arrow_batches(spark, 64))
        stack.enter_context(setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "256"))
        tries = [(None, None, 0)]
        for depth in range(2, longest + 1 if words else 2):
            both = len(tries) == 1
            found = []
            for trie, good, offset in tries:
                shared = spark.sparkContext.broadcast((trie, good, offset, both))
                bits = spark.sparkContext.broadcast(likely_buckets(codes, shared, least, words, buckets))
                found.append(staged(possible(codes, shared, bits, least, words, buckets), "windows"))
                shared.unpersist()
                bits.unpersist()
            pairs = reduce(DataFrame.union, found).select(F.expr(f"window div {words}").alias("pos"), (F.col("window") % words).alias("next"))
            added = single.select(F.col("pos").alias("next"), F.col("phrase").alias("word"))
            whole = pairs.join(levels[-1], "pos").join(added, "next").select(
                "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.concat("codes", F.array(F.col("next").cast("int"))).alias("codes"))
            if not both:
                whole = whole.join(levels[-1].select(F.col("codes").alias("tail")), F.expr(f"slice(codes, 2, {depth - 1}) = tail"), "left_semi")
            candidates = staged(ranked(whole.withColumn("all", F.lit(0)), "all", ["codes"], "candidates").drop("all", "size"), "candidates")
            size = candidates.count()
            if not size:
                break
            tries, parts = [], []
            for offset in range(0, size, most):
                some = candidates.filter((F.col("pos") >= offset) & (F.col("pos") < offset + most))
                own = some.select("pos", *(F.col("codes")[i].alias(f"w{i}") for i in range(depth))).toArrow()
                trie = Trie(np.stack([own[f"w{i}"].to_numpy() for i in range(depth)], axis=1), own["pos"].to_numpy() - offset)
                shared = spark.sparkContext.broadcast(trie)
                sums = staged(accepted(codes, shared, offset, min(most, size - offset), least), "counts")
                shared.unpersist()
                good = np.zeros(min(most, size - offset), bool)
                good[sums.select("pos").toArrow()["pos"].to_numpy() - offset] = True
                parts.append(sums)
                if good.any():
                    tries.append((trie, good, offset))
            levels.append(staged(candidates.join(reduce(DataFrame.union, parts), "pos"), "phrases"))
            if not tries:
                break
    return reduce(DataFrame.unionByName, [x.select("lang", "phrase", "codes", "f") for x in levels]), totals


def score(a: str, n: str, first: str, rest: str) -> F.Column:
    """floor(1000 * a * n / (l * r)) in exact decimal arithmetic."""
    wide = lambda c: f"cast({c} as decimal(20, 0))"
    return F.expr(f"cast(1000 as decimal(4, 0)) * {wide(a)} * {wide(n)} div ({wide(first)} * {wide(rest)})")


def collocations(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
                 share: int = 100, top: int = 2000, **sizes: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words.

    Texts are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line
    breaks, and these into words at spaces and tabs.  n is the number of
    words of the language, a how often the phrase occurs in pieces, overlaps
    included; only phrases with a >= ``least`` count.  Cut after its first k
    words, a phrase has l = occurrences of the first part, r = of the rest
    and the score floor(1000 a n / (l r)); the cut with the lowest score
    counts, the smallest k of several.  A phrase inside a longer one with
    100 f(longer) >= ``share`` a is left out; the test against phrases of one
    word more suffices, since such a phrase lies between any two.

    A null language is ``und``, together with texts that say so; null, empty
    and blank texts have no words; long texts are read whole; repeated rows
    count each; ties in score and a go by the phrase's UTF-8 bytes; other
    columns are ignored; an empty table gives an empty result.
    """
    frequent, totals = phrases(docs, lang=lang, text=text, least=least, longest=longest, **sizes)
    many = frequent.filter(F.size("codes") > 1)
    lone = frequent.select(F.col("codes").alias("part"), F.col("f").alias("part_f"))
    cuts = many.withColumn("k", F.explode(F.expr("sequence(1, size(codes) - 1)"))).select(
        "lang", "phrase", "codes", F.col("f").alias("a"), "k", F.expr("slice(codes, 1, k)").alias("first"),
        F.expr("slice(codes, k + 1, size(codes) - k)").alias("rest"))
    cuts = (cuts.join(lone.select(F.col("part").alias("first"), F.col("part_f").alias("l")), "first")
            .join(lone.select(F.col("part").alias("rest"), F.col("part_f").alias("r")), "rest").join(totals, "lang"))
    cuts = cuts.withColumn("score", score("a", "n", "l", "r"))
    best = cuts.groupBy("lang", "phrase", "codes", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = many.filter(F.size("codes") > 2).select(
        F.explode(F.array(F.expr("slice(codes, 1, size(codes) - 1)"), F.expr("slice(codes, 2, size(codes) - 1)"))).alias("codes"), "f")
    longer = longer.groupBy("codes").agg(F.max("f").alias("longer"))
    kept = best.join(longer, "codes", "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True)))
    kept = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
