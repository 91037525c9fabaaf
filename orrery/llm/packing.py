"""Packing tokenized documents into fixed windows by non-negative least squares.

A document (its token ids, then an end id) gives whole windows and one
remainder.  Combinations of at most three lengths that fill a window, or a
power of two, exactly are enumerated; non-negative least squares finds how
often to repeat each so that together they use up the length histogram; the
counts are rounded down, and what is left is packed greedily, largest first.
The histogram has one row per possible length, so the plan is made on the
driver at any corpus size; documents get their place by their rank within
their length.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import released, staged
from orrery.llm.token_count import PieceEncoder, byte_balanced

WINDOW, END_ID = 2048, 1
ITERATIONS = 200


def padded(total: int, window: int = WINDOW) -> int:
    """Length after padding: the window, except that a power of two stays."""
    return total if total & (total - 1) == 0 else window


def cut_documents(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                  window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Tokenize and cut: staged rows (part, piece, doc_id, start, length, doc_tokens, ids, local_rank).

    ``ids`` are little-endian unsigned 32-bit ids.  ``part`` is the task,
    ``piece`` its running number in it, ``local_rank`` the number of earlier
    pieces of the same length in it.  A null or empty text has the end id
    alone.  Documents are taken up in slices of about 1 MiB of text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, piece, ranks = TaskContext.get().partitionId(), 0, {}
        encoder = PieceEncoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in released(batches):
            texts, keys = batch.column(1), batch.column(0)
            for i, j in byte_balanced(texts):
                rows, own = [], []
                values, codes, ends = encoder.encoded(texts.slice(i, j - i), _bytes)
                stream = pa.array(values, pa.binary()).take(pa.array(codes))
                data, bounds = stream.buffers()[2], np.frombuffer(stream.buffers()[1], np.int32)[stream.offset:]
                whole = data.to_pybytes() if data is not None else b""
                upto = bounds[np.concatenate([[0], ends])]
                for at, (begin, finish) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True), i):
                    ids = whole[begin:finish] + end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        length = min(window, total - start)
                        rank = ranks.get(length, 0)
                        ranks[length] = rank + 1
                        rows.append((part, piece, start, length, total, ids[4 * start:4 * (start + length)], rank))
                        own.append(at)
                        piece += 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), keys.take(pa.array(own)),
                     *(pa.array(c, pa.int64()) for c in columns[2:5]), pa.array(columns[5], pa.binary()),
                     pa.array(columns[6], pa.int64())], names)

    names = ["part", "piece", "doc_id", "start", "length", "doc_tokens", "ids", "local_rank"]
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return staged(rows.mapInArrow(run, f"part int, piece bigint, doc_id {kind}, start bigint, length bigint, "
                                       "doc_tokens bigint, ids binary, local_rank bigint"), "pieces")


def _bytes(ids: Sequence[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()


def combinations(present: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """(n, 3) lengths, ascending, 0 for none: singles and pairs with a power of two as their sum, triples that fill the window."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    if powers[-1] != window:
        powers.append(window)
    out = [np.array([[0, 0, p] for p in powers if has[p]]).reshape(-1, 3)]
    for p in powers:
        a = np.arange(1, p // 2 + 1)
        a = a[has[a] & has[p - a]]
        out.append(np.stack([np.zeros_like(a), a, p - a], axis=1))
    for a in present[present <= window // 3]:
        b = np.arange(a, (window - a) // 2 + 1)
        b = b[has[b] & has[window - a - b]]
        out.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(out).astype(np.int64)


def least_squares(shapes: np.ndarray, counts: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """x >= 0 that makes the lengths used by ``shapes`` (repeated x times each) come near ``counts``.

    Accelerated projected gradient on |A x - counts|^2, restarted when the
    momentum points uphill; A is never built: its columns are the shapes.
    """
    size = len(counts)

    def use(x: np.ndarray) -> np.ndarray:
        return np.bincount(shapes.ravel(), np.repeat(x, 3), size)

    def gradient(x: np.ndarray) -> np.ndarray:
        left = use(x) - counts
        left[0] = 0.0
        return left[shapes].sum(axis=1)

    # the largest eigenvalue of A'A is at most its largest row sum
    degree = np.bincount(shapes.ravel(), minlength=size).astype(float)
    degree[0] = 0.0
    rate = 1.0 / max(1.0, degree[shapes].sum(axis=1).max())
    x = np.zeros(len(shapes))
    y, t = x, 1.0
    for _ in range(iterations):
        g = gradient(y)
        new = np.maximum(0.0, y - rate * g)
        if (g * (new - x)).sum() > 0:
            t = 1.0
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of a sequence, descending) with their repeat counts; together they use the histogram exactly."""
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []

    def take(shape: Sequence[int], times: int) -> None:
        lengths, uses = np.unique([s for s in shape if s], return_counts=True)
        times = int(min(times, (counts[lengths] // uses).min()))
        if times > 0:
            counts[lengths] -= uses * times
            patterns.append((tuple(sorted((int(s) for s in shape if s), reverse=True)), times))

    shapes = combinations(np.flatnonzero(counts), window)
    if len(shapes):
        x = least_squares(shapes, counts.astype(float))
        for i in np.argsort(-x, kind="stable"):
            if x[i] < 1:
                break
            take(shapes[i], int(x[i]))
    while counts.any():
        shape, gap, left = [], window, counts.copy()
        while gap:
            fits = np.flatnonzero(left[:gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            # exact partners first: a pair of lengths that closes the gap beats the largest length
            if shape and length < gap:
                pair = fits[left[gap - fits] > (fits * 2 == gap)]
                if len(pair):
                    length = int(pair[-1])
            uses = 1 if shape else max(1, min(int(left[length]), gap // length) if length * 2 <= gap else 1)
            shape += [length] * uses
            left[length] -= uses
            gap -= uses * length
        before = counts.sum()
        take(shape, int(counts.max()))
        assert counts.sum() < before
    return patterns


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank_from, rank_to, uses, first sequence, offset): whom of a length's ranks each pattern takes, where to.

    Rank r goes to sequence first + (r - rank_from) // uses, at offset +
    ((r - rank_from) % uses) * length.
    """
    out, used, first = [], {}, 0
    for shape, times in patterns:
        offset = 0
        for length in sorted(set(shape), reverse=True):
            uses, start = shape.count(length), used.get(length, 0)
            out.append((length, start, start + times * uses, uses, first, offset))
            used[length] = start + times * uses
            offset += uses * length
        first += times
    return out


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to rows with (part, length, local_rank).

    The rank of a piece within its length is its rank in its task plus the
    pieces of that length in earlier tasks (a window over one row per task
    and length).  Only the histogram (at most ``window`` rows) goes to the
    driver; the slot table it gives is bounded by the window as well, and is
    the only broadcast.
    """
    spark = pieces.sparkSession
    local = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in local.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = slots(plan(histogram, window))
    kinds = T.StructType([T.StructField(c, T.LongType()) for c in ("length", "rank_from", "rank_to", "uses", "first", "base")])
    table = F.broadcast(spark.createDataFrame(rows, kinds))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    local = local.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = pieces.join(local, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("local_rank"))
    at = F.col("rank") - F.col("rank_from")
    placed = ranked.join(table, (ranked["length"] == table["length"]) & (ranked["rank"] >= table["rank_from"])
                         & (ranked["rank"] < table["rank_to"])).drop(table["length"])
    return (placed.withColumn("sequence_id", F.expr("first + (rank - rank_from) div uses"))
            .withColumn("offset", F.col("base") + at % F.col("uses") * F.col("length"))
            .drop("part", "local_rank", "earlier", "rank", "rank_from", "rank_to", "uses", "first", "base"))


def pack(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, payload: dict | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, payload...) that cover every id of ``docs`` once.

    ``payload`` maps column names to columns over the cut pieces, by default
    the ``ids`` themselves; it is computed before the pieces are dealt, so a
    digest of the ids does not carry the ids along.  Null keys stay null;
    repeated rows are packed each; other columns are ignored; an empty table
    gives an empty result.
    """
    payload = {"ids": F.col("ids")} if payload is None else payload
    pieces = cut_documents(docs, tokenizer, key=key, text=text, window=window, end_id=end_id)
    rows = pieces.select("part", "doc_id", "start", "length", "doc_tokens", "local_rank",
                         *(c.alias(name) for name, c in payload.items()))
    return place(rows, window).withColumnRenamed("doc_id", key)
