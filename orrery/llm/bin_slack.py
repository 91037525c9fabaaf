"""Packing token sequences into windows by minimum bin slack.

Each window takes the fullest feasible combination of the lengths that are
left: the longest length is set, a subset-sum dynamic program over the
others (one bit for each total, so a length is a few shifts of a big
integer) gives the largest total that still fits, and the way back through
its steps names the lengths.  The combination is removed as often as the
counts allow.  Lengths form a histogram with at most one row per possible
length, so the plan is made on the driver at any corpus size; pieces find
their place by their rank within their length.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import arrow_batches, staged
from orrery.llm.packing import slots
from orrery.llm.token_count import byte_balanced

WINDOW, END_ID = 2048, 0
SLICE_BYTES = 8 << 20  # text tokenized at once
KEEP_WORDS = 500_000  # words remembered by a Python worker
JOINED = 200  # words of letters encoded as one text

# classes of bytes: 0 a byte of a word, 1 white space, 2 punctuation that may be cut off a letter
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class WordEncoder:
    """Token ids of whole texts, encoding each distinct word once.

    The tokenizer drops white space and never joins what it separates, nor a
    letter with the punctuation after it, so texts are cut there (on bytes,
    in numpy) and the words encoded by the library.  A tokenizer without such
    a pre-tokenizer, and texts that hold an added token, go to the library
    whole.
    """

    def __init__(self, path: str, keep: int = KEEP_WORDS):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self._encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            head = json.load(f)
        self.specials = [t["content"] for t in head.get("added_tokens") or []]
        steps = (head.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (steps[0].get("type") == "Split" and steps[0].get("invert") is True and steps[0].get("behavior") == "Removed"
                        and r"[^\s\p{L}\p{N}]+" in steps[0].get("pattern", {}).get("Regex", "")
                        and {"type": "Lowercase"} in (head.get("normalizer") or {}).get("normalizers", []))
        # a token with the word-end suffix ends a word: words of letters can be encoded many at a time
        suffix = (head.get("model") or {}).get("end_of_word_suffix")
        self.ends = np.zeros(model.get_vocab_size(), bool)
        self.ends[[i for t, i in model.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.keep, self.known, self.held = keep, {}, 0  # held: characters of the known words
        self.pool, self.first, self.length = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _number(self, pieces: list[str]) -> list[int]:
        """Places of the pieces; their ids are ``pool[first:first + length]``."""
        distinct = list(dict.fromkeys(pieces))
        known, new = self.known, [p for p in distinct if p not in self.known]
        self.held += sum(map(len, new))
        if known and (len(known) + len(new) > self.keep or self.held > 100 * self.keep):
            known, new, self.held = {}, distinct, sum(map(len, distinct))
            self.pool, self.first, self.length = self.pool[:0], self.first[:0], self.length[:0]
        letters = [p for p in new if p.isascii() and p.isalpha()] if self.by_word else []
        rows = self._encode([" ".join(letters[i:i + JOINED]) for i in range(0, len(letters), JOINED)])
        ids = np.fromiter((i for row in rows for i in row), "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if letters and len(stops) == len(letters) and stops[-1] == len(ids):
            rest = [p for p in new if not (p.isascii() and p.isalpha())]
        else:
            letters, ids, stops, rest = [], ids[:0], stops[:0], new
        rows = self._encode(rest)
        sizes = np.concatenate([np.diff(stops, prepend=0), np.fromiter(map(len, rows), np.int64, len(rows))])
        known.update(zip([*letters, *rest], range(len(self.length), len(self.length) + len(sizes)), strict=True))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(sizes) - sizes])
        self.length = np.concatenate([self.length, sizes])
        self.pool = np.concatenate([self.pool, ids, np.fromiter((i for row in rows for i in row), "<u4")])
        self.known = known
        return [known[p] for p in pieces]

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words of the texts, and how many each text has."""
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        kind = _KIND[raw]
        inside = kind != 1
        fresh = np.zeros(len(raw) + 1, bool)  # a word starts here
        fresh[bounds] = True
        before = np.concatenate([[False], inside[:-1]])
        fresh[:-1] |= ~before
        # Latin letters in two bytes count as letters before punctuation (0xc3 0x97 and 0xb7 are signs)
        letter = _LETTER[raw]
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        fresh[1:-1] |= letter[:-1] & (kind[1:] == 2)
        starts = np.flatnonzero(fresh[:-1] & inside)
        sizes = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
        # a word reaches to the next start, white space in between is not in it; words within ASCII are lower-cased,
        # which the tokenizer does to them anyway
        high = np.add.reduceat(raw >= 128, starts, dtype=np.int64) > 0 if len(starts) else np.empty(0, bool)
        words = np.where(np.repeat(high, sizes), raw[inside], _LOWER[raw[inside]])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        array = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(words)])
        return array, np.diff(np.searchsorted(starts, bounds))

    def encoded(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, ``end_id`` after each, and where each text's ids end."""
        texts = texts.fill_null("").cast(pa.string())
        whole = np.full(len(texts), not self.by_word)
        for s in self.specials:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        words, per_text = self._words(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts)
        table, rows = words.dictionary_encode(), np.flatnonzero(whole)
        pieces = table.dictionary.to_pylist()
        numbers = np.array(self._number(pieces + texts.take(pa.array(rows)).to_pylist()), np.int64)
        codes = np.insert(numbers[table.indices.to_numpy(zero_copy_only=False)], np.cumsum(per_text)[rows], numbers[len(pieces):])
        per_text = per_text + whole
        # the end id is one more value, after each text's words
        codes = np.insert(codes, np.cumsum(per_text), len(self.length))
        lengths = np.append(self.length, 1)[codes]
        upto = np.cumsum(lengths)
        first = np.append(self.first, len(self.pool))[codes]
        ids = np.append(self.pool, np.uint32(end_id))[np.repeat(first - upto + lengths, lengths) + np.arange(upto[-1])]
        return ids, upto[np.cumsum(per_text + 1) - 1]


def cut_documents(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                  window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Tokenize: staged rows (part, doc_id, piece, start, length, ids, local_rank).

    A document of more than ``window`` ids is cut into pieces of that many;
    the last may be shorter.  ``ids`` are little-endian unsigned 32-bit ids,
    ``part`` is the task, ``local_rank`` the number of earlier pieces of the
    same length in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, ranks, encoder = TaskContext.get().partitionId(), {}, WordEncoder(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i, j in byte_balanced(texts, SLICE_BYTES):
                ids, ends = encoder.encoded(texts.slice(i, j - i), end_id)
                begins = np.concatenate([[0], ends[:-1]])
                whole, rows = ids.astype("<u4").tobytes(), []
                for at, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True), i):
                    for piece, start in enumerate(range(0, end - begin, window)):
                        length = min(window, end - begin - start)
                        rank = ranks.get(length, 0)
                        ranks[length] = rank + 1
                        rows.append((at, piece, start, length, whole[4 * (begin + start):4 * (begin + start + length)], rank))
                at, piece, start, length, own, rank = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), keys.take(pa.array(at)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(own, pa.binary()),
                     pa.array(rank, pa.int64())], ["part", "doc_id", "piece", "start", "length", "ids", "local_rank"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    with arrow_batches(docs.sparkSession, 2000):
        return staged(rows.mapInArrow(run, f"part int, doc_id {kind}, piece int, start bigint, length bigint, ids binary, "
                                           "local_rank bigint"), "pieces")


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths (each at most as often as counted) with the largest total up to ``room``, longer ones preferred.

    Bit t of the reach says whether total t can be made.  Multiples of a
    length enter as 1, 2, 4, ... copies, so that any number of copies is a
    sum of steps.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in reversed(lengths):  # ascending: the way back meets the longest first
        left, copies = min(counts[length], room // length), 1
        while left > 0:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= (reach << (length * copies)) & mask
            left, copies = left - copies, copies * 2
    total, out = reach.bit_length() - 1, []
    for length, copies, before in reversed(steps):
        size = length * copies
        if total >= size and before >> (total - size) & 1:
            out += [length] * copies
            total -= size
    return out


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Combinations (lengths of a window, descending) with their repeat counts; together they use the histogram exactly."""
    counts = dict(histogram)
    out = []
    while counts:
        lengths = sorted(counts, reverse=True)
        longest = lengths[0]
        counts[longest] -= 1
        shape = [longest, *fullest([x for x in lengths if counts[x]], counts, window - longest)]
        counts[longest] += 1
        uses = {x: shape.count(x) for x in set(shape)}
        times = min(counts[x] // n for x, n in uses.items())
        for x, n in uses.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        out.append((tuple(sorted(shape, reverse=True)), times))
    return out


def pack(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, payload: dict | None = None) -> DataFrame:
    """Pieces (key, piece, start, length, payload..., sequence_id, offset) that cover every id of ``docs`` once.

    ``payload`` maps column names to columns over the cut pieces, by default
    the ``ids`` themselves; a digest of the ids does not carry the ids along.
    The rank of a piece within its length is its rank in its task plus the
    pieces of that length in earlier tasks (a window over one row per task
    and length).  Only the histogram goes to the driver, and the slot table,
    a few rows for each possible length, is the only broadcast.

    Null and empty texts have the end id alone.  Null keys stay null;
    repeated rows are packed each; equal lengths are dealt in the order of
    the input's parts; other columns are ignored; an empty table gives an
    empty result.
    """
    payload = {"ids": F.col("ids")} if payload is None else payload
    spark = docs.sparkSession
    pieces = cut_documents(docs, tokenizer, key=key, text=text, window=window, end_id=end_id)
    local = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in local.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    kinds = T.StructType([T.StructField(c, T.LongType()) for c in ("length", "rank_from", "rank_to", "uses", "first", "base")])
    table = F.broadcast(spark.createDataFrame(slots(plan(histogram, window)), kinds)).withColumnRenamed("length", "slot_length")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    local = local.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    rows = pieces.select("part", "doc_id", "piece", "start", "length", "local_rank", *(c.alias(name) for name, c in payload.items()))
    ranked = rows.join(local, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("local_rank"))
    placed = ranked.join(table, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from"))
                         & (F.col("rank") < F.col("rank_to")))
    at = F.col("rank") - F.col("rank_from")
    return placed.select(F.col("doc_id").alias(key), "piece", "start", "length", *payload,
                         F.expr("first + (rank - rank_from) div uses").alias("sequence_id"),
                         (F.col("base") + at % F.col("uses") * F.col("length")).alias("offset"))
