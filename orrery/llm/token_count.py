"""Token counts of whole texts by a given tokenizer file, in Arrow batches.

Texts are cut at boundaries that no token crosses, the distinct pieces of a
batch are encoded together, and only lengths (or id bytes) return.  Pieces
seen before come from a bounded table, so frequent words are encoded once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20  # text taken up at once
KEEP_PIECES = 500_000  # pieces remembered by a Python worker

# Places that no piece of a byte-level BPE crosses and whose left side does not matter to what follows: before white
# space that follows something else, and after a letter that another kind of character follows (RE2 patterns).
_MARK = "\0"
_BEFORE_SPACE, _AFTER_WORD = r"([!-~\pL])([ \t\r\n])", r"(\pL)([\t\r\n!-/:-@\[-`{-~])"
_SPACES = r" ([\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]|$)"  # without these, every space is such a place
_HERE = r"\1" + _MARK + r"\2"


class PieceEncoder:
    """Encodes texts by the pieces between safe boundaries.

    ``.json`` files are read by ``tokenizers``; a byte-level pre-tokenizer
    without normalizer is cut before white space, after words, and around added
    tokens.  Other ``.json`` tokenizers and ``.model`` files
    (``sentencepiece``) get whole texts.
    """

    def __init__(self, path: str, keep: int = KEEP_PIECES):
        self.keep, self.known = keep, {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: model.encode(texts, num_threads=1)
            self.specials, self.splits = None, False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self._encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            head = json.load(f)
        pre = head.get("pre_tokenizer") or {}
        added = [t["content"] for t in head.get("added_tokens") or []]
        plain = not any(t[k] for t in head.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip"))
        self.splits = (plain and head.get("normalizer") is None and pre.get("type") == "ByteLevel"
                       and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.specials = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """Pieces whose encodings, one after the other, are the encoding of each text (without marks in it)."""
        spaced = pc.match_substring_regex(texts, _SPACES)
        marked = pc.replace_substring(texts, " ", _MARK + " ")
        if pc.any(spaced).as_py():
            marked = pc.if_else(spaced, pc.replace_substring_regex(pc.if_else(spaced, texts, ""), _BEFORE_SPACE, _HERE), marked)
        return pc.split_pattern(pc.replace_substring_regex(marked, _AFTER_WORD, _HERE), _MARK)

    def _cut_apart(self, text: str) -> list[str]:
        """The same of a text that holds added tokens or the mark."""
        parts = self.specials.split(text) if self.splits and self.specials is not None else [text]
        out = []
        for part in filter(None, parts):
            whole = not self.splits or _MARK in part or self.specials is not None and self.specials.fullmatch(part)
            out += [part] if whole else self._cut(pa.array([part], pa.string()))[0].as_py()
        return out

    def encoded(self, texts: pa.Array, form) -> tuple[list, np.ndarray, np.ndarray]:
        """(values, codes, ends): ``form(ids)`` of the distinct pieces, the pieces of all texts as positions in it, and
        where each text's pieces end.  ``form`` must be the same on every call; null texts have no pieces."""
        texts = texts.fill_null("")
        odd = pc.match_substring(texts, _MARK) if self.splits else pa.array([True] * len(texts), pa.bool_())
        if self.splits and self.specials is not None:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self.specials.pattern))
        rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        plain = pc.if_else(odd, "", texts) if len(rows) else texts
        lists = self._cut(plain)
        flat, ends = lists.flatten(), lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
        if len(rows):  # the pieces of these texts are put in place of the empty piece that stands for them
            own = [self._cut_apart(t) for t in texts.take(pa.array(rows)).to_pylist()]
            sizes = np.diff(ends, prepend=0)
            sizes[rows] = [len(p) for p in own]
            parts, at = [], 0
            for row, p in zip(rows, own, strict=True):
                parts += [flat.slice(at, ends[row] - 1 - at), pa.array(p, pa.string())]
                at = ends[row]
            flat, ends = pa.concat_arrays([*parts, flat.slice(at)]), np.cumsum(sizes)
        table = flat.dictionary_encode()
        pieces = table.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.known]
        self.known.update(zip(new, map(form, self._encode(new)), strict=True))
        values = [self.known[p] for p in pieces]
        if len(self.known) > self.keep:  # the pieces met first stay: frequent ones are among them
            for p in new:
                del self.known[p]
        return values, table.indices.to_numpy(zero_copy_only=False), ends


def byte_balanced(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes each, at least one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(sizes):
        stop = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + limit, "right"))
        stop = max(start + 1, stop)
        yield start, stop
        start = stop


def count_tokens(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    A null or empty text has 0 bytes and 0 tokens.  Special strings inside a
    text are read as the library does by default; nothing is added, cut off
    or padded.  Repeated rows are counted each; other columns are ignored; an
    empty table gives an empty result.  ``tokenizer`` is a path that every
    executor can open.  One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer)
        for batch in batches:
            texts, counts = batch.column(1), []
            for i, j in byte_balanced(texts):
                values, codes, ends = encoder.encoded(texts.slice(i, j - i), len)
                upto = np.concatenate([[0], np.cumsum(np.array(values, np.int64)[codes])])
                counts.append(np.diff(upto[ends], prepend=0))
            column = np.concatenate(counts) if counts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(column, pa.int64()), batch.column(2)],
                                             ["k", "n_tokens", "n_bytes"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"),
                       F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")).alias("n"))
    kind = rows.schema["k"].dataType.simpleString()
    out = rows.mapInArrow(run, f"k {kind}, n_tokens long, n_bytes long")
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
