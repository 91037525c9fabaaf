"""URL filtering with a bit-parallel wildcard automaton.

All rules are compiled to globs over one canonical string per URL and packed
into the bits of a few 64-bit words.  One Shift-And step per byte advances
every rule of every URL of an Arrow batch at once.

Canonical URL: ``"." + host + path``.  The host is what follows the first
``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path
goes on up to ``?``, ``#`` or the end.  A null URL, or one without ``://``,
has an empty host and path.  Globs: ``*`` runs within the host (any byte but
``/``), ``**`` runs over anything, every other byte stands for itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = 64


class Rule(NamedTuple):
    """A host with all its subdomains, a path prefix, and the verdict."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


class Automaton:
    """Multiword Shift-And masks of a list of globs.

    Bit i of the state is set when the literal bytes of its glob up to
    position i have been read.  ``step[b]`` has the bits that byte b enters,
    ``stay[b]`` the bits that byte b keeps (a star follows them), ``start``
    the first bit of each glob, ``at_start`` those that a leading star lets
    start at any byte.  Each glob must have a literal byte.
    """

    def __init__(self, globs: Sequence[str]):
        parsed = [self._parse(g) for g in globs]
        bits = sum(len(p[1]) for p in parsed)
        self.words = max(1, -(-bits // WORD))
        self.step, self.stay, self.lead = (np.zeros((256, self.words), np.uint64) for _ in range(3))
        self.first, self.start = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        bit = 0
        for lead, literals in parsed:
            for k, (byte, star) in enumerate(literals):
                w, mask = bit // WORD, np.uint64(1 << (bit % WORD))
                self.step[byte, w] |= mask
                for b in self._loop(star):
                    self.stay[b, w] |= mask
                if k == 0:
                    self.first[w] |= mask
                    self.start[w] |= mask
                    for b in self._loop(lead):
                        self.lead[b, w] |= mask
                bit += 1
            # without a last star the last bit is not kept: it is set after the last byte only if the glob ends there
            self.final.append((w, mask))

    @staticmethod
    def _loop(star: str) -> Iterable[int]:
        return () if not star else range(256) if star == "**" else (b for b in range(256) if b != ord("/"))

    @staticmethod
    def _parse(glob: str) -> tuple[str, list[tuple[int, str]]]:
        lead, literals, data, i = "", [], glob.encode(), 0
        while i < len(data):
            if data[i] == ord("*"):
                run = 1
                while i + run < len(data) and data[i + run] == ord("*"):
                    run += 1
                star = "**" if run > 1 else "*"
                if literals:
                    literals[-1] = (literals[-1][0], star)
                else:
                    lead = star
                i += run
            else:
                literals.append((data[i], ""))
                i += 1
        if not literals:
            raise ValueError(f"glob without a literal byte: {glob!r}")
        return lead, literals

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """(texts x globs) booleans: which globs match which whole text.

        Texts are stepped together, longest first, so each byte position
        works on the texts that still have one: long texts cost their own
        length only.
        """
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        size = lengths[order]
        live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        state = np.zeros((len(texts), self.words), np.uint64)
        may = np.tile(self.start, (len(texts), 1))  # first bits that the next byte may enter
        one, top = np.uint64(1), np.uint64(WORD - 1)
        for at, n in enumerate(live):
            byte = data[begin[:n] + at]
            now, enter = state[:n], may[:n]
            moved = now << one
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> top
            moved &= ~self.first
            state[:n] = ((moved | enter) & self.step[byte]) | (now & self.stay[byte])
            may[:n] = enter & self.lead[byte]
        out = np.zeros((len(texts), len(self.final)), bool)
        for k, (w, mask) in enumerate(self.final):
            out[order, k] = (state[:, w] & mask) != 0
        return out


def host_column(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_column(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url",
                default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) of every row of ``pages``.

    Of the rules that fit a URL the one with the longest name wins (on equal
    length the earlier of the list); without one, ``rule`` is null and the
    verdict is ``default``.  Null, empty and malformed URLs are judged by
    their empty host and path.  Repeated rows give repeated results; an empty
    table gives an empty result; other columns of ``pages`` are ignored.  No
    shuffle: one pass over the URL column; the rules travel with the task.
    """
    rules = list(rules)
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    names = np.array([rules[i].name for i in ranked] + [None], object)
    automaton = Automaton([rules[i].glob for i in ranked]) if rules else None

    @F.pandas_udf("string")
    def winner(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for canonical in batches:
            texts = [t.encode("utf-8") for t in canonical]
            if automaton is None or not texts:
                yield pd.Series([None] * len(texts), dtype=object)
                continue
            hit = automaton.match(texts)
            best = np.where(hit.any(axis=1), hit.argmax(axis=1), len(ranked))
            yield pd.Series(names[best], dtype=object)

    parts = pages.select(F.col(key), host_column(F.col(url)).alias("host"), path_column(F.col(url)).alias("path"))
    judged = parts.withColumn("rule", winner(F.concat(F.lit("."), "host", "path")))
    verdict = F.lit(default)
    for r in rules:
        verdict = F.when(F.col("rule") == r.name, r.verdict).otherwise(verdict)
    return judged.select(key, "host", "path", "rule", verdict.alias("verdict"))
