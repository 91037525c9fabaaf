"""Quality classification by ordinal cumulative-link regression over hashed text.

Grades are ordered 0..K-1.  One weight vector, shared by all grades, maps a
text's hashed features to a latent score s; ordered thresholds t_1 < ... <
t_{K-1} give P(grade >= k) = 1 / (1 + exp(t_k - s)).  The expected grade is
the sum of these tail probabilities; one of them decides the selection.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import released, staged, text_slices

BITS = 18  # features are hashed to 2 ** BITS weights
SAMPLE = 6000  # rows that may be learned from, at most
RARE = 0.005  # features in a smaller share of the sampled rows (or in fewer than 3 rows) get no weight

_WORD = re.compile(r"\w+")
_LETTERS, _DIGITS, _AGAIN = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")


def shape(token: str) -> str:
    """A token's outline: a run of capitals as A, of other letters as a, of digits as 0; other runs once; 4 characters."""
    capital = len(token) > 1 and token.isupper()
    return _AGAIN.sub(r"\1", _DIGITS.sub("0", _LETTERS.sub("A" if capital else "a", token)))[:4]


class Features:
    """Hashed features of texts: whether each word and each stem (first letters of a longer word) occurs, and shares of
    the text's tokens: those of each outline, those that follow an equal token, and those that occurred before.

    Tokens stand between white space; a token's word is its letters and
    digits in lower case.  Known tokens are kept in a table that is emptied
    when it has grown past a bound, so frequent tokens are hashed once.
    """

    def __init__(self, bits: int = BITS, keep: int = 250_000):
        self.mask, self.keep = (1 << bits) - 1, keep
        self.known: dict[str, int] = {}
        self.outline, self.word, self.stem = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.again, self.before = self._slot("r:again"), self._slot("r:before")

    def _slot(self, name: str) -> int:
        return zlib.crc32(name.encode("utf-8", "replace")) & self.mask

    def _learn(self, tokens: set[str]) -> None:
        new = list(tokens.difference(self.known))
        if len(self.known) + len(new) > self.keep:
            self.known, new = {}, list(tokens)
            self.outline, self.word, self.stem = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        words = ["".join(_WORD.findall(t)).lower() for t in new]
        self.outline = np.concatenate([self.outline, np.array([self._slot("s:" + shape(t)) for t in new], np.int64)])
        self.word = np.concatenate([self.word, np.array([self._slot("w:" + w) if w else -1 for w in words], np.int64)])
        self.stem = np.concatenate([self.stem, np.array([self._slot("p:" + w[:STEM]) if len(w) > STEM else -1 for w in words], np.int64)])

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, slot, value) of the texts' features, rows ascending; a text without a token has none."""
        split = [t.split() for t in texts]
        self._learn(set().union(*split))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        ids = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(texts)), sizes)
        share = SHARE / np.maximum(1, sizes)
        size = self.mask + 1
        outlines, counts = np.unique(row * size + self.outline[ids], return_counts=True)
        word, stem = self.word[ids], self.stem[ids]
        words = np.unique(np.concatenate([(row * size + word)[word >= 0], (row * size + stem)[stem >= 0]]))
        again = np.bincount(row[1:][(ids[1:] == ids[:-1]) & (row[1:] == row[:-1])], minlength=len(texts))
        distinct = np.bincount(np.unique(row * len(self.known) + ids) // max(1, len(self.known)), minlength=len(texts))
        some = np.flatnonzero(sizes)
        rows = np.concatenate([outlines // size, words // size, some, some])
        slots = np.concatenate([outlines % size, words % size, np.full(len(some), self.again), np.full(len(some), self.before)])
        values = np.concatenate([counts * share[outlines // size], np.full(len(words), WORD), (again * share)[some],
                                 ((sizes - distinct) * share)[some]])
        order = np.argsort(rows, kind="stable")
        return rows[order], slots[order], values[order]


SHARE, WORD = 8.0, 0.5  # values of a share of 1, and of a word or stem that occurs
STEM = 4  # letters of a stem


@dataclass
class Model:
    """Weights by slot, ascending thresholds (one fewer than grades), and the number of bits."""

    weights: np.ndarray
    thresholds: np.ndarray
    bits: int = BITS

    def tails(self, latent: np.ndarray) -> np.ndarray:
        """(rows, grades - 1): P(grade >= 1), P(grade >= 2), ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - latent[:, None], -60, 60)))

    def latent(self, features: tuple[np.ndarray, np.ndarray, np.ndarray], rows: int) -> np.ndarray:
        row, slot, value = features
        return np.bincount(row, self.weights[slot] * value, rows)


def fit_ordinal(features: tuple[np.ndarray, np.ndarray, np.ndarray], grades: np.ndarray, top: int, *, bits: int = BITS,
                epochs: int = 200, penalty: float = 2e-4, sparse: float = 1e-3, rate: float = 0.05) -> Model:
    """Maximum likelihood of the cumulative-link model with an L2 and a (smoothed) L1 penalty, by Adam over all rows.

    There are more words than rated rows; the L1 penalty ``sparse`` keeps the
    few rows of a rare grade from being learned by their incidental words.

    Thresholds are the first one and positive gaps (softplus), so their order
    always holds.  Grades weigh the same in total, whatever their share.
    """
    size = 1 << bits
    model = Model(np.zeros(size), np.arange(top, dtype=float), bits)
    n = len(grades)
    if not n:
        return model
    owner, slots, values = features
    use = (np.bincount(slots, minlength=size) >= max(3, RARE * n))[slots]
    owner, slots, values = owner[use], slots[use], values[use]
    known, slots = np.unique(slots, return_inverse=True)
    share = np.bincount(grades, minlength=top + 1)
    balance = (n / np.maximum(1, share) / max(1, (share > 0).sum()))[grades] / n
    w, raw = np.zeros(len(known)), np.concatenate([[-1.0], np.full(top - 1, 1.0)])
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(raw), np.zeros_like(raw)]
    at = np.arange(n)
    for step in range(1, epochs + 1):
        cuts = raw[0] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(raw[1:])))])
        s = np.bincount(owner, w[slots] * values, n)
        tail = np.concatenate([np.ones((n, 1)), Model(w, cuts).tails(s), np.zeros((n, 1))], axis=1)
        p = np.maximum(tail[at, grades] - tail[at, grades + 1], 1e-9)
        slope = tail * (1 - tail)  # derivative of each tail by s, minus that by its threshold
        upper, lower = slope[at, grades], slope[at, grades + 1]
        d_s = -(upper - lower) / p * balance
        d_cuts = np.zeros((n, top + 2))
        np.add.at(d_cuts, (at, grades), upper / p * balance)
        np.add.at(d_cuts, (at, grades + 1), -lower / p * balance)
        by_cut = d_cuts[:, 1:-1].sum(axis=0)
        later = np.cumsum(by_cut[::-1])[::-1]
        d_raw = np.concatenate([[later[0]], later[1:] / (1 + np.exp(-raw[1:]))])
        d_w = np.bincount(slots, d_s[owner] * values, len(known)) + penalty * w + sparse * np.tanh(50 * w)
        pace = rate * min(1.0, 2 * (1 - step / (epochs + 1)))
        for x, g, m, v in ((w, d_w, moments[0], moments[1]), (raw, d_raw, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model.weights[known] = w
    model.thresholds = raw[0] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(raw[1:])))])
    return model


def grade_column(quality: Column, toxic: Column) -> Column:
    """Grade of a label row: 0 for bad quality, 1 for good quality that is toxic, 2 for good quality that is not (a null
    flag of toxicity counts as not); null without a quality."""
    return F.when(quality == 0, 0).when(quality == 1, F.when(toxic == 1, 1).otherwise(2))


def fit(docs: DataFrame, ratings: DataFrame, *, key: str = "doc_id", text: str = "text", grade: str = "grade", top: int = 2,
        sample_rows: int = SAMPLE, **options) -> Model:
    """Learn from rated rows: of each grade 0..``top`` those with the smallest hash of the key, ``sample_rows`` in all at most.

    ``ratings`` has the key and an integer grade.  A key that is rated more
    than once counts with its least grade; null keys, grades, and texts, and
    grades out of range teach nothing.  Only (key, grade) is ranked; the
    sampled keys (at most ``sample_rows``) are broadcast to find their texts,
    and executors send their hashed features: at most one entry per distinct
    word of a sampled text.
    """
    each = max(1, sample_rows // (top + 1))
    rated = ratings.filter(F.col(key).isNotNull() & F.col(grade).between(0, top)).groupBy(F.col(key).alias("k")).agg(
        F.min(grade).cast("int").alias("grade"))
    known = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k")).join(rated, "k")
    # the limit by rank is applied before the shuffle too: each task sends few rows of a grade
    order = Window.partitionBy("grade").orderBy(F.xxhash64(F.col("k").cast("string"), F.lit("rate")), "k")
    picked = known.distinct().withColumn("at", F.row_number().over(order)).filter(F.col("at") <= each).select("k", "grade")
    picked = staged(picked, "rated")
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull())
    sample = rows.join(F.broadcast(picked), "k")

    @F.pandas_udf("slots binary, values binary")  # packed: lists of Python numbers would fill the driver
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = Features()
        for texts in released(batches):
            row, slot, value = table.of(list(texts))
            cut = np.searchsorted(row, np.arange(1, len(texts)))
            yield pd.DataFrame({"slots": [x.tobytes() for x in np.split(slot.astype("<i4"), cut)],
                                "values": [x.tobytes() for x in np.split(value.astype("<f4"), cut)]}
                               if len(texts) else {"slots": [], "values": []})

    got = sample.select("k", "grade", features("text").alias("f")).select("k", "grade", "f.*").collect()
    got.sort(key=lambda r: (str(r["k"]), r["slots"], r["values"]))
    sizes = [len(r["slots"]) // 4 for r in got]
    parts = (np.repeat(np.arange(len(got)), sizes), np.frombuffer(b"".join(r["slots"] for r in got), "<i4").astype(np.int64),
             np.frombuffer(b"".join(r["values"] for r in got), "<f4").astype(np.float64))
    return fit_ordinal(parts, np.array([r["grade"] for r in got], np.int64), top, **options)


def score_column(model: Model, text: Column) -> Column:
    """struct<latent, expected_grade, tails: array>: tails[k - 1] is P(grade >= k).

    A null text scores like an empty one: no feature, latent 0.  Whole texts
    are read, in slices of bounded size.
    """
    kind = T.StructType([T.StructField("latent", T.DoubleType()), T.StructField("expected_grade", T.DoubleType()),
                         T.StructField("tails", T.ArrayType(T.DoubleType()))])

    @F.pandas_udf(kind)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = Features(model.bits)
        for texts in released(batches):
            latent = np.zeros(len(texts))
            body = [t or "" for t in texts]
            for i, j in text_slices(body):
                latent[i:j] = model.latent(table.of(body[i:j]), j - i)
            tails = model.tails(latent)
            yield pd.DataFrame({"latent": latent, "expected_grade": tails.sum(axis=1), "tails": list(tails)})

    return score(text.cast("string"))


def classify(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", at_least: int = 1,
             threshold: float = 0.5) -> DataFrame:
    """(key, expected_grade, p_tail, p_tail_2, kept) of every row: P(grade >= 1), P(grade >= 2) (null if the model has no
    grade 2), and kept if P(grade >= ``at_least``) reaches ``threshold``.

    Null, empty and wordless texts have no feature; they get the grade of
    latent 0.  Repeated rows get equal results, null keys stay null, other
    columns are ignored, an empty table gives an empty result.  No shuffle.
    """
    scored = docs.select(F.col(key), score_column(model, F.col(text)).alias("s"))
    tails = F.col("s.tails")
    return scored.select(key, F.col("s.expected_grade").alias("expected_grade"), tails[0].alias("p_tail"),
                         F.get(tails, F.lit(1)).alias("p_tail_2"), (tails[at_least - 1] >= threshold).alias("kept"))
