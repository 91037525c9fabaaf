"""Language identification by a bidirectional gated recurrent network over bytes.

The network (minimal gated units, one chain per direction) is trained in
numpy by backpropagation through time on a bounded sample, labels every byte
position of every text, and a document's probabilities are the mean over its
letter positions.  Texts are read in consecutive segments of fixed length;
many segments step through the network together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import released

SEGMENT = 128  # bytes that are read from a fresh state, in both directions
HIDDEN = 8
BLOCK = 1024  # segments stepped together
UNDETERMINED = "und"

#: Positions that count for a document: ASCII letters and all bytes of longer characters.
LETTER = np.array([chr(b).isascii() and chr(b).isalpha() or b >= 128 for b in range(256)])


@dataclass
class Network:
    """Weights of both directions (first axis); gates stacked as [forget; candidate].

    For byte b and state h: f = clip(1/2 + (embed_f[b] + Uf h) / 4, 0, 1), n =
    softsign(embed_n[b] + f * (Un h)), h' = h + f * (n - h); these activations
    cost a few plain array operations.  Label scores are ``out`` times the two
    states of a position plus ``bias``.
    """

    labels: list[str]
    embed: np.ndarray  # (2, 2 * hidden, 256)
    inner: np.ndarray  # (2, 2 * hidden, hidden)
    out: np.ndarray  # (labels, 2 * hidden)
    bias: np.ndarray  # (labels, 1)

    @classmethod
    def fresh(cls, labels: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
        return cls(labels, 0.3 * draw(2, 2 * hidden, 256), draw(2, 2 * hidden, hidden) / hidden ** 0.5,
                   draw(len(labels), 2 * hidden) / hidden ** 0.5, np.zeros((len(labels), 1), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.inner, self.out, self.bias]

    def states(self, data: np.ndarray, keep: bool = False):
        """States of both directions at every position of ``data`` (segments x length): (length, 2, hidden, segments).

        The backward chain is stored at the position it has just read.  With
        ``keep`` also the intermediate values that training needs.
        """
        n, length = data.shape
        hidden = self.inner.shape[2]
        columns = np.ascontiguousarray(data.T)
        h = np.zeros((2, hidden, n), np.float32)
        out = np.empty((length, 2, hidden, n), np.float32)
        gates = np.empty((2, 2 * hidden, n), np.float32)
        trace = []
        for t in range(length):
            back = length - 1 - t
            np.take(self.embed[0], columns[t], axis=1, out=gates[0], mode="clip")
            np.take(self.embed[1], columns[back], axis=1, out=gates[1], mode="clip")
            moved = self.inner @ h
            f = moved[:, :hidden] + gates[:, :hidden]
            f *= 0.25
            f += 0.5
            np.maximum(f, 0.0, out=f)
            np.minimum(f, 1.0, out=f)
            m = moved[:, hidden:]
            c = f * m
            c += gates[:, hidden:]
            c /= np.abs(c) + 1.0
            if keep:
                trace.append((h, f, m, c))
            step = c - h
            step *= f
            h = h + step
            out[t, 0] = h[0]
            out[back, 1] = h[1]
        return (out, trace) if keep else out

    def label(self, data: np.ndarray) -> np.ndarray:
        """Label probabilities of every position: (length, labels, segments)."""
        states = self.states(data)
        length, _, hidden, n = states.shape
        scores = self.out @ states.reshape(length, 2 * hidden, n) + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, data: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over the letter positions, and its gradients (backpropagation through time)."""
        n, length = data.shape
        hidden = self.inner.shape[2]
        states, trace = self.states(data, keep=True)
        flat = states.reshape(length, 2 * hidden, n)
        scores = self.out @ flat + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        prob = np.exp(scores)
        prob /= prob.sum(axis=1, keepdims=True)
        mask = LETTER[data.T].astype(np.float32)
        mask /= max(1.0, mask.sum())
        loss = -float((np.log(prob[:, target, np.arange(n)] + 1e-9) * mask).sum())
        prob[:, target, np.arange(n)] -= 1.0
        prob *= mask[:, None, :]
        d_out = np.einsum("tln,thn->lh", prob, flat, optimize=True)
        d_bias = prob.sum(axis=(0, 2))[:, None]
        d_states = (self.out.T @ prob).reshape(length, 2, hidden, n)
        d_inner = np.zeros_like(self.inner)
        d_gates = np.empty((length, 2, 2 * hidden, n), np.float32)
        dh = np.zeros((2, hidden, n), np.float32)
        turned = np.ascontiguousarray(self.inner.transpose(0, 2, 1))
        for t in range(length - 1, -1, -1):
            h, f, m, c = trace[t]
            dh[0] += d_states[t, 0]
            dh[1] += d_states[length - 1 - t, 1]
            d_c = dh * f * (1 - np.abs(c)) ** 2
            d_f = (dh * (c - h) + d_c * m) * (0.25 * ((f > 0) & (f < 1)))
            moved = np.concatenate([d_f, d_c * f], axis=1)  # with respect to the product with h
            d_inner += moved @ h.transpose(0, 2, 1)
            dh = dh * (1 - f) + turned @ moved
            d_gates[t, :, :hidden], d_gates[t, :, hidden:] = d_f, d_c
        d_embed = np.empty_like(self.embed)
        read = (data.T.ravel(), data.T[::-1].ravel())
        for k in range(2):
            for row in range(2 * hidden):
                d_embed[k, row] = np.bincount(read[k], d_gates[:, k, row].ravel(), 256)
        return loss, [d_embed, d_inner, d_out, d_bias]


def train(segments: list[bytes], targets: list[int], labels: list[str], *, hidden: int = HIDDEN, epochs: int = 8,
          batch: int = 256, rate: float = 0.02, seed: int = 7) -> Network:
    """Fit a network with Adam; each segment's label is the target of all its letters."""
    net = Network.fresh(labels, hidden, seed)
    if not segments:
        return net
    data, target = _matrix(segments), np.asarray(targets)
    rng = np.random.default_rng(seed)
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps, total = 0, epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            _, grads = net.gradients(data[pick], target[pick])
            steps += 1
            scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
            pace = rate * (1 - 0.9 * steps / total) * (1 - 0.999 ** steps) ** 0.5 / (1 - 0.9 ** steps)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                g = g * scale
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= pace * m / (np.sqrt(v) + 1e-8)
    return net


def _matrix(segments: list[bytes]) -> np.ndarray:
    out = np.zeros((len(segments), SEGMENT), np.uint8)
    for row, s in zip(out, segments, strict=True):
        row[:len(s)] = np.frombuffer(s, np.uint8)
    return out


def segment_matrix(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All segments of the texts, one after the other, padded with zero bytes, and the text that each is from."""
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    count = -(-sizes // SEGMENT)
    data = np.zeros((int(count.sum()), SEGMENT), np.uint8)
    at = np.concatenate([[0], np.cumsum(count)])
    flat = data.reshape(-1)
    for i, t in enumerate(texts):
        begin = at[i] * SEGMENT
        flat[begin:begin + len(t)] = np.frombuffer(t, np.uint8)
    return data, np.repeat(np.arange(len(texts)), count)


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """(texts x labels) mean label probabilities over each text's letter positions (0 without any)."""
    total = np.zeros((len(texts), len(net.labels)))
    letters = np.zeros(len(texts))
    data, owner = segment_matrix(texts)
    for at in range(0, len(data), BLOCK):
        part, own = data[at:at + BLOCK], owner[at:at + BLOCK]
        mask = LETTER[part]
        pooled = np.einsum("tln,nt->nl", net.label(part), mask.astype(np.float32), optimize=True)
        np.add.at(total, own, pooled)
        np.add.at(letters, own, mask.sum(axis=1))
    return total / np.maximum(letters, 1)[:, None]


def training_rows(key: Column, lang: Column) -> Column:
    """Rows to learn from: a language is given and the key's crc32 modulo 3 is not 1 (a null key counts as empty)."""
    return lang.isNotNull() & ~held_out(key)


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_language: int = 250,
        segments_per_doc: int = 6, **options) -> Network:
    """Train on a bounded sample of ``docs`` (all of whose rows may be learned from).

    Of each language the ``docs_per_language`` rows with the smallest hash of
    the key are taken, and of each at most ``segments_per_doc`` segments
    spread evenly over the whole text: at most 0.23 MB per language reach the
    driver.  Rows without a letter teach nothing.  Ties in the hash are
    ordered by the text's hash; equal rows are taken once; of equally
    probable labels the first in code point order is predicted.
    """
    usable = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("sample")).alias("h"))
    # hashes are ranked, not texts; the limit by rank is applied before the shuffle as well, so a language with most
    # of the rows sends few of them
    first = Window.partitionBy("lang").orderBy("h", "text_hash")
    hashes = usable.filter(F.col("text").rlike(r"\p{L}")).select("lang", "h", F.xxhash64("text").alias("text_hash"))
    picked = hashes.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= docs_per_language).drop("at").distinct()
    # docs_per_language rows a language; copies of a row are joined to one pick and become one again
    rows = usable.join(F.broadcast(picked), ["lang", "h"]).filter(F.xxhash64("text") == F.col("text_hash"))
    sample = rows.groupBy("lang", "h", "text_hash").agg(F.first("text").alias("text"))

    @F.pandas_udf("array<binary>")
    def spread(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            data = t.encode("utf-8", "replace")
            cells = -(-len(data) // SEGMENT)
            pick = np.unique(np.linspace(0, cells - 1, min(cells, segments_per_doc)).astype(int))
            out.append([data[i * SEGMENT:(i + 1) * SEGMENT] for i in pick])
        return pd.Series(out)

    rows = sample.select("lang", "h", spread("text").alias("segments")).collect()
    labels = sorted({r["lang"] for r in rows})
    rows.sort(key=lambda r: (r["lang"], r["h"], r["segments"]))
    pairs = [(bytes(s), labels.index(r["lang"])) for r in rows for s in r["segments"]]
    return train([p[0] for p in pairs], [p[1] for p in pairs], labels, **options)


def predict_column(net: Network, text: Column) -> Column:
    """struct<lang: string, score: double>: the most probable label and its pooled probability.

    ``und`` with score 0 for a null text, a text without a letter, or a
    network without labels.  Every byte of the text is read.
    """

    @F.pandas_udf("lang string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in released(batches):
            lang = np.full(len(texts), UNDETERMINED, object)
            best = np.zeros(len(texts))
            rows = [i for i, t in enumerate(texts) if t]
            size, at = 0, []
            for k, i in enumerate(rows):
                at.append(i)
                size += len(texts.iloc[i])
                if size >= 4 * BLOCK * SEGMENT or k == len(rows) - 1:
                    prob = document_probabilities(net, [texts.iloc[j].encode("utf-8", "replace") for j in at])
                    top = prob.argmax(axis=1)
                    lang[at] = [net.labels[x] for x in top]
                    best[at] = np.clip(prob[np.arange(len(at)), top], 0, 1)
                    size, at = 0, []
            yield pd.DataFrame({"lang": lang, "score": best})

    if not net.labels:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    body = text.cast("string")
    # texts without a letter are passed as null: they need no network
    return score(F.when(body.rlike(r"\p{L}"), body))


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", net: Network | None = None,
             **options) -> DataFrame:
    """(key, held_out, lang_pred, score) of every row of ``docs``.

    Learns from the rows that ``training_rows`` admits, predicts from the
    text alone.  Null keys are not held out; repeated rows get equal results;
    an empty table gives an empty result; other columns are ignored.
    """
    net = fit(docs.filter(training_rows(F.col(key), F.col(lang))), key=key, text=text, lang=lang, **options) if net is None else net
    scored = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), predict_column(net, F.col(text)).alias("p"))
    return scored.select(key, "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
