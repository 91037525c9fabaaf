"""Phrases against plain counting, with broadcasts cut into small parts, and the trie against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest


def plain(rows, least, share, top, longest=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    out = []
    many = [(lang, p) for (lang, p), a in f.items() if a >= least and len(p) > 1]
    for lang, p in many:
        a = f[lang, p]
        inside = any(g == lang and len(q) > len(p) and 100 * f[g, q] >= share * a
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for g, q in many)
        if not inside:
            s, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, left, right, n[lang], s))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


@pytest.mark.parametrize("words, rows, depth", [(5, 30, 3), (60, 900, 2), (300, 3000, 5), (9, 1, 1), (9, 0, 2)])
def test_trie_equals_a_dictionary(words, rows, depth):
    from orrery.llm.trie import Trie

    rng = np.random.default_rng(rows)
    draw = lambda n: np.minimum((words * rng.random(n) ** 3).astype(np.int32), words - 1)
    keys = np.unique(np.stack([draw(rows) for _ in range(depth)], axis=1), axis=0) if rows else np.empty((0, depth), np.int64)
    keys = keys[rng.permutation(len(keys))]
    trie, codes = Trie(keys), draw(5000)
    codes[rng.random(5000) < 0.1] = -1
    number = {tuple(k): i for i, k in enumerate(keys.tolist())}
    want = [(i, number[w]) for i in range(5000) if (w := tuple(codes[i:i + depth].tolist())) in number]
    at, found = trie.walk(codes)
    assert list(zip(at.tolist(), found.tolist(), strict=True)) == want


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    common = ["alpha", "Beta", "gamma", "of", "the", "été", "x y", " "]
    rare = [f"w{i}" for i in range(300)]
    out = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(1, 60)):
            text += rng.choice(rare if rng.random() < 0.3 else common) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " the Beta of gamma x! "])
        out.append((i, ["en", "de", None, "und", ""][i % 5], text, "c"))
    out += [(100, "en", None, "c"), (101, "en", "", None), (102, None, " .\t,", "c"), (103, "fr", "a a a a a a a a a a", "c"),
            (104, "de", "the of the of " * 20_000, "c"), (None, "en", "the of", "c"), (5, "en", "again the of", "c"), (5, "en", "again the of", "c")]
    return out


@pytest.mark.parametrize("sizes", [{}, {"vocabulary": 3, "most": 4}])
@pytest.mark.parametrize("share", [100, 60])
def test_collocations_equal_plain_counting(spark, rows, sizes, share):
    from orrery.llm.collocations import collocations

    if share == 60 and not sizes:
        pytest.skip("the other sizes cover it")
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, phrase string").repartition(3)
    got = collocations(docs, least=6, share=share, top=15, **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain([(r[1], r[2]) for r in rows], 6, share, 15)


def test_collocations_of_nothing(spark, rows):
    from orrery.llm.collocations import collocations

    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, phrase string")
    assert collocations(docs.limit(0)).collect() == []
    assert collocations(docs.filter("doc_id = 103"), least=11).collect() == []


def test_score_is_exact_beyond_64_bits(spark):
    from orrery.llm.collocations import score

    a, n, left, right = 10 ** 12 + 7, 10 ** 13 + 3, 3 * 10 ** 12 + 1, 5 * 10 ** 12 + 11
    row = spark.createDataFrame([(a, n, left, right)], "a bigint, n bigint, l bigint, r bigint").select(score("a", "n", "l", "r")).first()
    assert row[0] == 1000 * a * n // (left * right)
