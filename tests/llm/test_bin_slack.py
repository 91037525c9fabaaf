"""Minimum bin slack packing against enumeration and the tokenizer library."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def library_ids(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [0]


def test_fullest_equals_enumeration():
    from orrery.llm.bin_slack import fullest

    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        room = rng.randint(0, 30)
        best = max(sum(x * n for x, n in zip(counts, uses, strict=True)) for uses in
                   itertools.product(*(range(n + 1) for n in counts.values()))
                   if sum(x * n for x, n in zip(counts, uses, strict=True)) <= room)
        got = fullest(sorted(counts, reverse=True), counts, room)
        assert sum(got) == best and all(got.count(x) <= counts[x] for x in set(got))


def test_plan_uses_the_histogram_and_few_windows():
    from orrery.llm.bin_slack import plan

    rng = random.Random(4)
    for histogram in ({2048: 3}, {1025: 7}, {700: 100, 1: 3}, {x: rng.randint(1, 40) for x in rng.sample(range(1, 2049), 300)}, {}):
        patterns, used = plan(histogram), {}
        for shape, times in patterns:
            assert sum(shape) <= 2048 and times > 0
            for x in shape:
                used[x] = used.get(x, 0) + times
        assert used == histogram
        least = -(-sum(x * n for x, n in histogram.items()) // 2048)
        single = sum(n for x, n in histogram.items() if x > 1024)
        windows = sum(times for _, times in patterns)
        if len(histogram) > 100:
            assert windows <= max(least, single) * 1.01 + 1
    # a small case against all partitions: 7 windows of 10 hold these, 6 cannot
    assert sum(t for _, t in plan({6: 4, 4: 4, 3: 3, 7: 2, 5: 1}, 10)) == 7


def test_words_equal_the_library_on_odd_strings(path):
    import pyarrow as pa
    from tokenizers import Tokenizer
    from orrery.llm.bin_slack import WordEncoder

    rng = random.Random(3)
    parts = [" ", "  ", "a", "b", "The", "é", "É", "J̌", "İ", "\n", "\t", "'s", "'S", "1", "23", "!", "##", "<|endoftext|>", "<|",
             " ", " ", "\x85", "\x1c", "\x00", "日本", "😀", "́", "​", "　", "\x0b", ".", "ß", "×", "²", "'", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + [None, "", "x " * 5000]
    model, encoder = Tokenizer.from_file(path), WordEncoder(path, keep=400)
    for rows in (texts[:1500], texts[1500:], [""], [None]):
        ids, ends = encoder.encoded(pa.array(rows, pa.string()), 0)
        at = 0
        for text, end in zip(rows, ends.tolist(), strict=True):
            assert ids[at:end].tolist() == model.encode(text or "", add_special_tokens=False).ids + [0], repr(text)
            at = end
        assert at == len(ids)


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_packing_places_every_id_once(spark, file):
    from orrery.llm.bin_slack import pack

    path = pytest.importorskip("public_tokenizers").path(file)
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choice(["alpha", "Beta,", "gamma's", "d.", "été", "\n"]) for _ in range(n))
    rows = [(i, prose(rng.randint(1, 700)), "a", "b") for i in range(60)]
    rows += [(100, prose(6000), "a", None), (101, None, None, "b"), (102, "", "a", "b"), (103, "<|endoftext|> x <|startoftext|>", "a", "b"),
             (None, "no key", "a", "b"), (5, "again", "a", "b"), (5, "again", "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string, piece string").repartition(3)
    got = pack(docs, path, payload={"ids": F.col("ids"), "ids_crc32": F.crc32("ids")}).collect()
    sequences, by_doc = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.start == 2048 * r.piece
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    wanted = {}
    for key, text, *_ in rows:
        wanted.setdefault(key, []).append(library_ids(path, text))
    for key, texts in wanted.items():
        pieces = sorted(by_doc[key], key=lambda r: r.start)
        ids = [np.frombuffer(r.ids, "<u4").tolist() for r in pieces]
        assert (sorted(ids) == sorted(texts)) if len(texts) > 1 else (sum(ids, []) == texts[0])
        assert all(r.length == 2048 for r in pieces[:-1]) or len(texts) > 1
    least = -(-sum(r.length for r in got) // 2048)
    assert len(sequences) <= least + 1
    assert pack(docs.limit(0), path).count() == 0
