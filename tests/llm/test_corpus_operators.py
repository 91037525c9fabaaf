"""Corpus operators against brute force, libraries and round trips, with awkward rows in every table."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, size string, h string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(200)
    edited = base.split()
    edited[17] = "changed"
    rows = [(i, prose(rng.randint(1, 60)), "en" if i % 2 else "de", f"s{i % 3}", "x", "y") for i in range(20)]
    rows += [(20, base, "en", "s0", None, "y"), (21, base, "en", None, "x", None), (22, " ".join(edited), None, "s1", "x", "y"),
             (23, None, "en", "s2", "x", "y"), (24, "", "en", "s2", "x", "y"), (25, " \n\t", "en", None, "x", "y"),
             (26, prose(30_000), "en", "s0", "x", "y"), (27, "123 !!", "en", "s1", "x", "y"), (None, "no key here at all", "en", "s1", "x", "y"),
             (5, "again", "en", "s1", "x", "y"), (5, "again", "en", "s1", "x", "y"), (28, "a" * 300_000, "de", "s1", "x", "y"),
             (29, "x <|endoftext|>  y\u00a0 z\n\n don't", "de", "s2", "x", "y")]
    return rows, spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def library_ids(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_token_counts_equal_the_library(spark, awkward, path):
    from orrery.llm.token_count import count_tokens

    rows, docs = awkward
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, path).collect())
    want = []
    for key, text, *_ in rows:
        n = len(library_ids(path, text))
        want.append((str(key), len((text or "").encode()), n, n > 1024))
    assert got == sorted(want)
    assert count_tokens(docs.limit(0), path).count() == 0


def test_piece_encoder_on_odd_strings(path):
    import pyarrow as pa
    from orrery.llm.token_count import PieceEncoder

    rng = random.Random(3)
    parts = [" ", "  ", "a", "b", "The", "é", "\n", "\t", "'s", "'ll", "1", "23", "!", "##", "<|endoftext|>", "<|", "\u00a0", "\u2003",
             "\x85", "\x1c", "\x00", "日本", "😀", "\u0301", "\u200b", "\u3000", "\x0b", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    values, codes, ends = PieceEncoder(path, keep=500).encoded(pa.array(texts), list)
    at = 0
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    for text, end in zip(texts, ends, strict=True):
        assert [x for c in codes[at:end] for x in values[c]] == model.encode(text, add_special_tokens=False).ids, repr(text)
        at = end


def test_packing_covers_every_id_once(spark, awkward, path):
    from orrery.llm.packing import pack, padded

    rows, docs = awkward
    got = pack(docs, path, payload={"ids": F.col("ids"), "crc": F.crc32("ids")}).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        assert r.crc == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length and 1 <= r.length <= 2048
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    wanted = sorted(np.array([*library_ids(path, t), 1], "<u4").tobytes() for _, t, *_ in rows)
    found = []
    for pieces in by_doc.values():
        starts = sorted(pieces)
        copies = sum(s == 0 for s, _ in starts)
        found += [b"".join(ids for s, ids in starts[c::copies]) for c in range(copies)]
    assert sorted(found) == wanted
    total = sum(r.length for r in got)
    assert total <= sum(padded(sum(n for _, n in p)) for p in by_sequence.values())
    assert pack(docs.limit(0), path).count() == 0


def test_packing_plan_uses_the_histogram_exactly():
    from collections import Counter

    from orrery.llm.packing import padded, plan

    rng = random.Random(2)
    for histogram in ({}, {1: 5}, {2048: 3, 1024: 7}, {700: 1000, 5: 3}, dict(Counter(rng.randint(1, 2048) for _ in range(20_000)))):
        used = Counter()
        for shape, times in plan(histogram):
            assert sum(shape) <= 2048 and times > 0
            for n in shape:
                used[n] += times
        assert used == Counter(histogram)
    tokens = sum(a * b for a, b in histogram.items())
    assert sum(padded(sum(s)) * n for s, n in plan(histogram)) < 1.01 * tokens


def test_mixing_meets_targets(spark, awkward):
    from orrery.llm.mixing import mix

    rows, docs = awkward
    one, two = (sorted(map(tuple, mix(docs).collect()), key=str) for _ in range(2))
    assert one == two and len(one) == len(rows)
    sizes, taken, target = {}, {}, {}
    by_key = {(k, str(t)): s for k, t, _, s, *_ in rows}
    assert len(by_key) <= len(rows)
    for r in mix(docs, carry=("source",)).collect():
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] = r.source_size
        target[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    free = {s: (i % 3 + 1) for i, s in enumerate(order) if target[s] < 3 * sizes[s] - 1e-6}
    assert len({round(target[s] / w, 6) for s, w in free.items()}) <= 1
    longest = 30_000
    assert all(abs(taken[s] - target[s]) <= longest for s in sizes)
    assert mix(docs.limit(0)).count() == 0


URLS = [None, "", "no scheme", "http://a.com/x", "HTTP://WWW.Example.COM/en/a?q#f", "http://example.com/en/", "http://xexample.com/en/",
        "http://b.net/es/1", "http://net/fr/", "http://evil.org/x.net/es/", "http://c.net/es", "http://com", "https://é.com/" + "y" * 50_000,
        "http://a.com/b\n/c", "x://y://z.com/"]


def plain_verdict(url, rules):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = rest
    for c in "/?#":
        host = host.partition(c)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.partition(c)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_filter_equals_plain_rules(spark):
    from orrery.llm.queries import URL_RULES
    from orrery.llm.url_filter import Rule, filter_urls

    more = [*URL_RULES, *(("h%d.org" % i, "/p/%d" % i, "block") for i in range(30))]  # several words of state
    urls = [*URLS, *("http://a.h%d.org/p/%d" % (i, i) for i in range(30)), "http://h3.org/p/4"]
    pages = spark.createDataFrame([(i if i else None, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    for rules in (URL_RULES, more):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, [Rule(*r) for r in rules]).collect()}
        assert got == {(i if i else None): plain_verdict(u, rules) for i, u in enumerate(urls)}
    assert filter_urls(pages.limit(0), [Rule(*r) for r in URL_RULES]).count() == 0
    assert {r.verdict for r in filter_urls(pages, []).collect()} == {"allow"}


def test_warc_round_trip(spark):
    from orrery.llm.warc import coalesce_ranges, read_records, round_trip, write_archives, plan_records

    big, line = "é\r\n\r\n" * 400_000, "same payload " * 20
    rows = [(1, "http://a", line, 1), (2, None, line, 1), (3, "b\nc\\", None, 2), (4, "d", "", 2), (5, "e", "short", 3), (6, "f", "short", 3),
            (7, "g", big, 4), (None, "h", line, 4), (8, "i", line[:-1] + "\0", 5), (1, "http://a", line, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    got = round_trip(pages).collect()
    assert sorted((str(r.page_id), str(r.url), r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (str(k), str(u), len((t or "").encode()), hashlib.sha256((t or "").encode()).hexdigest()) for k, u, t, _ in rows)
    revisits = [r for r in got if r.record_type == "revisit"]
    assert sorted(str(r.page_id) for r in revisits) == ["1", "2", "None"]  # one of the two equal rows is the response
    assert {r.refers_to.split(":")[2] for r in revisits} == {"1"}
    assert all(bytes(r.payload) == (dict((k, t) for k, _, t, _ in rows)[r.page_id] or "").encode() for r in got if r.payload is not None and r.page_id not in (1,))
    index = write_archives(plan_records(pages))
    some = read_records(index.filter("page_id in (5, 7)")).collect()
    assert sorted(r.page_id for r in some) == [5, 7]
    assert round_trip(pages.limit(0)).count() == 0
    assert coalesce_ranges([(0, 10), (10, 5), (500_000, 5), (500_010, 9_000_000)]) == [[0, 1], [2], [3]]


def test_language_gradients_and_accuracy(spark, awkward):
    from orrery.llm import language_id as lid

    net = lid.Network.fresh(["a", "b"], 3)
    for name in ("embed", "inner", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    data = np.random.default_rng(0).integers(97, 122, (4, 6)).astype(np.uint8)
    _, grads = net.gradients(data, np.array([0, 1, 0, 1]))
    for weights, grad in zip(net.weights(), grads, strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), weights.shape)
        weights[at] += 1e-3
        up, _ = net.gradients(data, np.array([0, 1, 0, 1]))
        weights[at] -= 2e-3
        down, _ = net.gradients(data, np.array([0, 1, 0, 1]))
        weights[at] += 1e-3
        assert (up - down) / 2e-3 == pytest.approx(grad[at], rel=0.02)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    rows, odd = awkward
    got = {(r.doc_id, r.lang_pred == "und"): r for r in lid.identify(odd, epochs=1).collect()}
    assert all((k, True) in got for k in (23, 24, 25, 27)) and (26, False) in got
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[(None, False)].held_out is False
    assert lid.identify(odd.limit(0)).count() == 0


def test_quality_separates_labels(spark, awkward):
    from orrery.llm.quality import classify, fit, fit_ordinal, grade_column

    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", grade_column(F.col("quality"), F.col("toxic")).alias("grade"))
    model = fit(docs, labels.filter("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = classify(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    rates = {r.quality: r.k for r in held.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rates[1] > 0.97 and rates[0] < 0.2
    rows, odd = awkward
    got = classify(odd, model).collect()
    assert len(got) == len(rows) and all(0 <= r.p_tail <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    assert classify(odd.limit(0), model).count() == 0
    empty = fit_ordinal((np.empty(0, int), np.empty(0, int), np.empty(0)), np.empty(0, int), 2)
    assert empty.thresholds.tolist() == [0.0, 1.0]
    assert fit(odd.limit(0), labels).weights.any() == False  # noqa: E712


def test_quality_rejects_toxic_documents(spark):
    import corpus_pipeline as pipeline
    from orrery.llm.quality import fit, grade_column
    from orrery.llm.queries import op10_quality

    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id", "toxic")
    rated = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", grade_column(F.col("quality"), F.col("toxic")).alias("grade"))
    held = labels.filter("doc_id % 3 = 0")

    def rates(kept):
        found = held.join(kept.select("doc_id", F.lit(1).alias("k")), "doc_id", "left")
        return {r.toxic: r.k for r in found.groupBy("toxic").agg(F.avg(F.coalesce("k", F.lit(0))).alias("k")).collect()}

    with pytest.MonkeyPatch.context() as patch:  # both learn without the held-out labels
        patch.setattr("orrery.llm.queries.quality_model", lambda s, d, _: fit(d, rated.filter("doc_id % 3 <> 0")))
        patch.setattr(pipeline, "quality_model", lambda s, d, _: fit(d, rated.filter("doc_id % 3 <> 0")))
        got = op10_quality(spark, sf)
        assert {"p_tail", "p_tail_2", "kept"} <= set(got.columns)
        for kept in (got.filter("kept"), pipeline.quality_stage(spark, docs, sf)):
            share = rates(kept)
            assert share[1] < 0.15 and share[0] > 0.95, share


def brute_classes(rows, similar=0.8):
    from orrery.llm.minhash import Shingler, probability_jaccard

    texts = sorted({(k, t) for k, t in rows if k is not None and t and t.split()})
    sets = Shingler().of([t for _, t in texts])
    parent = {k: k for k, _ in rows if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if probability_jaccard(sets[i], sets[j]) >= similar:
                a, b = root(texts[i][0]), root(texts[j][0])
                parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in parent}


def test_probability_jaccard_and_signatures():
    from orrery.llm.minhash import probability_jaccard, signatures

    def plain(a, b):
        return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())

    rng = np.random.default_rng(1)
    for _ in range(5):
        a, b = ({int(k): int(rng.integers(1, 5)) for k in rng.choice(80, 50, replace=False)} for _ in range(2))
        as_set = lambda d: (np.array(sorted(d), np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([d[k] for k in sorted(d)]))
        pair = [as_set(a), as_set(b)]
        pair = [(h[np.argsort(h)], c[np.argsort(h)]) for h, c in pair]
        exact = probability_jaccard(*pair)
        assert exact == pytest.approx(plain(a, b))
        one, two = signatures(pair, 4096)
        assert (one == two).mean() == pytest.approx(exact, abs=0.04)


def test_near_duplicates_equal_brute_force(spark, awkward):
    from orrery.llm.minhash import near_duplicates

    rows, docs = awkward
    got = near_duplicates(docs).collect()
    want = brute_classes([r[:2] for r in rows])
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert want[21] == 20 and want[22] == 20
    assert all(r.kept == (r.doc_id is None or r.class_id == r.doc_id) for r in got)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert near_duplicates(docs.limit(0)).count() == 0


VECTORS = "vec_id bigint, embedding array<float>, label int, rank int, n string"


def awkward_vectors():
    rng = np.random.default_rng(4)
    rows, centre = [], rng.normal(size=16)
    for i in range(150):
        v = centre + rng.normal(size=16) * 0.1 if i % 3 == 0 else rng.normal(size=16)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3), 1, "x"))
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1, 1, "x"), (300, [], 1, 1, "x"), (400, [0.0] * 16, 1, None, "x"), (500, [nan] + [1.0] * 15, 1, 1, None),
             (600, [inf] + [1.0] * 15, 1, 1, "x"), (700, [None] + [1.0] * 15, 1, 1, "x"), (800, [1.0, 2.0], 0, 1, "x"), (801, [1.0, 2.0], 0, 1, "x"),
             (None, rows[0][1], 0, 1, "x"), (900, rows[0][1], None, 1, "x"), (901, [x * 3 for x in rows[0][1]], 0, 1, "x"),
             (902, rows[0][1], 0, 1, "x"), (902, rows[0][1], 0, 1, "x")]
    return rows


def good(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_embedding_dedup_equals_brute_force(spark):
    from orrery.llm.embedding_dedup import near_vectors

    rows = awkward_vectors()
    got = near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    n, parent = [0] * len(rows), {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.float32(r[1]).astype(float) if good(r[1]) and r[0] is not None and r[2] is not None else None for r in rows]
    for i, a in enumerate(unit):
        for j, b in enumerate(unit):
            if i != j and a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]:
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    n[i] += 1
                    x, y = root(rows[i][0]), root(rows[j][0])
                    parent[max(x, y)] = min(x, y)
    want = sorted(str((r[0], n[i], None if r[0] is None else root(r[0]))) for i, r in enumerate(rows))
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in got) == want
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_nearest_recall_and_form(spark):
    from orrery.llm.ann import nearest

    rows = awkward_vectors()
    table = spark.createDataFrame(rows, VECTORS)
    for shard_rows in (4096, 40):
        got = nearest(table, shard_rows=shard_rows, every=10).collect()
        known = {(r[0], tuple(r[1])) for r in rows if good(r[1]) and r[0] is not None}
        hits = wanted = 0
        for q, v in known:
            if q % 10:
                continue
            a = np.float32(v).astype(float)
            near = sorted((float(np.sqrt(((np.float32(w).astype(float) - a) ** 2).sum())), k) for k, w in known if k != q and len(w) == len(v))[:10]
            own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            assert [r[0] for r in own] == list(range(1, len(near) + 1))
            assert [(s, k) for _, k, s in own] == sorted((s, k) for _, k, s in own)
            wanted += len(near)
            hits += len({k for _, k in near} & {k for _, k, _ in own})
        assert hits / wanted >= 0.9
    assert nearest(table.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    from orrery.llm.common import connected_components

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 100), (7, 7)], "a bigint, b bigint")
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 99, 100, 200]], "id bigint")
    got = {r.id: r.component for r in connected_components(nodes, edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99, 200: 200}


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES] == ["language ID", "quality classifier", "MinHash near-dedup", "mixing sources", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = pipeline.duplicate_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    classes = brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes.values()))
    mixed = pipeline.mixing_stage(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert pipeline.language_stage(spark, docs, SF).count() >= 0.95 * docs.count()


def test_mixing_stage_keeps_rows_when_the_scan_is_cut_otherwise(spark, tmp_path):
    from collections import Counter

    import corpus_pipeline as pipeline
    from orrery.llm.mixing import mix

    path = str(tmp_path / "docs")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(12).write.parquet(path)
    docs = spark.read.parquet(path)
    want = Counter({r.doc_id: r.taken // r.size for r in mix(docs).collect() if r.taken})
    texts = {r.doc_id: r.text for r in docs.collect()}
    name = "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(name, "1")
        mixed = pipeline.mixing_stage(spark, docs, SF)
        spark.conf.set(name, "64")  # as if the cluster had grown before the result is written
        rows = mixed.select("doc_id", "text").collect()
    finally:
        spark.conf.unset(name)
    assert Counter(r.doc_id for r in rows) == want
    assert all(texts[r.doc_id] == r.text for r in rows)


def test_rows_with_ids_equal_a_semi_join(spark):
    from orrery.llm.common import rows_with_ids

    rows = spark.createDataFrame([(i, f"t{i}") for base in (0, 32760, 1 << 33, (5 << 33) + 65535) for i in range(base, base + 20)] * 2, "_row bigint, text string")
    ids = rows.filter("_row % 3 = 0").select("_row")
    expect = rows.join(ids.distinct(), "_row", "left_semi")
    got = rows_with_ids(rows, ids, "_row")
    assert got.columns == rows.columns and sorted(got.collect()) == sorted(expect.collect())
    assert rows_with_ids(rows, ids.limit(0), "_row").isEmpty()


def test_stages_leave_texts_where_they_are_read(spark, monkeypatch):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = pipeline.duplicate_stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(_row" not in plan
    written = []
    stage = pipeline.staged
    monkeypatch.setattr(pipeline, "staged", lambda df, *a, **k: written.append(df.columns) or stage(df, *a, **k))
    mixed = pipeline.mixing_stage(spark, docs, SF)
    # no second table of the texts, and no join on rows: only with the sums of the buckets, which are broadcast
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not written and "SortMergeJoin" not in plan and "_row" not in plan


def test_short_texts_at_the_threshold_are_linked(spark):
    """Pairs of 9 and 8 words, 4 of 5 shingles shared: similarity 0.8, which sketches alone would miss in part."""
    from orrery.llm.minhash import near_duplicates

    rows = []
    for i in range(300):
        own = [f"w{i}x{j}" for j in range(9)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:8]))]
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    # what may be lost is lost by the bands (8 registers, 50 bands): about 0.002 of such pairs
    assert sum(got[2 * i] == got[2 * i + 1] for i in range(300)) >= 297


def test_stages_on_awkward_rows(spark, awkward):
    import corpus_pipeline as pipeline

    prose = "the quick brown fox jumps over the lazy dog again and again until it is tired of all that jumping around here"
    rows = [(7, "c " + prose, "en", "s", 1), (7, "something entirely different that is like no other text in this table", "en", "s", 1),
            (5, prose + " one", "en", "s", 1), (3, prose + " one", "en", "s", 1), (None, prose + " one", None, None, None),
            (None, "a lone text without a key that nothing else resembles", "en", "s", 1), (8, None, "en", "s", 1), (9, "", None, "s", 1),
            (11, "twice the same row", "en", "s", 1), (11, "twice the same row", "en", "s", 1)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                                                 "class_id string, kept string").repartition(2)
    kept = pipeline.duplicate_stage(spark, docs, SF)
    assert kept.columns == list(pipeline.COLUMNS)
    assert sorted((str(r.doc_id), (r.text or "")[:5]) for r in kept.collect()) == sorted(
        [("7", "somet"), ("3", "the q"), ("None", "a lon"), ("8", ""), ("9", ""), ("11", "twice")])
    # no row of these has a label: nothing is learned, nothing goes
    unlabelled = docs.withColumn("doc_id", -F.col("doc_id") - 1)
    assert pipeline.quality_stage(spark, unlabelled, SF).count() == len(rows)


def test_warc_records_are_read_by_many_tasks(spark):
    from orrery.llm import warc

    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://a.example/").alias("url"),
                                   F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(10_000)), lambda i: F.sha2(F.concat("id", i).cast("string"), 256))).alias("html"))
    read = warc.read_records(warc.write_archives(warc.plan_records(pages), None))
    with_rows = read.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()
    assert len(with_rows) > 1 and sum(r.n for r in with_rows) == 40


def test_language_sample_takes_equal_rows_once(spark, monkeypatch):
    from orrery.llm import language_id

    body = "der hund läuft über die straße und die katze schläft"
    rows = [(i, f"{body} {i}", "de") for i in range(30)] + [(1, f"{body} 1", "de")] * 5 + [(2, None, "de"), (3, "12 34", "de"), (None, body, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language_id, "train", lambda segments, labels, names, **options: seen.extend(segments))
    language_id.fit(docs)
    assert sorted(seen) == sorted(f"{body} {i}".encode() for i in range(30))
