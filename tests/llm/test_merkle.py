"""Merkle manifest against a plain tree, with blocks of several heights and awkward rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, **other):
    row = {**row, **other}
    parts = []
    for f in FIELDS:
        v = None if row[f] is None else str(row[f])
        parts.append("-" if v is None else f"{len(v.encode())}:{v}")
    return digest("".join(parts))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, i):
    for level in levels[:-1]:
        first = i // 8 * 8
        yield level[first:i], level[i + 1:first + 8]
        i //= 8


def plain_audit(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        groups[name] = ordered
        trees[name] = plain_tree([plain_leaf(r) for r in ordered])
    top = plain_tree([trees[n][-1][0] for n in names])
    out = []
    for t, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            proof, node = "", plain_leaf(row, text=tampered(row))
            for left, right in (*plain_path(trees[name], i), *plain_path(top, t)):
                proof += "".join(left + right)
                node = digest("".join([*left, node, *right]))
            out.append((row["doc_id"], plain_leaf(row), trees[name][-1][0], top[-1][0], digest(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_keeps_halves_together(levels):
    from orrery.llm.merkle import addresses, nodes

    places = addresses(levels)
    assert sorted(np.concatenate(places).tolist()) == list(range(nodes(levels))) and places[0][0] == 0
    if levels > 1:
        upper = levels // 2
        assert sorted(np.concatenate(places[:upper]).tolist()) == list(range(nodes(upper)))
        for k in range(8 ** upper):  # each bottom subtree lies in one run of places
            own = np.concatenate([places[d][k * 8 ** (d - upper):(k + 1) * 8 ** (d - upper)] for d in range(upper, levels)])
            assert own.max() - own.min() + 1 == len(own) == nodes(levels - upper)


@pytest.mark.parametrize("height", [1, 2, 4])
def test_audit_equals_a_plain_tree(spark, height):
    from orrery.llm.merkle import audit

    kinds = "doc_id bigint, source string, lang string, n_chars bigint, text string, pos string, size string, tree string, digest string"
    rows = [dict(doc_id=i, source=f"s{i % 3}", lang="en", n_chars=i, text=f"Text {i} É") for i in range(150)]
    rows += [dict(doc_id=i, source=None, lang="fr" if i % 2 else "é", n_chars=None, text=None if i % 5 == 0 else "") for i in range(200, 218)]
    rows += [dict(doc_id=None, source="s", lang=None, n_chars=1, text="No key"), dict(doc_id=7, source="s1", lang="en", n_chars=7, text="again"),
             dict(doc_id=9, source=None, lang="", n_chars=1, text="Long " * 50_000)] + [dict(rows[5]) for _ in range(12)]
    rows += [dict(doc_id=1000 + i, source="s", lang=f"l{i:02d}", n_chars=1, text="A") for i in range(70)]
    docs = spark.createDataFrame([(*(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")), "x", "y", "z", "w") for r in rows], kinds)
    claimed = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    got = audit(docs, {"text": claimed}, height=height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    tampered = lambda r: r["text"].lower() if r["text"] and r["doc_id"] is not None and r["doc_id"] % 3 == 0 else r["text"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_audit(rows, tampered)
    if height == 2:
        assert audit(docs.limit(0), {"text": claimed}).collect() == []
        one = docs.filter("doc_id = 3 and text = 'Text 3 É'")
        row = audit(one, {}).first()
        assert row["verified"] and row["root"] == row["subroot"] == row["leaf"] and row["proof_sha256"] == digest("")
