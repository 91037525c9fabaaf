"""Merkle manifest of a table: eight-way hash trees in van Emde Boas blocks.

Every row is a leaf of its group's tree; the roots of the groups are the
leaves of one more tree.  Digests are SHA-256 of the children's digests as
lower-case hex text.  A tree is stored in aligned blocks of ``HEIGHT`` edges:
each block is a complete subtree whose digests lie in van Emde Boas order
(top half of the levels first, then each bottom subtree, recursively), so
that a node's place follows from its depth and index alone.  The roots of the
blocks are the leaves of the next layer of blocks, until one block is left: a
layer is 4,096 times smaller than the one below.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import ranked, staged

FANOUT, HEIGHT = 8, 4
DIGEST = 32  # bytes; as hex text twice as long
STEP = "array<struct<left: string, right: string>>"  # siblings on both sides, from the block's root upwards
TOP = ""  # name of the tree over the groups' roots


# --- blocks ------------------------------------------------------------------

def nodes(levels: int) -> int:
    """Nodes of a complete tree with so many levels."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


@lru_cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Place of every node in van Emde Boas order, by depth (0: the root) and index within the depth."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    lower = addresses(levels - upper)
    starts = nodes(upper) + np.arange(FANOUT ** upper) * nodes(levels - upper)
    return (*addresses(upper), *((starts[:, None] + within).ravel() for within in lower))


def edges(size: int, height: int) -> int:
    """Edges between the leaves and the root of a block in a tree of ``size`` nodes on the block's lowest level."""
    up = 0
    while up < height and size > 1:
        size, up = -(-size // FANOUT), up + 1
    return up


def build_block(digests: bytes, up: int) -> bytes:
    """Block over consecutive leaf digests (``up`` edges high) in van Emde Boas order; empty places are zero."""
    places = addresses(up + 1)
    store = np.zeros((nodes(up + 1), DIGEST), np.uint8)
    level = np.frombuffer(digests, np.uint8).reshape(-1, DIGEST)
    store[places[up][:len(level)]] = level
    for depth in range(up - 1, -1, -1):
        text = level_text(store, len(level), depth + 1, places)
        run = 2 * DIGEST * FANOUT
        above = b"".join(sha256(text[i:i + run]).digest() for i in range(0, len(text), run))
        level = np.frombuffer(above, np.uint8).reshape(-1, DIGEST)
        store[places[depth][:len(level)]] = level
    return store.tobytes()


def level_text(store: np.ndarray, count: int, depth: int, places: Sequence[np.ndarray]) -> bytes:
    """The first ``count`` digests of a depth, read from their places, as hex text."""
    return store[places[depth][:count]].tobytes().hex().encode()


class Block:
    """Reads paths out of a stored block of ``n`` leaves."""

    def __init__(self, store: bytes, n: int, up: int):
        table, places, self.levels = np.frombuffer(store, np.uint8).reshape(-1, DIGEST), addresses(up + 1), []
        for depth in range(up, 0, -1):
            self.levels.append(level_text(table, n, depth, places))
            n = -(-n // FANOUT)

    def path(self, index: int) -> Iterator[tuple[bytes, bytes]]:
        """Siblings left and right of a leaf, then of its ancestors below the block's root."""
        wide = 2 * DIGEST
        for text in self.levels:
            own, first = index * wide, index // FANOUT * FANOUT * wide
            yield text[first:own], text[own + wide:first + FANOUT * wide]
            index //= FANOUT


# --- trees -------------------------------------------------------------------

def build(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Layers of blocks over ``leaves`` (tree, pos, size, digest), lowest first; each is a staged table.

    Columns: tree, block, n (leaves of the block), size (of its layer in the
    tree), up (edges), nodes (van Emde Boas digests).  A group holds at most
    FANOUT ** height rows.
    """
    full = FANOUT ** height

    def make(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["pos"].to_numpy())
        digests = b"".join(rows["digest"].take(pa.array(order)).to_pylist())
        size = rows["size"][0].as_py()
        up = edges(size, height)
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([len(order)], pa.int64()), "size": pa.array([size], pa.int64()),
                         "up": pa.array([up], pa.int32()), "nodes": pa.array([build_block(digests, up)], pa.binary())})

    layers, largest = [], leaves.agg(F.max("size")).first()[0] or 0
    while True:
        rows = leaves.withColumn("block", F.expr(f"pos div {full}")).select("tree", "block", "pos", "size", "digest")
        layers.append(staged(rows.groupBy("tree", "block").applyInArrow(
            make, "tree string, block bigint, n bigint, size bigint, up int, nodes binary"), "merkle"))
        if largest <= full:
            return layers
        largest = -(-largest // full)
        leaves = layers[-1].filter(F.col("size") > full).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("size") / full).alias("size"),
            F.substring("nodes", 1, DIGEST).alias("digest"))  # the root is the first in van Emde Boas order


def roots(layers: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """(tree, digest) of every tree: the root of its last block."""
    last = [x.filter(F.col("size") <= FANOUT ** height).select("tree", F.substring("nodes", 1, DIGEST).alias("digest"))
            for x in layers]
    return reduce(DataFrame.union, last)


def descend(layers: list[DataFrame], ends: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The lowest layer with ``above``, the siblings between each block's root and the end of the tree.

    ``ends`` has (tree, above, ...) for what follows a tree's own root; more
    columns of it are handed down to each block.
    """
    full = FANOUT ** height
    more = [c for c in ends.columns if c not in ("tree", "above")]
    above = None
    for layer in reversed(layers):
        last = layer.filter(F.col("size") <= full).join(ends, "tree")
        if above is not None:
            last = last.unionByName(layer.filter(F.col("size") > full).join(above, ["tree", "block"]))
        if layer is layers[0]:
            return last
        above = children(last, more, full)
    raise ValueError("a tree has at least one layer")


def children(blocks: DataFrame, more: Sequence[str], full: int) -> DataFrame:
    """For each leaf of the blocks, which is a block of the layer below: (tree, block, above, ...)."""
    schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()),
                           T.StructField("above", T.ArrayType(T.StructType([T.StructField("left", T.StringType()),
                                                                            T.StructField("right", T.StringType())]))),
                           *(blocks.schema[c] for c in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                block, out = Block(row["nodes"], row["n"], row["up"]), []
                for i in range(row["n"]):
                    own = [{"left": a.decode(), "right": b.decode()} for a, b in block.path(i)]
                    out.append({"tree": row["tree"], "block": row["block"] * full + i, "above": own + row["above"],
                                **{c: row[c] for c in more}})
                    if len(out) == 512:
                        yield pa.RecordBatch.from_pylist(out, schema=kinds)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return blocks.mapInArrow(run, schema)


# --- the manifest of a table -------------------------------------------------

def leaf(fields: Mapping[str, Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 length, a colon and its text; a null is a dash."""
    texts = [c.cast("string") for c in fields.values()]
    return F.unhex(F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256))


def audit(docs: DataFrame, claimed: Mapping[str, Column], *, key: str = "doc_id", group: str = "lang",
          fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), height: int = HEIGHT) -> DataFrame:
    """Build the manifest of ``docs`` and hold another version of the rows against it.

    ``claimed`` maps fields to columns over ``docs`` that give the version to
    be verified.  Returns per row: key, leaf, subroot (of its group), root,
    proof_sha256 (SHA-256 of all siblings from the leaf to the root),
    folded_root (recomputed from the claimed leaf and the stored siblings)
    and verified (whether it is the root).

    Leaves of a group ascend by key (nulls first), rows with one key by their
    digest; equal rows get a leaf each.  A null group is a group and comes
    first, others by their UTF-8 bytes.  Null fields, empty and long texts
    are hashed as they are; other columns are ignored; an empty table gives
    an empty result.
    """
    # tree names that sort as the groups do: no null, and the null group before all others
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    own = {f: F.col(f) for f in fields}
    rows = docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf(own).alias("digest"),
                       leaf({**own, **claimed}).alias("claim"))
    rows = rows.withColumn("claim", F.when(F.col("claim") != F.col("digest"), F.col("claim")))  # null: as stored
    leaves = staged(ranked(rows, "tree", ["key", "digest"], "leaves"), "leaves")
    groups = build(leaves, height)

    subroots = staged(ranked(roots(groups, height).select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest"),
                             "tree", ["name"], "subroots"), "subroots")
    over = build(subroots, height)
    ends = roots(over, height).select("tree", F.expr(f"cast(array() as {STEP})").alias("above"),
                                      F.lower(F.hex("digest")).alias("root"))
    full = FANOUT ** height
    paths = children(descend(over, ends, height), ["root"], full).withColumnRenamed("block", "pos").drop("tree")
    ends = subroots.select("pos", F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot")).join(paths, "pos").drop("pos")

    blocks = staged(descend(groups, ends, height), "proofs")
    places = leaves.withColumn("block", F.expr(f"pos div {full}")).select("tree", "block", "pos", "key", "digest", "claim")
    kind = places.schema["key"].dataType.simpleString()
    out = places.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        verify, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumnRenamed("key", key).withColumn("verified", F.col("folded_root") == F.col("root"))


def verify(rows: pa.Table, blocks: pa.Table) -> pa.Table:
    """Proof digest and folded root of the leaves of one block."""
    stored = blocks.to_pylist()[0]
    block = Block(stored["nodes"], stored["n"], stored["up"])
    above = [(s["left"].encode(), s["right"].encode()) for s in stored["above"]]
    first = int(rows["pos"].to_numpy().min())  # the group has all leaves of its block
    proofs, folded = [], []
    for pos, digest, claim in zip(rows["pos"].to_pylist(), rows["digest"].to_pylist(), rows["claim"].to_pylist(), strict=True):
        proof, node = sha256(), (claim or digest).hex().encode()
        for left, right in (*block.path(pos - first), *above):
            proof.update(left + right)
            node = sha256(left + node + right).hexdigest().encode()
        proofs.append(proof.hexdigest())
        folded.append(node.decode())
    same = lambda text: pa.array([text] * len(folded), pa.string())
    return pa.table({"key": rows["key"], "leaf": pa.array([d.hex() for d in rows["digest"].to_pylist()], pa.string()),
                     "subroot": same(stored["subroot"]), "root": same(stored["root"]),
                     "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})
