"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Unit vectors are projected on m random directions.  Two vectors collide in a
projection when their values differ by at most w (a window centred on the
query).  m, w and the count l are calibrated: a pair at the least cosine
collides in at least l of m projections with the wanted recall.  Directions
come in m - l + 1 groups, so a pair that misses at most m - l of them
collides in every direction of some group: only such pairs are looked at,
found by grid cells of each group and a sorted projection within a cell.
Pairs that pass the count are verified by their cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import connected_components, staged
from orrery.llm.vectors import usable

COSINE = 0.98
GROUPS = 3  # of directions; a pair may miss one direction less
RECALL = 0.9999  # of a pair exactly at the least cosine
CELL = 4.0  # cell width in windows
STORE_ROWS = 4096  # rows of a cell that are compared in one piece
BROADCAST_ROWS = 50_000
CHUNK = 1 << 19  # pairs looked at together


class Calibration:
    """Directions per group, window and count for a least cosine and a recall.

    A direction of a pair at distance d = sqrt(2 - 2 cosine) differs by a
    normal variable of deviation d.  The miss probability is the largest at
    which at most ``groups`` - 1 of m directions miss with ``recall``.  More
    directions per group (one per factor four of the largest label) keep
    the share of a cell's false pairs falling as tables grow.
    """

    def __init__(self, rows: int, cosine: float = COSINE, groups: int = GROUPS, recall: float = RECALL):
        self.cosine, self.groups = cosine, groups
        self.size = max(5, math.ceil(math.log(max(rows, 1) / 1024 + 1, 4)))
        self.m = self.size * groups
        self.count = self.m - groups + 1
        low, high = 0.0, 0.5
        for _ in range(60):
            miss = (low + high) / 2
            kept = sum(math.comb(self.m, k) * miss ** k * (1 - miss) ** (self.m - k) for k in range(groups))
            low, high = (miss, high) if kept >= recall else (low, miss)
        low_z, high_z = 0.0, 12.0
        for _ in range(60):
            z = (low_z + high_z) / 2
            low_z, high_z = (z, high_z) if math.erfc(z / math.sqrt(2)) > low else (low_z, z)
        self.window = high_z * math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-5
        self.cell = CELL * self.window

    def directions(self, dims: int) -> np.ndarray:
        return np.random.default_rng([11, dims]).normal(0, 1, (dims, self.m))


def _rows(plan: Calibration):
    """Arrow function: each vector as a store row in its home cell of each group, and as probe rows in all cells its window touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = part.column(2)
                width = np.diff(vectors.offsets.to_numpy())
                for dims in np.unique(width):
                    pick = np.flatnonzero(width == dims)
                    own = part.take(pa.array(pick))
                    values = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(pick), dims).astype(np.float64)
                    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
                    yield from _expand(plan, own, dims, unit, unit @ plan.directions(int(dims)))

    return run


def _expand(plan: Calibration, own: pa.RecordBatch, dims: int, unit: np.ndarray, projected: np.ndarray) -> Iterator[pa.RecordBatch]:
    for g in range(plan.groups):
        mine = projected[:, g * plan.size:(g + 1) * plan.size]
        home = np.floor(mine / plan.cell).astype(np.int64)
        low = np.floor((mine - plan.window) / plan.cell).astype(np.int64)
        high = np.floor((mine + plan.window) / plan.cell).astype(np.int64)
        rows, cells = np.arange(len(mine)), np.zeros((len(mine), 0), np.int64)
        for k in range(plan.size):  # one column more: every row once for each cell that its window touches there
            times = (high[rows, k] - low[rows, k] + 1)
            first = np.cumsum(times) - times
            step = np.arange(times.sum()) - np.repeat(first, times)
            rows, cells = np.repeat(rows, times), np.repeat(cells, times, axis=0)
            cells = np.concatenate([cells, (low[rows, k] + step)[:, None]], axis=1)
        for role, at, keys in ((0, np.arange(len(mine)), home), (1, rows, cells)):
            name = np.zeros(len(at), np.int64)
            for k in range(plan.size):
                name = name * 1_000_003 + keys[:, k]
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [own.column(0).take(take), own.column(1).take(take), pa.array(np.full(len(at), dims, np.int32)),
                 pa.array(np.full(len(at), g, np.int32)), pa.array(name), pa.array(np.full(len(at), role, np.int32)),
                 own.column(3).take(take), _binary(projected[at].astype(np.float32)), _binary(unit[at])],
                ["id", "label", "dims", "g", "cell", "role", "n", "projected", "unit"])


def _binary(block: np.ndarray) -> pa.Array:
    data, width = np.ascontiguousarray(block), block.shape[1] * block.itemsize
    offsets = pa.array(np.arange(0, (len(block) + 1) * width, width), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(block), [None, offsets.buffers()[1], pa.py_buffer(data.tobytes())])


def _compare(plan: Calibration):
    """Arrow function over sorted rows: per probe the rows of the cell it links with (sum of class sizes), and links that span them."""

    def links(g: int, store, probe):
        """(probe row, store row) index pairs that this group finds first and that are verified."""
        (sp, su), (pp, pu) = store, probe
        first = g * plan.size
        order = np.argsort(sp[:, first], kind="stable")
        sp, su = sp[order], su[order]
        begin = np.searchsorted(sp[:, first], pp[:, first] - plan.window, "left")
        times = np.searchsorted(sp[:, first], pp[:, first] + plan.window, "right") - begin
        ends = np.cumsum(times)
        at = 0
        while at < len(pp):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
            t = times[at:stop]
            p = np.repeat(np.arange(at, stop), t)
            s = np.repeat(begin[at:stop], t) + np.arange(len(p)) - np.repeat(np.cumsum(t) - t, t)
            for k in range(first + 1, first + plan.size):
                near = np.abs(sp[s, k] - pp[p, k]) <= plan.window
                p, s = p[near], s[near]
            hits = np.abs(sp[s] - pp[p]) <= plan.window
            # a pair that all of an earlier group collides in has been found there
            earlier = hits[:, :first].reshape(len(p), g, plan.size).all(axis=2).any(axis=1) if g else np.zeros(len(p), bool)
            keep = (hits.sum(axis=1) >= plan.count) & ~earlier
            p, s = p[keep], s[keep]
            if len(p):
                good = np.einsum("ij,ij->i", su[s], pu[p]) >= plan.cosine
                yield p[good], order[s[good]]
            at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, store = None, None

        def block(rows: pa.RecordBatch):
            n = rows.num_rows
            return (np.frombuffer(b"".join(rows.column("projected").to_pylist()), np.float32).reshape(n, -1),
                    np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(n, -1))

        for batch in batches:
            if not batch.num_rows:
                continue
            names = ("label", "dims", "g", "cell", "salt", "role")
            keys = np.stack([np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in names], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                key, rows = tuple(keys[lo, :5]), batch.slice(lo, hi - lo)
                ids, sizes = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n"))
                if keys[lo, 5] == 0:  # stores come first; a store that goes on in the next batch is extended
                    own = (ids, sizes, *block(rows))
                    store = tuple(np.concatenate(x) for x in zip(store, own, strict=True)) if now == key else own
                    now = key
                    continue
                if now != key:
                    continue
                count = np.zeros(len(ids), np.int64)
                edges = np.empty((0, 2), np.int64)
                for p, s in links(int(keys[lo, 2]), store[2:], block(rows)):
                    other = store[0][s] != ids[p]
                    p, s = p[other], s[other]
                    np.add.at(count, p, store[1][s])
                    edges = _spanning(np.concatenate([edges, np.stack([ids[p], store[0][s]], axis=1)]))
                some = np.flatnonzero(count)
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([ids[some], edges[:, 0]])), pa.array(np.concatenate([count[some], np.zeros(len(edges), np.int64)])),
                         pa.array(np.concatenate([ids[some], edges[:, 1]]))], ["id", "links", "other"])

    return run


def _spanning(edges: np.ndarray) -> np.ndarray:
    """Few edges with the same components: each node with the least node of its component."""
    if not len(edges):
        return edges
    nodes, at = np.unique(edges, return_inverse=True)
    at = at.reshape(edges.shape)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[at[:, 0]], label[at[:, 1]])
        new = label.copy()
        np.minimum.at(new, at[:, 0], least)
        np.minimum.at(new, at[:, 1], least)
        np.minimum.at(new, label, new)  # what a node learns its root learns too
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[other], nodes[label[other]]], axis=1)


def near_vectors(table: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``table``.

    Rows link when their labels are equal and not null, their vectors have
    equal length, and the cosine is at least ``cosine``.  Vectors that are
    null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows with a null key or label: they have no links and
    their own key as component.  Repeated rows are vectors of their own that
    link with each other.  Other columns are ignored; an empty table gives
    an empty result.

    Equal vectors of a label are compared once, weighted by their number.
    The rows of a large cell are dealt over several pieces of at most about
    4,096, each met by all probes of the cell; a pair's link is counted in
    the task, so a group of n near copies sends n rows on, not n * n.
    """
    rows = table.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
                        F.col(vector).cast("array<float>").alias("v"))
    joins = usable(F.col("v")) & F.col("id").isNotNull() & F.col("label").isNotNull()
    marked = rows.withColumn("h", F.when(joins, F.xxhash64("v")))
    classes = staged(marked.filter("h IS NOT NULL").groupBy("label", "h", "v").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-classes")
    plan = Calibration(classes.groupBy("label").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0, cosine, recall=recall)
    spread = classes.select(F.col("rep").alias("id"), "label", "v", "n").mapInArrow(
        _rows(plan), "id bigint, label bigint, dims int, g int, cell bigint, role int, n bigint, projected binary, unit binary")
    cell = ["label", "dims", "g", "cell"]
    sizes = spread.filter("role = 0").groupBy(*cell).agg(F.count(F.lit(1)).alias("stored"))
    large = staged(sizes.filter(F.col("stored") > STORE_ROWS).select(*cell, F.ceil(F.col("stored") / STORE_ROWS).cast("int").alias("pieces")), "large-cells")
    few = large.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    dealt = spread.join(F.broadcast(large) if few else large, cell, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    salts = F.when(F.col("role") == 0, F.array(F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("pieces") - 1))
    dealt = dealt.withColumn("salt", F.explode(salts)).drop("pieces")
    together = dealt.repartition(*cell, "salt").sortWithinPartitions(*cell, "salt", "role")
    found = staged(together.mapInArrow(_compare(plan), "id bigint, links bigint, other bigint"), "vector-links")
    reps = classes.select(F.col("rep").alias("id")).distinct()
    component = connected_components(reps, found.filter("id <> other").distinct(), left="id", right="other")
    counted = component.join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
    known = classes.join(counted.withColumnRenamed("id", "rep"), "rep").select(
        "label", "h", "v", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    out = marked.join(known, ["label", "h", "v"], "left")
    component_id = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      component_id.alias("component_id"), F.coalesce(component_id == F.col("id"), F.lit(True)).alias("kept"))
