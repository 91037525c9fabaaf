"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Points are inserted in batches: a greedy beam search on the graph so far
proposes neighbours, relaxed distance pruning keeps those that no kept
neighbour is much nearer to, and reverse edges are added and pruned the same
way.  Queries run a beam search in every shard; the shards' bests are merged
and ranked by the exact distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import staged
from orrery.llm.vectors import matrix, usable

DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 96, 1.2
SHARD_ROWS, QUERY_ROWS = 4096, 2048  # points of a shard, about; queries that search a shard together
BATCH = 256


def _squares(points: np.ndarray, at: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """(q, c) squared distances of each query to its own candidates; infinite where the candidate is -1."""
    diff = points[np.maximum(at, 0)] - queries[:, None, :]
    out = np.einsum("qcd,qcd->qc", diff, diff)
    out[at < 0] = np.inf
    return out


def beam_search(points: np.ndarray, graph: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int,
                expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(q, beam) nearest points found (-1: none) and their squared distances, nearest first.

    All queries step together: each expands its ``expand`` nearest points not
    yet expanded, until none has such a point in its beam.
    """
    count, q = len(points), len(queries)
    start = np.broadcast_to(entry, (q, len(entry)))
    at = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), bool)
    seen = np.zeros((q, count), bool)
    width = min(beam, len(entry))
    first = _squares(points, start, queries)
    order = np.argsort(first, axis=1, kind="stable")[:, :width]
    at[:, :width] = np.take_along_axis(start, order, 1)
    dist[:, :width] = np.take_along_axis(first, order, 1)
    done[:, :width] = False
    seen[:, entry] = True
    rows = np.arange(q)
    while True:
        open_at = np.where(done, np.inf, dist)
        live = np.isfinite(open_at).any(axis=1)
        if not live.any():
            return at, dist
        own = rows[live]
        pick = np.argsort(open_at[own], axis=1, kind="stable")[:, :expand]
        usable_pick = np.isfinite(np.take_along_axis(open_at[own], pick, 1))
        node = np.where(usable_pick, np.take_along_axis(at[own], pick, 1), -1)
        done[own[:, None], pick] = True
        near = graph[np.maximum(node, 0)]
        near = np.where((node >= 0)[:, :, None], near, -1).reshape(len(own), -1)
        near = np.where((near >= 0) & ~seen[own[:, None], np.maximum(near, 0)], near, -1)
        near = -np.sort(-near, axis=1)  # equal proposals side by side, so that each is taken once
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        r, c = np.nonzero(near >= 0)
        seen[own[r], near[r, c]] = True
        most = int((near >= 0).sum(axis=1).max(initial=0))
        if not most:
            continue
        near = np.take_along_axis(near, np.argsort(near < 0, axis=1, kind="stable")[:, :most], 1)
        fresh = _squares(points, near, queries[own])
        all_at = np.concatenate([at[own], near], axis=1)
        all_dist = np.concatenate([dist[own], fresh], axis=1)
        all_done = np.concatenate([done[own], near < 0], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        at[own], dist[own] = np.take_along_axis(all_at, order, 1), np.take_along_axis(all_dist, order, 1)
        done[own] = np.take_along_axis(all_done, order, 1)


def robust_prune(points: np.ndarray, owners: np.ndarray, at: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """(o, degree) kept neighbours (-1: none) of each owner among its candidates ``at`` (-1: none).

    The nearest candidate is kept; every candidate c with alpha * d(kept, c)
    <= d(owner, c) goes; and so on.
    """
    at = np.where(at == owners[:, None], -1, at)
    dist = _squares(points, at, points[owners])
    order = np.argsort(dist, axis=1, kind="stable")
    at, dist = np.take_along_axis(at, order, 1), np.take_along_axis(dist, order, 1)
    block = points[np.maximum(at, 0)]
    norm = np.einsum("ocd,ocd->oc", block, block)
    between = norm[:, :, None] + norm[:, None, :] - 2 * (block @ block.transpose(0, 2, 1))
    alive = at >= 0
    out = np.full((len(owners), degree), -1, np.int64)
    rows = np.arange(len(owners))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        best = alive.argmax(axis=1)
        out[some, k] = at[rows, best][some]
        alive[rows, best] = False
        alive &= (alpha * alpha) * between[rows, best] > dist
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
                passes: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(n, 2 * degree) neighbours (-1: none) and the entry points.

    Lists may grow to twice the degree by reverse edges before they are
    pruned again.  The entry is the point nearest to the mean, with the
    points of the first batch as its neighbours.
    """
    count = len(points)
    graph = np.full((count, 2 * degree), -1, np.int64)
    if count <= 1:
        return graph, np.arange(count)
    entry = np.array([int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())])
    order = np.random.default_rng(5).permutation(count)
    order = np.concatenate([entry, order[order != entry[0]]])
    head = order[:min(count, 2 * degree)]
    graph[head, :degree] = robust_prune(points, head, np.broadcast_to(head, (len(head), len(head))), degree, alpha)
    steps = [order[len(head):]] + [order] * (passes - 1)
    for todo in steps:
        size = len(head)
        at = 0
        while at < len(todo):
            own = todo[at:at + min(BATCH, size)]  # no batch is larger than what it is searched on
            at += len(own)
            size += len(own)
            proposed, _ = beam_search(points, graph, entry, points[own], beam)
            kept = robust_prune(points, own, np.concatenate([proposed, graph[own]], axis=1), degree, alpha)
            graph[own] = -1
            graph[own, :degree] = kept
            _reverse(points, graph, own, kept, degree, alpha)
    return graph, entry


def _reverse(points: np.ndarray, graph: np.ndarray, own: np.ndarray, kept: np.ndarray, degree: int, alpha: float) -> None:
    """Add own -> kept edges backwards; lists that overflow are pruned to ``degree``."""
    r, c = np.nonzero(kept >= 0)
    source, target = own[r], kept[r, c]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, times = np.unique(target, return_index=True, return_counts=True)
    widest = int(times.max(initial=0))
    if not widest:
        return
    incoming = np.full((len(nodes), widest), -1, np.int64)
    incoming[np.repeat(np.arange(len(nodes)), times), np.arange(len(target)) - np.repeat(first, times)] = source
    incoming[(incoming[:, :, None] == graph[nodes][:, None, :]).any(axis=2)] = -1
    merged = np.concatenate([graph[nodes], incoming], axis=1)
    size = (merged >= 0).sum(axis=1)
    merged = np.take_along_axis(merged, np.argsort(merged < 0, axis=1, kind="stable"), 1)
    fits = size <= graph.shape[1]
    graph[nodes[fits]] = merged[fits][:, :graph.shape[1]]
    over = np.flatnonzero(~fits)
    for at in range(0, len(over), BATCH):
        part = over[at:at + BATCH]
        width = int(size[part].max())
        pruned = robust_prune(points, nodes[part], merged[part][:, :width], degree, alpha)
        graph[nodes[part]] = -1
        graph[nodes[part], :degree] = pruned


def build_index(vectors: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Staged index (shard, pos, id, v, neighbours, entry) of distinct (id, v) rows: a graph for each shard.

    Rows are dealt to shards of about ``shard_rows`` by a hash of the id, so
    a shard fits in a task at every table size.  Every row is indexed.
    """
    total = vectors.count()
    shards = max(1, -(-total // shard_rows))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id").reset_index(drop=True)
        graph, entry = build_graph(matrix(rows["v"]))
        return pd.DataFrame({"shard": rows["shard"], "pos": np.arange(len(rows)), "id": rows["id"], "v": rows["v"],
                             "neighbours": [g[g >= 0].astype(np.int32) for g in graph],
                             "entry": np.isin(np.arange(len(rows)), entry)})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    index = dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(
        build, "shard int, pos int, id bigint, v array<float>, neighbours array<int>, entry boolean")
    return staged(index, "ann-index")


def search_index(index: DataFrame, queries: DataFrame, k: int, *, beam: int = SEARCH_BEAM,
                 query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, id, score): of every shard the ``k`` nearest found for every (query_id, v) row; Euclidean distance in double.

    The stated query set meets all shards in blocks: a group holds one shard
    and at most about ``query_rows`` queries.
    """
    blocks = max(1, -(-queries.count() // query_rows))

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64"})
        rows = rows.sort_values("pos")
        points, ids = matrix(rows["v"]), rows["id"].to_numpy()
        graph = np.full((len(rows), max(1, int(rows["neighbours"].map(len).max()))), -1, np.int64)
        for line, near in zip(graph, rows["neighbours"], strict=True):
            line[:len(near)] = near
        entry, out = np.flatnonzero(rows["entry"]), []
        want = matrix(asked["v"])
        for at in range(0, len(want), BATCH):
            part = want[at:at + BATCH]
            found, _ = beam_search(points, graph, entry, part, beam)
            diff = points[np.maximum(found, 0)].astype(np.float64) - part[:, None, :].astype(np.float64)
            score = np.sqrt((diff * diff).sum(axis=2))
            score[found < 0] = np.inf
            order = np.lexsort((ids[np.maximum(found, 0)], score), axis=1)[:, :k]
            score, found = np.take_along_axis(score, order, 1), np.take_along_axis(found, order, 1)
            r, c = np.nonzero(found >= 0)
            out.append(pd.DataFrame({"query_id": asked["query_id"].to_numpy()[at + r], "id": ids[found[r, c]], "score": score[r, c]}))
        return pd.concat(out)

    shards = index.select("shard").distinct()
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.join(F.broadcast(shards.agg(F.sort_array(F.collect_list("shard")).alias("shards")))).withColumn("shard", F.explode("shards")).drop("shards")
    stored = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return stored.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        search, "query_id bigint, id bigint, score double")


def nearest(table: DataFrame, *, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding",
            shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` nearest rows found for each row whose key is divisible by ``every``.

    Candidates are all rows but the query's own; ties go to the smaller key;
    with fewer candidates than ``k`` all are returned.  Vectors that are
    null, empty, zero or hold null or non-finite components, and rows with a
    null key, take no part, nor do vectors of another length than the query's.
    A repeated key is one candidate for each different vector it has.  Other
    columns are ignored; an empty table gives an empty result.

    Equal vectors are one point of the index, which keeps their ``k`` + 1
    smallest keys (no more can be among the nearest), so a vector that very
    many rows share neither fills a shard nor hides other neighbours.
    """
    rows = table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    rows = rows.filter(usable(F.col("v")) & F.col("id").isNotNull()).dropDuplicates().withColumn("h", F.xxhash64("v"))
    # ranks up to k + 1 only: applied before the shuffle as well
    order = Window.partitionBy("h", "v").orderBy("id")
    members = rows.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1)
    classes = staged(members.groupBy("h", "v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("members")), "ann-classes")
    out = None
    for dims in [r[0] for r in classes.select(F.size("v").alias("d")).distinct().sort("d").collect()]:
        own = classes.filter(F.size("v") == dims)
        # a repeated key may stand for several vectors: points are named by position in a unique hash of (rep, vector)
        points = own.select(F.xxhash64("rep", "v").alias("id"), "v", "members")
        index = build_index(points.select("id", "v"), shard_rows=shard_rows)
        queries = rows.filter((F.size("v") == dims) & (F.col("id") % every == 0)).select(
            F.col("id").alias("query_id"), "v")
        found = search_index(index, queries, k + 1, beam=beam).join(points.select("id", "members"), "id")
        near = found.select("query_id", "score", F.explode("members").alias("near")).filter("near <> query_id")
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "near")))
        part = ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("near").alias(key), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(key), F.lit(0.0).alias("score")).limit(0)
    return out
