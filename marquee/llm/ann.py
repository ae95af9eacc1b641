"""Nearest neighbours by a robust-pruned directed graph in each shard.

Equal vectors are one node that holds their smallest ids. Nodes are dealt to
shards by hash; each shard links its nodes: a greedy search from the entry
proposes neighbours, and pruning keeps a proposal only if no kept neighbour is
nearer to it by the relaxation factor, so that edges stay diverse. Back edges
are added and pruned alike. A query runs a beam search in every shard of its
dimension, and the shards' best are merged.

All distances are Euclidean and in double precision on the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import stored

#: Nodes of a shard, about; edges of a node; beam while linking and searching.
SHARD_NODES, DEGREE, BUILD_BEAM, SEARCH_BEAM = 6000, 32, 48, 128
#: Nodes that a search starts from: the one nearest to the mean, and others drawn
#: at random, so that a dense group about the mean cannot hold all of a beam.
ENTRIES = 24
RELAXED = 1.2
#: Nodes that are linked, and queries that are searched, together.
BATCH = 256
#: Tasks that shards are dealt to, for each shard, so that few meet in one.
TASKS_PER_SHARD = 4
#: Queries that are sent to a shard's graph together.
QUERY_BLOCK = 20_000


def usable(vector: Column) -> Column:
    """Vectors that take part: not NULL, zero, or with a part that is NULL or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``b`` [..., k, d] to rows of ``a`` [..., d]."""
    gap = b - a[..., None, :]
    return np.einsum("...d,...d->...", gap, gap)


class Graph:
    """Nodes, their out-edges (-1: none) and the entries where searches start."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.vectors, self.edges, self.entries = vectors, edges, entries

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of many queries at once: nodes by distance and squared distances (inf: none)."""
        n = len(queries)
        start = np.tile(self.entries, (n, 1))
        beam = max(beam, start.shape[1])
        nodes = np.full((n, beam), -1, np.int64)
        dists = np.full((n, beam), np.inf)
        done = np.ones((n, beam), bool)
        far = _squares(queries, self.vectors[start])
        order = np.argsort(far, axis=1, kind="stable")
        nodes[:, : start.shape[1]] = np.take_along_axis(start, order, 1)
        dists[:, : start.shape[1]] = np.take_along_axis(far, order, 1)
        done[:, : start.shape[1]] = False
        visited = np.zeros((n, len(self.vectors)), bool)
        visited[:, self.entries] = True
        active = np.arange(n)
        while len(active):
            first = np.argmin(done[active], axis=1)  # in order: the nearest that is not expanded
            here = nodes[active, first]
            done[active, first] = True
            near = self.edges[here]
            new = (near >= 0) & ~visited[active[:, None], near]
            # Each neighbour once: edges of a node are distinct.
            at, k = np.nonzero(new)
            visited[active[at], near[at, k]] = True
            far = np.full(near.shape, np.inf)
            gap = self.vectors[near[at, k]] - queries[active[at]]
            far[at, k] = np.einsum("ij,ij->i", gap, gap)
            both_d = np.concatenate([dists[active], far], 1)
            both_n = np.concatenate([nodes[active], np.where(new, near, -1)], 1)
            both_x = np.concatenate([done[active], ~new], 1)
            order = np.argsort(both_d, axis=1, kind="stable")[:, :beam]
            dists[active] = np.take_along_axis(both_d, order, 1)
            nodes[active] = np.take_along_axis(both_n, order, 1)
            done[active] = np.take_along_axis(both_x, order, 1) | ~np.isfinite(dists[active])
            active = active[~done[active].all(1)]
        return nodes, dists


def prune(vectors: np.ndarray, own: np.ndarray, proposals: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Kept neighbours of many nodes at once: [m, degree] of proposals [m, c] (-1: none).

    Takes the nearest proposal and drops those that lie nearer to it, by the
    factor, than to the node; and so on.
    """
    order_d = _squares(vectors[own], vectors[np.maximum(proposals, 0)])
    order_d[(proposals < 0) | (proposals == own[:, None])] = np.inf
    order = np.argsort(order_d, axis=1, kind="stable")
    proposals, far = np.take_along_axis(proposals, order, 1), np.take_along_axis(order_d, order, 1)
    twice = np.zeros(proposals.shape, bool)
    twice[:, 1:] = (proposals[:, 1:] == proposals[:, :-1]) & (far[:, 1:] == far[:, :-1])
    far[twice] = np.inf
    kept = np.full((len(own), degree), -1, np.int64)
    points = vectors[np.maximum(proposals, 0)]
    for k in range(degree):
        best = np.argmin(far, axis=1)
        rows = np.flatnonzero(np.isfinite(far[np.arange(len(own)), best]))
        if not len(rows):
            break
        kept[rows, k] = proposals[rows, best[rows]]
        between = _squares(points[rows, best[rows]], points[rows])
        drop = relaxed * relaxed * between <= far[rows]
        far[rows] = np.where(drop, np.inf, far[rows])
        far[rows, best[rows]] = np.inf
    return kept


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED, batch: int = BATCH) -> Graph:
    """Links all nodes, in batches against the graph so far, first strictly and then relaxed.

    The order is a permutation drawn from the number of nodes, so that a graph
    that is built again is the same.
    """
    n = len(vectors)
    chance = np.random.default_rng(n)
    middle = int(np.argmin(_squares(vectors.mean(0), vectors)))
    entries = np.unique(np.append(chance.permutation(n)[: ENTRIES - 1], middle))
    # Starts from random edges, as a connected whole.
    edges = np.full((n, degree), -1, np.int64)
    if n > 1:
        start = min(degree // 2, n - 1)
        edges[:, :start] = (np.arange(n)[:, None] + 1 + np.stack([chance.choice(n - 1, start, replace=False) for _ in range(n)])) % n
    graph = Graph(vectors, edges, entries)
    for factor in (1.0, relaxed):
        order = chance.permutation(n)
        for k in range(0, n, batch):
            own = order[k : k + batch]
            found, _ = graph.search(vectors[own], beam)
            edges[own] = prune(vectors, own, np.concatenate([found, edges[own]], 1), degree, factor)
            _back(vectors, edges, own, factor)
    return _reached(graph)


def _reached(graph: Graph) -> Graph:
    """With one more edge to each node that no path leads to, from the nearest one found."""
    seen = np.zeros(len(graph.vectors), bool)
    front = graph.entries
    while len(front):
        seen[front] = True
        after = np.unique(graph.edges[front])
        front = after[(after >= 0) & ~seen[after]]
    lost = np.flatnonzero(~seen)
    if not len(lost):
        return graph
    found = np.concatenate([graph.search(graph.vectors[lost[k : k + BATCH]], 8)[0][:, 0] for k in range(0, len(lost), BATCH)])
    order = np.argsort(found, kind="stable")
    found, lost = found[order], lost[order]
    _, starts, counts = np.unique(found, return_index=True, return_counts=True)
    more = np.full((len(graph.vectors), int(counts.max())), -1, np.int64)
    more[found, np.arange(len(found)) - np.repeat(starts, counts)] = lost
    return Graph(graph.vectors, np.concatenate([graph.edges, more], 1), graph.entries)


def _back(vectors: np.ndarray, edges: np.ndarray, own: np.ndarray, relaxed: float) -> None:
    """Edges back to the nodes just linked; a node with too many prunes them."""
    degree = edges.shape[1]
    at, k = np.nonzero(edges[own] >= 0)
    to, back = edges[own[at], k], own[at]
    order = np.lexsort((back, to))
    to, back = to[order], back[order]
    nodes, starts, counts = np.unique(to, return_index=True, return_counts=True)
    wide = int(counts.max()) if len(counts) else 0
    more = np.full((len(nodes), wide), -1, np.int64)
    more[np.repeat(np.arange(len(nodes)), counts), np.arange(len(to)) - np.repeat(starts, counts)] = back
    known = (more[:, :, None] == edges[nodes][:, None, :]).any(2)
    more[known] = -1
    both = np.concatenate([edges[nodes], more], 1)
    full = (both >= 0).sum(1) > degree
    # Room for all: empty places go to the end.
    packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
    edges[nodes[~full]] = packed[~full]
    if full.any():
        edges[nodes[full]] = prune(vectors, nodes[full], both[full], degree, relaxed)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width)


def distinct_vectors(rows: DataFrame, k: int, key: str, vector: str) -> DataFrame:
    """(vector, ids): each usable vector once, with its ``k + 1`` smallest ids in order.

    No more can be among the ``k`` nearest of any query, whose own id is left
    out. Ids are ranked by window limits, task by task before they meet.
    """
    used = rows.where(usable(F.col(vector))).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")).distinct()
    dealt = used.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    some = dealt.withColumn("k", F.row_number().over(W.partitionBy("vector", "salt").orderBy("id"))).where(F.col("k") <= k + 1)
    best = some.withColumn("k", F.row_number().over(W.partitionBy("vector").orderBy("id"))).where(F.col("k") <= k + 1)
    return best.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def index(rows: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The stored index: (shard, width, node, vector, ids, edges) for every usable row's vector."""
    nodes = stored(distinct_vectors(rows, k, key, vector).withColumn("width", F.size("vector")), "ann-nodes")
    shards = nodes.groupBy("width").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(shard_nodes))).cast("int").alias("shards"))
    dealt = nodes.join(shards, "width").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))

    def link(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector"), table.column("width")[0].as_py())
        # In the order of the ids, so that the graph does not depend on how rows arrived.
        order = np.argsort(np.array([v[0].as_py() for v in table.column("ids")]), kind="stable")
        table, vectors = table.take(pa.array(order)), vectors[order]
        graph = build(vectors)
        edges = pa.array([e[e >= 0].tolist() for e in graph.edges], pa.list_(pa.int32()))
        entry = pa.array(np.isin(np.arange(len(vectors)), graph.entries))
        return pa.table([table.column("width"), table.column("shard"), pa.array(np.arange(len(vectors), dtype=np.int32)), entry, table.column("vector"), table.column("ids"), edges], names=["width", "shard", "node", "entry", "vector", "ids", "edges"])

    schema = "width int, shard int, node int, entry boolean, vector array<double>, ids array<bigint>, edges array<int>"
    # Shards are small in bytes and dear to build: a number of tasks of its own keeps adaptive
    # execution from putting them together.
    tasks = TASKS_PER_SHARD * int(shards.agg(F.sum("shards")).first()[0] or 1)
    spread = dealt.select("width", "shard", "vector", "ids").repartition(tasks, "width", "shard")
    linked = spread.groupBy("width", "shard").applyInArrow(link, schema)
    return stored(linked, "ann-index")


def search(indexed: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query (id, vector).

    Equal distances go to the smaller id; a query's own id is left out. If there
    are fewer candidates than ``k``, all are given.
    """
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    asked = queries.withColumn("width", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    shards = indexed.select(F.col("width").alias("of"), F.col("shard").alias("asked")).distinct()
    asked = asked.join(shards, F.col("width") == F.col("of"))  # every shard of the query's width
    asked = asked.select("id", "vector", "of", "asked", "block")
    graphs = indexed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def look(nodes: pa.Table, questions: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["query_id", "vec_id", "score"])
        if not len(nodes) or not len(questions):
            return empty
        nodes = nodes.sort_by("node")
        width = nodes.column("width")[0].as_py()
        vectors = _matrix(nodes.column("vector"), width)
        lists = [e.as_py() for e in nodes.column("edges")]
        edges = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int64)
        for row, e in zip(edges, lists):
            row[: len(e)] = e
        graph = Graph(vectors, edges, np.flatnonzero(nodes.column("entry").to_numpy()))
        ids = [v.as_py() for v in nodes.column("ids")]
        found: list[tuple[int, int, float]] = []
        wanted, names = _matrix(questions.column("vector"), width), questions.column("id").to_pylist()
        for start in range(0, len(names), BATCH):
            near, _ = graph.search(wanted[start : start + BATCH], max(beam, k + 1))
            for name, query, row in zip(names[start : start + BATCH], wanted[start : start + BATCH], near):
                row = row[row >= 0]
                gap = vectors[row] - query
                exact = np.sqrt((gap * gap).sum(1))
                best = sorted((float(d), i) for d, node in zip(exact, row) for i in ids[node] if i != name)[:k]
                found.extend((name, i, d) for d, i in best)
        if not found:
            return empty
        columns = list(zip(*found))
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    grouped = graphs.groupBy("width", "shard", "block").cogroup(asked.groupBy("of", "asked", "block"))
    found = grouped.applyInArrow(look, "query_id bigint, vec_id bigint, score double")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each row for which ``is_query`` holds, against all rows.

    Rows whose vector is not ``usable`` neither ask nor are found, nor do rows of
    another width than the query's. Repeated rows count once; ids that stand for
    several vectors count once for each.
    """
    queries = rows.where(is_query & usable(F.col(vector))).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")).distinct()
    return search(index(rows, k, key, vector), queries, k)
