"""Nearest neighbours by inner product: a pruned directed graph for each shard.

Rows are dealt to shards by a hash of their id. A shard's distinct vectors are cut into bands of
similar length, and those of a band are the nodes of a graph. They are inserted in batches: a
greedy search from the entry node proposes neighbours, and pruning keeps a near one only if no
neighbour kept before is closer to it by the relaxation factor, so that the edges point in
different directions. Queries run a beam search in every shard, and the best of all shards are kept.

Largest inner product becomes nearest point by one more coordinate, which gives all vectors of a
band the same norm. Within a band this coordinate never outweighs the others by much, whatever
other lengths the table has. A query takes the bands from the longest vectors down, and leaves
out those whose length bounds their products below what it has found.

How wide a beam has to be depends on the vectors: each graph is tried with some of the shard's
own vectors against all its nodes, and keeps the width that finds enough of them. All is in
double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncolake.llm.shared import written

#: Rows of a shard and queries of a block, about: what one task holds.
SHARD_ROWS = 8_192
QUERY_ROWS = 4_096
#: Edges that pruning keeps, edges of a node before it is pruned again, relaxation.
DEGREE = 32
MOST_EDGES = 48
ALPHA = 1.2
#: Widths of the beam; that of a search is the least one, doubled until PROBES vectors of the
#: shard find this share of their nearest nodes.
BUILD_BEAM = 64
SEARCH_BEAM = 128
PROBES = 128
PROBE_RECALL = 0.985
#: The shortest vector of a band, as a share of the longest.
BAND = 0.5
#: Nodes inserted and queries advanced at once, and beam entries expanded in one step.
BATCH = 512
EXPAND = 4
#: Components that are gathered at once for products, 64 MB of them.
GATHERED = 8 * 1024 * 1024


class Graph:
    """Edges as rows of an array, -1 where there is none; node 0 is the entry."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None):
        self.vectors = vectors
        self.edges = edges
        if edges is None:
            self.edges = np.full((len(vectors) + 1, MOST_EDGES), -1, np.int32)
            self._insert_all()
            self._reach_all()

    # -- search

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and products of the best found, best first; -1 behind the last."""
        block = max(1, min(BATCH, GATHERED // (EXPAND * self.edges.shape[1] * queries.shape[1])))
        parts = [
            self._search(queries[start : start + block], beam)
            for start in range(0, len(queries), block)
        ]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, count = len(self.vectors), len(queries)
        ids = np.full((count, beam), -1, np.int32)
        sims = np.full((count, beam), -np.inf)
        done = np.ones((count, beam), bool)
        seen = np.zeros((count, n + 1), bool)
        ids[:, 0], done[:, 0], seen[:, 0] = 0, False, True
        sims[:, 0] = queries @ self.vectors[0]
        active = np.arange(count)
        while len(active):
            open_ = ~done[active]
            place = np.argsort(~open_, axis=1, kind="stable")[:, :EXPAND]
            rows = active[:, None]
            nodes = np.where(np.take_along_axis(open_, place, 1), ids[rows, place], n)
            done[rows, place] = True
            near = np.sort(self.edges[nodes].reshape(len(active), -1), axis=1)
            fresh = (near >= 0) & ~seen[rows, near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            # Few of the neighbours are new late in a search: the new ones move to the front.
            width = int(fresh.sum(axis=1).max())
            if width:
                front = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
                fresh = np.take_along_axis(fresh, front, 1)
                near = np.where(fresh, np.take_along_axis(near, front, 1), n)
                seen[rows, near] = True
                around = self.vectors[np.minimum(near, n - 1)]
                found = np.matmul(around, queries[active][:, :, None])[:, :, 0]
                sim = np.where(fresh, found, -np.inf)
                every = np.concatenate([sims[active], sim], axis=1)
                best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
                sims[active] = np.take_along_axis(every, best, 1)
                joined = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
                ids[active] = np.take_along_axis(joined, best, 1)
                closed = np.concatenate([done[active], ~fresh], axis=1)
                done[active] = np.take_along_axis(closed, best, 1)
            active = active[~done[active].all(axis=1)]
        return ids, sims

    # -- building

    def _prune(self, nodes: np.ndarray, found: np.ndarray, degree: int) -> np.ndarray:
        """Of the nodes found for each node, -1 for none, those that keep an edge."""
        block = max(1, GATHERED // (found.shape[1] * self.vectors.shape[1]))
        parts = [
            self._prune_block(nodes[start : start + block], found[start : start + block], degree)
            for start in range(0, len(nodes), block)
        ]
        return np.concatenate(parts)

    def _prune_block(self, nodes: np.ndarray, found: np.ndarray, degree: int) -> np.ndarray:
        norm = float(self.vectors[0] @ self.vectors[0])
        around = self.vectors[np.maximum(found, 0)]
        sims = np.matmul(around, self.vectors[nodes][:, :, None])[:, :, 0]
        alive = (found >= 0) & (found != nodes[:, None])
        order = np.argsort(np.where(alive, -sims, np.inf), axis=1, kind="stable")
        found = np.take_along_axis(found, order, 1)
        alive = np.take_along_axis(alive, order, 1)
        alive[:, 1:] &= found[:, 1:] != found[:, :-1]
        far = np.maximum(norm - np.take_along_axis(sims, order, 1), 0)
        around = np.take_along_axis(around, order[:, :, None], 1)
        out = np.full((len(nodes), degree), -1, np.int32)
        rows = np.arange(len(nodes))
        for k in range(degree):
            first = np.argmax(alive, axis=1)
            any_ = alive[rows, first]
            if not any_.any():
                break
            chosen = np.where(any_, found[rows, first], -1)
            out[:, k] = chosen
            alive[rows, first] = False
            between = norm - np.matmul(around, self.vectors[chosen][:, :, None])[:, :, 0]
            alive &= ALPHA * ALPHA * np.maximum(between, 0) > far
        return out

    def _insert_all(self) -> None:
        n, size = len(self.vectors), 1
        while size < n:
            batch = np.arange(size, min(n, size + min(size, BATCH)))
            found, _ = self.search(self.vectors[batch], BUILD_BEAM)
            out = self._prune(batch, found, DEGREE)
            self.edges[batch, :DEGREE] = out
            self._point_back(np.repeat(batch, DEGREE), out.ravel())
            size = int(batch[-1]) + 1

    def _point_back(self, source: np.ndarray, target: np.ndarray) -> None:
        """Adds the edge back for each edge; nodes with too many edges then are pruned."""
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(first, count)
        degree = (self.edges[nodes] >= 0).sum(axis=1)
        fits = degree + count <= MOST_EDGES
        fit = np.repeat(fits, count)
        self.edges[target[fit], (np.repeat(degree, count) + rank)[fit]] = source[fit]
        full = np.flatnonzero(~fits)
        # The nodes with the most new edges share a chunk, so that padding stays small.
        full = full[np.argsort(count[full], kind="stable")]
        for start in range(0, len(full), 64):
            part = full[start : start + 64]
            most = int(count[part].max())
            found = np.full((len(part), MOST_EDGES + most), -1, np.int32)
            found[:, :MOST_EDGES] = self.edges[nodes[part]]
            for i, k in enumerate(part.tolist()):
                new = source[first[k] : first[k] + count[k]]
                found[i, MOST_EDGES : MOST_EDGES + len(new)] = new
            self.edges[nodes[part]] = -1
            self.edges[nodes[part], :DEGREE] = self._prune(nodes[part], found, DEGREE)

    def _reached(self) -> np.ndarray:
        reached = np.zeros(len(self.vectors), bool)
        reached[0], front = True, np.array([0])
        while len(front):
            near = np.unique(self.edges[front])
            near = near[near >= 0]
            front = near[~reached[near]]
            reached[front] = True
        return reached

    def _reach_all(self) -> None:
        """Gives every node that the entry does not lead to an edge from a node found near it."""
        while True:
            lost = np.flatnonzero(~self._reached())[:BATCH]
            if not len(lost):
                return
            found, _ = self.search(self.vectors[lost], BUILD_BEAM)
            for node, near in zip(lost.tolist(), found.tolist(), strict=True):
                free = [k for k in near if k >= 0 and self.edges[k, -1] < 0]
                if not free:
                    wider = np.full((len(self.edges), 1), -1, np.int32)
                    self.edges = np.concatenate([self.edges, wider], axis=1)
                    free = [k for k in near if k >= 0]
                slot = int((self.edges[free[0]] >= 0).sum())
                self.edges[free[0], slot] = node


    def width(self, probes: np.ndarray, beam: int) -> int:
        """The least beam, from `beam` on by doubling, that finds PROBE_RECALL of the probes'
        nearest nodes; one of all nodes is not doubled again."""
        n = len(self.vectors)
        near = min(20, n)
        sims = probes @ self.vectors.T
        least = np.partition(sims, n - near, axis=1)[:, n - near]
        while beam < n:
            _, found = self.search(probes, beam)
            # The same product may differ in its last bits.
            if (found[:, :near] >= least[:, None] - 1e-12).mean() >= PROBE_RECALL:
                break
            beam *= 2
        return beam


def _lengths(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the binary logarithms of their lengths; no component
    overflows or vanishes on the way."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / most
    norms = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / norms[:, None], np.log2(most[:, 0]) + np.log2(norms)


def _bands(logs: np.ndarray) -> np.ndarray:
    """Numbers of the bands: one starts at the longest vector that none before it holds."""
    order = np.argsort(-logs, kind="stable")
    ordered = -logs[order]
    band = np.zeros(len(logs), np.int32)
    start, number = 0, 0
    while start < len(ordered):
        stop = int(np.searchsorted(ordered, ordered[start] - np.log2(BAND), side="right"))
        band[order[start:stop]] = number
        start, number = stop, number + 1
    return band


def _level(units: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Vectors scaled so that the longest has length one, with a coordinate that makes all
    lengths one."""
    norms = np.exp2(logs - logs.max())
    rest = np.sqrt(np.maximum(1 - norms * norms, 0))
    return np.column_stack([units * norms[:, None], rest])


def build(ids: np.ndarray, vectors: np.ndarray, beam: int = SEARCH_BEAM) -> pd.DataFrame:
    """The index of one shard: for every distinct vector its band, its number there, its ids,
    ascending, its edges, and the width of beam that its graph takes.

    A repeated id counts once, with the smallest of its vectors. Node 0 is the vector nearest to
    the mean of its band, the others follow in an order that a hash of their least id gives.
    """
    order = np.lexsort([*vectors.T[::-1], ids])
    ids, vectors = ids[order], vectors[order]
    once = np.concatenate([[True], ids[1:] != ids[:-1]])
    ids, vectors = ids[once], vectors[once]
    distinct, which = np.unique(vectors, axis=0, return_inverse=True)
    which = which.ravel()
    by_node = np.argsort(which, kind="stable")
    cuts = np.flatnonzero(np.diff(which[by_node])) + 1
    groups = np.split(ids[by_node], cuts)
    least = np.array([g[0] for g in groups], np.int64)
    mixed = least.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(mixed ^ (mixed >> np.uint64(29)), kind="stable")
    units, logs = _lengths(distinct)
    bands = _bands(logs)
    tried = units[order[:PROBES]]
    probes = np.column_stack([tried, np.zeros(len(tried))])
    parts = []
    for band in range(int(bands.max()) + 1):
        mine = order[bands[order] == band]
        level = _level(units[mine], logs[mine])
        entry = int(np.argmax(level @ level.mean(axis=0)))
        place = np.concatenate([[entry], np.delete(np.arange(len(mine)), entry)])
        mine, level = mine[place], np.ascontiguousarray(level[place])
        graph = Graph(level)
        parts.append(
            pd.DataFrame(
                {
                    "band": band,
                    "node": np.arange(len(mine)),
                    "ids": [groups[k].tolist() for k in mine.tolist()],
                    "vector": list(distinct[mine]),
                    "edges": [e[e >= 0].tolist() for e in graph.edges[: len(mine)]],
                    "beam": graph.width(probes, beam),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def _usable(vector: Column) -> Column:
    """Whether a vector has finite components that are not all zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return F.coalesce(
        vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def prepared(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, dim) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    return (
        rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
        .filter(F.col("id").isNotNull() & _usable(F.col("vector")))
        .withColumn("dim", F.size("vector"))
    )


_NODE = (
    "dim int, shard int, band int, node int, ids array<long>, vector array<double>, "
    "edges array<int>, beam int"
)


def index(
    rows: DataFrame, id_col: str, vector_col: str, shard_rows: int = SHARD_ROWS
) -> tuple[DataFrame, dict[int, int]]:
    """Graphs of all shards, a row for each node, written to the shared folder; and the number
    of shards for each length of vectors. Vectors of one length make shards of their own.
    """
    usable = prepared(rows, id_col, vector_col)
    counts = {r.dim: r["count"] for r in usable.groupBy("dim").count().collect()}
    shards = {dim: -(-n // shard_rows) for dim, n in counts.items()}
    placed = usable.withColumn("shard", _dealt(F.xxhash64("id"), shards))

    def build_shard(shard: pd.DataFrame) -> pd.DataFrame:
        out = build(shard["id"].to_numpy(), np.stack(shard["vector"].to_list()))
        out.insert(0, "shard", shard["shard"].iloc[0])
        out.insert(0, "dim", shard["dim"].iloc[0])
        return out

    return written(placed.groupBy("dim", "shard").applyInPandas(build_shard, _NODE), "ann"), shards


def _dealt(hash_: Column, parts: dict[int, int]) -> Column:
    """A number below that of the row's length of vectors."""
    return F.pmod(hash_, _parts(parts)).cast("int")


def _parts(parts: dict[int, int]) -> Column:
    if not parts:
        return F.lit(1)
    pairs = [x for dim, n in parts.items() for x in (F.lit(dim), F.lit(n))]
    return F.try_element_at(F.create_map(*pairs), F.col("dim"))


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k rows of the largest inner
    product found, ranks from 1, ties to the smaller id; all if there are fewer. A row with the
    query's own id is no candidate.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
    without an id; only vectors of the query's length are its candidates. A repeated id counts
    once, with the smallest of its vectors. Equal vectors are one node, however many rows hold
    them, and come back as their ids. Both sides go to (shard, block of queries) groups, each
    bounded by the two sizes.
    """
    nodes, shards = index(rows, id_col, vector_col, shard_rows)
    asked = (
        prepared(queries, id_col, vector_col)
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("dim", F.size("vector"))
    )
    counts = {r.dim: r["count"] for r in asked.groupBy("dim").count().collect()}
    blocks = {dim: -(-n // query_rows) for dim, n in counts.items() if dim in shards}

    def each(parts: dict[int, int], name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), _parts(parts) - 1)).alias(name)

    known = F.col("dim").isin(list(blocks))
    left = nodes.filter(known).select("*", each(blocks, "block"))
    right = (
        asked.filter(known)
        .withColumn("block", _dealt(F.xxhash64("id"), blocks))
        .select("*", each({d: shards[d] for d in blocks}, "shard"))
    )
    wide = max(beam, 2 * k)

    def search(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _search_block(nodes, asked, k, wide)

    key = ["dim", "shard", "block"]
    found = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score")
    return ranked.filter(F.col("rank") <= k)


def _search_block(nodes: pd.DataFrame, asked: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    if not len(nodes) or not len(asked):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    own = asked["id"].tolist()
    queries = np.stack(asked["vector"].to_list())
    units, query_logs = _lengths(queries)
    asks = np.column_stack([units, np.zeros(len(units))])
    best: list[list[tuple[float, int]]] = [[] for _ in own]
    for _, band in nodes.groupby("band"):
        band = band.sort_values("node", ignore_index=True)
        vectors = np.stack(band["vector"].to_list())
        ids = [np.asarray(x) for x in band["ids"]]
        band_units, logs = _lengths(vectors)
        # No product here is above that of the lengths, but for its rounding.
        bound = np.exp2(np.minimum(query_logs + logs.max(), 1023)) * (1 + 1e-9)
        open_ = [i for i, b in enumerate(best) if len(b) < k or bound[i] >= b[-1][0]]
        if not open_:
            continue
        edges = np.full((len(band) + 1, max(1, max(map(len, band["edges"])))), -1, np.int32)
        for i, out in enumerate(band["edges"]):
            edges[i, : len(out)] = out
        graph = Graph(_level(band_units, logs), edges)
        found, _ = graph.search(asks[open_], max(beam, int(band["beam"].iloc[0])))
        for i, near in zip(open_, found, strict=True):
            near = near[near >= 0]
            scores = (vectors[near] * queries[i]).sum(axis=1)
            for at in np.argsort(-scores, kind="stable").tolist():
                score = float(scores[at])
                if len(best[i]) >= k and score < best[i][-1][0]:
                    break
                mine = [int(x) for x in ids[near[at]][: k + 1].tolist() if x != own[i]]
                every = best[i] + [(score, x) for x in mine]
                best[i] = sorted(every, key=lambda b: (-b[0], b[1]))[:k]
    rows = [(q, x, score) for q, b in zip(own, best, strict=True) for score, x in b]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])
