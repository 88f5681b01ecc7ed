"""Nearest neighbours by navigable small-world graphs, one for each shard."""

from __future__ import annotations

import heapq
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.storage import stored

#: Distinct vectors in a shard (one task builds its graph), queries that meet a shard
#: together, links of a node on each layer (twice as many on the lowest), and the
#: breadth of the search while building and while searching.
SHARD_ROWS = 6_000
BLOCK_QUERIES = 2_000
#: Most partitions of the search; beyond, a partition has several shards and blocks.
SEARCH_PARTS = 20_000
LINKS = 16
BUILD_BREADTH = 40
SEARCH_BREADTH = 160
NEAREST = 10


class Graph:
    """A hierarchy of layers; ``links[layer]`` is a flat array, one row of neighbour
    numbers for each node, filled up with -1."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.seen = np.zeros(len(vectors), "int32")
        self.turn = 0

    def distances(self, query: np.ndarray, nodes) -> np.ndarray:
        """Squared, less the query's own part."""
        return self.norms[nodes] - 2 * (self.vectors[nodes] @ query)

    def layer(self, query, entries: list[tuple[float, int]], breadth: int, links) -> list:
        """The ``breadth`` nearest nodes that a best-first walk meets, nearest first."""
        self.turn += 1
        seen, turn = self.seen, self.turn
        for _, node in entries:
            seen[node] = turn
        ahead = list(entries)
        heapq.heapify(ahead)
        best = [(-d, node) for d, node in entries]
        heapq.heapify(best)
        while ahead:
            d, node = heapq.heappop(ahead)
            if d > -best[0][0] and len(best) >= breadth:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            far = self.distances(query, near)
            if len(best) >= breadth:
                closer = far < -best[0][0]
                near, far = near[closer], far[closer]
            for e, other in zip(far.tolist(), near.tolist(), strict=True):
                if len(best) < breadth:
                    heapq.heappush(best, (-e, other))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, other))
                else:
                    continue
                heapq.heappush(ahead, (e, other))
        return sorted((-d, node) for d, node in best)

    def search(self, query: np.ndarray, breadth: int) -> list[int]:
        at = [(float(self.distances(query, [self.entry])[0]), self.entry)]
        for links in self.links[:0:-1]:
            at = self.layer(query, at[:1], 1, links)
        return [node for _, node in self.layer(query, at[:1], breadth, self.links[0])]


def _spread(graph: Graph, found: list[tuple[float, int]], most: int, own: float) -> list[int]:
    """Up to ``most`` of the nodes, nearest first, each nearer to the centre than to those
    chosen before; room left is filled with the nearest others.  ``own`` is the square of
    the centre's norm."""
    nodes = np.array([n for _, n in found])
    if len(nodes) <= most:
        return nodes.tolist()
    far = np.array([d for d, _ in found]) + own
    vectors, norms = graph.vectors[nodes], graph.norms[nodes]
    apart = norms[None, :] + norms[:, None] - 2 * (vectors @ vectors.T)
    blocked, chosen = np.zeros(len(nodes), bool), []
    for k in range(len(nodes)):
        if not blocked[k]:
            chosen.append(k)
            if len(chosen) == most:
                break
            blocked |= apart[k] < far
    for k in range(len(nodes)):
        if len(chosen) == most:
            break
        if blocked[k] and k not in chosen:
            chosen.append(k)
    return nodes[chosen].tolist()


def build(vectors: np.ndarray, links: int = LINKS, breadth: int = BUILD_BREADTH) -> Graph:
    """Nodes are inserted one by one, each linked to a spread choice of those near it."""
    n = len(vectors)
    random = np.random.default_rng(11)
    top = np.minimum((-np.log(1 - random.random(n)) / log(links)).astype(int), 12)
    graph = Graph(vectors, [], 0)
    room = [2 * links] + [links] * int(top.max(initial=0))
    graph.links = [np.full((n, r), -1, "int32") for r in room]
    norms = graph.norms
    highest = int(top[0]) if n else 0
    for node in range(1, n):
        query = vectors[node]
        at = [(float(graph.distances(query, [graph.entry])[0]), graph.entry)]
        for level in range(highest, int(top[node]), -1):
            at = graph.layer(query, at[:1], 1, graph.links[level])
        for level in range(min(highest, int(top[node])), -1, -1):
            layer = graph.links[level]
            at = graph.layer(query, at, breadth, layer)
            chosen = _spread(graph, at, links, norms[node])
            layer[node, : len(chosen)] = chosen
            for other in chosen:
                row = layer[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                    continue
                around = np.append(row, node)
                far = graph.distances(vectors[other], around)
                order = np.argsort(far, kind="stable")
                found = list(zip(far[order].tolist(), around[order].tolist(), strict=True))
                row[:] = -1
                kept = _spread(graph, found, room[level], norms[other])
                row[: len(kept)] = kept
        if top[node] > highest:
            highest, graph.entry = int(top[node]), node
    return graph


def _usable(embeddings: DataFrame) -> DataFrame:
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return embeddings.select("vec_id", F.col("embedding").cast("array<float>")).where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0)
    )


def build_index(embeddings: DataFrame, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS):
    """Graphs over all distinct vectors: one row for each dimension and shard.

    Equal vectors are one node.  It keeps the ``nearest + 1`` smallest of their ids: all
    of them are equally near to anything, so no others can be among the nearest.
    """
    own = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = stored(
        _usable(embeddings)
        .distinct()
        .select("*", F.row_number().over(own).alias("k"))
        .where(F.col("k") <= nearest + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(
        "embedding",
        "ids",
        F.size("embedding").alias("dim"),
        F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard"),
    )

    def made(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows["embedding"].to_list()).astype("float32")
        order = np.lexsort(vectors.T[::-1])
        vectors = np.ascontiguousarray(vectors[order])
        ids = np.full((len(rows), nearest + 1), -1, "int64")
        held = np.zeros((len(rows), nearest + 1), bool)
        for k, own_ids in enumerate(rows["ids"].iloc[order]):
            ids[k, : len(own_ids)], held[k, : len(own_ids)] = own_ids, True
        graph = build(vectors)
        return pd.DataFrame(
            {
                "dim": [rows["dim"].iloc[0]],
                "shard": [rows["shard"].iloc[0]],
                "entry": [graph.entry],
                "vectors": [vectors.tobytes()],
                "ids": [ids.tobytes()],
                "held": [held.tobytes()],
                "layers": [[x.tobytes() for x in graph.links]],
            }
        )

    schema = "dim int, shard int, entry int, vectors binary, ids binary, held binary"
    return stored(
        # By range: a hash would put several shards into one task, and leave others idle.
        dealt.repartitionByRange(shards, "dim", "shard")
        .groupBy("dim", "shard")
        .applyInPandas(made, schema + ", layers array<binary>")
    )


def search(index: DataFrame, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """The nearest of all shards: query_id, rank, vec_id, score.

    ``queries`` has vec_id and embedding.  Queries go in blocks to every shard of their
    dimension; each block and shard is a task's work, and their results are merged.
    """
    asked = queries.dropDuplicates(["vec_id"])
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    grouped = (
        asked.select(
            "vec_id",
            "embedding",
            F.size("embedding").alias("dim"),
            F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        )
        .groupBy("dim", "block")
        .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("asked"))
    )

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in rows.itertuples():
            vectors = np.frombuffer(row.vectors, "float32").reshape(-1, row.dim)
            n = len(vectors)
            links = [np.frombuffer(x, "int32").reshape(n, -1) for x in row.layers]
            ids = np.frombuffer(row.ids, "int64").reshape(n, -1)
            held = np.frombuffer(row.held, bool).reshape(n, -1)
            graph = Graph(vectors, links, row.entry)
            for one in row.asked:
                query_id, query = one["vec_id"], np.array(one["embedding"], "float32")
                nodes = np.array(graph.search(query, SEARCH_BREADTH))
                exact = vectors[nodes].astype(float) - query.astype(float)
                score = np.sqrt((exact**2).sum(1))
                counts = held[nodes].sum(1)
                own, far = ids[nodes][held[nodes]], np.repeat(score, counts)
                other = own != query_id
                own, far = own[other], far[other]
                first = np.lexsort((own, far))[:nearest]
                out += zip([query_id] * len(first), own[first].tolist(), far[first].tolist())
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    # A number of its own: a shard is small in bytes but long in work, so partitions that
    # are merged by size would leave one task all of it.  Four to a shard and block, as a
    # hash puts few of them together then.
    parts = min(max(1, 4 * blocks * index.count()), SEARCH_PARTS)
    return (
        index.join(grouped, "dim")
        .repartition(parts, "dim", "shard", "block")
        .groupBy("dim", "shard", "block")
        .applyInPandas(found, "query_id long, vec_id long, score double")
        .withColumn("rank", rank)
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_neighbours(
    embeddings: DataFrame, nearest: int = NEAREST, every: int = 100, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """For each vector whose id is divisible by ``every``: its nearest among all others.

    Distance is Euclidean, in double precision on the original vectors; ties go to the
    smaller id.  Columns: query_id, rank (from 1), vec_id, score.

    Vectors that are null, zero or hold nulls or non-finite numbers take no part, nor do
    null ids.  Vectors meet those of the same length only.  Repeated rows count once;
    vectors that share an id never find each other, and as queries one of them stands
    for all.  Other columns are ignored; without vectors the result is empty.
    """
    index = build_index(embeddings, nearest, shard_rows)
    return search(index, _usable(embeddings).where(F.col("vec_id") % every == 0), nearest)
