"""Nearest neighbours by largest inner product over robust-pruned graphs.

Vectors are dealt by a hash of their id into shards of about ``SHARD_ROWS``. In
each shard a directed graph is built: a node's neighbours are proposed by greedy
searches from the entry, and relaxed distance pruning keeps a neighbour only if
no kept one is ``ALPHA`` times closer to it than the node is, which leaves diverse
edges. A query runs a beam search in each shard; the shards' answers are merged
by the exact score. Queries go to shards in blocks of ``BLOCK_ROWS``, so a task
holds one shard's graph and one block.

Inner products are turned into distances by one more coordinate that lifts every
vector of a shard to the same norm; queries have 0 there. Equal vectors are one
node with a list of ids. Shards of no more nodes than the beam are searched whole.

Cases: vectors that are null, empty, zero, or hold null, NaN or infinite parts
take no part. Vectors are compared with those of the same length only. Repeated
ids are candidates each; a query never finds its own id. An empty table gives no
rows. Extra columns take no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize, parts_for

SHARD_ROWS = 8192
BLOCK_ROWS = 4096
DEGREE = 32
WIDEST = 48
ALPHA = 1.2
BUILD_BEAM = 64
BEAM = 128
BATCH = 128


class Graph:
    """Distinct vectors of a shard, lifted to one norm, with their edges."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None):
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        lift = np.sqrt(np.maximum(squares.max() - squares, 0))
        self.points = np.column_stack([vectors, lift]).astype(np.float32)
        self.norms = (self.points**2).sum(axis=1)
        mean = self.points.mean(axis=0)
        self.entry = int((self.norms - 2 * self.points @ mean).argmin())
        n = len(vectors)
        if edges is None:
            self.edges = np.full((n, WIDEST), -1, np.int32)
            self.degree = np.zeros(n, np.int64)
            self._build()
        else:
            self.edges = edges

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, list]:
        """Beams of node ids and distances, and the nodes expanded on the way.

        All queries of a batch take a step at a time: each expands its nearest
        unexpanded node.
        """
        q = len(queries)
        ids = np.full((q, beam), -1, np.int64)
        far = np.full((q, beam), np.inf, np.float32)
        done = np.zeros((q, beam), bool)
        seen = np.zeros((q, len(self.points)), bool)
        ids[:, 0] = self.entry
        far[:, 0] = self.norms[self.entry] - 2 * queries @ self.points[self.entry]
        seen[:, self.entry] = True
        path = []
        while True:
            open_far = np.where(done, np.inf, far)
            pick = open_far.argmin(axis=1)
            rows = np.flatnonzero(np.isfinite(open_far[np.arange(q), pick]))
            if not len(rows):
                return ids, far, path
            pick = pick[rows]
            nodes = ids[rows, pick]
            done[rows, pick] = True
            path.append((rows, nodes, far[rows, pick]))
            near = self.edges[nodes]
            column = rows[:, None]
            fresh = (near >= 0) & ~seen[column, near]
            seen[np.broadcast_to(column, near.shape)[fresh], near[fresh]] = True
            dots = np.einsum("rkd,rd->rk", self.points[near], queries[rows])
            gaps = np.where(fresh, self.norms[near] - 2 * dots, np.inf)
            all_far = np.concatenate([far[rows], gaps], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            take = np.arange(len(rows))[:, None]
            far[rows] = all_far[take, best]
            ids[rows] = np.concatenate([ids[rows], near], axis=1)[take, best]
            done[rows] = np.concatenate([done[rows], np.zeros(near.shape, bool)], axis=1)[take, best]

    def _pruned(self, node: int, found: np.ndarray) -> np.ndarray:
        """Diverse neighbours of ``node`` among ``found``."""
        found = np.unique(found[(found >= 0) & (found != node)])
        points, norms = self.points[found], self.norms[found]
        own = np.maximum(norms + self.norms[node] - 2 * points @ self.points[node], 0)
        order = np.argsort(own, kind="stable")
        found, points, norms, own = found[order], points[order], norms[order], own[order]
        between = (norms[:, None] + norms[None, :] - 2 * points @ points.T) * ALPHA**2
        alive, kept = np.ones(len(found), bool), []
        while len(kept) < DEGREE and alive.any():
            k = int(alive.argmax())
            kept.append(k)
            alive &= between[k] > own
            alive[k] = False
        return found[kept]

    def _connect(self, node: int, found: np.ndarray) -> None:
        kept = self._pruned(node, found)
        self.edges[node] = -1
        self.edges[node, : len(kept)] = kept
        self.degree[node] = len(kept)
        for other in kept:
            if node in self.edges[other, : self.degree[other]]:
                continue
            if self.degree[other] == WIDEST:
                shorter = self._pruned(other, np.append(self.edges[other], node))
                self.edges[other] = -1
                self.edges[other, : len(shorter)] = shorter
                self.degree[other] = len(shorter)
            else:
                self.edges[other, self.degree[other]] = node
                self.degree[other] += 1

    def _build(self) -> None:
        n = len(self.points)
        order = np.random.default_rng(7).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]])
        at = min(n, BATCH)
        for node in order[:at]:
            self._connect(int(node), order[:at])
        while at < n:
            batch = order[at : at + BATCH]
            ids, _, path = self.search(self.points[batch], BUILD_BEAM)
            proposed = [[row] for row in ids]
            for rows, nodes, _ in path:
                for row, node in zip(rows, nodes):
                    proposed[row].append(node)
            for row, node in enumerate(batch):
                self._connect(int(node), np.hstack([*proposed[row], batch[:row][-8:]]))
            at += len(batch)


def valid(vector: str) -> Column:
    """True for vectors that take part."""
    parts = F.col(vector).cast("array<double>")
    usable = F.forall(
        parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(usable & F.exists(parts, lambda x: x != 0), F.lit(False))


def index(vectors: DataFrame) -> DataFrame:
    """``dim, shard, ids, vectors, edges``: packed arrays, a row for each shard."""
    shards = parts_for(vectors, SHARD_ROWS)

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        whole = np.array(rows["vector"].tolist(), np.float64)
        points, place = np.unique(whole, axis=0, return_inverse=True)
        graph = Graph(points) if len(points) > BEAM else None
        return pd.DataFrame({
            "dim": [key[0]],
            "shard": [key[1]],
            "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
            "place": [place.astype(np.int32).ravel().tobytes()],
            "vectors": [points.tobytes()],
            "edges": [graph.edges.tobytes() if graph else b""],
        })

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return materialize(
        dealt.groupBy("dim", "shard").applyInPandas(
            build,
            "dim int, shard int, ids binary, place binary, vectors binary, edges binary",
        ),
        "vector-index",
    )


def _answers(shard: pd.Series, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best of one shard for each query of a block."""
    ids = np.frombuffer(shard["ids"], np.int64)
    place = np.frombuffer(shard["place"], np.int32)
    points = np.frombuffer(shard["vectors"]).reshape(-1, int(shard["dim"]))
    order = np.argsort(place, kind="stable")  # ids of a node follow each other, smallest first
    starts = np.searchsorted(place[order], np.arange(len(points) + 1))
    graph = None
    if shard["edges"]:
        graph = Graph(points, np.frombuffer(shard["edges"], np.int32).reshape(-1, WIDEST))
    wanted = np.array(queries["vector"].tolist(), np.float64)
    out = []
    for at in range(0, len(queries), BATCH):
        block = wanted[at : at + BATCH]
        if graph is None:
            nodes = np.broadcast_to(np.arange(len(points)), (len(block), len(points)))
        else:
            lifted = np.column_stack([block, np.zeros(len(block))]).astype(np.float32)
            nodes, _, _ = graph.search(lifted, max(BEAM, 2 * k))
        for row, query in enumerate(queries["vec_id"].iloc[at : at + BATCH]):
            found = nodes[row][nodes[row] >= 0]
            scores = (points[found] * block[row]).sum(axis=1)
            members = [order[starts[n] : min(starts[n] + k + 1, starts[n + 1])] for n in found]
            each = np.repeat(scores, [len(m) for m in members])
            names = ids[np.concatenate(members)]
            other = names != query
            names, each = names[other], each[other]
            best = np.lexsort((names, -each))[:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": names[best], "score": each[best]}))
    return pd.concat(out)


def search(indexed: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found over all shards."""
    blocks = parts_for(queries, BLOCK_ROWS)
    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    left = indexed.withColumn("block", F.explode(numbers))
    shards = indexed.select("dim", "shard")
    right = queries.withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    ).join(shards.groupBy("dim").agg(F.collect_list("shard").alias("shards")), "dim").select(
        "dim", F.explode("shards").alias("shard"), "block", "vec_id", "vector"
    )

    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _answers(shard.iloc[0], block, k)

    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        run, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")


def nearest(
    rows: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows to each query row, itself left out."""
    known = rows.filter(F.col(id_column).isNotNull() & valid(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.size(vector).alias("dim"),
        is_query.alias("__query"),
    )
    wanted = known.filter("__query").drop("__query")
    return search(index(known.drop("__query")), wanted, k)
