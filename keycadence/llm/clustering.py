"""Exact Lloyd clustering with bounds by the norm of a centroid's total displacement.

Every vector remembers, for each centroid, the distance when it was last computed
and in which round that was. The centroids of all rounds are kept. A stored distance
is loosened by how far the centroid is now from where it was in that round, which is
never more than the sum of its steps since (a centroid that moves back and forth
costs nothing). Only where the loosened bounds leave another centroid possible, the
distances are computed anew, first to the own centroid, then to those still in
reach. Bounds are widened by more than their rounding, and vectors have whole
components: what is computed is exact, so the assignment is the one of plain Lloyd.

The state is one table, written anew in each round below the shared folder, and the
last one is deleted. Tasks add up their vectors by cluster, so that ``k`` rows a task
are shuffled; the driver sees ``k`` centroids and nothing else. No row meets others of
its cluster, whatever the size of one.

Cases: vectors that are null, of another length, or hold a null or non-finite
component take no part. Components beyond ``2^21`` in size count as that, so that
distances fit 64 bits; sums beyond 64 bits stop at the largest number. Rows of one id
are vectors of their own; a null id starts no cluster unless too few others are
there, and ties are in order of the components. With fewer vectors than ``k`` there
are as many clusters. Without vectors there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, materialize

SCALE = 64
MOST = 1 << 27
#: Relative slack of the bounds; stored distances are rounded to 24 bits.
SLACK = 1e-6
LARGEST = (1 << 63) - 1
STATE = "vec_id long, v array<int>, cluster int, far array<float>, seen array<tinyint>"
FOUND = "vec_id long, cluster int, distance long"


def whole_vectors(rows: DataFrame, size: int, column: str = "embedding") -> DataFrame:
    """``vec_id, v``: the vectors that take part, with whole components."""
    v = F.col(column)
    real = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    limit = F.lit(float(MOST))
    whole = F.transform(
        v,
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, limit), -limit)).cast("int"),
    )
    return rows.filter((F.size(v) == size) & real).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(F.asc_nulls_last(mark), "v").limit(k).collect()
    return np.array([r.v for r in chosen], np.int64)


def _apart(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors."""
    gap = rows - centroid
    return np.einsum("ij,ij->i", gap, gap)


def nearest(
    rows: np.ndarray, own: np.ndarray, far: np.ndarray, seen: np.ndarray, history: np.ndarray
) -> tuple[np.ndarray, int]:
    """Nearest centroid of each row by the last of ``history``; updates ``far`` and ``seen``.

    Also returns how many distances were computed.
    """
    now, centroids = len(history) - 1, history[-1]
    numbers = np.arange(len(centroids))
    moved = np.sqrt(((centroids - history).astype(float) ** 2).sum(2))[seen, numbers]
    every = np.arange(len(rows))
    loose = (far + moved) * (1 + SLACK) + SLACK
    tight = (far - moved) - (far + moved) * SLACK - SLACK
    tight[every, own] = np.inf
    work = np.flatnonzero((tight <= loose[every, own][:, None]).any(axis=1))
    found = own.copy()
    if not len(work):
        return found, 0
    mine = own[work]
    best = _apart(rows[work], centroids[mine])
    far[work, mine], seen[work, mine] = np.sqrt(best), now
    reach = tight[work] <= (np.sqrt(best) * (1 + SLACK) + SLACK)[:, None]
    computed = len(work) + int(reach.sum())
    for j in numbers:
        at = np.flatnonzero(reach[:, j])
        if len(at):
            apart = _apart(rows[work[at]], centroids[j])
            far[work[at], j], seen[work[at], j] = np.sqrt(apart), now
            nearer = (apart < best[at]) | ((apart == best[at]) & (j < mine[at]))
            best[at[nearer]], mine[at[nearer]] = apart[nearer], j
    found[work] = mine
    return found, computed


def _matrix(values: pa.Array, width: int, kind: type) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _settled(batch: pa.RecordBatch, history: np.ndarray) -> tuple:
    """Rows, cluster and bounds of a batch of the state, by the last centroids."""
    k, size = history.shape[1:]
    rows = _matrix(batch.column("v"), size, np.int64)
    if "cluster" not in batch.schema.names:
        apart = np.stack([_apart(rows, c) for c in history[-1]], axis=1)
        far = np.sqrt(apart).astype(np.float32)
        return rows, apart.argmin(axis=1).astype(np.int32), far, np.zeros_like(far, np.int8)
    far, seen = _matrix(batch.column("far"), k, np.float32), _matrix(batch.column("seen"), k, np.int8)
    own = batch.column("cluster").to_numpy(zero_copy_only=False)
    return rows, nearest(rows, own, far, seen, history)[0], far, seen


def _assigned(state: DataFrame, history: np.ndarray) -> DataFrame:
    """The state after one more round of assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, own, far, seen = _settled(batch, history)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(own), _lists(far), _lists(seen)],
                ["vec_id", "v", "cluster", "far", "seen"],
            )

    return state.mapInArrow(run, STATE)


def _final(state: DataFrame, history: np.ndarray) -> DataFrame:
    """Clusters and exact squared distances, after the last round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own, _, _ = _settled(batch, history)
            apart = _apart(rows, history[-1][own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(own), pa.array(apart)],
                ["vec_id", "cluster", "distance"],
            )

    return state.mapInArrow(run, FOUND)


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids replaced by the floor of their vectors' exact means."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            rows = _matrix(batch.column("v"), size, np.int64)
            own = batch.column("cluster").to_numpy(zero_copy_only=False)
            counts += np.bincount(own, minlength=k)
            for j in np.unique(own):
                totals[j] += rows[own == j].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, dtype=np.int32)), pa.array(counts), _lists(totals)],
            ["cluster", "n", "totals"],
        )

    parts = state.select("v", "cluster").mapInArrow(run, "cluster int, n long, totals array<long>")
    exact = parts.select("cluster", "n", F.posexplode("totals").alias("place", "total"))
    sums = exact.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    after = centroids.copy()
    for row in sums.filter("n > 0").collect():
        after[row.cluster, row.place] = int(row.total) // row.n
    return after


def centroid_clusters(
    rows: DataFrame, k: int = 16, size: int = 64, rounds: int = 3, seed: int = 1
) -> DataFrame:
    """Cluster and squared distance of every vector after ``rounds`` rounds of Lloyd.

    ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.
    """
    spark = rows.sparkSession
    state = materialize(whole_vectors(rows, size), "vectors")
    centroids = first_centroids(state, k, seed)
    if not len(centroids):
        empty = f"{FOUND}, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    history = centroids[None]
    for _ in range(rounds):
        before, state = state, materialize(_assigned(state, history), "clusters")
        discard(before)
        history = np.concatenate([history, _moved(state, history[-1])[None]])
    before, found = state, materialize(_final(state, history), "clusters")
    discard(before)
    spread = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    inertia = {r.cluster: int(r.d) for r in spread.collect()}
    whole = min(sum(inertia.values()), LARGEST)
    about = [
        (
            j,
            min(inertia.get(j, 0), LARGEST),
            whole,
            hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest(),
        )
        for j, c in enumerate(history[-1])
    ]
    about = spark.createDataFrame(
        about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(about), "cluster").select(*found.columns, *about.columns[1:])
