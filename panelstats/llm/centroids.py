"""Centroid clustering with equal-average equal-variance search.

Centroids are sorted by the sum of their components. A vector starts at the centroid whose mean is next to its own and goes
outward; with s a sum of k components and D = sqrt(k * sum(x^2) - s^2) k times the deviation's square root,

    k * |x - c|^2 >= (s_x - s_c)^2 + (D_x - D_c)^2,

so that the walk ends where the mean's term alone exceeds k times the best distance so far, and a centroid whose two terms
exceed it is passed by without a distance. What is left is compared by exact integer distances. The vectors of a batch
walk together; a step computes distances of those vectors alone that have not rejected its centroid.

A round is one pass: tasks add up counts and component sums of their own vectors, and one row a cluster comes to the driver.

Defined results: vectors that are null, have another length than ``dims``, or hold null or non-finite components take no
part; rows that share an id, and equal vectors, each count; rows without id take part, and as starting centroids their id
counts as the empty text; with fewer vectors than ``k`` there are as many centroids as vectors; distances that are equal go to the smaller number;
a centroid without vectors stays; an empty table gives an empty result; other columns of any name are left out. Components
of 2^26 and more after scaling raise an error, since distances might leave 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop, save, tidy

#: Largest component that keeps every distance and bound exact.
LIMIT = 1 << 26
#: Vectors that walk together.
BATCH = 8192


def quantise(vectors: DataFrame, dims: int = 64, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component of the vectors with ``dims`` finite ones."""
    x = F.transform(F.col(embedding), lambda e: e.cast("double"))
    sound = (F.size(x) == dims) & F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))))
    whole = lambda e: F.when(F.abs(e * scale) < F.lit(float(LIMIT)), F.floor(e * scale).cast("int")).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("int"))
    return vectors.filter(F.coalesce(sound, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, whole).alias("v"))


def starts(rows: DataFrame, k: int = 16, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, in that order; equal ids by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in rows.orderBy(key, "v").limit(k).select("v").collect()], np.int64)


def _spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of components, and the roots of k * sum(x^2) - sum^2."""
    s = x.sum(1)
    return s, np.sqrt(np.maximum(x.shape[1] * (x.astype(float) ** 2).sum(1) - s.astype(float) ** 2, 0))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row and its squared distance; and how many distances were computed."""
    dims = x.shape[1]
    own, other = _spread(x), _spread(centroids)
    ranked = np.lexsort((np.arange(len(centroids)), other[0]))
    means, spreads = other[0][ranked], other[1][ranked]
    best, chosen = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), -1)
    left = np.searchsorted(means, own[0]) - 1  # the walk's next centroid below and above
    right = left + 1
    walking, computed = np.arange(len(x)), 0
    while len(walking):
        below, above = left[walking], right[walking]
        down = np.where(below >= 0, np.abs(own[0][walking] - means[np.maximum(below, 0)]), np.iinfo(np.int64).max)
        up = np.where(above < len(means), np.abs(means[np.minimum(above, len(means) - 1)] - own[0][walking]), np.iinfo(np.int64).max)
        go_down = down <= up
        gap, at = np.minimum(down, up), np.where(go_down, below, above)
        # Floats have room to err: a bound counts when it is above by more than a millionth.
        room = np.where(chosen[walking] < 0, np.inf, dims * best[walking].astype(float) * (1 + 1e-6) + 1)
        on = (gap < np.iinfo(np.int64).max) & (gap.astype(float) ** 2 <= room)  # else all further means are further still
        walking, at, gap, room, go_down = walking[on], at[on], gap[on].astype(float), room[on], go_down[on]
        left[walking[go_down]] -= 1
        right[walking[~go_down]] += 1
        near = gap**2 + (own[1][walking] - spreads[at]) ** 2 <= room
        rows, number = walking[near], ranked[at[near]]
        distance = ((x[rows] - centroids[number]) ** 2).sum(1)
        computed += len(rows)
        better = (distance < best[rows]) | (distance == best[rows]) & (number < chosen[rows])
        best[rows[better]], chosen[rows[better]] = distance[better], number[better]
    return chosen, best, computed


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    v = batch.column(batch.schema.get_field_index("v"))
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), -1)


def _blocks(batches):
    for batch in batches:
        for i in range(0, len(batch), BATCH):
            yield batch.slice(i, BATCH)


def update(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid becomes the floored mean of its vectors."""
    k, dims = centroids.shape

    @tidy
    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in _blocks(batches):
            x = _matrix(batch)
            cluster = nearest(x, centroids)[0]
            counts += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, x)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = rows.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)])
    out = centroids.copy()
    for r in added.collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return out


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    @tidy
    def run(batches):
        for batch in _blocks(batches):
            cluster, distance, _ = nearest(_matrix(batch), centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dims: int = 64, scale: int = 64) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, cluster_inertia, inertia) of every vector of (vec_id, embedding), and the centroids."""
    spark = vectors.sparkSession
    rows, path = save(quantise(vectors, dims, scale), "vectors")
    centroids = starts(rows, k, seed)
    if not len(centroids):
        return rows.selectExpr("vec_id", "0 AS cluster", *[f"0L AS {c}" for c in ("distance", "cluster_inertia", "inertia")]), centroids
    for _ in range(rounds):
        centroids = update(rows, centroids)
    assigned, _ = save(assign(rows, centroids), "assigned")
    drop(spark, path)
    total = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    of_cluster = F.create_map(*[F.lit(x) for r in total for x in (r["cluster"], r["cluster_inertia"])])
    return assigned.withColumn("cluster_inertia", of_cluster[F.col("cluster")]).withColumn("inertia", F.lit(sum(r["cluster_inertia"] for r in total)).cast("long")), centroids


def digest(centroid: np.ndarray) -> str:
    """Lower-case hex sha256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
