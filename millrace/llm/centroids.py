"""Centroid clustering of embeddings in integers, by partial-distance search.

Components become integers, so distances, sums and floors are exact and no order
of addition matters. A vector's distances grow dimension block by dimension
block, those of the largest variance first; a centroid is abandoned once its part
is strictly above the best whole distance so far, so ties are always decided on
all dimensions. What moves between tasks is sums by cluster, never vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, materialize

#: Components of a vector, centroids, rounds, and the factor that components are multiplied with.
DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Dimensions added to a partial distance between two looks at the best one.
BLOCK = 8
#: Integers beyond this are taken as this, so that no distance leaves a long.
LIMIT = 1 << 26
LONGEST = (1 << 63) - 1


def quantized(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v (integers) of the rows that have exactly 64 finite components."""
    x, wrong = F.col(f"`{vec_col}`"), lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    kept = df.select(F.col(f"`{id_col}`").alias("vec_id"), x.cast("array<double>").alias("x"))
    kept = kept.filter((F.size("x") == DIMENSIONS) & ~F.exists("x", wrong))
    whole = lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    return kept.select("vec_id", F.transform("x", whole).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(np.int64)


def nearest(v: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, component differences computed); of ties the smaller number."""
    v, centroids = np.ascontiguousarray(v[:, order]), np.ascontiguousarray(centroids[:, order])
    rows, blocks = np.arange(len(v)), range(BLOCK, v.shape[1], BLOCK)
    head = ((v[:, None, :BLOCK] - centroids[None, :, :BLOCK]) ** 2).sum(axis=2)
    cluster = head.argmin(axis=1)  # a first guess, taken to the end
    best = head[rows, cluster] + ((v[:, BLOCK:] - centroids[cluster, BLOCK:]) ** 2).sum(axis=1)
    work, guess = head.size * BLOCK + v[:, BLOCK:].size, cluster.copy()
    for c in range(len(centroids)):
        alive = np.flatnonzero((head[:, c] <= best) & (guess != c))
        part = head[alive, c]
        for lo in blocks:
            part = part + ((v[alive, lo : lo + BLOCK] - centroids[c, lo : lo + BLOCK]) ** 2).sum(axis=1)
            work += len(alive) * BLOCK
            on = part <= best[alive]
            alive, part = alive[on], part[on]
        won = (part < best[alive]) | (c < cluster[alive])
        best[alive[won]], cluster[alive[won]] = part[won], c
    return cluster, best, work


def dimension_order(vecs: DataFrame) -> np.ndarray:
    """Dimensions by falling variance over all vectors; sums by task, 64 rows to the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0)).astype(float)
                n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(np.full(DIMENSIONS, n)), pa.array(s), pa.array(q)], ["d", "n", "s", "q"])

    got = vecs.select("v").mapInArrow(sums, "d int, n long, s double, q double").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    spread = {r.d: r.q / r.n - (r.s / r.n) ** 2 if r.n else 0.0 for r in got}
    return np.array(sorted(range(DIMENSIONS), key=lambda d: (-spread.get(d, 0.0), d)))


def first_centroids(vecs: DataFrame) -> np.ndarray:
    """The vectors of the least sha256 of ``1:<vec_id>``, at most 16; of equal ids the one of the least components first."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.v for r in vecs.select(key.alias("h"), "v").orderBy("h", "v").limit(CENTROIDS).collect()], np.int64).reshape(-1, DIMENSIONS)


def moved(vecs: DataFrame, centroids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The floors of the means of every centroid's vectors; a centroid without any stays."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(0))
                cluster, _, _ = nearest(v, centroids, order)
                n += np.bincount(cluster, minlength=len(n))
                np.add.at(s, cluster, v)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(s[some].tolist(), pa.list_(pa.int64()))], ["c", "n", "s"])

    parts = vecs.select("v").mapInArrow(sums, "c int, n long, s array<long>").select("c", "n", F.posexplode("s").alias("d", "x"))
    out = centroids.copy()
    for r in parts.groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():  # 16 * 64 rows at most
        out[r.c, r.d] = int(r.x) // r.n
    return out


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept row.

    Rows whose vector is null, has not exactly 64 components or has a null,
    NaN or infinite one are not kept; without kept rows there is no result row. A null
    id counts as an empty one where ids are hashed. Rows stated twice are two
    vectors, also as first centroids; fewer than 16 kept rows start as many
    centroids. Integers are held within 2**26 (components within 2**20), and sums of
    distances beyond a long are given as its largest value. Other columns may
    have any names.
    """
    vecs = materialize(quantized(df, id_col, vec_col), "vectors")
    order, centroids = dimension_order(vecs), first_centroids(vecs)
    for _ in range(ROUNDS if len(centroids) else 0):
        centroids = moved(vecs, centroids, order)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = nearest(matrix(batch.column(1)), centroids, order)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    kind = vecs.schema["vec_id"].dataType.simpleString()
    found = materialize(vecs.select("vec_id", "v").mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned")
    discard(vecs)
    own = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # 16 rows at most
    total, held = sum(int(r.own) for r in own), lambda x: min(int(x), LONGEST)
    rows = [(r.cluster, held(r.own), held(total), hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in own]
    facts = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
