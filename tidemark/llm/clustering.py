"""Centroid clustering by bit planes: exact distances from AND and popcount.

A vector's 64 components become integers, floor(scale * x), in two's complement of `PLANES` bits. Plane b of a vector is one
64-bit number: bit b of each component. The dot product of two vectors is the sum over planes i and j of
weight(i) * weight(j) * popcount(a_i AND b_j), weights being 2^i, and -2^i for the sign's plane; with it squared distances are
exact integers. As many planes are kept as the largest component of the table needs, so a unit vector takes 10 numbers
in place of 64.

Planes are packed once and written. A round reads them, gives each vector the nearest centroid, and adds up, in
the task, one row for each cluster: its count and the sums of its components, so what is exchanged and what
the driver gets (sums by cluster) depend on the number of clusters alone, and a vector that is a third of
the table spreads over tasks as any. New centroids are exact floors of sum / count, taken in whole numbers.

Cases. Vectors of another length, null ones, and those with a null or non-finite component are left out. A null
identifier is hashed as empty text. Repeated rows and identifiers are vectors of their own; where the hashes
that choose the first centroids tie, the smaller components go first. Fewer vectors than clusters: as many
centroids as vectors. Nearest ties go to the smaller number; empty clusters keep their centroid. Components of 2^27 or
more (as integers) would pass 64 bits as distances: the job fails and says so. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import load, saved

CLUSTERS, ROUNDS, SEED, SCALE = 40, 5, 2, 256
WIDTH, PLANES = 64, 28
#: Vectors compared with all centroids at once: what fits a core's cache.
BLOCK = 512


def weights(planes: int) -> np.ndarray:
    """The worth of a bit in each plane; the last one is the sign's."""
    return np.array([*(1 << b for b in range(planes - 1)), -(1 << (planes - 1))], np.int64)


def packed(values: np.ndarray, planes: int) -> np.ndarray:
    """Planes (one row each) of vectors of integers (one row each)."""
    out = np.empty((planes, len(values)), np.uint64)
    for b in range(planes):
        bits = ((values >> b) & 1).astype(np.uint8)
        out[b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The vectors of integers that the planes stand for."""
    out = np.zeros((planes.shape[1], WIDTH), np.int64)
    for plane, weight in zip(planes, weights(len(planes)), strict=True):
        out += weight * np.unpackbits(np.ascontiguousarray(plane).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return out


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of all vectors of `left` with all of `right`, both as planes."""
    worth = weights(len(left))
    pairs: dict[int, list[tuple[int, int]]] = {}
    for i in range(len(left)):
        for j in range(len(right)):
            pairs.setdefault(int(worth[i] * worth[j]), []).append((i, j))
    out = np.zeros((left.shape[1], right.shape[1]), np.int64)
    for weight, same in pairs.items():
        ones = np.zeros(out.shape, np.uint16)  # at most 64 for each pair of planes
        for i, j in same:
            ones += np.bitwise_count(left[i][:, None] & right[j][None, :])
        out += ones.astype(np.int64) * weight
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """The squared length of every vector."""
    worth, out = weights(len(planes)), np.zeros(planes.shape[1], np.int64)
    for i in range(len(planes)):
        for j in range(len(planes)):
            out += np.bitwise_count(planes[i] & planes[j]) * (worth[i] * worth[j])
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector, the first of equals, and its squared distance."""
    cluster, far = np.empty(planes.shape[1], np.int64), np.empty(planes.shape[1], np.int64)
    own = squares(centroids)
    for begin in range(0, planes.shape[1], BLOCK):
        part = planes[:, begin : begin + BLOCK]
        gap = squares(part)[:, None] + own[None, :] - 2 * dots(part, centroids)
        best = gap.argmin(axis=1)
        cluster[begin : begin + BLOCK], far[begin : begin + BLOCK] = best, gap[np.arange(len(best)), best]
    return cluster, far


def integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """vec_id and the integers x of the vectors that count."""
    whole = F.col("vector")
    scaled = F.transform(whole, lambda x: F.floor(x * F.lit(float(scale))))
    finite = lambda x: F.abs(x) < F.lit(float("inf"))
    large = lambda x: finite(x) & (F.abs(x * F.lit(float(scale))) >= (1 << (PLANES - 1)) - 1)
    return (
        vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
        .where((F.size(whole) == WIDTH) & F.coalesce(F.forall(whole, finite), F.lit(False)))
        .where(F.when(F.coalesce(F.exists(whole, large), F.lit(False)), F.raise_error(F.lit(
            f"a component is too large: floor({scale} * x) must lie within 2^{PLANES - 1}"
        ))).otherwise(True)).select("vec_id", scaled.alias("x"))
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The `clusters` vectors with the smallest SHA-256 of `<seed>:<vec_id>`, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(name.cast("binary"), 256), "x").limit(clusters).select("x").collect()
    return np.array([row.x for row in rows], np.int64).reshape(-1, WIDTH)


def as_planes(column: pa.Array, planes: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.ascontiguousarray(flat.reshape(-1, planes).T)


def updated(vectors: DataFrame, planes: int, centroids: np.ndarray) -> np.ndarray:
    """The centroids of the next round."""
    shared = packed(centroids, planes)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), WIDTH), np.int64)
        for batch in batches:
            here = as_planes(batch.column("planes"), planes)
            cluster, _ = nearest(here, shared)
            order = np.argsort(cluster, kind="stable")
            found, starts, sizes = np.unique(cluster[order], return_index=True, return_counts=True)
            counts[found] += sizes
            sums[found] += np.add.reduceat(unpacked(here)[order], starts, axis=0)
        full = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(full), pa.array(counts[full]), *(pa.array(np.ascontiguousarray(sums[full, k])) for k in range(WIDTH))],
            names=["cluster", "n", *(f"s{k}" for k in range(WIDTH))],
        )

    names = ["n", *(f"s{k}" for k in range(WIDTH))]
    parts = vectors.select("planes").mapInArrow(add_up, "cluster long, " + ", ".join(f"{name} long" for name in names))
    totals = parts.groupBy("cluster").agg(*[F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in names])
    after = centroids.copy()
    for row in totals.collect():  # one for each cluster
        after[row.cluster] = [int(row[f"s{k}"]) // int(row.n) for k in range(WIDTH)]
    return after


def clustered(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance (squared) of every vector that counts, and the centroids, as integers."""
    whole = integers(vectors, id_column, vector_column, scale)
    kind = whole.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(whole, clusters, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint"), centroids
    least, most = whole.select(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    planes = max(int(least).bit_length(), int(most).bit_length()) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            rows = np.ascontiguousarray(packed(values, planes).T).view(np.int64)
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * planes)
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "planes": pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))})

    rows = saved(whole.mapInArrow(pack, f"vec_id {kind}, planes array<bigint>"))
    for _ in range(rounds):
        centroids = updated(rows, planes, centroids)
    last = packed(centroids, planes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, far = nearest(as_planes(batch.column("planes"), planes), last)
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "cluster": pa.array(cluster.astype(np.int32)), "distance": pa.array(far)})

    return rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance bigint"), centroids


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    rows, centroids = clustered(load(spark, folder, "embeddings"))
    rows = saved(rows)
    inertia = {row.cluster: row.d for row in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids.tolist()]
    kinds = spark.createDataFrame(
        [(number, d, sum(inertia.values()), digests[number]) for number, d in sorted(inertia.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return rows.join(F.broadcast(kinds), "cluster").select(  # one row for each cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _round(number: int) -> str:
    """SQL of one round: who is nearest to the centroids c<number>, and the centroids that follow."""
    return f"""
near{number} AS (
  SELECT r, vec_id, min(d * {CLUSTERS} + cluster) AS best FROM (
    SELECT v.r, v.vec_id, c.cluster,
           list_sum(list_transform(range(1, 65), lambda k: (v.x[k] - c.x[k]) * (v.x[k] - c.x[k])))::HUGEINT AS d
    FROM v, c{number} AS c) GROUP BY r, vec_id),
sums{number} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM (
    SELECT (n.best % {CLUSTERS})::INTEGER AS cluster, k, sum(v.x[k])::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM near{number} n JOIN v USING (r), range(1, 65) t(k) GROUP BY 1, 2) GROUP BY cluster),
c{number + 1} AS (
  SELECT c.cluster, coalesce(s.x, c.x)::BIGINT[] AS x FROM c{number} c LEFT JOIN sums{number} s ON s.cluster = c.cluster),"""


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda e: floor(e::DOUBLE * {SCALE})::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
c0 AS (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS cluster, x
  FROM (SELECT sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {CLUSTERS})),
{"".join(_round(number) for number in range(ROUNDS))}
last AS (
  SELECT v.r, v.vec_id, min(list_sum(list_transform(range(1, 65), lambda k: (v.x[k] - c.x[k]) * (v.x[k] - c.x[k])))::HUGEINT * {CLUSTERS} + c.cluster) AS best
  FROM v, c{ROUNDS} c GROUP BY v.r, v.vec_id),
given AS (SELECT vec_id, (best % {CLUSTERS})::INTEGER AS cluster, (best // {CLUSTERS})::BIGINT AS distance FROM last)
SELECT g.vec_id, g.cluster, g.distance, (sum(g.distance) OVER (PARTITION BY g.cluster))::BIGINT AS cluster_inertia,
       (sum(g.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM given g JOIN c{ROUNDS} c ON c.cluster = g.cluster
"""

QUERIES = {"op12_clusters": op12_clusters}
ORACLE_SQL = {"op12_clusters": SQL}
