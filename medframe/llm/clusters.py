"""Centroid clustering of vectors with exact integers and incremental distances.

Vectors become integers, ``floor(scale * x)``. The squared distance of a vector to a
centroid is ``|x|^2 - 2 x.c + |c|^2``; each vector keeps its dot products with all
centroids. When a round moves the centroids, only the components in which a
centroid changed are multiplied, by the change, and added to the kept products;
then every vector takes the centroid with the smallest distance again (ties: the
smaller number). All numbers are integers, so the kept products stay exact and any
order of summation gives the same result.

*Spark.* Vectors are packed into blocks of bounded bytes: ids, integer components,
dot products. A round is one narrow pass over the blocks, written to the
shared folder with the new products, assignments and the sums of each cluster of
the block; the table before it is removed. New centroids come from the sums alone
(the other columns are not read), added in Spark: a number per cluster and
component reaches the driver, and goes back with the next round. No vector is
shuffled, so large clusters make no hot task, and a lost executor costs the blocks
it held.

Edge cases: vectors that are null, of another length than ``dim``, or hold a null or
non-finite component take no part. Rows are clustered one by one: repeated and null
ids stay, each with its own cluster. The first centroids are the vectors whose
``1:<id>`` has the smallest SHA-256; rows that share an id follow in order of their
vectors, rows without id come last. With fewer vectors than ``k`` there are fewer
centroids; with none the result is empty. A cluster without vectors keeps its
centroid. Integers beyond 2^27 in size are set to it (no 64-bit distance holds
them); sums that no 64-bit integer holds are given as the largest. Other columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import remove, store
from medframe.llm.blocks import matrices

BLOCK_BYTES = 1 << 20
LARGEST = 1 << 27
MAX_LONG = (1 << 63) - 1
BLOCK = ("ids binary, known binary, x binary, dots binary, counts array<long>, sums array<long>, "
         "inertia array<decimal(38,0)>")


def integers(m: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(scale * m), -LARGEST, LARGEST).astype(np.int32)


def _valid(vector_col: str, dim: int) -> F.Column:
    v = F.col(vector_col)
    return (F.size(v) == dim) & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def seeds(vectors: DataFrame, id_col: str, vector_col: str, k: int, dim: int, scale: int) -> np.ndarray:
    """The first centroids: at most ``k`` vectors, smallest hash of the id first."""
    rows = (vectors.where(_valid(vector_col, dim))
            .select(F.col(vector_col).cast("array<double>").alias("v"),
                    F.sha2(F.concat(F.lit("1:"), F.col(id_col).cast("string")), 256).alias("h"))
            .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect())
    return integers(np.array([r["v"] for r in rows], dtype=np.float64).reshape(-1, dim), scale).astype(np.int64)


def product(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``x @ c.T`` in exact integers; as doubles where these hold every sum."""
    bound = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(c).max(initial=0))
    if bound < 1 << 53:
        return (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return x.astype(np.int64) @ c.T


def update(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Kept products after the centroids moved by ``change``: only the nonzero
    components of each centroid's change are multiplied."""
    dots = dots.copy()
    for j in range(len(change)):
        moved = np.flatnonzero(change[j])
        if len(moved):
            dots[:, j] += product(x[:, moved], change[j:j + 1, moved])[:, 0]
    return dots


def assign(x: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector."""
    cost = (centroids * centroids).sum(axis=1) - 2 * dots
    cluster = cost.argmin(axis=1)  # the first of equal ones
    wide = x.astype(np.int64)
    return cluster, cost[np.arange(len(x)), cluster] + (wide * wide).sum(axis=1)


def _sum_exact(d: np.ndarray) -> int:
    return (int((d >> 32).sum()) << 32) + int((d & 0xFFFFFFFF).sum())


def _record(ids: bytes, known: bytes, x: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    cluster, distance = assign(x, dots, centroids)
    k, dim = centroids.shape
    counts, sums, inertia = np.bincount(cluster, minlength=k), np.zeros((k, dim), dtype=np.int64), []
    for j in range(k):
        mine = cluster == j
        sums[j] = x[mine].sum(axis=0, dtype=np.int64)
        inertia.append(_sum_exact(distance[mine]))
    return pa.record_batch([
        pa.array([ids], pa.binary()), pa.array([known], pa.binary()), pa.array([x.tobytes()], pa.binary()),
        pa.array([dots.tobytes()], pa.binary()), pa.array([counts.tolist()], pa.list_(pa.int64())),
        pa.array([sums.ravel().tolist()], pa.list_(pa.int64())),
        pa.array([inertia], pa.list_(pa.decimal128(38, 0)))],
        names=["ids", "known", "x", "dots", "counts", "sums", "inertia"])


def pack(vectors: DataFrame, id_col: str, vector_col: str, centroids: np.ndarray, scale: int) -> DataFrame:
    """Blocks of the valid vectors with their products; null ids are marked."""
    dim = centroids.shape[1]
    rows = max(1, BLOCK_BYTES // (4 * dim))

    def run(batches):
        held, count = [], 0

        def out():
            ids, known, x = (np.concatenate(c) for c in zip(*held))
            for i in range(0, len(ids), rows):
                cut = slice(i, i + rows)
                yield _record(ids[cut].tobytes(), known[cut].tobytes(), x[cut], product(x[cut], centroids), centroids)

        for batch in batches:
            known = np.asarray(batch.column(0).is_valid())
            ids = batch.column(0).fill_null(0)
            place = pa.array(np.arange(batch.num_rows))
            for at, m in matrices(pa.record_batch([place, batch.column(1)], names=["id", "v"]), "id", "v"):
                if m.shape[1] == dim:
                    held.append((ids.to_numpy(zero_copy_only=False)[at], known[at], integers(m, scale)))
                    count += len(at)
                    if count >= rows:
                        yield from out()
                        held, count = [], 0
        if held:
            yield from out()

    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    return slim.mapInArrow(run, BLOCK)


def _unpacked(batch: pa.RecordBatch, dim: int):
    columns = [batch.column(i).to_pylist() for i in range(4)]
    for ids, known, x, dots in zip(*columns):
        x = np.frombuffer(x, dtype=np.int32).reshape(-1, dim)
        yield ids, known, x, np.frombuffer(dots, dtype=np.int64).reshape(len(x), -1)


def move(blocks: DataFrame, centroids: np.ndarray, change: np.ndarray) -> DataFrame:
    """The blocks after the centroids moved by ``change`` to ``centroids``."""
    def run(batches):
        for batch in batches:
            for ids, known, x, dots in _unpacked(batch, centroids.shape[1]):
                yield _record(ids, known, x, update(dots, x, change), centroids)

    return blocks.mapInArrow(run, BLOCK)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floor of the mean of each cluster's vectors; empty ones stay."""
    def total(name):
        each = blocks.select(F.posexplode(name).alias("place", "value"))
        return {r["place"]: int(r["total"]) for r in each.groupBy("place").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()}

    counts, sums = total("counts"), total("sums")
    k, dim = centroids.shape
    out = centroids.copy()
    for j in range(k):
        if counts.get(j):
            out[j] = [sums[j * dim + d] // counts[j] for d in range(dim)]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, dim: int = 64,
            scale: int = 64, rounds: int = 3) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per valid
    vector, after ``rounds`` moves of the centroids and a last assignment."""
    spark = vectors.sparkSession
    ship.ensure(spark)
    centroids = seeds(vectors, id_col, vector_col, k, dim, scale)
    if not len(centroids):
        return spark.createDataFrame([], "id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    blocks, path = store(pack(vectors, id_col, vector_col, centroids, scale), "blocks")
    for _ in range(rounds):
        new = moved(blocks, centroids)
        change, centroids = new - centroids, new
        before = path
        blocks, path = store(move(blocks, centroids, change), "blocks")
        remove(spark, before)
    inertia = [0] * len(centroids)
    for r in (blocks.select(F.posexplode("inertia").alias("place", "value")).groupBy("place")
              .agg(F.sum("value").alias("total")).collect()):
        inertia[r["place"]] = int(r["total"])
    whole = min(sum(inertia), MAX_LONG)
    own = np.array([min(i, MAX_LONG) for i in inertia], dtype=np.int64)
    digests = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()])

    def run(batches):
        for batch in batches:
            for ids, known, x, dots in _unpacked(batch, dim):
                at, distance = assign(x, dots, centroids)
                ids, known = np.frombuffer(ids, dtype=np.int64), np.frombuffer(known, dtype=bool)
                yield pa.record_batch([
                    pa.array(ids, pa.int64(), mask=~known), pa.array(at, pa.int32()), pa.array(distance, pa.int64()),
                    pa.array(own[at], pa.int64()), pa.array(np.full(len(at), whole), pa.int64()),
                    pa.array(digests[at], pa.string())],
                    names=["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return blocks.select("ids", "known", "x", "dots").mapInArrow(
        run, "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
