"""Blocks of vectors for searches of a query set against all rows.

Vectors are packed into blocks of bounded bytes; a tile is one block of queries
with one block of candidates. Candidate blocks move once, to the task of their
salt; the query blocks, the smaller side, are repeated per salt. Each task
keeps the best ``k`` of a query in a heap and hands them on; a window over at
most ``k`` rows of a query and task ends the search.

Vectors that are null, empty or hold a null or non-finite component take no
part, nor do rows without an id. Vectors of different length are not compared.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import store

BLOCK_ROWS = 8192
BLOCK_BYTES = 4 << 20
QUERY_ROWS = 2048
HELD_QUERIES = 50_000  # queries whose heaps a task holds before it hands them on

BLOCK = "dim int, ids binary, data binary"


def matrices(batch: pa.RecordBatch, id_col: str, vector_col: str):
    """(ids, matrix float64) of a batch for every vector length in it."""
    ids = batch.column(batch.schema.get_field_index(id_col))
    col = batch.column(batch.schema.get_field_index(vector_col))
    lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    lengths = np.where(pc.is_valid(ids).to_numpy(zero_copy_only=False), lengths, 0)
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN
    own = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(own)[:-1])).astype(np.int64)
    names = pc.fill_null(ids, 0).cast(pa.int64()).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        if dim:
            rows = np.flatnonzero(lengths == dim)
            m = flat[starts[rows][:, None] + np.arange(dim)]
            good = np.isfinite(m).all(axis=1)
            yield names[rows[good]], m[good]


def pack(df: DataFrame, id_col: str, vector_col: str, rows: int, nonzero: bool) -> DataFrame:
    """``dim, ids, data`` blocks (int64 and float64 bytes) of the valid vectors."""
    def run(batches):
        held: dict[int, list] = {}

        def out(dim):
            ids, data = (np.concatenate(x) for x in zip(*held.pop(dim)))
            size = max(1, min(rows, BLOCK_BYTES // (8 * dim)))
            for i in range(0, len(ids), size):
                yield pa.record_batch([pa.array([dim], pa.int32()),
                                       pa.array([ids[i:i + size].tobytes()], pa.binary()),
                                       pa.array([data[i:i + size].tobytes()], pa.binary())],
                                      names=["dim", "ids", "data"])

        for batch in batches:
            for ids, m in matrices(batch, "id", "v"):
                if nonzero:
                    keep = (m != 0).any(axis=1)
                    ids, m = ids[keep], m[keep]
                if len(ids):
                    dim = m.shape[1]
                    held.setdefault(dim, []).append((ids, m))
                    if sum(x[1].nbytes for x in held[dim]) >= BLOCK_BYTES:
                        yield from out(dim)
        for dim in list(held):
            yield from out(dim)

    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    return slim.mapInArrow(run, BLOCK)


def valid(vector_col: str, nonzero: bool) -> F.Column:
    """The vectors that ``pack`` takes."""
    def finite(x):
        return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))  # not-a-number is greater

    v = F.col(vector_col)
    out = (F.size(v) > 0) & F.forall(v, finite)
    return out & F.exists(v, lambda x: x.cast("double") != 0) if nonzero else out


def unpack(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(data).reshape(-1, dim)


class Heaps:
    """The best ``k`` (smallest (cost, id)) of each query."""

    def __init__(self, k: int):
        self.k = k
        self.of: dict[int, list] = {}

    def add(self, query: int, cost, other: int) -> None:
        heap = self.of.setdefault(query, [])
        item = (-cost, -other)  # the worst is on top
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)

    def flush(self, kind):
        rows = [(q, -o, -c) for q, heap in self.of.items() for c, o in heap]
        self.of = {}
        q, o, c = zip(*rows) if rows else ((), (), ())
        return pa.record_batch([pa.array(q, pa.int64()), pa.array(o, pa.int64()), pa.array(c, kind)],
                               names=["query_id", "vec_id", "cost"])


def best_of_rows(rows: np.ndarray, cost: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest (cost, id) of each row number."""
    order = np.lexsort((ids, cost, rows))
    first = np.searchsorted(rows[order], rows[order], side="left")
    return order[np.arange(len(order)) - first < k]


def search(df: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int, tile, kind: str,
           nonzero: bool) -> DataFrame:
    """``query_id, rank, vec_id, cost``: for every row of ``queries`` the ``k``
    rows of ``df`` of smallest (cost, id), its own id left out. ``tile(qid, q,
    cid, c, k)`` gives row numbers of queries, of candidates and costs that
    hold the best ``k`` of the tile. Of query rows that share an id one (the
    smallest valid vector) is asked; candidates that share an id all count."""
    spark = df.sparkSession
    ship.ensure(spark)
    asked = queries.where(valid(vector_col, nonzero)).groupBy(F.col(id_col)).agg(F.min(vector_col).alias(vector_col))
    left, _ = store(pack(asked, id_col, vector_col, QUERY_ROWS, nonzero), "queries")
    right, _ = store(pack(df, id_col, vector_col, BLOCK_ROWS, nonzero), "candidates")
    tasks = max(1, math.ceil(right.count() / 2))
    right = right.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(tasks)).cast("int"))
    left = left.select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                       F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("salt"))
    tiles = right.repartition(tasks, "dim", "salt").join(left.repartition(tasks, "dim", "salt"), ["dim", "salt"])
    arrow = pa.float64() if kind == "double" else pa.int64()

    def run(batches):
        heaps = Heaps(k)
        for batch in batches:
            for row in batch.to_pylist():
                qid, q = unpack(row["q_ids"], row["q_data"], row["dim"])
                cid, c = unpack(row["ids"], row["data"], row["dim"])
                at, other, cost = tile(qid, q, cid, c, k)
                keep = best_of_rows(at, cost, cid[other], k)
                for i, j, x in zip(qid[at[keep]].tolist(), cid[other[keep]].tolist(), cost[keep].tolist()):
                    heaps.add(i, x, j)
                if len(heaps.of) > HELD_QUERIES:
                    yield heaps.flush(arrow)
        yield heaps.flush(arrow)

    found = tiles.select("dim", "ids", "data", "q_ids", "q_data").mapInArrow(
        run, f"query_id long, vec_id long, cost {kind}")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("cost", "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "cost")
