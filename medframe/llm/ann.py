"""Nearest neighbours by a block matrix join on int8 tiles.

Each vector is quantised to int8 with its own scale. The product of two int8
blocks gives every squared distance of a tile up to an error that the norms
and the quantisation errors bound (Cauchy-Schwarz). A pair is kept if its lower
bound does not exceed the k-th smallest upper bound of its query; kept pairs
are recomputed from the original vectors in double precision, component after
component, and merged by heaps. No pair is lost, so the recall is 1.

Edge cases: vectors that are null, zero, empty or hold a null or non-finite
component take no part, neither do rows without an id. Fewer than ``k``
candidates: all of them. Ties go to the smaller id; rows that share an id are
all candidates, except for the query of that id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe.llm import blocks

QUERIES_AT_ONCE = 256


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scale, norm, quantisation error) of each row."""
    scale = np.abs(m).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    q = np.rint(m / scale[:, None]).astype(np.int8)
    error = np.sqrt(((m - q * scale[:, None]) ** 2).sum(axis=1))
    return q, scale, np.sqrt((m * m).sum(axis=1)), error


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, summed in the order of components."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - y[:, j]
        total += d * d
    return np.sqrt(total)


def tile(qid, q, cid, c, k):
    """Row numbers and distances of the pairs of a tile that can be among the
    ``k`` nearest of their query."""
    dim = q.shape[1]
    exact = np.float32 if 127 * 127 * dim < 2 ** 24 else np.float64  # holds int8 products exactly
    with np.errstate(over="ignore", invalid="ignore"):
        cq, cs, cn, ce = quantise(c)
        right = cq.T.astype(exact)
        out = []
        for start in range(0, len(q), QUERIES_AT_ONCE):
            part, names = q[start:start + QUERIES_AT_ONCE], qid[start:start + QUERIES_AT_ONCE]
            pq, ps, pn, pe = quantise(part)
            dot = (pq.astype(exact) @ right).astype(np.float64) * ps[:, None] * cs[None, :]
            square = pn[:, None] ** 2 + cn[None, :] ** 2
            slack = 2 * (pn[:, None] * ce[None, :] + pe[:, None] * (cn + ce)[None, :]) + 1e-9 * square
            square -= 2 * dot
            high = square + slack
            high[names[:, None] == cid[None, :]] = np.inf
            kth = np.partition(high, k - 1, axis=1)[:, k - 1] if len(cid) > k else np.full(len(part), np.inf)
            keep = ~(square - slack > kth[:, None]) & (names[:, None] != cid[None, :])  # not-a-number stays
            a, b = np.nonzero(keep)
            for i in range(0, len(a), 1 << 16):
                x, y = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
                d = _exact(part[x], c[y])
                best = blocks.best_of_rows(x, d, cid[y], k)
                out.append((x[best] + start, y[best], d[best]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean distance) of the ``k``
    nearest rows of ``df`` for every row of ``queries``."""
    return blocks.search(df, queries, id_col, vector_col, k, tile, "double", nonzero=True).select(
        "query_id", "rank", "vec_id", F.col("cost").alias("score"))
