"""Exact top-k by inner product, term at a time.

A vector is a sparse row of integer weights, ``floor(scale * x)`` per
component. For a block of candidates every component has a posting list (rows
and weights). The weights of a few queries are scattered, component after
component, over the postings into dense score arrays; a partition selects the
best of each array, heaps and a window merge the blocks. Every candidate is
scored, in exact integers.

Edge cases: vectors that are null, empty or hold a null or non-finite component
take no part, nor do rows without an id; zero vectors score 0. Fewer than
``k`` candidates: all of them. Ties go to the smaller id; rows that share an
id are all candidates, except for the query of that id. Scores beyond 64 bits
are computed exactly and held at the ends of the range.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe.llm import blocks

SCALE = 256
QUERIES_AT_ONCE = 64
DENSE = 0.5   # share of rows from which a posting list is scattered as a whole column
_LIMIT = 2 ** 63 - 1


def postings(weights: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per component (rows, weights); rows None: the whole column."""
    out = []
    for j in range(weights.shape[1]):
        column = np.ascontiguousarray(weights[:, j])
        rows = np.flatnonzero(column)
        out.append((None, column) if len(rows) > DENSE * len(column) else (rows, column[rows]))
    return out


def accumulate(queries: np.ndarray, lists, size: int) -> np.ndarray:
    """Scores of a few sparse query rows against ``size`` candidates."""
    scores = np.zeros((len(queries), size), dtype=queries.dtype)
    room = np.empty_like(scores)
    for j, (rows, weights) in enumerate(lists):
        w = queries[:, j]
        if not w.any() or len(weights) == 0:
            continue
        if rows is None:
            np.multiply(w[:, None], weights[None, :], out=room)
            scores += room
        else:
            scores[:, rows] += w[:, None] * weights[None, :]
    return scores


def _integers(m: np.ndarray, other: np.ndarray) -> np.dtype:
    bound = float(np.abs(m).max(initial=0)) * float(np.abs(other).max(initial=0)) * m.shape[1]
    return np.dtype(np.int32 if bound < 2 ** 31 else np.int64 if bound < 2 ** 62 else object)


def _cast(m: np.ndarray, kind) -> np.ndarray:
    if kind != object:
        return m.astype(kind)
    return np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)


def tile(qid, q, cid, c, k):
    """Row numbers and costs (negative scores) of the best ``k`` of a tile."""
    with np.errstate(over="ignore"):
        q, c = np.floor(SCALE * q), np.floor(SCALE * c)
    top = np.finfo(np.float64).max
    q, c = np.clip(q, -top, top), np.clip(c, -top, top)
    kind = _integers(q, c)
    lists = postings(_cast(c, kind))
    out = []
    for start in range(0, len(q), QUERIES_AT_ONCE):
        names = qid[start:start + QUERIES_AT_ONCE]
        scores = accumulate(_cast(q[start:start + QUERIES_AT_ONCE], kind), lists, len(cid))
        if kind == object:
            scores = np.array([[min(max(x, -_LIMIT), _LIMIT) for x in row] for row in scores], dtype=np.int64)
        own = names[:, None] == cid[None, :]
        if len(cid) > k:
            shown = np.where(own, np.iinfo(scores.dtype).min, scores)
            kth = np.partition(shown, len(cid) - k, axis=1)[:, len(cid) - k]
            a, b = np.nonzero((scores >= kth[:, None]) & ~own)
        else:
            a, b = np.nonzero(~own)
        cost = -scores[a, b].astype(np.int64)
        best = blocks.best_of_rows(a, cost, cid[b], k)
        out.append((a[best] + start, b[best], cost[best]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def top(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
        k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` (long) of the ``k`` rows of ``df`` of
    highest integer inner product for every row of ``queries``."""
    return blocks.search(df, queries, id_col, vector_col, k, tile, "long", nonzero=False).select(
        "query_id", "rank", "vec_id", (-F.col("cost")).alias("score"))
