"""Clustering with kept products against plain Python integers."""

import hashlib
import math
import random

import numpy as np

from medframe.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int, x int, ids string, cluster string"


def plain(rows, k=16, dim=64, scale=64, rounds=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]

    def order(r):
        return (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])

    cents = [list(v) for _, v in sorted(kept, key=order)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = [j for j, _ in assign()]
        for j in range(len(cents)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                cents[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = assign()
    total = sum(d for _, d in last)
    own = [sum(d for j, d in last if j == c) for c in range(len(cents))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, own[j], total, digest[j]) for (i, _), (j, d) in zip(kept, last)), key=str)


def f32(x):
    return float(np.float32(x))


def vectors(n=400, dim=64):
    rng = random.Random(8)
    rows = [(i, [f32(rng.gauss(i % 5 / 4, 0.2)) for _ in range(dim)]) for i in range(n)]
    rows += [(1000 + i, [0.5] * dim) for i in range(150)]                       # equal vectors, ties
    rows += [(7, [0.25] * dim), (7, [0.25] * dim), (None, [0.1] * dim), (None, [-0.1] * dim)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (dim - 1)), (2003, [1.0] * (dim + 1)),
             (2004, [None] + [0.0] * (dim - 1)), (2005, [math.nan] * dim), (2006, [math.inf] + [0.0] * (dim - 1)),
             (2007, [0.0] * dim), (2008, [-1e6] + [0.0] * (dim - 1))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "a", "b") for i, v in rows], SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_plain_integers(spark, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK_BYTES", 64 * 4 * 50)  # several blocks a task
    rows = vectors()
    rows = [(i, v if v is None else [x if x is None else f32(x) for x in v]) for i, v in rows]
    assert result(clusters.cluster(frame(spark, rows).repartition(3))) == plain(rows)


def test_few_and_no_vectors(spark):
    rows = [(i, [f32(i * 0.3 - j * 0.01) for j in range(64)]) for i in range(5)]
    assert result(clusters.cluster(frame(spark, rows))) == plain(rows)
    for none in ([], [(1, None), (2, [1.0])]):
        df = clusters.cluster(frame(spark, none))
        assert df.collect() == [] and df.columns[:3] == ["id", "cluster", "distance"]


def test_kept_products_stay_exact():
    rng = np.random.default_rng(2)
    for size in (40, clusters.LARGEST):
        x = rng.integers(-size, size + 1, (300, 64)).astype(np.int32)
        c = rng.integers(-size, size + 1, (16, 64))
        dots = clusters.product(x, c)
        for _ in range(4):
            new = c.copy()
            new[rng.integers(0, 16, 20), rng.integers(0, 64, 20)] = rng.integers(-size, size + 1, 20)
            dots, c = clusters.update(dots, x, new - c), new
            assert (dots == x.astype(np.int64) @ c.T).all()
        at, d = clusters.assign(x, dots, c)
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m)) for m in c] for v in x[:20]]
        assert [e.index(min(e)) for e in exact] == at[:20].tolist() and [min(e) for e in exact] == d[:20].tolist()


def test_huge_components_are_held(spark):
    rows = [(i, [3e38 * (-1) ** i] + [0.0] * 63) for i in range(4)]
    got = clusters.cluster(frame(spark, rows), k=2).collect()
    assert len(got) == 4 and all(r["distance"] >= 0 for r in got)
