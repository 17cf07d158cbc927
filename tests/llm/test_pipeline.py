"""The pipeline on a small fixture against a plain chain of its five stages, and
the quality model against plain numpy."""

import collections
import math
import random

import numpy as np
import pytest
from test_operators import RANKS, SCHEMA, WORDS, near, plain_components

from medframe.llm import mixing, pii, quality

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")


def plain_scores(texts, labelled, shrinkage=quality.SHRINKAGE):
    """Quadratic discriminant by definition: inverse covariances, determinants."""
    x = np.array([quality.statistics((t or "").encode()) for t in texts], dtype=np.float64)
    train = np.array([x[i] for i, _ in labelled])
    y = np.array([k for _, k in labelled])
    centre, scale = train.mean(axis=0), train.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (train - centre) / scale
    covs = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    counts = [int((y == k).sum()) for k in (0, 1)]
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / len(y)
    at = np.clip((x - centre) / scale, -quality.CLIP, quality.CLIP)
    logs = []
    for k in (0, 1):
        cov = (1 - 2 * shrinkage) * covs[k] + shrinkage * pooled + shrinkage * np.eye(x.shape[1])
        d = at - z[y == k].mean(axis=0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + math.log((counts[1] + 1) / (counts[0] + 1)), -500, 500)))


def fixture(n=160):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        if good:
            text = ". ".join(" ".join(rng.choices(WORDS, k=rng.randint(6, 14))).capitalize() for _ in range(rng.randint(3, 8))) + "."
            if i % 9 == 1 and rows:
                text = near(rng.choice([r[1] for r in rows if r[1] and len(r[1]) > 200]), rng) if i > 12 else text
            if i % 7 == 0:
                text += f" write to x{i}@a.example.com or +1 (213) 555-01{i:02d} from 10.0.0.{i % 250}"
        else:
            text = " ".join(rng.choice(["$$$", "BUY", "now!!!", "#1", "%%", "x" * 30]) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, "en", rng.choice(["a", "b", "c", None]), len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    rows += [(n, None, "en", "a", None), (n + 1, "", "en", "b", 0), (n + 2, rows[1][1], "de", "a", 5), (n + 3, "z" * 30_000, "en", "c", 1)]
    labels += [(n + 50, 1, 0), (3, None, 1)]
    return rows, labels


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows, labels = fixture()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_scores_equal_the_plain_discriminant(spark, sf):
    rows, labels = fixture()
    docs, table = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = {r["doc_id"] for r in docs.where(quality.held_out(docs["doc_id"])).collect()}
    labelled = [(i, k) for i, k, _ in labels if k is not None and i < len(rows) and i not in held]
    want = plain_scores([r[1] for r in rows], labelled)
    got = {r["id"]: r["score"] for r in quality.scored(docs, table).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(list(want), abs=1e-6)


def test_pipeline_equals_a_plain_chain(spark, sf):
    tiktoken = pytest.importorskip("tiktoken")
    from medframe.llm import bpe

    rows, labels = fixture()
    scores = plain_scores([r[1] for r in rows], [(i, k) for i, k, _ in labels if k is not None and i < len(rows)])
    rows = [r for r, s in zip(rows, scores) if s >= corpus_pipeline.LEAST_QUALITY]
    assert 60 < len(rows) < 140
    label = plain_components(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT)
    rows = [r for r in rows if label[r[0]][1] == r[0]]
    rows = [(i, t and pii.mask(t), lang, s, n if t is None else len(pii.mask(t))) for i, t, lang, s, n in rows]
    planned = {r["id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = collections.Counter()
    for i, t, lang, s, n in rows:
        ids = tuple(encode.encode_ordinary(t or ""))
        want[i, lang, s, n, ids, len(ids), True] += planned[i]
    out = corpus_pipeline.run(spark, sf)
    got = collections.Counter((r["doc_id"], r["lang"], r["source"], r["n_chars"], tuple(r["token_ids"]), r["n_tokens"],
                               r["round_trip"]) for r in out.collect())
    assert got == +want
    masked = [t for _, t, *_ in rows if t and "[EMAIL]" in t]
    assert masked and not any("example.com" in t for _, t, *_ in rows if t)


def test_pipeline_of_empty_tables(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert corpus_pipeline.run(spark, d).collect() == []
