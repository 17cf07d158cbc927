"""Near-duplicate documents by min-max hashing.

Each document is the set of its word shingles (64-bit hashes). A random
permutation is evaluated once per shingle and gives *two* signature values,
the minimum and the maximum, so ``2 * permutations`` values cost half the
evaluations. Bands of ``rows`` values make buckets.

Documents with equal sets form a class, one class member goes on. Within a
bucket the pairs are not listed: a leader is compared with all members, linked
components are merged, and again while this merges much. What a bucket then
still holds in different components is compared in full: small buckets by
pairs, large ones in tiles of bounded size that return links only. So no link
between different texts of a bucket is lost. Every link is confirmed on the
full shingle sets.

Edge cases: a null or empty text (or one of white space only) has an empty set,
links with nothing and is its own component. Equal rows are one class. Rows are
linked by their sets, whatever their ids: rows with different texts may share an
id, and rows without one take part like others (a component without any id is
null). Ids are integers. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from medframe import ship
from medframe.llm.batches import (U64, hash_words, join_copies, mix, number_words, remove, slices, store,
                                  text_bytes, values, words)

MISS = 1e-6        # chance that a pair exactly at the threshold shares no bucket
ROWS = 5           # signature values per band
GAIN = 0.7         # leader rounds go on while the pairs left fall below this share of those before
SMALL_BUCKET = 50  # pairs across components up to which a bucket is compared pair by pair
TILE_ITEMS = 400_000  # shingles of a block of a large bucket


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that a pair of similarity ``threshold`` is missed with
    probability at most ``miss``: (1 - t^rows)^bands <= miss."""
    return max(1, math.ceil(math.log(miss) / math.log(1 - threshold ** rows)))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    split = [words(t) for t in texts]
    different, ids = number_words([w for own in split for w in own])
    flat = hash_words(different)[ids]
    out, at = [], 0
    for own in split:
        h = flat[at:at + len(own)]
        at += len(own)
        if len(h) >= n:
            h = np.unique(mix(_fold([h[i:len(h) - n + 1 + i] for i in range(n)])))
        elif len(h):
            h = mix(_fold([h[i:i + 1] for i in range(len(h))]) + U64(len(h)))
        out.append(h)
    return out


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    acc = np.zeros(len(parts[0]), dtype=U64)
    for p in parts:
        acc = (acc ^ p) * U64(0x9E3779B97F4A7C15)
        acc ^= acc >> U64(29)
    return acc


def permutations(count: int) -> list[tuple[np.uint64, np.uint64]]:
    rng = np.random.default_rng(20240917)
    raw = rng.integers(0, 2 ** 63, size=(count, 2), dtype=np.uint64)
    return [(U64(int(a) * 2 + 1 & 0xFFFFFFFFFFFFFFFF), U64(int(b) * 2 & 0xFFFFFFFFFFFFFFFF))
            for a, b in raw]


def minmax_signatures(flat: np.ndarray, starts: np.ndarray, perms) -> np.ndarray:
    """(values, documents): minimum and maximum of every permutation."""
    sig = np.empty((2 * len(perms), len(starts)), dtype=U64)
    buf = np.empty_like(flat)
    for k, (a, b) in enumerate(perms):
        np.bitwise_xor(flat, b, out=buf)
        np.multiply(buf, a, out=buf)
        sig[2 * k] = np.minimum.reduceat(buf, starts)
        sig[2 * k + 1] = np.maximum.reduceat(buf, starts)
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) bucket keys, distinct between bands."""
    keys = np.empty((sig.shape[1], bands), dtype=np.int64)
    for b in range(bands):
        acc = np.full(sig.shape[1], b + 1, dtype=U64)
        for r in range(rows):
            acc = mix(acc * U64(0x9E3779B97F4A7C15) ^ sig[b * rows + r])
        keys[:, b] = acc.view(np.int64)
    return keys


def _signer(n: int, bands: int, rows: int):
    perms = permutations((bands * rows + 1) // 2)

    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(text_bytes(part, "text"), n)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(sizes)
            prints: list = [None] * len(sets)
            keys: list = [None] * len(sets)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                for i, k in zip(full, band_keys(minmax_signatures(flat, starts, perms), bands, rows)):
                    keys[i] = k
                    prints[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            yield pa.record_batch([
                pa.array(values(part, "id"), pa.int64()),
                pa.array(sizes),
                pa.array(prints, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ], names=["id", "n_shingles", "print", "bands"])

    return run


def _setter(n: int):
    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(text_bytes(part, "text"), n)
            yield pa.record_batch([
                pa.array(values(part, "id"), pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ], names=["id", "print", "items"])

    return run


def _confirmer(percent: int):
    """Pairs whose sets satisfy 100 * |A and B| >= percent * |A or B|."""
    def run(batches):
        for batch in slices(batches, "items_a"):
            a, b = values(batch, "a"), values(batch, "b")
            left, right = values(batch, "items_a"), values(batch, "items_b")
            keep = []
            for i, (x, y) in enumerate(zip(left, right)):
                x, y = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.record_batch([pa.array([a[i] for i in keep], pa.int64()),
                                   pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``node, component`` (smallest
    node reachable) for every node with an edge. Alternating large and small
    stars; each step is a grouped minimum and a join, so a node of high degree
    is never gathered in one place."""
    spark = edges.sparkSession
    cur, path = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                   F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        nxt, new = store(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "edges")
        # done when every node points to one root and no root points further
        loose = nxt.groupBy("a").count().where("count > 1").select("a").unionByName(
            nxt.join(nxt.select(F.col("a").alias("b")), "b", "left_semi").select("a"))
        remove(spark, path)
        cur, path = nxt, new
        if loose.isEmpty():
            break
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, rows: int, miss: float) -> DataFrame:
    """One row per document: ``id, n_shingles, print`` (fingerprint of its set),
    ``grp`` (a number of its component) and ``component_id``. What is compared and
    linked are the different sets, each a node with a number of its own; ids only
    come back at the end, so repeated and null ids lose no link."""
    spark = docs.sparkSession
    ship.ensure(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    bands = bands_for(percent / 100, rows, miss)
    signed, _ = store(slim.mapInArrow(
        _signer(shingle, bands, rows),
        "id long, n_shingles long, print binary, bands array<bigint>"), "signed")

    # classes of equal sets, numbered as they are written
    classes, _ = store(signed.where("print is not null").groupBy("print").agg(
        F.min("id").alias("low"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")).withColumn(
        "node", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    members, _ = store(buckets.join(sizes.select("key"), "key").distinct(), "members")
    nodes, _ = store(members.select("node").distinct(), "nodes")
    # the set of a class comes from the rows of its smallest id (null: of those without one)
    wanted = classes.select("node", "print", "low").join(nodes, "node", "left_semi")
    lows = wanted.select("low").distinct()
    own = slim.join(lows, F.col("id") == F.col("low"), "left_semi")
    if not lows.where("low is null").isEmpty():
        own = own.unionByName(slim.where("id is null"))
    sets, _ = store(own.mapInArrow(_setter(shingle), "id long, print binary, items binary").join(
        wanted.select("print", "node"), "print").groupBy("node").agg(F.first("items").alias("items")).select(
        F.col("node").alias("id"), "items"), "sets")

    label = _link_buckets(members, nodes, sets, percent)
    named = classes.select("node", "print", "low").join(label, "node", "left").select(
        "print", "low", F.coalesce("component", "node").alias("grp"))
    smallest = named.groupBy("grp").agg(F.min("low").alias("component_id"))
    named, _ = store(named.join(smallest, "grp").select("print", "grp", "component_id"), "groups")
    out = join_copies(signed.select("id", "n_shingles", "print"), named, "print")
    return out.select("id", "n_shingles", "print", "grp", F.when(F.col("print").isNull(), F.col("id")).otherwise(
        F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id`` (smallest id
    reachable over links of similarity >= ``percent`` / 100, itself included)."""
    return _grouped(docs, id_col, text_col, shingle, percent, rows, miss).select("id", "n_shingles", "component_id")


def _tile_linker(percent: int):
    """Links across components inside one tile of a bucket (members of one or
    two of its blocks), by marking one set and summing the marks of the others."""
    def run(tile):
        order = tile["component"].to_numpy()
        nodes, block = tile["node"].to_numpy(), tile["block"].to_numpy()
        flat = np.concatenate([np.frombuffer(x, dtype=U64) for x in tile["items"]])
        sizes = np.array([len(x) // 8 for x in tile["items"]])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        flat = np.unique(flat, return_inverse=True)[1]
        marks = np.zeros(flat.max() + 1, dtype=np.int64)
        split = block.min() != block.max()
        a, b, seen = [], [], set()  # one link of two components is enough
        for i in range(len(nodes)):
            if split and block[i] != block.min():
                continue
            mine = flat[starts[i]:starts[i] + sizes[i]]
            marks[mine] = 1
            both = np.add.reduceat(marks[flat], starts)
            marks[mine] = 0
            hit = (100 * both >= percent * (sizes + sizes[i] - both)) & (order != order[i])
            if split:
                hit &= block != block[i]
            for j in np.flatnonzero(hit):
                if (order[i], order[j]) not in seen:
                    seen |= {(order[i], order[j]), (order[j], order[i])}
                    a.append(min(nodes[i], nodes[j]))
                    b.append(max(nodes[i], nodes[j]))
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return run


def _size_fits(percent: int):
    return (F.least("x.n_shingles", "y.n_shingles") * 100
            >= F.greatest("x.n_shingles", "y.n_shingles") * percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b")
    side = side.join(sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a")
    return side.select("a", "b", "items_a", "items_b").mapInArrow(_confirmer(percent), "a long, b long")


def _ordered_pairs(joined: DataFrame, percent: int) -> DataFrame:
    return joined.where(_size_fits(percent)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _link_buckets(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) after comparing all members of a bucket that are not
    yet in one component: leader rounds while these merge much, then the pairs
    of small buckets and the tiles of large ones."""
    spark = members.sparkSession
    label = nodes.select("node", F.col("node").alias("component"))
    before, turn = math.inf, 0
    while True:
        turn += 1
        now, now_path = store(members.join(label, "node"), "now")
        per = now.groupBy("key", "component").agg(
            F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("n")).groupBy("key").agg(
            F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"),
            F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
        open_keys, open_path = store(per.where("c > 1").select(
            "key", ((F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs"),
            F.ceil(F.col("n") / TILE_ITEMS).cast("int").alias("blocks")), "open")
        left = open_keys.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
        if left == 0:
            return label
        last = left > GAIN * before
        before = left
        if not last:
            held = now.join(open_keys.select("key"), "key")
            lead = held.groupBy("key").agg(F.min(F.struct(
                F.xxhash64("node", F.lit(turn)), "node", "component", "n_shingles")).alias("l")).select(
                "key", "l.node", "l.component", "l.n_shingles")
            pairs = _ordered_pairs(lead.alias("x").join(held.alias("y"), "key").where(
                "x.component <> y.component"), percent)
            links = _confirmed(pairs, sets, percent)
        else:
            held = now.join(open_keys.where(F.col("pairs") <= SMALL_BUCKET).select("key"), "key")
            pairs = _ordered_pairs(held.alias("x").join(held.alias("y"), "key").where(
                "x.node < y.node and x.component <> y.component"), percent)
            large = now.join(open_keys.where(F.col("pairs") > SMALL_BUCKET), "key").withColumn(
                "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            tiles = large.join(sets, F.col("node") == F.col("id")).select(
                "key", "node", "component", "block", "items",
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            tiles = tiles.groupBy("key", F.least("block", "other").alias("one"),
                                  F.greatest("block", "other").alias("two"))
            links = _confirmed(pairs, sets, percent).unionByName(
                tiles.applyInPandas(_tile_linker(percent), "a long, b long"))
        named = links.join(label.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(
            label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
        merged = components(named.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        label, _ = store(label.join(merged.withColumnRenamed("component", "to"),
                                    F.col("component") == merged["node"], "left").select(
            label["node"], F.coalesce("to", "component").alias("component")), "labels")
        remove(spark, now_path, open_path)
        if last:
            return label


def _printer(n: int):
    """Appends the fingerprint of each row's set (null: no words)."""
    def run(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(text_bytes(part, "text"), n)
            prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.record_batch([*part.columns, pa.array(prints, pa.binary())], names=[*part.schema.names, "__print"])

    return run


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest
    ``doc_id`` (rows without one come last, then the smallest fingerprint; of
    rows equal in both any). Rows without words stay.

    An id that occurs once decides for its row. The rows of repeated ids and those
    without an id are told apart by their sets, which are computed again for
    them alone."""
    found, _ = store(_grouped(docs, "doc_id", "text", shingle, percent, ROWS, MISS).where("grp is not null").select(
        "id", "print", "grp"), "grouped")
    best = found.groupBy("grp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("best"))
    judged, _ = store(join_copies(found, best, "grp").select("id", "print", (
        F.col("id").eqNullSafe(F.col("best.id")) & (F.col("print") == F.col("best.print"))).alias("stays")), "judged")
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    twice, _ = store(ids.where("n > 1").select("doc_id"), "twice")
    gone = judged.where("id is not null and not stays").select(F.col("id").alias("doc_id")).distinct()
    odd = docs.where("doc_id is null")
    # always merge joins: the plan is the same at every size
    if twice.isEmpty():
        kept = docs.where("doc_id is not null").join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)
    else:
        kept = docs.where("doc_id is not null").join(gone.unionByName(twice).hint("merge"), "doc_id", "left_anti").select(
            docs.columns)
        odd = odd.unionByName(docs.join(twice.hint("merge"), "doc_id", "left_semi").select(docs.columns))
    if odd.isEmpty():
        return kept
    ship.ensure(docs.sparkSession)
    own = odd.mapInArrow(_printer(shingle), StructType([*odd.schema.fields, StructField("__print", BinaryType())]))
    bare = own.where("__print is null").drop("__print")
    own = own.where("__print is not null").dropDuplicates(["doc_id", "__print"])
    stay = judged.where("stays").select(F.col("id").alias("__id"), F.col("print").alias("__own")).distinct()
    own = own.join(stay.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__own")),
                   "left_semi").drop("__print")
    return kept.unionByName(bare).unionByName(own)
