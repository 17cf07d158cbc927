"""Helpers shared by the operators: bounded slices of Arrow batches, the word
rule, word hashing, and tables in the shared folder."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from medframe.session import ensure_checkpoint_dir

# Text bytes handled at once inside a task; a longer single text goes alone.
CHUNK_BYTES = 2 << 20

U64 = np.uint64


def slices(batches, column: str, limit: int = CHUNK_BYTES):
    """Cut record batches into slices of at most ``limit`` bytes of ``column``
    (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.array([0 if v is None else v for v in
                          pc.binary_length(col).to_pylist()], dtype=np.int64)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def values(batch, column: str) -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def text_bytes(batch, column: str) -> list[bytes]:
    """The column as UTF-8 bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [v or b"" for v in col.cast(kind).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased: maximal runs without space and
    U+0009 to U+000D (``bytes.lower`` and ``bytes.split`` are ASCII-only)."""
    return text.lower().split()


def hash_words(different: list[bytes]) -> np.ndarray:
    """Stable 64-bit hashes."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, different), dtype=U64, count=len(different))


def number_words(flat: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different words, and the place of each word among them."""
    index = dict.fromkeys(flat)
    for i, w in enumerate(index):
        index[w] = i
    return list(index), np.fromiter(map(index.__getitem__, flat), dtype=np.int64, count=len(flat))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (wrapping multiplications and shifts)."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


HOT_SHARE = 1000  # a key is hot with over total / HOT_SHARE rows
HOT_ROWS = 100    # and over this many


def join_copies(rows, dim, key: str):
    """``rows`` left joined with ``dim`` (one row per ``key``), keys with very
    many rows in parts: the at most ``HOT_SHARE`` hot keys are known by broadcast,
    their rows are dealt to parts and their row of ``dim`` is repeated for each.
    ``rows`` is read three times: pass a stored table or a cheap plan over one."""
    share = max(HOT_ROWS, rows.count() // HOT_SHARE)
    hot = F.broadcast(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where(
        F.col("__n") > share).select(key, F.ceil(F.col("__n") / share).alias("__parts")))
    spread = dim.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce(F.col("__parts"), F.lit(1)) - 1))).drop("__parts")
    dealt = rows.join(hot, key, "left").withColumn("__part", F.coalesce(
        F.monotonically_increasing_id() % F.col("__parts"), F.lit(0))).drop("__parts")
    return dealt.join(spread.hint("merge"), [key, "__part"], "left").drop("__part")


def new_path(spark, name: str) -> str:
    """A fresh path in the cluster's shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/medframe-{name}-{uuid.uuid4().hex}"


def store(df, name: str):
    """Write ``df`` under the shared folder and read it back: cuts lineage and
    survives lost executors. Returns (frame, path)."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark, *paths: str) -> None:
    """Delete tables written by ``store`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
