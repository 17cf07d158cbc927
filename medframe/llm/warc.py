"""WARC archives with an index written first.

Writing: every task writes one gzip member per record into files of its own
under a shared folder and returns, per record, file, offset, length, url and
digest. This index becomes a table, so a file left by a lost task is never
referred to. Records whose payload equals that of an earlier one (smallest id)
are revisits without payload.

Reading: any selection of index rows is sorted by file and offset, ranges that
lie close together are fetched in one read of bounded size, and the records
are cut out of it and parsed.

Edge cases: a null payload is empty. A null url has no target header and is
read back as null; control characters in urls are percent-encoded. Rows that
share the smallest id of a payload are all responses; a record without an id
is a revisit if another record of the payload has one, else a response.
Payloads below ``min_bytes`` are always responses.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import new_path, slices, store, values

DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 1 << 30     # a task begins another file beyond this
READ_BYTES = 8 << 20     # one read covers at most this much, or one record
TASK_BYTES = 64 << 20    # archive bytes a reading task gets
GAP_BYTES = 64 << 10     # unwanted bytes between two records that one read may cover
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

INDEX = ("id long, record_type string, url string, payload_digest string, file string, "
         "offset long, length long")
RECORD = ("id long, record_type string, url string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")


def open_fs(uri: str):
    """(file system, path) of a qualified URI; shared storage on a cluster."""
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest if colon else uri).lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def qualified(spark, path: str) -> str:
    """``path`` with the scheme of the file system Spark would use for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _target(url: str) -> bytes:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url).encode()


def record(rec_id, kind: str, url, refers_to, payload: bytes, digest: str, size: int) -> bytes:
    """One uncompressed record. ``size`` is that of the full payload."""
    block = b""
    head = [b"WARC/1.0", f"WARC-Type: {kind}".encode(),
            f"WARC-Record-ID: <urn:record:{'' if rec_id is None else rec_id}>".encode(),
            f"WARC-Date: {DATE}".encode(), f"WARC-Payload-Digest: sha1:{digest}".encode(),
            f"X-Payload-Length: {size}".encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _target(url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}".encode(), f"WARC-Refers-To: <urn:record:{refers_to}>".encode()]
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + \
            str(size).encode() + b"\r\n\r\n" + payload
        head.append(b"Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}".encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of ``RECORD`` from one uncompressed record; checks the digest."""
    head, _, body = raw.partition(b"\r\n\r\n")
    named = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = body[:int(named[b"Content-Length"])]

    def rec_id(name):
        text = named[name][len("<urn:record:"):-1] if name in named else b""
        return int(text) if text else None

    kind = named[b"WARC-Type"].decode()
    digest = named[b"WARC-Payload-Digest"].decode()[len("sha1:"):]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of record {named[b'WARC-Record-ID'].decode()} does not match its digest")
    url = named.get(b"WARC-Target-URI")
    return {"id": rec_id(b"WARC-Record-ID"), "record_type": kind, "url": None if url is None else url.decode(),
            "refers_to": rec_id(b"WARC-Refers-To"), "payload_digest": digest, "payload": payload,
            "payload_bytes": int(named[b"X-Payload-Length"]) if payload is None else len(payload)}


def _writer(folder: str):
    def run(batches):
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for part in slices(batches, "payload"):
            rows = part.to_pylist()
            done: list[tuple] = []
            for r in rows:
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                payload = (r["payload"] or "").encode()
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                kind = "revisit" if r["refers_to"] is not None else "response"
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = pack.compress(record(r["id"], kind, r["url"], r["refers_to"],
                                           b"" if kind == "revisit" else payload, digest,
                                           len(payload))) + pack.flush()
                out.write(raw)
                done.append((r["id"], kind, r["url"], digest, name, at, len(raw)))
                at += len(raw)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), kinds)],
                                  names=["id", "record_type", "url", "payload_digest", "file", "offset", "length"])
        if out is not None:
            out.close()

    return run


def write(df: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0):
    """Write one record per row. Returns (index, folder)."""
    spark = df.sparkSession
    ship.ensure(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn(
        "size", F.octet_length("payload"))
    first = rows.select("id", "digest", "size").where(F.col("size") >= min_bytes).groupBy(
        "digest", "size").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where(
        "copies > 1").select("digest", "size", "first")
    plan = rows.join(first, ["digest", "size"], "left").select(
        "id", "url", "payload", "digest",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    folder = qualified(spark, new_path(spark, "warc"))
    index, _ = store(plan.mapInArrow(_writer(folder), INDEX), "warc-index")
    return index, folder


def ranges(rows, read_bytes: int = READ_BYTES, gap_bytes: int = GAP_BYTES):
    """Group sorted (file, offset, length) rows into reads: lists of rows of
    one file that lie close together."""
    group: list[tuple] = []
    for row in rows:
        if group:
            file, end = group[-1][0], group[-1][1] + group[-1][2]
            if row[0] != file or row[1] - end > gap_bytes or row[1] + row[2] - group[0][1] > read_bytes:
                yield group
                group = []
        group.append(row)
    if group:
        yield group


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the selected ``index`` rows, parsed (columns of
    ``RECORD``; ``payload`` null unless ``payloads``)."""
    ship.ensure(index.sparkSession)
    names = [c.strip().split(" ")[0] for c in RECORD.split(",")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        fs, base = open_fs(folder)
        file, handle = None, None
        listed = (r for b in batches for r in zip(values(b, "file"), values(b, "offset"), values(b, "length")))
        for group in ranges(listed):
            if group[0][0] != file:
                file = group[0][0]
                handle = fs.open_input_file(f"{base}/{file}")
            start = group[0][1]
            span = handle.read_at(group[-1][1] + group[-1][2] - start, start)
            found = [parse(zlib.decompress(span[o - start:o - start + n], 31)) for _, o, n in group]
            if not payloads:
                for r in found:
                    r["payload"] = None
            yield pa.record_batch([pa.array([r[c] for r in found], t) for c, t in zip(names, kinds)], names=names)

    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    spread = index.select("file", "offset", "length").repartitionByRange(
        1 + total // TASK_BYTES, "file", "offset").sortWithinPartitions("file", "offset")
    return spread.mapInArrow(run, RECORD)
