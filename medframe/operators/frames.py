"""Image frames of DICOM files as rows.

``frames(df)`` turns each file of a ``path, content`` DataFrame into one row
per frame: ``path, frame, data (PNG), height, width`` plus pass-through
columns. It is an Arrow batch function (``mapInArrow``): frames of one file
stay in one task, a file never goes to the driver. Native (uncompressed)
pixel data only (little or big endian): 8/16-bit MONOCHROME2 and 8-bit RGB samples as stored; anything else,
or any failure, gives no rows for that file (the file-level rule of the
reference: an empty image list).

``to_image`` is the column form (pandas UDF): an array of
``struct<data, height, width>`` per file, height and width left null. All
images of a file share one cell: for files of few frames; ``frames`` has no
such limit.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medframe import dictionary as dictmod
from medframe import ship
from medframe.sources import tokenise as tk

IMAGE_DDL = "array<struct<data:binary,height:int,width:int>>"
_NATIVE_TS = {tk.TS_EXPLICIT_LE, tk.TS_IMPLICIT_LE, tk.TS_DEFLATED_LE, tk.TS_EXPLICIT_BE, None}

# Attribute tags of the image pixel module (PS3.3 C.7.6.3).
T_SAMPLES, T_PHOTOMETRIC, T_PLANAR = 0x00280002, 0x00280004, 0x00280006
T_FRAMES, T_ROWS, T_COLUMNS = 0x00280008, 0x00280010, 0x00280011
T_BITS_ALLOC, T_PIXEL_REP = 0x00280100, 0x00280103


def _png(pixels: np.ndarray) -> bytes:
    """Encode a (h, w) uint8/uint16 or (h, w, 3) uint8 array as PNG."""
    h, w = pixels.shape[:2]
    if pixels.ndim == 3:
        color, depth = 2, 8
    else:
        color, depth = 0, 16 if pixels.dtype == np.uint16 else 8
    raw = pixels.astype(">u2") if depth == 16 else pixels.astype(np.uint8)
    rows = raw.reshape(h, -1).view(np.uint8).reshape(h, -1)
    body = np.hstack([np.zeros((h, 1), dtype=np.uint8), rows]).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", w, h, depth, color, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(body, 6)) + chunk(b"IEND", b"")


def _value(elems: dict, tag: int, default=None):
    e = elems.get(tag)
    if e is None or e.kind != "bytes":
        return default
    if e.vr in ("US", "SS", "UL", "SL"):
        nums = tk._numbers(e)
        return nums[0] if nums else default
    text = tk.element_text(e, tk.DEFAULT)
    return text.split("\\")[0].strip() if text else default


def _frame_plan(data, vr_of):
    """Validate one file and return (pixel array, rows, cols, samples, bits,
    signed, planar, frames); raises on anything not decodable."""
    parsed = tk.parse(memoryview(data), vr_of, stop_at_pixel=False)
    ts = parsed.syntax
    if ts not in _NATIVE_TS:
        raise ValueError("compressed or unsupported transfer syntax")
    elems = {e.tag: e for e in parsed.elements}
    pix = elems.get(tk.PIXEL_DATA)
    if pix is None or pix.kind != "bytes":
        raise ValueError("no native pixel data")
    rows, cols = int(_value(elems, T_ROWS)), int(_value(elems, T_COLUMNS))
    samples = int(_value(elems, T_SAMPLES, 1))
    bits = int(_value(elems, T_BITS_ALLOC, 8))
    signed = int(_value(elems, T_PIXEL_REP, 0)) == 1
    planar = int(_value(elems, T_PLANAR, 0))
    if _value(elems, T_PHOTOMETRIC, "MONOCHROME2") not in ("MONOCHROME2", "RGB"):
        raise ValueError("photometric interpretation")
    nframes = int(float(_value(elems, T_FRAMES, "1") or 1))
    if bits == 8:
        dtype = np.int8 if signed else np.uint8
    elif bits == 16:
        order = ">" if ts == tk.TS_EXPLICIT_BE else "<"
        dtype = f"{order}i2" if signed else f"{order}u2"
    else:
        raise ValueError("bits allocated")
    if samples not in (1, 3) or (samples == 3 and bits != 8):
        raise ValueError("samples per pixel")
    arr = np.frombuffer(pix.value, dtype=dtype)
    per = rows * cols * samples
    if per == 0 or nframes < 1 or arr.size < per * nframes:
        raise ValueError("pixel data too short")
    return arr, rows, cols, samples, bits, signed, planar, nframes


def iter_frames(data, vr_of):
    """Frames of one file as (png, height, width), one at a time. Nothing
    (an empty iterator) when the file cannot be decoded; validation happens
    before the first frame, so a file gives all its frames or none."""
    try:
        arr, rows, cols, samples, bits, signed, planar, nframes = _frame_plan(data, vr_of)
    except Exception:
        return
    per = rows * cols * samples
    for f in range(nframes):
        fr = arr[f * per : (f + 1) * per]
        if samples == 3:
            img = fr.reshape(3, rows, cols).transpose(1, 2, 0) if planar else fr.reshape(rows, cols, 3)
            img = img.astype(np.uint8)
        else:
            img = fr.reshape(rows, cols)
            if signed:  # shift to unsigned, keeping order
                offset = 128 if bits == 8 else 32768
                img = (img.astype(np.int32) + offset).astype(np.uint8 if bits == 8 else np.uint16)
            elif bits == 16:
                img = img.astype(np.uint16)
        yield _png(img), rows, cols


def decode_frames(data, vr_of) -> list[tuple[bytes, int, int]]:
    """All frames of one file as (png, height, width); [] on any failure."""
    try:
        return list(iter_frames(data, vr_of))
    except Exception:
        return []


# Output batches of ``frames`` are flushed at these bounds, so many-frame
# files never build one huge Arrow batch.
FLUSH_ROWS = 4096
FLUSH_BYTES = 64 * 1024 * 1024


def _vr_lookup():
    by_tag = {e.tag: e.vr for e in dictmod.active().elements}
    return by_tag.get


def _check_format(output_format: str) -> None:
    if str(output_format).lower() != "png":
        raise ValueError(f"image output format {output_format!r} is not supported; only 'png'")


def frames(df: DataFrame, content_col: str = "content", dimensions: bool = True,
           output_format: str = "png") -> DataFrame:
    """One row per frame: pass-through columns, ``frame`` (0-based),
    ``data`` (PNG bytes), ``height``, ``width`` (null unless ``dimensions``)."""
    _check_format(output_format)
    ship.ensure(df.sparkSession)
    vr_of = _vr_lookup()
    passthrough = [c for c in df.columns if c != content_col]
    fields = {f.name: f for f in df.schema.fields}
    ddl = ", ".join(
        [f"`{c}` {fields[c].dataType.simpleString()}" for c in passthrough]
        + ["frame int", "data binary", "height int", "width int"]
    )

    names = passthrough + ["frame", "data", "height", "width"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column(content_col)
            take, fno, datas, hs, ws = [], [], [], [], []
            size = 0

            def flush():
                idx = pa.array(take, pa.int64())
                arrays = [batch.column(c).take(idx) for c in passthrough]
                arrays += [pa.array(fno, pa.int32()), pa.array(datas, pa.binary()),
                           pa.array(hs, pa.int32()), pa.array(ws, pa.int32())]
                return pa.RecordBatch.from_arrays(arrays, names=names)

            for i in range(batch.num_rows):
                buf = contents[i].as_buffer() if contents[i].is_valid else None
                if buf is None:
                    continue
                for j, (png, h, w) in enumerate(iter_frames(buf, vr_of)):
                    take.append(i)
                    fno.append(j)
                    datas.append(png)
                    hs.append(h if dimensions else None)
                    ws.append(w if dimensions else None)
                    size += len(png)
                    if len(take) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                        yield flush()
                        take, fno, datas, hs, ws, size = [], [], [], [], [], 0
            if take or batch.num_rows == 0:
                yield flush()

    return df.mapInArrow(run, ddl)


def to_image(col: Column | str, spark=None, output_format: str = "png") -> Column:
    """Column form over file bytes: ``array<struct<data,height,width>>``
    with height and width null (the reference's UDF gives no dimensions)."""
    _check_format(output_format)
    if spark is not None:
        ship.ensure(spark)
    vr_of = _vr_lookup()

    @F.pandas_udf(IMAGE_DDL)
    def _images(contents: pd.Series) -> pd.Series:
        return contents.map(
            lambda b: [] if b is None else [
                {"data": png, "height": None, "width": None} for png, _, _ in decode_frames(b, vr_of)
            ]
        )

    c = F.col(col) if isinstance(col, str) else col
    return _images(c)


def read_frames(spark, path, where: str | None = None, options: dict | None = None,
                dimensions: bool = True, output_format: str = "png") -> DataFrame:
    """Frames of the DICOM files under ``path`` (directory or glob) as rows:
    ``path, frame, data, height, width``; a file scan with no shuffle."""
    from medframe.sources.dicom import binary_files

    files = binary_files(spark, path, where, options).select("path", "content")
    return frames(files, dimensions=dimensions, output_format=output_format)
