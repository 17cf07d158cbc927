"""Image frames (I1-I3): PNG rows per frame."""

import struct
import zlib

import numpy as np

import dcmwrite as W
from medframe.operators import frames
from medframe.sources import dicom


def _decode_png(png: bytes):
    pos, idat = 8, b""
    while pos < len(png):
        n = struct.unpack(">I", png[pos:pos + 4])[0]
        kind = png[pos + 4:pos + 8]
        data = png[pos + 8:pos + 8 + n]
        if kind == b"IHDR":
            w, h, depth, color = struct.unpack(">IIBB", data[:10])
        elif kind == b"IDAT":
            idat += data
        pos += 12 + n
    raw = zlib.decompress(idat)
    bpp = (2 if depth == 16 else 1) * (3 if color == 2 else 1)
    rows = [raw[i * (w * bpp + 1) + 1:(i + 1) * (w * bpp + 1)] for i in range(h)]
    dtype = ">u2" if depth == 16 else np.uint8
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(h, w, -1).squeeze(-1) if color == 0 else \
        np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(h, w, 3)


def _gray8(rows, cols, nframes):
    px = bytes(range(rows * cols * nframes))
    ds = (W.element(0x00280002, "US", W.nums("H", 1)) + W.element(0x00280004, "CS", W.text("MONOCHROME2", "CS"))
          + W.element(0x00280008, "IS", W.text(str(nframes), "IS"))
          + W.element(0x00280010, "US", W.nums("H", rows)) + W.element(0x00280011, "US", W.nums("H", cols))
          + W.element(0x00280100, "US", W.nums("H", 8)) + W.element(0x00280103, "US", W.nums("H", 0))
          + W.element(0x7FE00010, "OB", W.pad(px, "OB")))
    return W.part10(ds), px


def test_frames_rows_and_pixels(spark, write_files):
    data, px = _gray8(3, 4, 2)
    d = write_files({"g.dcm": data, "ct.dcm": W.ct_slice(4, 5, 1), "bad.txt": b"nope"})
    files = dicom.binary_files(spark, d).select("path", "content")
    out = {(r.path.rsplit("/", 1)[1], r.frame): r for r in frames.frames(files).collect()}
    assert set(out) == {("g.dcm", 0), ("g.dcm", 1), ("ct.dcm", 0)}
    g1 = out[("g.dcm", 1)]
    assert (g1.height, g1.width) == (3, 4)
    assert _decode_png(g1.data).tobytes() == px[12:24]
    ct = _decode_png(out[("ct.dcm", 0)].data)
    assert ct.shape == (4, 5) and ct.dtype == np.dtype(">u2")


def test_rgb_frame(spark, write_files):
    px = bytes(range(2 * 2 * 3))
    ds = (W.element(0x00280002, "US", W.nums("H", 3)) + W.element(0x00280004, "CS", W.text("RGB", "CS"))
          + W.element(0x00280006, "US", W.nums("H", 0))
          + W.element(0x00280010, "US", W.nums("H", 2)) + W.element(0x00280011, "US", W.nums("H", 2))
          + W.element(0x00280100, "US", W.nums("H", 8)) + W.element(0x7FE00010, "OB", px))
    d = write_files({"rgb.dcm": W.part10(ds)})
    r = frames.frames(dicom.binary_files(spark, d).select("path", "content")).first()
    assert _decode_png(r.data).tobytes() == px


def test_to_image_udf(spark, write_files):
    data, _ = _gray8(2, 2, 3)
    d = write_files({"g.dcm": data, "x.txt": b"not dicom"})
    df = dicom.binary_files(spark, d).select("path", frames.to_image("content", spark=spark).alias("imgs"))
    got = {r.path.rsplit("/", 1)[1]: r.imgs for r in df.collect()}
    assert len(got["g.dcm"]) == 3 and got["x.txt"] == []
    assert got["g.dcm"][0].height is None


def test_compressed_pixel_data_gives_no_rows(spark, write_files):
    frag = W.item(b"") + W.item(b"\xff\xd8\xff\xd9")
    ds = (W.element(0x00280010, "US", W.nums("H", 2)) + W.element(0x00280011, "US", W.nums("H", 2))
          + W.element(0x7FE00010, "OB", frag + b"\xfe\xff\xdd\xe0\x00\x00\x00\x00", undefined=True))
    d = write_files({"j.dcm": W.part10(ds, W.JPEG_BASELINE)})
    assert frames.frames(dicom.binary_files(spark, d).select("path", "content")).count() == 0


def test_read_frames_from_path(spark, write_files):
    data, _ = _gray8(2, 3, 2)
    d = write_files({"g1.dcm": data, "g2.dcm": data})
    rows = frames.read_frames(spark, d).collect()
    assert len(rows) == 4 and {(r.height, r.width) for r in rows} == {(2, 3)}


def test_only_png_output():
    import pytest

    with pytest.raises(ValueError):
        frames.to_image("content", output_format="jpeg")


def test_big_endian_16_bit_frame(spark, write_files):
    vals = [0, 1, 256, 65535]
    e = lambda tag, vr, v: W.element(tag, vr, v, explicit=True, le=False)
    ds = (e(0x00280002, "US", W.nums("H", 1, le=False)) + e(0x00280010, "US", W.nums("H", 2, le=False))
          + e(0x00280011, "US", W.nums("H", 2, le=False)) + e(0x00280100, "US", W.nums("H", 16, le=False))
          + e(0x7FE00010, "OW", W.nums("H", *vals, le=False)))
    d = write_files({"be.dcm": W.part10(ds, W.EXPLICIT_BE)})
    r = frames.read_frames(spark, d).first()
    assert _decode_png(r.data).astype(int).ravel().tolist() == vals
