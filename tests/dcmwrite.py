"""Test-only DICOM writer for synthesised fixtures (the reference's sample
files are not available). Covers what the SQL encoder does not: implicit VR,
big endian, deflate, undefined lengths, encapsulated pixel data."""

from __future__ import annotations

import struct
import zlib

from medframe.dictionary import LONG_LENGTH_VRS

EXPLICIT_LE = "1.2.840.10008.1.2.1"
IMPLICIT_LE = "1.2.840.10008.1.2"
EXPLICIT_BE = "1.2.840.10008.1.2.2"
DEFLATED = "1.2.840.10008.1.2.1.99"
JPEG_BASELINE = "1.2.840.10008.1.2.4.50"
UNDEF = 0xFFFFFFFF


def pad(b: bytes, vr: str) -> bytes:
    if len(b) % 2:
        b += b"\x00" if vr in ("UI", "OB", "OW", "UN") else b" "
    return b


def text(s: str, vr: str, encoding="ascii") -> bytes:
    return pad(s.encode(encoding), vr)


def nums(fmt: str, *vals, le=True) -> bytes:
    return struct.pack(("<" if le else ">") + fmt * len(vals), *vals)


def element(tag: int, vr: str, value: bytes, explicit=True, le=True, undefined=False) -> bytes:
    e = "<" if le else ">"
    head = struct.pack(e + "HH", tag >> 16, tag & 0xFFFF)
    n = UNDEF if undefined else len(value)
    if explicit:
        if vr in LONG_LENGTH_VRS:
            return head + vr.encode() + b"\x00\x00" + struct.pack(e + "I", n) + value
        return head + vr.encode() + struct.pack(e + "H", n) + value
    return head + struct.pack(e + "I", n) + value


def item(data: bytes, undefined=False, le=True) -> bytes:
    e = "<" if le else ">"
    if undefined:
        return struct.pack(e + "HHI", 0xFFFE, 0xE000, UNDEF) + data + struct.pack(e + "HHI", 0xFFFE, 0xE00D, 0)
    return struct.pack(e + "HHI", 0xFFFE, 0xE000, len(data)) + data


def sequence(tag: int, items: list[bytes], explicit=True, le=True, undefined=False) -> bytes:
    e = "<" if le else ">"
    body = b"".join(items)
    if undefined:
        body += struct.pack(e + "HHI", 0xFFFE, 0xE0DD, 0)
    return element(tag, "SQ", body, explicit, le, undefined=undefined)


def meta(ts: str) -> bytes:
    body = (element(0x00020001, "OB", b"\x00\x01")
            + element(0x00020002, "UI", text("1.2.840.10008.5.1.4.1.1.2", "UI"))
            + element(0x00020003, "UI", text("1.2.3.4", "UI"))
            + element(0x00020010, "UI", text(ts, "UI")))
    return element(0x00020000, "UL", struct.pack("<I", len(body))) + body


def part10(dataset: bytes, ts: str = EXPLICIT_LE, preamble=True, with_meta=True) -> bytes:
    out = (b"\x00" * 128 + b"DICM") if preamble else b""
    if with_meta:
        out += meta(ts)
    if ts == DEFLATED:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        dataset = c.compress(dataset) + c.flush()
    return out + dataset


def ct_slice(rows=4, cols=4, frames=1) -> bytes:
    """A small CT-like file: the reference's golden patient/study values."""
    pixels = bytes((i * 7) % 256 for i in range(rows * cols * frames * 2))
    ds = (element(0x00080005, "CS", text("ISO_IR 100", "CS"))
          + element(0x00080018, "UI", text("1.2.3.4.5", "UI"))
          + element(0x00080020, "DA", text("20120706", "DA"))
          + element(0x00080030, "TM", text("111823.360000", "TM"))
          + element(0x00080060, "CS", text("CT", "CS"))
          + element(0x00100010, "PN", text("Pancreas-CT-CB_001", "PN"))
          + element(0x00100020, "LO", text("Pancreas-CT-CB_001", "LO"))
          + element(0x00280002, "US", nums("H", 1))
          + element(0x00280004, "CS", text("MONOCHROME2", "CS"))
          + element(0x00280008, "IS", text(str(frames), "IS"))
          + element(0x00280010, "US", nums("H", rows))
          + element(0x00280011, "US", nums("H", cols))
          + element(0x00280100, "US", nums("H", 16))
          + element(0x00280101, "US", nums("H", 12))
          + element(0x00280102, "US", nums("H", 11))
          + element(0x00280103, "US", nums("H", 0))
          + element(0x7FE00010, "OW", pixels))
    return part10(ds)
