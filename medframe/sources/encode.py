"""Encode table rows as DICOM Part-10 files (explicit VR little endian).

The inverse of the decoders (V12). The values of an element are a typed column
(text, integers, doubles or bytes); one Arrow function per batch lays out all
files of the batch in one buffer: lengths give every element's place, and
headers and values are copied there by numpy, without a loop over rows. Items of
sequences are SQL expressions of hex text (``item``), the values of an SQ.

A null value leaves the attribute out of the file; ``''`` writes it empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from medframe import dictionary as dictmod
from medframe import ship
from medframe.dictionary import LONG_LENGTH_VRS
from medframe.functions.decode import sql_str

# Fixed values from PS3.10 / PS3.5.
PREAMBLE_HEX = "00" * 128 + "4449434D"  # 128 zero bytes + "DICM"
EXPLICIT_LE_UID = "1.2.840.10008.1.2.1"
SECONDARY_CAPTURE_UID = "1.2.840.10008.5.1.4.1.1.7"
IMPLEMENTATION_UID = "2.25.384610297450196832147"

_INT_WIDTH = {"US": 2, "SS": 2, "UL": 4, "SL": 4, "SV": 8, "UV": 8}


@dataclass
class Attr:
    """One element to write: ``value`` is an SQL expression.

    str VRs take a string (values joined by a backslash); US SS UL SL SV UV
    take an integer or an array of integers; FL FD an array of doubles; AT an
    integer tag; OB OW UN binary; SQ an array of item hex strings (``item()``).
    """

    tag: int
    vr: str
    value: str
    multi: bool = False  # numeric/AT value is an array expression


def attr(keyword_or_tag, value: str, vr: str | None = None, multi: bool = False) -> Attr:
    d = dictmod.active()
    if isinstance(keyword_or_tag, int):
        tag = keyword_or_tag
        e = d.by_tag.get(tag)
    else:
        e = d.by_keyword[keyword_or_tag]
        tag = e.tag
    vr = vr or (e.single_vr if e else "UN")
    return Attr(tag, vr, value, multi)


def _le_hex(x: str, nbytes: int) -> str:
    """Little-endian hex of an integer SQL expression (two's complement).

    Bytes are swapped arithmetically, so ``x`` is a cheap reference repeated
    per byte rather than a string expression rebuilt per byte."""
    v = f"cast({x} as bigint)"
    parts = [
        f"shiftleft(shiftright({v}, {8 * i}) & 255, {8 * (nbytes - 1 - i)})" if i else
        f"shiftleft({v} & 255, {8 * (nbytes - 1)})"
        for i in range(nbytes)
    ]
    return f"lpad(hex({' | '.join(parts)}), {2 * nbytes}, '0')"


def _tag_hex(tag: int) -> str:
    g, e = tag >> 16, tag & 0xFFFF
    return f"{g & 0xFF:02X}{g >> 8:02X}{e & 0xFF:02X}{e >> 8:02X}"


def value_hex(a: Attr) -> str:
    """SQL hex text of the (even-length) value of an item's element; null when absent."""
    vr, v = a.vr, a.value
    if vr in _INT_WIDTH or vr == "AT":
        arr = v if a.multi else f"array({v})"
        if vr == "AT":
            one = f"concat({_le_hex('shiftright(x, 16)', 2)}, {_le_hex('x & 65535', 2)})"
        else:
            one = _le_hex("x", _INT_WIDTH[vr])
        return f"(case when {v} is null then null else array_join(transform({arr}, x -> {one}), '') end)"
    if vr in ("FL", "FD"):
        raise ValueError(f"{vr} values inside sequence items are not supported")
    if vr == "SQ":
        items = f"transform({v}, it -> concat('FEFF00E0', {_le_hex('length(it) div 2', 4)}, it))"
        return f"array_join({items}, '')"
    if vr in ("OB", "OW", "OD", "OF", "OL", "OV", "UN"):
        h = f"hex({v})"
        return f"concat({h}, if(length({h}) % 4 = 2, '00', ''))"
    pad = "00" if vr == "UI" else "20"
    h = f"hex(encode({v}, 'UTF-8'))"
    return f"concat({h}, if(length({h}) % 4 = 2, '{pad}', ''))"


def element_hex(a: Attr, vh: str) -> str:
    """Full element hex (tag, VR, length, value); null when the value is null."""
    vr_hex = a.vr.encode("ascii").hex().upper()
    n = f"(length({vh}) div 2)"
    if a.vr in LONG_LENGTH_VRS:
        length = f"concat('0000', {_le_hex(n, 4)})"
    else:
        length = _le_hex(n, 2)
    return f"concat('{_tag_hex(a.tag)}{vr_hex}', {length}, {vh})"


def _element_hex_bound(a: Attr) -> str:
    """``element_hex`` with the value hex evaluated once: it is bound to a
    lambda variable, since inside conditional branches Spark's common
    subexpression elimination would not merge the two uses."""
    return f"element_at(transform(array({value_hex(a)}), v -> {element_hex(a, 'v')}), 1)"


def item(attrs: list[Attr]) -> str:
    """SQL hex text of one sequence item's data set (for an SQ ``value``)."""
    parts = [f"coalesce({_element_hex_bound(a)}, '')" for a in sorted(attrs, key=lambda x: x.tag)]
    return "concat(" + ", ".join(parts) + ")" if parts else "''"


def _meta_hex() -> str:
    elems = [
        Attr(0x00020001, "OB", ""),
        Attr(0x00020002, "UI", ""),
        Attr(0x00020010, "UI", ""),
        Attr(0x00020012, "UI", ""),
    ]
    values = ["0001", _str_hex(SECONDARY_CAPTURE_UID, "00"), _str_hex(EXPLICIT_LE_UID, "00"),
              _str_hex(IMPLEMENTATION_UID, "00")]
    body = ""
    for a, vh in zip(elems, values):
        body += _static_element(a, vh)
    group_len = len(body) // 2
    head = _static_element(Attr(0x00020000, "UL", ""), group_len.to_bytes(4, "little").hex().upper())
    return head + body


def _str_hex(s: str, pad: str) -> str:
    h = s.encode("ascii").hex().upper()
    return h + (pad if len(h) % 4 == 2 else "")


def _static_element(a: Attr, vh: str) -> str:
    n = len(vh) // 2
    vr_hex = a.vr.encode("ascii").hex().upper()
    if a.vr in LONG_LENGTH_VRS:
        length = "0000" + n.to_bytes(4, "little").hex().upper()
    else:
        length = n.to_bytes(2, "little").hex().upper()
    return f"{_tag_hex(a.tag)}{vr_hex}{length}{vh}"


META_HEX = _meta_hex()


def file_length(elements_bytes: int) -> int:
    """Bytes of a file whose data set takes ``elements_bytes`` bytes."""
    return len(PREAMBLE_HEX) // 2 + len(META_HEX) // 2 + elements_bytes


# How numbers of a VR are stored (little endian).
_NUMBERS = {"US": "<u2", "SS": "<i2", "UL": "<u4", "SL": "<i4", "SV": "<i8", "UV": "<u8", "FL": "<f4", "FD": "<f8"}
_BYTES_VRS = frozenset("OB OW OD OF OL OV UN".split())


def _typed(a: Attr) -> str:
    """SQL of the column that the builder takes for ``a``."""
    if a.vr in ("FL", "FD"):
        return f"cast({a.value} as array<double>)"
    if a.vr in _NUMBERS or a.vr == "AT":
        if a.multi:
            return f"cast({a.value} as array<bigint>)"
        return f"if(({a.value}) is null, null, array(cast({a.value} as bigint)))"
    if a.vr == "SQ":
        return f"cast({a.value} as array<string>)"
    return f"cast({a.value} as {'binary' if a.vr in _BYTES_VRS else 'string'})"


class Ragged:
    """Values of a column: bytes of all rows, and per row how many; absent rows."""

    def __init__(self, lengths: np.ndarray, flat: np.ndarray, present: np.ndarray):
        self.lengths, self.flat, self.present = lengths, flat, present


def _offsets(arr: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_binary(arr.type) or pa.types.is_large_list(arr.type)
    raw = np.frombuffer(arr.buffers()[1], dtype=np.int64 if wide else np.int32)
    return raw[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)


def ragged(arr: pa.Array, vr: str) -> Ragged:
    present = np.asarray(arr.is_valid())
    if vr == "SQ":
        rows = [b"" if r is None else b"".join(
            b"\xfe\xff\x00\xe0" + (len(h) // 2).to_bytes(4, "little") + bytes.fromhex(h) for h in r) for r in arr.to_pylist()]
        return Ragged(np.array([len(r) for r in rows], dtype=np.int64), np.frombuffer(b"".join(rows), dtype=np.uint8), present)
    if vr in _NUMBERS or vr == "AT":
        arr = arr.fill_null([])
        at = _offsets(arr)
        numbers = arr.values.fill_null(0).to_numpy(zero_copy_only=False)[at[0]:at[-1]]
        if vr == "AT":
            stored = np.stack([numbers >> 16, numbers & 0xFFFF], axis=1).astype("<u2") if len(numbers) else np.zeros((0, 2), "<u2")
            width = 4
        elif vr in ("FL", "FD"):
            stored = numbers.astype(_NUMBERS[vr])
            width = stored.itemsize
        else:
            stored = numbers.astype(np.int64).astype(_NUMBERS[vr])  # wraps, as a cast does
            width = stored.itemsize
        return Ragged(np.diff(at) * width, np.frombuffer(stored.tobytes(), dtype=np.uint8), present)
    if not (pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)):
        arr = arr.cast(pa.large_binary() if pa.types.is_large_string(arr.type) else pa.binary())
    arr = arr.fill_null(b"")
    at = _offsets(arr)
    data = arr.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Ragged(np.diff(at), flat, present)


def _header(a: Attr, lengths: np.ndarray) -> np.ndarray:
    """The element headers, a row each."""
    long = a.vr in LONG_LENGTH_VRS
    fixed = bytes.fromhex(_tag_hex(a.tag)) + a.vr.encode("ascii") + (b"\0\0" if long else b"")
    if not long and len(lengths) and lengths.max() > 0xFFFF:
        raise ValueError(f"{a.tag:08X}: a value of {lengths.max()} bytes is too long for {a.vr}")
    sizes = lengths.astype("<u4" if long else "<u2")
    out = np.empty((len(lengths), len(fixed) + sizes.itemsize), dtype=np.uint8)
    out[:, :len(fixed)] = np.frombuffer(fixed, dtype=np.uint8)
    out[:, len(fixed):] = sizes.view(np.uint8).reshape(len(lengths), -1)
    return out


def build(attrs: list[Attr], prefix: bytes, columns: list[pa.Array]) -> pa.Array:
    """One file per row: ``prefix``, then the present elements in order."""
    n = len(columns[0])
    values = [ragged(c, a.vr) for a, c in zip(attrs, columns)]
    headers, sizes = [], []
    for a, v in zip(attrs, values):
        padded = v.lengths + v.lengths % 2
        headers.append(_header(a, padded))
        sizes.append(np.where(v.present, headers[-1].shape[1] + padded, 0))
    total = np.full(n, len(prefix), dtype=np.int64) + sum(sizes)
    at = np.concatenate(([0], np.cumsum(total)))
    if at[-1] >= 1 << 31:
        raise ValueError("a batch of files beyond 2 GiB: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    out = np.empty(at[-1], dtype=np.uint8)
    place = at[:-1].copy()
    if prefix:
        out[place[:, None] + np.arange(len(prefix))] = np.frombuffer(prefix, dtype=np.uint8)
    place += len(prefix)
    for a, v, head, size in zip(attrs, values, headers, sizes):
        rows = np.flatnonzero(v.present)
        out[place[rows][:, None] + np.arange(head.shape[1])] = head[rows]
        start = place + head.shape[1]
        first = np.cumsum(v.lengths) - v.lengths
        out[np.repeat(start - first, v.lengths) + np.arange(len(v.flat))] = v.flat
        odd = np.flatnonzero(v.present & (v.lengths % 2 == 1))
        out[start[odd] + v.lengths[odd]] = 0 if a.vr == "UI" or a.vr in _BYTES_VRS else 0x20
        place += size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out)])


# Files laid out together, whatever the session's batch size: each byte has indices of
# 8 bytes meanwhile.
BUILD_ROWS = 1024


def build_parts(attrs: list[Attr], prefix: bytes, columns: list[pa.Array]) -> pa.Array:
    """``build``, so many rows at once."""
    parts = [build(attrs, prefix, [c.slice(i, BUILD_ROWS) for c in columns])
             for i in range(0, len(columns[0]), BUILD_ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def encode(df: DataFrame, attrs: list[Attr], part10: bool = True, name: str = "content") -> DataFrame:
    """Add a binary column ``name`` holding one DICOM file per row."""
    ship.ensure(df.sparkSession)
    attrs = sorted(attrs, key=lambda x: x.tag)
    prefix = bytes.fromhex(PREAMBLE_HEX + META_HEX) if part10 else b""
    if not attrs:
        return df.withColumn(name, F.lit(prefix))

    @F.arrow_udf(BinaryType())
    def files(*columns: pa.Array) -> pa.Array:
        return build_parts(attrs, prefix, list(columns))

    return df.withColumn(name, files(*[F.expr(_typed(a)) for a in attrs]))


def text_file(text_sql: str) -> Column:
    """Bytes of a plain text file (not DICOM), for mixed inputs."""
    return F.expr(f"encode({text_sql}, 'UTF-8')")


__all__ = ["Attr", "attr", "encode", "item", "text_file", "file_length", "sql_str"]
