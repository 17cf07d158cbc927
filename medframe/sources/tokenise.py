"""DICOM byte tokeniser: one file's bytes -> its top-level elements.

This is the one piece of per-row custom code of the scan. It runs inside an
Arrow batch function (``mapInArrow``) on the executors; the driver never sees
file bytes. It reads PS3.10 files (preamble + ``DICM`` + file meta group) and
bare data sets, in explicit or implicit VR little endian, explicit VR big
endian and deflated explicit VR little endian; undefined lengths, nested
sequences and encapsulated pixel data (kept as fragments) are handled.

A file that cannot be read raises ``NotDicom``; the caller turns that into
``isDicom = false`` and keeps the row.
"""

from __future__ import annotations

import base64
import json
import struct
import sys
import zlib
from operator import attrgetter

from medframe.dictionary import LONG_LENGTH_VRS, SINGLE_VRS
from medframe.sources.charsets import DEFAULT, Charset, charset

# Fixed values from PS3.5 / PS3.10.
PIXEL_DATA = 0x7FE00010
ITEM = 0xFFFEE000
ITEM_DELIM = 0xFFFEE00D
SEQ_DELIM = 0xFFFEE0DD
UNDEFINED = 0xFFFFFFFF
TS_IMPLICIT_LE = "1.2.840.10008.1.2"
TS_EXPLICIT_LE = "1.2.840.10008.1.2.1"
TS_DEFLATED_LE = "1.2.840.10008.1.2.1.99"
TS_EXPLICIT_BE = "1.2.840.10008.1.2.2"
TEXT_VRS = frozenset("LT ST UT UR".split())
CHARSET_VRS = frozenset("LO LT PN SH ST UC UT".split())
STRINGISH_VRS = frozenset("AE AS CS DA DS DT IS LO LT PN SH ST TM UC UI UR UT".split())
BINARY_VRS = frozenset("OB OD OF OL OV OW UN".split())
_VALID_VR_CODES = frozenset(v.encode() for v in SINGLE_VRS)
_TAG = attrgetter("tag")


class NotDicom(Exception):
    pass


class Rejected(Exception):
    """A filter failed: the file's row is not wanted. ``tags``: elements read."""

    def __init__(self, tags: int):
        super().__init__(f"rejected after {tags} elements")
        self.tags = tags


# What bytes that are no DICOM data set can raise; anything else is a failure of the task.
PARSE_FAULTS = (NotDicom, struct.error, zlib.error, ValueError, IndexError)


class Elem:
    """One element: ``value`` is bytes, a list of item data sets (SQ), or a
    list of fragments (encapsulated pixel data)."""

    __slots__ = ("tag", "vr", "value", "le", "kind")

    def __init__(self, tag, vr, value, le, kind="bytes"):
        self.tag, self.vr, self.value, self.le, self.kind = tag, vr, value, le, kind


class Parsed:
    """``syntax``: the transfer syntax the file names, if it does; ``stopped``:
    parsing ended at PixelData (the rest was not read)."""

    __slots__ = ("syntax", "elements", "charset", "stopped")

    def __init__(self, syntax, elements, charset, stopped=False):
        self.syntax, self.elements, self.charset, self.stopped = syntax, elements, charset, stopped


def _implicit_vr(tag: int, vr_of) -> str:
    group, elem = tag >> 16, tag & 0xFFFF
    if elem == 0:
        return "UL"
    if group & 1 and 0x10 <= elem <= 0xFF:
        return "LO"  # private creator
    vr = vr_of(tag)
    if vr is None:
        return "UN"
    if vr in SINGLE_VRS:
        return vr
    if vr == "OB or OW":
        return "OW"
    return vr.split(" or ")[0] if " or " in vr else "UN"


_LE = (struct.Struct("<H").unpack_from, struct.Struct("<I").unpack_from, struct.Struct("<HH").unpack_from)
_BE = (struct.Struct(">H").unpack_from, struct.Struct(">I").unpack_from, struct.Struct(">HH").unpack_from)
# explicit VR element header in one read: group, element, VR code, 2-byte length
_HDR_LE = struct.Struct("<HH2sH").unpack_from
_HDR_BE = struct.Struct(">HH2sH").unpack_from
# VR code bytes -> (VR, uses a 4-byte length)
_VR_CODES = {v.encode(): (v, v in LONG_LENGTH_VRS) for v in SINGLE_VRS}


class _Reader:
    """Walks one data set with an explicit stack, so nesting has no limit.

    ``keep``: top-level tags to return (None: all). ``checks``: top-level tag ->
    function(element, elements before it); the first element of a tag that
    fails its check ends the walk with ``Rejected``."""

    def __init__(self, buf, explicit, le, vr_of, stop_at_pixel, keep=None, checks=None):
        self.keep = keep
        self.checks = dict(checks) if checks else None
        self.buf = buf
        self.explicit = explicit
        self.le = le
        self.vr_of = vr_of
        self.stop_at_pixel = stop_at_pixel
        self.stopped = False

    def dataset(self, pos, end, top=False):
        """Elements from ``pos`` to ``end`` and the position after them.

        ``out`` collects the innermost open data set. ``open_`` holds, for every
        data set around it, what to go on with: its elements, its end, whether
        an item delimiter ends it, and the sequence that is being read: the
        element, where it ends, whether a delimiter ends it, and the encoding
        around it."""
        buf, vr_of = self.buf, self.vr_of
        explicit, le = self.explicit, self.le
        u32, tagf = (_LE if le else _BE)[1:]
        hdr = _HDR_LE if le else _HDR_BE
        stop_pixel = top and self.stop_at_pixel
        keep = self.keep if top else None
        checks = self.checks if top else None
        out: list = []
        append = out.append
        delimited = False           # the open item ends with a delimiter
        open_: list = []
        items = None                # items of the sequence whose next item is due
        while True:
            if items is not None:
                # between the items of the innermost sequence
                stop, seq_delimited = open_[-1][4:6]
                if pos < stop:
                    if pos + 8 > stop:
                        raise NotDicom("truncated item")
                    g, el = tagf(buf, pos)
                    length = u32(buf, pos + 4)[0]
                    pos += 8
                    if (g << 16) | el == ITEM:
                        delimited = length == UNDEFINED
                        end = stop if delimited else pos + length
                        if end > stop:
                            raise NotDicom("truncated item")
                        out = []
                        append = out.append
                        items.append(out)
                        items = None
                        continue
                    if (g << 16) | el != SEQ_DELIM:
                        raise NotDicom("expected item")
                    if not seq_delimited:
                        pos = stop
                elif seq_delimited:
                    raise NotDicom("unterminated sequence")
                # the sequence is complete
                out, end, delimited, elem, _, _, explicit, le, keep, checks = open_.pop()
                u32, tagf = (_LE if le else _BE)[1:]
                hdr = _HDR_LE if le else _HDR_BE
                append = out.append
                if elem is not None:
                    append(elem)
                items = None
                continue
            if pos >= end:
                if not open_:
                    return out, pos
                if delimited:
                    raise NotDicom("unterminated item")
                items = open_[-1][3].value if open_[-1][3] is not None else []
                continue
            if pos + 8 > end:
                raise NotDicom("truncated element header")
            if explicit:
                g, el, code, length = hdr(buf, pos)
            else:
                g, el = tagf(buf, pos)
            tag = (g << 16) | el
            if g == 0xFFFE:
                if tag != ITEM_DELIM:
                    raise NotDicom("unexpected delimiter")
                if not open_:
                    raise NotDicom("stray item delimiter")
                pos = pos + 8 if delimited else end
                items = open_[-1][3].value if open_[-1][3] is not None else []
                continue
            if stop_pixel and tag == PIXEL_DATA and not open_:
                self.stopped = True
                return out, end
            if explicit:
                hit = _VR_CODES.get(code)
                if hit is None:
                    raise NotDicom("invalid VR")
                vr, long_len = hit
                if long_len:
                    if pos + 12 > end:
                        raise NotDicom("truncated element header")
                    length = u32(buf, pos + 8)[0]
                    pos += 12
                else:
                    pos += 8
            else:
                vr = _implicit_vr(tag, vr_of)
                length = u32(buf, pos + 4)[0]
                pos += 8
            if length == UNDEFINED:
                if (vr in ("OB", "OW") and explicit) or (tag == PIXEL_DATA and (vr in ("SQ", "UN") or not explicit)):
                    frags, pos = self.fragments(pos, end, tagf, u32)
                    append(Elem(tag, vr, frags, le, "fragments"))
                    continue
                if vr not in ("SQ", "UN") and explicit:
                    raise NotDicom("undefined length on a non-sequence")
                elem = Elem(tag, "SQ", [], le, "items")
                open_.append((out, end, delimited, elem, end, True, explicit, le, keep, checks))
                items, keep, checks = elem.value, None, None
                if vr == "UN" and explicit:  # encoded as implicit VR little endian
                    explicit, le = False, True
                    u32, tagf = _LE[1:]
                continue
            nxt = pos + length
            if nxt > end:
                raise NotDicom("truncated value")
            if vr == "SQ":
                # a broken sequence makes the file invalid, requested or not
                elem = Elem(tag, vr, [], le, "items") if keep is None or tag in keep else None
                open_.append((out, end, delimited, elem, nxt, False, explicit, le, keep, checks))
                items, keep, checks = [] if elem is None else elem.value, None, None
                continue
            if keep is not None and tag not in keep:
                pos = nxt  # not requested: skipped without a copy
                continue
            elem = Elem(tag, vr, bytes(buf[pos:nxt]), le)
            if checks is not None and tag in checks and not checks.pop(tag)(elem, out):
                raise Rejected(len(out) + 1)
            append(elem)
            pos = nxt

    def fragments(self, pos, end, tagf, u32):
        frags = []
        while True:
            if pos + 8 > end:
                raise NotDicom("truncated fragment")
            g, el = tagf(self.buf, pos)
            tag = (g << 16) | el
            flen = u32(self.buf, pos + 4)[0]
            pos += 8
            if tag == SEQ_DELIM:
                return frags, pos
            if tag != ITEM or flen == UNDEFINED or pos + flen > end:
                raise NotDicom("bad fragment")
            frags.append(bytes(self.buf[pos : pos + flen]))
            pos += flen


def _guess(buf, vr_of):
    """Transfer syntax of a stream without a file meta header, or None."""
    if len(buf) < 8:
        return None
    for le in (True, False):
        g, e = struct.unpack_from("<HH" if le else ">HH", buf, 0)
        tag = (g << 16) | e
        dict_vr = vr_of(tag) or ("UL" if e == 0 else None)  # group lengths are UL
        code = bytes(buf[4:6])
        if code in _VALID_VR_CODES and (dict_vr is not None or g == 0x0002):
            if dict_vr is None or code.decode() in dict_vr or g == 0x0002:
                return (True, le)
        if dict_vr is not None:
            length = struct.unpack_from("<I" if le else ">I", buf, 4)[0]
            if length <= len(buf) - 8 or length == UNDEFINED:
                return (False, le)
    return None


def _meta(buf, pos) -> tuple[int, str | None]:
    """Walks the file meta group: (where the data set starts, transfer syntax)."""
    end, syntax = len(buf), None
    while pos + 8 <= end:
        g, el, code, length = _HDR_LE(buf, pos)
        if g != 0x0002:
            return pos, syntax
        hit = _VR_CODES.get(code)
        if hit is None:
            raise NotDicom("invalid VR")
        pos += 8
        if hit[1]:
            if pos + 4 > end:
                raise NotDicom("truncated element header")
            length = _LE[1](buf, pos)[0]
            pos += 4
        if pos + length > end:
            raise NotDicom("truncated value")
        if el == 0x0010 and syntax is None:
            syntax = bytes(buf[pos:pos + length]).decode("ascii", "replace").rstrip("\x00 ")
        pos += length
    if pos < end:
        raise NotDicom("truncated element header")
    return pos, syntax


def parse(data: bytes, vr_of, stop_at_pixel: bool = True, keep=None, checks=None) -> Parsed:
    """Parse one file. ``vr_of(tag) -> dictionary VR or None``; ``keep``: the
    top-level tags to return (others with a defined length are skipped
    without a copy; the character set is always kept); ``checks``: see
    ``_Reader``."""
    if keep is not None:
        keep = frozenset(keep) | {0x00080005} | frozenset(checks or ())
    buf = memoryview(data)
    pos = 132 if bytes(buf[128:132]) == b"DICM" else 0
    named = None
    if len(buf) >= pos + 8 and _LE[0](buf, pos)[0] == 0x0002 and bytes(buf[pos + 4 : pos + 6]) in _VR_CODES:
        pos, named = _meta(buf, pos)
        ts = named or TS_EXPLICIT_LE
    elif pos == 132:
        ts = TS_EXPLICIT_LE
    else:
        guess = _guess(buf, vr_of)
        if guess is None:
            raise NotDicom("not a DICOM stream")
        ts = {(True, True): TS_EXPLICIT_LE, (False, True): TS_IMPLICIT_LE,
              (True, False): TS_EXPLICIT_BE, (False, False): TS_IMPLICIT_LE}[guess]
    explicit, le = True, True
    if ts == TS_IMPLICIT_LE:
        explicit = False
    elif ts == TS_EXPLICIT_BE:
        le = False
    elif ts == TS_DEFLATED_LE:
        inflated = zlib.decompressobj(-zlib.MAX_WBITS).decompress(bytes(buf[pos:]))
        buf, pos = memoryview(inflated), 0
    reader = _Reader(buf, explicit, le, vr_of, stop_at_pixel, keep, checks)
    elements, _ = reader.dataset(pos, len(buf), top=True)
    elements.sort(key=_TAG)
    return Parsed(named, elements, charset_of(elements), reader.stopped)


def charset_of(elements, inherited: Charset = DEFAULT) -> Charset:
    """The character set of a data set; items without one inherit it."""
    for e in elements:
        if e.tag == 0x00080005 and e.kind == "bytes":
            return charset(e.value.decode("ascii", "replace").rstrip("\x00 "))
        if e.tag > 0x00080005:
            break
    return inherited


# ----------------------------------------------------------------- values


# native item codes of little-endian integers, for values of a whole number of items
_NATIVE = {"US": ("H", 2), "SS": ("h", 2), "UL": ("i", 4), "SL": ("i", 4), "UV": ("q", 8), "SV": ("q", 8),
           "FL": ("f", 4), "FD": ("d", 8)} if sys.byteorder == "little" else {}


def _numbers(e: Elem):
    v, vr = e.value, e.vr
    if e.le and (native := _NATIVE.get(vr)) and len(v) % native[1] == 0:
        return memoryview(v).cast(native[0]).tolist()
    end = "<" if e.le else ">"
    if vr == "US":
        return list(struct.unpack(f"{end}{len(v) // 2}H", v[: len(v) // 2 * 2]))
    if vr == "SS":
        return list(struct.unpack(f"{end}{len(v) // 2}h", v[: len(v) // 2 * 2]))
    if vr in ("SL", "UL"):  # UL wraps to signed 32-bit, as the JVM int does
        return list(struct.unpack(f"{end}{len(v) // 4}i", v[: len(v) // 4 * 4]))
    if vr in ("SV", "UV"):  # UV wraps to signed 64-bit
        return list(struct.unpack(f"{end}{len(v) // 8}q", v[: len(v) // 8 * 8]))
    if vr == "FL":
        return list(struct.unpack(f"{end}{len(v) // 4}f", v[: len(v) // 4 * 4]))
    if vr == "FD":
        return list(struct.unpack(f"{end}{len(v) // 8}d", v[: len(v) // 8 * 8]))
    return None


def _unsigned(e: Elem):
    v, end = e.value, "<" if e.le else ">"
    if e.vr == "UL":
        return list(struct.unpack(f"{end}{len(v) // 4}I", v[: len(v) // 4 * 4]))
    if e.vr == "UV":
        return list(struct.unpack(f"{end}{len(v) // 8}Q", v[: len(v) // 8 * 8]))
    return _numbers(e)


def _at_values(e: Elem):
    v, end = e.value, "<" if e.le else ">"
    n = len(v) // 4
    pairs = struct.unpack(f"{end}{n * 2}H", v[: n * 4])
    return [f"{pairs[i]:04X}{pairs[i + 1]:04X}" for i in range(0, len(pairs), 2)]


def element_text(e: Elem, cs: Charset, faults: list | None = None) -> str | None:
    """All values of an element as DICOM text (backslash-separated). Bytes that
    its character set has no text for become U+FFFD and are told in ``faults``."""
    if e.kind != "bytes":
        return None
    vr = e.vr
    if vr in STRINGISH_VRS:
        text, whole = (cs if vr in CHARSET_VRS else DEFAULT).decode(e.value, vr == "PN")
        if not whole and faults is not None:
            faults.append(f"java.nio.charset.CharacterCodingException: {cs.name if vr in CHARSET_VRS else DEFAULT.name}")
        return text.rstrip("\x00 ")
    if vr == "AT":
        return "\\".join(_at_values(e))
    nums = _numbers(e)
    if nums is not None:
        return "\\".join(_num_text(x) for x in nums)
    return None


def _num_text(x):
    if isinstance(x, float):
        return repr(x)
    return str(x)


def slot(e: Elem, dict_vr: str | None, cs: Charset, item_json, faults: list | None = None):
    """Typed slot ``(vr, str, ints, dbls, bin)`` for the decoder.

    A known element stored as UN is read with its dictionary VR (UN values
    are little endian, PS3.5 6.2.2). ``faults`` collects what could only be
    read in part."""
    vr = e.vr
    target = dict_vr if dict_vr in SINGLE_VRS else vr
    if vr == "UN" and e.kind == "bytes" and target not in ("UN", "SQ"):
        e = Elem(e.tag, target, e.value, True)
    if e.kind == "items":
        return (vr, item_json(e.value), None, None, None)
    if e.kind == "fragments":
        return (vr, None, None, None, None)
    s = ints = dbls = b = None
    if target in ("SL", "SS", "US", "UL", "SV", "UV"):
        ints = (_numbers(e) if vr in ("SL", "SS", "US", "UL", "SV", "UV")
                else _parse_ints(e, cs, 64 if target in ("SV", "UV") else 32))
    elif target in ("FL", "FD"):
        if vr in ("FL", "FD"):
            dbls = _numbers(e)
        elif vr in ("SL", "SS", "US", "UL", "SV", "UV"):
            dbls = [float(x) for x in _numbers(e)]
        else:
            dbls = _parse_floats(e, cs)
    elif target in BINARY_VRS or target == "SQ":
        b = e.value
    else:
        s = element_text(e, cs, faults)
        if s is None:
            b = e.value
    return (vr, s, ints, dbls, b)


class ConversionError(ValueError):
    """A value that does not convert; ``java`` is the JVM-style message."""

    def __init__(self, java: str):
        super().__init__(java)
        self.java = java


def _number_error(part: str) -> ConversionError:
    return ConversionError(f'java.lang.NumberFormatException: For input string: "{part}"')


def _parse_ints(e, cs, bits):
    text = element_text(e, cs) or ""
    out = []
    for part in text.split("\\"):
        part = part.strip()
        if part:
            if part.lstrip("+-").isdigit():
                value = int(part) if len(part) <= 20 else 1 << 64
                if not -(1 << bits - 1) <= value < 1 << bits - 1:
                    raise _number_error(part)
                out.append(value)
            else:
                raise _number_error(part)
    return out


def _parse_floats(e, cs):
    text = element_text(e, cs) or ""
    out = []
    for part in (x.strip() for x in text.split("\\")):
        if part:
            try:
                out.append(float(part))
            except ValueError:
                raise _number_error(part) from None
    return out


def error_text(exc: Exception) -> str:
    """JVM-style text of a value conversion failure."""
    if isinstance(exc, ConversionError):
        return exc.java
    return f"java.lang.IllegalArgumentException: {exc}"


# ----------------------------------------------------------------- DICOM JSON


def _json_value(e: Elem, cs: Charset):
    """DICOM JSON (PS3.18 F.2) object for an element that is no sequence."""
    vr = e.vr
    out = {"vr": vr}
    if e.kind == "fragments":
        return out
    v = e.value
    if len(v) == 0:
        return out
    if vr in BINARY_VRS:
        out["InlineBinary"] = base64.b64encode(v).decode("ascii")
        return out
    if vr == "PN":
        vals = []
        for name in element_text(e, cs).split("\\"):
            groups = name.split("=")
            obj = {}
            for label, g in zip(("Alphabetic", "Ideographic", "Phonetic"), groups):
                if g:
                    obj[label] = g
            vals.append(obj if obj else None)
        out["Value"] = vals
        return out
    if vr in ("IS", "DS"):
        vals = []
        for part in element_text(e, cs).split("\\"):
            part = part.strip()
            if not part:
                vals.append(None)
                continue
            try:
                vals.append(int(part) if vr == "IS" else _ds_number(part))
            except ValueError:
                vals.append(part)
        out["Value"] = vals
        return out
    if vr in ("US", "UL", "UV", "SS", "SL", "SV", "FL", "FD"):
        # JSON has no infinity or not-a-number: null
        out["Value"] = [None if isinstance(x, float) and x - x != 0 else x for x in _unsigned(e)]
        return out
    if vr == "AT":
        out["Value"] = _at_values(e)
        return out
    text = element_text(e, cs)
    parts = [text] if vr in TEXT_VRS else text.split("\\")
    out["Value"] = [p if p != "" else None for p in parts]
    return out


def _ds_number(s):
    f = float(s)
    if f - f != 0:  # infinite or not a number: kept as text
        raise ValueError(s)
    return int(f) if f.is_integer() and "e" not in s.lower() and "." not in s else f


def _to_json(obj) -> str:
    return json.dumps(obj, separators=(",", ":"), ensure_ascii=False)


def json_text(elements, cs: Charset, key_of) -> str:
    """DICOM JSON object of a data set, sequences at every depth."""
    return _json_parts([(elements, cs)], key_of)


def items_text(items, cs: Charset, key_of) -> str:
    """DICOM JSON array of a sequence's items."""
    return _json_parts(_between("[", [(item, cs) for item in items], "]"), key_of)


def _between(start: str, parts: list, end: str) -> list:
    out: list = [start]
    for i, part in enumerate(parts):
        if i:
            out.append(",")
        out.append(part)
    out.append(end)
    return out


def _json_parts(todo: list, key_of) -> str:
    """Texts as they are; (elements, inherited character set) as objects. Works
    on a stack of what is still to be written, so depth has no limit."""
    out = []
    stack = todo[::-1]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
            continue
        elements, cs = part
        by_tag = {e.tag: e for e in sorted(elements, key=_TAG)}
        cs = charset_of(by_tag.values(), cs)
        parts: list = ["{"]
        for i, e in enumerate(by_tag.values()):
            parts.append(f'{"," if i else ""}"{key_of(e.tag)}":')
            if e.kind != "items":
                parts.append(_to_json(_json_value(e, cs)))
            elif not e.value:
                parts.append(f'{{"vr":"{e.vr}"}}')
            else:
                parts += _between(f'{{"vr":"{e.vr}","Value":[', [(item, cs) for item in e.value], "]}")
        parts.append("}")
        stack.extend(reversed(parts))
    return "".join(out)


def hex_key(tag: int) -> str:
    return f"{tag:08X}"
