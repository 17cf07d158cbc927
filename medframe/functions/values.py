"""Value decoding by VR in Python, for readers that return finished columns.

The same rules as the SQL expressions of ``medframe.functions.decode`` (tests
compare the two on generated values). ``finisher(vr)`` maps an element's raw
value to (column value, error text or None).
"""

from __future__ import annotations

import calendar
import functools
import re
from collections.abc import Callable

from medframe.dictionary import FLOAT_VRS, INT_VRS, LONG_VRS, MULTI_STRING_VRS
from medframe.functions import decode

_DAY = re.compile(r"[0-9]{8}\Z")
_DIGITS = re.compile(r"[0-9]*")
_TWO = re.compile(r"[0-9]{2}\Z")
_TIME = re.compile(r"[0-9]{6}(?:[.][0-9]{1,6})?\Z")


def first(text: str | None) -> str | None:
    """First backslash-separated value, spaces trimmed."""
    return None if text is None else text.split("\\", 1)[0].strip(" ")


def _failed(v: str, rest: str) -> tuple[None, str]:
    shown = v if len(v) <= 64 else v[:64] + "..."
    return None, f"{decode._PARSE_EXC}{shown}' could not be parsed{rest}"


@functools.lru_cache(maxsize=1 << 14)
def date(v: str | None) -> tuple[str | None, str | None]:
    """DA first value -> ISO date; days past the month's end become its last."""
    if not v:
        return "", None
    if not _DAY.match(v):
        lead = _DIGITS.match(v).end()
        if lead < 4 or lead > 8:
            return _failed(v, " at index 0")
        if not _TWO.match(v[4:6]):
            return _failed(v, " at index 4")
        if not _TWO.match(v[6:8]):
            return _failed(v, " at index 6")
        return _failed(v, ", unparsed text found at index 8")
    y, m, d = int(v[:4]), int(v[4:6]), int(v[6:])
    for bad, message, n in ((y == 0, decode._RANGE_YEAR_OF_ERA, y), (not 1 <= m <= 12, decode._RANGE_MONTH, m),
                            (not 1 <= d <= 31, decode._RANGE_DAY, d)):
        if bad:
            return _failed(v, f": {message}{n}")
    return f"{v[:4]}-{v[4:6]}-{min(d, calendar.monthrange(y, m)[1]):02d}", None


def _sections(v: str) -> tuple[int, str | None]:
    """(characters read, nine digits of the fraction) by the optional sections."""
    at, nano = 6, None
    for w in decode._TM_FRACTION_WIDTHS:
        digits = v[at + 1:at + 1 + w]
        if v[at:at + 1] == "." and len(digits) == w and digits.isascii() and digits.isdigit():
            padded = digits.ljust(9, "0")
            if nano is None or nano == padded:
                at, nano = at + 1 + w, padded
    return at, nano


@functools.lru_cache(maxsize=1 << 14)
def time(v: str | None) -> tuple[str | None, str | None]:
    """TM first value -> ISO time."""
    if not v:
        return "", None
    if _TIME.match(v):
        fraction = v[7:].rstrip("0")
    else:
        for i in (0, 2, 4):
            if not _TWO.match(v[i:i + 2]):
                return _failed(v, f" at index {i}")
        end, nano = _sections(v)
        if end < len(v):
            return _failed(v, f", unparsed text found at index {end}")
        fraction = (nano or "").rstrip("0")
    h, m, s = int(v[:2]), int(v[2:4]), int(v[4:6])
    if m > 59:
        return _failed(v, f": {decode._RANGE_MINUTE}{m}")
    if h == 24 and not (s or m or fraction):
        return "00:00:00", None
    if h > 23:
        return _failed(v, f": {decode._RANGE_HOUR}{h}")
    if s > 59:
        return _failed(v, f": {decode._RANGE_SECOND}{s}")
    return f"{v[:2]}:{v[2:4]}:{v[4:6]}" + (f".{fraction}" if fraction else ""), None


NO_NAME = {"Alphabetic": "", "Ideographic": "", "Phonetic": ""}


def person(v: str | None) -> dict:
    """PN first value -> its three groups, components trimmed."""
    groups = ["^".join(c.strip(" ") for c in g.split("^")).rstrip("^") for g in (v or "").split("=")[:3]]
    return dict(zip(NO_NAME, [*groups, "", ""]))


def _int32(values: list | None) -> list:
    return [((x + (1 << 31)) & 0xFFFFFFFF) - (1 << 31) for x in values or ()]


def finisher(vr: str) -> Callable:
    """raw value -> (column value, error)."""
    if vr in ("LT", "ST", "UT", "UR"):
        return lambda v: ((v or "").rstrip(" "), None)
    if vr == "PN":
        return lambda v: (person(first(v)), None)
    if vr == "DA":
        return lambda v: date(first(v))
    if vr == "TM":
        return lambda v: time(first(v))
    if vr in MULTI_STRING_VRS:
        return lambda v: (first(v) or "", None)
    if vr in INT_VRS:
        return lambda v: (_int32(v), None)
    if vr in FLOAT_VRS or vr in LONG_VRS:
        return lambda v: (v or [], None)
    if vr == "SQ":
        return lambda v: (v or "", None)
    return lambda v: (v, None)


def raw_kind(vr: str) -> str:
    """Which raw value a column of dictionary VR ``vr`` is made of: text, ints,
    doubles or bytes."""
    if vr in INT_VRS or vr in LONG_VRS:
        return "ints"
    if vr in FLOAT_VRS:
        return "dbls"
    if vr in MULTI_STRING_VRS or vr in ("LT", "ST", "UT", "UR", "PN", "DA", "TM", "SQ"):
        return "str"
    return "bin"
