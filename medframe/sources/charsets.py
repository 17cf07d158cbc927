"""Character sets of DICOM text (PS3.5 6.1, PS3.3 C.12.1.1.2).

``Specific Character Set`` names one set, or several with code extensions
(ISO 2022): then escape sequences inside a value switch the set for the low (G0)
or high (G1) bytes, and each value, each component or group of a person name and
each line starts again with the first set. Bytes for which the current set has no
text become U+FFFD, and the caller is told.
"""

from __future__ import annotations

import functools
import re

# Defined terms -> Python codec of the set.
SINGLE = {
    "": "ascii",
    "ISO_IR 6": "ascii",
    "ISO_IR 100": "latin-1",
    "ISO_IR 101": "iso8859_2",
    "ISO_IR 109": "iso8859_3",
    "ISO_IR 110": "iso8859_4",
    "ISO_IR 144": "iso8859_5",
    "ISO_IR 127": "iso8859_6",
    "ISO_IR 126": "iso8859_7",
    "ISO_IR 138": "iso8859_8",
    "ISO_IR 148": "iso8859_9",
    "ISO_IR 203": "iso8859_15",
    "ISO_IR 13": "shift_jis",
    "ISO_IR 166": "tis-620",
    "ISO_IR 192": "utf-8",
    "GB18030": "gb18030",
    "GBK": "gbk",
}
# Escape sequence (without ESC) -> (G0 or G1, codec, bytes a character).
ESCAPES = {
    b"(B": (0, "ascii", 1),
    b"(J": (0, "ascii", 1),
    b")I": (1, "shift_jis", 1),
    b"-A": (1, "latin-1", 1),
    b"-B": (1, "iso8859_2", 1),
    b"-C": (1, "iso8859_3", 1),
    b"-D": (1, "iso8859_4", 1),
    b"-L": (1, "iso8859_5", 1),
    b"-G": (1, "iso8859_6", 1),
    b"-F": (1, "iso8859_7", 1),
    b"-H": (1, "iso8859_8", 1),
    b"-M": (1, "iso8859_9", 1),
    b"-b": (1, "iso8859_15", 1),
    b"-T": (1, "tis-620", 1),
    b"$B": (0, "$B", 2),
    b"$@": (0, "$@", 2),
    b"$(D": (0, "$(D", 2),
    b"$)C": (1, "euc_kr", 2),
    b"$)A": (1, "gb2312", 2),
}
_ESCAPE = re.compile(rb"\x1b([\x20-\x2f]*[\x30-\x7e])")
_LINE = re.compile(rb"([\\\t\n\f\r])")
_NAME = re.compile(rb"([\\\t\n\f\r^=])")


def _codec(data: bytes, codec: str) -> tuple[str, bool]:
    try:
        return data.decode(codec), True
    except UnicodeDecodeError:
        return data.decode(codec, "replace"), False


class Charset:
    """``first``: codec of the first set; ``extended``: escapes may switch."""

    def __init__(self, name: str, first: str, extended: bool, known: bool):
        self.name, self.first, self.extended, self.known = name, first, extended, known

    def decode(self, value: bytes, name: bool = False) -> tuple[str, bool]:
        """(text, whether every byte had one); ``name``: a person name."""
        if value.isascii() and (not self.extended or b"\x1b" not in value):
            return value.decode("ascii"), True
        if not self.extended:
            text, whole = _codec(value, self.first)
            return text, whole and self.known
        return self._switched(value, _NAME if name else _LINE)

    def _switched(self, value: bytes, delimiter) -> tuple[str, bool]:
        out, whole = [], self.known
        low, wide, high = "ascii", False, self.first
        for i, part in enumerate(_ESCAPE.split(value)):
            if i % 2:  # an escape sequence
                if part not in ESCAPES:
                    out.append("�")
                    whole = False
                    continue
                half, codec, size = ESCAPES[part]
                if half:
                    high = codec
                else:
                    low, wide = codec, size > 1
            elif wide:  # two low bytes a character; delimiters come after a switch back
                text, good = _codec(b"\x1b" + low.encode() + part, "iso2022_jp_2")
                out.append(text)
                whole &= good
            else:
                for j, piece in enumerate(delimiter.split(part)):
                    if j % 2:
                        out.append(piece.decode("ascii"))
                        high = self.first
                    else:
                        text, good = _codec(piece, high)
                        out.append(text)
                        whole &= good
        return "".join(out), whole


@functools.lru_cache(maxsize=256)
def charset(terms: str) -> Charset:
    """The set that the text of ``Specific Character Set`` names. An unknown term
    reads as ASCII, and every value with other bytes as incomplete."""
    parts = [t.strip() for t in terms.split("\\")]
    first = parts[0].replace("ISO 2022 IR", "ISO_IR")
    extended = len(parts) > 1 or parts[0].startswith("ISO 2022")
    if extended and first not in SINGLE:
        first = ""  # a multi-byte set that only an escape sequence selects
    return Charset(terms, SINGLE.get(first, "ascii"), extended, first in SINGLE)


DEFAULT = charset("")
