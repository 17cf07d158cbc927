"""Personal data in texts: patterns propose, checks confirm, context adjusts.

Base kinds, in order: email, ip, card, phone. Every base match that passes its
check (parts of an address, Luhn and length of a card, digits of a phone) is a
span. Added kinds are proposed by pattern, confirmed by a checksum where there
is one (IBAN: mod 97), and scored: the kind's own score, plus a bonus for a
context word of the kind within ``WINDOW`` characters. They become spans at
``MIN_SCORE``. Matches of one kind are leftmost and do not overlap; those that
fail their check are dropped without a second try. Only an IBAN, which words
can follow or precede, is tried at each word end inside a match (that of the
country's length first, then the last) and, if all fail, from the next word.

The patterns are written so that no text costs more than linear time: runs are
entered at their start only and taken possessively, an address is looked for
at its ``@``.

Edge cases: null and empty texts have no spans. Offsets are code points, end
exclusive. Columns other than id and text are not read (``find``) or pass
through unchanged (``redact``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import slices, values

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
WINDOW = 40
MIN_SCORE = 0.6

# What a kind scores without context, and its context words.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact"),
    "ip": ("ip", "server", "host", "address"),
    "card": ("card", "credit", "visa", "payment"),
    "phone": ("phone", "tel", "call", "mobile"),
    "iban": ("iban", "bank", "account", "konto"),
    "ssn": ("ssn", "social", "security", "tax"),
}
BONUS = 0.4

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b")
IBAN_LENGTH = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR PS QA UA", 30: "KW MU", 31: "MT",
}.items() for country in countries.split()}
LEAST_IBAN = 15
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0    # no match starts before this place
    for m in _DOMAIN.finditer(text):
        at = m.start()
        run = text[free:at]
        local = len(run) - len(run.rstrip(LOCAL))
        if local:
            yield at - local, m.end()
            free = m.end()
        else:
            free = max(free, at)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (g.lstrip("0") for g in m.groups())):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _IBAN.search(text, at):
        start, found = m.start(), m.group()
        ends, size = [], 0
        for word in found.split(" "):
            size += len(word)
            if size >= LEAST_IBAN:
                ends.append((size == IBAN_LENGTH.get(found[:2]), size))
        at = start + 1
        for _, size in sorted(ends, reverse=True):
            if mod97(found.replace(" ", "")[:size]):
                at = start + _place(found, size)
                yield start, at
                break


def _place(found: str, size: int) -> int:
    """Where the first ``size`` characters that are no spaces end."""
    return next(i for i in range(size, len(found) + 1) if i - found.count(" ", 0, i) == size)


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def score(kind: str, text: str, start: int, end: int) -> float:
    """Own score of the kind, more with a context word nearby, at most 1."""
    near = text[max(0, start - WINDOW):start].lower() + " " + text[end:end + WINDOW].lower()
    return min(1.0, SCORES[kind] + BONUS * (not set(CONTEXT[kind]).isdisjoint(_WORD.findall(near))))


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of a text, by kind, then start."""
    out: list[tuple[str, int, int, float]] = []
    if not text:
        return out
    if "@" in text:
        out += [("email", a, b, score("email", text, a, b)) for a, b in _emails(text)]
    for kind, find in (("ip", _ips), ("card", _cards)):
        out += [(kind, a, b, score(kind, text, a, b)) for a, b in find(text)]
    if "+" in text:
        out += [("phone", a, b, score("phone", text, a, b)) for a, b in _phones(text)]
    for kind, find in (("iban", _ibans), ("ssn", _ssns)):
        for a, b in find(text):
            if (s := score(kind, text, a, b)) >= MIN_SCORE:
                out.append((kind, a, b, s))
    return out


def _joined(found) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores``."""
    ship.ensure(df.sparkSession)
    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for part in slices(batches, "text"):
            cols: list[list] = [[] for _ in range(7)]
            for text in values(part, "text"):
                found = spans(text)
                base = [s for s in found if s[0] in BASE]
                for c, kind in zip(cols, BASE):
                    c.append(sum(s[0] == kind for s in base))
                cols[4].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                cols[5].append(_joined(found))
                cols[6].append([s[3] for s in found])
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(pa.float64())]
            yield pa.record_batch(
                [part.column(0)] + [pa.array(c, t) for c, t in zip(cols, kinds)],
                names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"])

    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(run, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string, scores array<double>")


def mask(text: str) -> str:
    """The text with every span replaced by its kind in brackets. Overlapping
    spans become one. Repeated until nothing is found, as a replacement can
    shorten a run that was too long to be confirmed."""
    while found := sorted((a, b, k) for k, a, b, _ in spans(text)):
        out, at, i = [], 0, 0
        while i < len(found):
            start, end, kind = found[i]
            i += 1
            while i < len(found) and found[i][0] < end:
                end = max(end, found[i][1])
                i += 1
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        text = "".join(out) + text[at:]
    return text


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced by ``[KIND]``. A null
    text stays null; other columns and the order of columns stay."""
    ship.ensure(df.sparkSession)

    def run(batches):
        for part in slices(batches, text_col):
            at = part.schema.get_field_index(text_col)
            kind = part.schema.field(at).type
            texts = pa.array([t and mask(t) for t in values(part, text_col)], kind)
            yield part.set_column(at, part.schema.field(at), texts)

    return df.mapInArrow(run, df.schema)
