"""Rewriting JSON texts without building their values.

A single scan tells keys from strings and copies everything else as it is
spelt: numbers, escapes and repeated keys stay; space between tokens goes. Nothing
recurses, so texts of any depth are rewritten; an invalid text gives None.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SPACE = " \t\n\r"
_KEYS = re.compile(rf"({_STRING})(?:([{_SPACE}]*+:)?)|[{_SPACE}]++")
_TOKENS = re.compile(rf"({_STRING})([{_SPACE}]*+:)?|[{{}}\[\],]|[^{_SPACE}{{}}\[\],\"]++")
_VALID_STRING = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"\Z')
_VALID_SCALAR = re.compile(r"(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)\Z")


def _refuse(name: str):
    raise ValueError(name)  # not-a-number and infinity are no JSON


def valid(text: str) -> bool:
    try:
        json.loads(text, parse_constant=_refuse, parse_int=len, parse_float=len)
        return True
    except RecursionError:
        return _valid_deep(text)
    except ValueError:
        return False


def _valid_deep(text: str) -> bool:
    """The grammar on a stack of open brackets, for texts too deep to parse."""
    stack = bytearray()
    want = "value"                  # value, value or end, key, key or end, after
    at = 0
    for m in _TOKENS.finditer(text):
        if text[at:m.start()].strip(_SPACE):
            return False
        at = m.end()
        t = m.group()
        if m.group(1) is not None:
            if not _VALID_STRING.match(m.group(1)):
                return False
            if m.group(2) is not None:
                if not want.startswith("key"):
                    return False
                want = "value"
                continue
            if not want.startswith("value"):
                return False
            want = "after"
        elif t in "{[":
            if not want.startswith("value"):
                return False
            stack.append(ord(t))
            want = "key or end" if t == "{" else "value or end"
        elif t in "}]":
            opener = ord("{" if t == "}" else "[")
            if not stack or stack[-1] != opener or want not in ("after", "key or end" if t == "}" else "value or end"):
                return False
            stack.pop()
            want = "after"
        elif t == ",":
            if want != "after" or not stack:
                return False
            want = "key" if stack[-1] == ord("{") else "value"
        else:
            if not want.startswith("value") or not _VALID_SCALAR.match(t):
                return False
            want = "after"
    return want == "after" and not stack and not text[at:].strip(_SPACE)


def key_of(spelt: str) -> str:
    """The key a JSON string spells."""
    return json.loads(spelt) if "\\" in spelt else spelt[1:-1]


def rename_keys(text: str, rename: Callable[[str], str]) -> str | None:
    """The text with keys renamed at every depth."""
    if not valid(text):
        return None

    def one(m):
        spelt = m.group(1)
        if spelt is None:
            return ""
        if m.group(2) is None:
            return spelt
        old = key_of(spelt)
        new = rename(old)
        return (spelt if new == old else json.dumps(new, ensure_ascii=False)) + ":"

    return _KEYS.sub(one, text)


# ------------------------------------------------------------------ data sets

DATASET, ELEMENT, PLAIN, LIST = range(4)


class _Open:
    """An open bracket: what it holds, and what its next value is."""

    __slots__ = ("kind", "some", "child", "vr", "due")

    def __init__(self, kind: int, child: int = PLAIN):
        self.kind = kind        # of an object, or LIST
        self.some = False       # something was written in it
        self.child = child      # kind of the objects in a list, or of the next value
        self.vr = None          # of an element
        self.due = False        # the next value is the element's VR


def rewrite_elements(text: str, decide: Callable[[str], tuple[str, Callable | None]]) -> str | None:
    """A DICOM JSON data set, or array of them, with elements kept, dropped or
    replaced at every depth. ``decide(key)`` gives ``("keep", None)``, ``("drop",
    None)`` or ``("replace", function)`` of the element's text, which returns its
    new text or None to drop it. Elements inside a kept sequence are decided
    in turn; those of a dropped or replaced one are gone with it."""
    if not valid(text):
        return None
    out: list[str] = []
    stack: list[_Open] = []
    taken: list[str] | None = None      # tokens of a value that is not copied
    depth = 0
    change = spelt = None

    def separate():
        if stack and stack[-1].some:
            out.append(",")
        if stack:
            stack[-1].some = True

    for m in _TOKENS.finditer(text):
        t = m.group(1) + ":" if m.group(2) is not None else m.group()
        if taken is not None:           # inside a value to drop or replace
            taken.append(t)
            depth += t in "{[" if len(t) == 1 else 0
            depth -= t in "}]" if len(t) == 1 else 0
            if depth or m.group(2) is not None or t == ",":
                continue
            new = change("".join(taken)) if change is not None else None
            taken = None
            if new is not None:
                separate()
                out.append(f"{spelt}:{new}")
            continue
        if t == ",":
            continue
        if m.group(2) is not None:      # a key
            top = stack[-1]
            if top.kind == DATASET:
                what, change = decide(key_of(m.group(1)))
                if what != "keep":
                    taken, depth, spelt = [], 0, m.group(1)
                    continue
                top.child = ELEMENT
            elif top.kind == ELEMENT:
                name = key_of(m.group(1))
                top.due = name == "vr"
                top.child = DATASET if name == "Value" and top.vr in ("SQ", None) else PLAIN
            separate()
            out.append(t)
            continue
        if t in ("}", "]"):
            stack.pop()
            out.append(t)
            continue
        top = stack[-1] if stack else None
        if top is not None and top.kind == LIST:
            separate()
        if t == "{":
            kind = DATASET if top is None else top.child
            stack.append(_Open(kind))
        elif t == "[":
            # objects of an array are of the kind its owner expects; a root array holds data sets
            stack.append(_Open(LIST, DATASET if top is None else top.child if top.kind != DATASET else PLAIN))
        elif top is not None and top.due:
            top.vr, top.due = key_of(t) if t[0] == '"' else None, False
        out.append(t)
    return "".join(out)


_VR = re.compile(r'[{,]"vr":"([A-Z]{2})"')


def element_vr(text: str) -> str | None:
    """The VR of an element's text."""
    m = _VR.search(text)
    return m.group(1) if m else None


def hashed_element(text: str, salt: str) -> str | None:
    """The element with every text of its value replaced by a salted hash; None
    for sequences and bytes."""
    vr = element_vr(text)
    if vr == "SQ":
        return None
    element = json.loads(text)

    def one(v):
        if isinstance(v, dict):
            return {k: one(x) for k, x in v.items()}
        if v is None or v == "":
            return v
        shown = v if isinstance(v, str) else json.dumps(v)
        return hashlib.sha256((shown + salt).encode()).hexdigest()

    out = {"vr": vr} if vr else {}
    if "Value" in element:
        out["Value"] = [one(v) for v in element["Value"]]
    elif len(element) > len(out):
        return None
    return json.dumps(out, separators=(",", ":"), ensure_ascii=False)
