"""Which files a data source reads: globs, folders, partition folders, options.

The rules are those of Spark's own file sources: names that start with ``.`` or
``_`` are hidden; a folder gives the files in it and in its partition folders
(``key=value``), with ``recursiveFileLookup`` those of every folder below and no
partition columns; ``pathGlobFilter`` tests file names, ``modifiedAfter`` and
``modifiedBefore`` (UTC) modification times.
"""

from __future__ import annotations

import contextlib
import datetime
import re
from collections import deque
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import chain, islice
from urllib.parse import unquote

from pyarrow import fs as pafs

from medframe.sources import files
from medframe.sources.files import Found

LISTING_THREADS = 16
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_MAGIC = re.compile(r"(?<!\\)[*?\[{]")


def glob_pattern(glob: str) -> re.Pattern:
    """One path segment of a Hadoop glob: ``* ? [a-c] [^a] {a,b}`` and ``\\``."""
    out, i, depth = [], 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out.append(re.escape(glob[i]))
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and (end := glob.find("]", i + 2)) > 0:
            inner = glob[i + 1:end]
            negated = inner[0] in "^!"
            inner = (inner[1:] if negated else inner).replace("\\", "\\\\").replace("[", "\\[")
            out.append(f"[{'^' if negated else ''}{inner}]")
            i = end
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        i += 1
    return re.compile("".join(out) + ")" * depth + r"\Z")


def hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _qualified(path: str) -> str:
    """Paths of the local file system as Spark writes them."""
    scheme, _, rest = files.split_uri(path)
    return f"file:/{rest.lstrip('/')}" if scheme == "file" else path


def matches(path: str, conf: tuple) -> Iterator[tuple[str, pafs.FileInfo]]:
    """The files and folders a path or glob names, a folder listed at a time; raises if
    there is no such path."""
    path = _qualified(path.rstrip("/") or "/")
    if not _MAGIC.search(path):
        info = files.info(path, conf)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"Path does not exist: {path}")
        yield path, info
        return
    scheme, authority, rest = files.split_uri(path)
    head = f"{scheme}://{authority}" if authority else f"{scheme}:"
    parts = [p for p in rest.split("/") if p]
    fixed = next(i for i, p in enumerate(parts) if _MAGIC.search(p))
    folders = ["/".join([head, *parts[:fixed]])]

    def within(folder, part):
        pattern = glob_pattern(part)
        return ((u, e) for u, e in files.entries(folder, conf)
                if pattern.match(e.base_name) and (not hidden(e.base_name) or part.startswith(e.base_name[0])))

    for part in parts[fixed:-1]:
        folders = sorted(u for folder in folders for u, e in within(folder, part) if e.type == pafs.FileType.Directory)
    for folder in folders:
        yield from within(folder, parts[-1])


def resolve(path: str, conf: tuple) -> list[tuple[str, pafs.FileInfo]]:
    """The files and folders a path or glob names; raises if there are none."""
    found = sorted(matches(path, conf), key=lambda f: f[0])
    if not found:
        raise FileNotFoundError(f"Path does not exist: {path}")
    return found


def _option(options: dict, key: str) -> str | None:
    return next((str(v) for k, v in options.items() if k.lower() == key.lower()), None)


def _moment(text: str | None) -> float | None:
    if text is None:
        return None
    at = datetime.datetime.fromisoformat(text)
    return (at if at.tzinfo else at.replace(tzinfo=datetime.timezone.utc)).timestamp()


def paths_of(options: dict) -> list[str]:
    """The paths a reader was given (``load`` of one or several)."""
    import json

    several = _option(options, "paths")
    one = _option(options, "path")
    out = json.loads(several) if several else []
    if one:
        out.append(one)
    if not out:
        raise ValueError("dicomFile needs a path")
    return out


def walk(options: dict) -> Iterator[tuple[Found, tuple[str, ...]]]:
    """(file, names of its partition columns) of everything ``options`` name."""
    return walk_ahead(options, LISTING_THREADS, must_match=True)


def walk_ahead(options: dict, most: int, must_match: bool = False) -> Iterator[tuple[Found, tuple[str, ...]]]:
    """The same with at most ``most`` folders listed ahead of what was taken, by threads,
    one level at a time. ``must_match``: raises if a path names nothing."""
    conf = files.conf_of(options)
    recursive = (_option(options, "recursiveFileLookup") or "").lower() == "true"
    name_filter = _option(options, "pathGlobFilter")
    pattern = glob_pattern(name_filter) if name_filter else None
    after, before = _moment(_option(options, "modifiedAfter")), _moment(_option(options, "modifiedBefore"))

    def wanted(uri, info, vals):
        modified = info.mtime.timestamp() if info.mtime is not None else 0.0
        if pattern is not None and not pattern.match(info.base_name):
            return None
        if (after is not None and modified <= after) or (before is not None and modified >= before):
            return None
        return Found(uri, info.size, modified, vals)

    def entries(level):
        out = files.entries(level[0], conf)
        first = next(out, None)  # lists the folder
        return level, out if first is None else chain((first,), out)

    def named(path):
        if must_match:
            yield from resolve(path, conf)
            return
        with contextlib.suppress(FileNotFoundError):
            yield from matches(path, conf)

    level = []
    for path in paths_of(options):
        for uri, info in named(path):
            if info.type == pafs.FileType.Directory:
                level.append((uri, (), ()))
            elif (one := wanted(uri, info, ())) is not None:
                yield one, ()
    with ThreadPoolExecutor(max_workers=most) as pool:
        while level:
            nearer, ahead, folders = [], deque(), iter(level)
            while True:
                ahead.extend([pool.submit(entries, f) for f in islice(folders, most - len(ahead))])
                if not ahead:
                    break
                (uri, names, vals), children = ahead.popleft().result()
                for child, info in children:
                    if hidden(info.base_name):
                        continue
                    if info.type == pafs.FileType.File:
                        if (one := wanted(child, info, vals)) is not None:
                            yield one, names
                    elif recursive:
                        nearer.append((child, names, vals))
                    elif "=" in info.base_name:
                        key, _, value = info.base_name.partition("=")
                        value = None if value == DEFAULT_PARTITION else unquote(value)
                        nearer.append((child, (*names, unquote(key)), (*vals, value)))
            level = nearer


def partition_columns(found: list) -> dict[str, str]:
    """Partition column -> Spark type, inferred from all values as Spark does."""
    names = {n for _, n in found}
    if len(names) > 1:
        raise ValueError(f"conflicting partition columns: {sorted(names)}")
    columns = names.pop() if names else ()
    return {c: _type({f.values[i] for f, _ in found if f.values[i] is not None}) for i, c in enumerate(columns)}


def _type(texts: set) -> str:
    for kind, parse in _PARSERS.items():
        try:
            for t in texts:
                parse(t)
            return kind if texts else "string"
        except ValueError:
            continue
    return "string"


def _int(bits: int):
    def parse(text):
        if not re.match(r"[+-]?[0-9]+\Z", text) or not -(1 << bits - 1) <= int(text) < 1 << bits - 1:
            raise ValueError(text)
        return int(text)

    return parse


def _double(text):
    if not re.match(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\Z", text):
        raise ValueError(text)
    return float(text)


def _date(text):
    if not re.match(r"[0-9]{4}-[0-9]{2}-[0-9]{2}\Z", text):
        raise ValueError(text)
    return datetime.date.fromisoformat(text)


_PARSERS = {"int": _int(32), "bigint": _int(64), "double": _double, "date": _date}


def partition_value(text: str | None, kind: str):
    """The typed value of a partition folder."""
    if text is None:
        return None
    return _PARSERS.get(kind, str)(text)
