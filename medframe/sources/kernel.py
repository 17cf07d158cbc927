"""Decoding of a batch of files into Arrow columns (runs on executors).

A file is a row, always: one that is not DICOM has ``isDicom`` false and null
columns. Every requested keyword is a column of its own, made when a file of the
batch has the element, so a wide schema costs little where files are narrow.

- ``make_kernel``: inside ``mapInArrow``, raw values that the SQL decoders finish
- ``Decoder`` with ``final``: finished values, for the data source

Header reads fetch a prefix of each file by ranges and stop at PixelData, or at
the first element that fails a pushed filter.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa

from medframe.dictionary import INT_VRS, MULTI_STRING_VRS
from medframe.functions import values
from medframe.sources import files
from medframe.sources import tokenise as tk

# Header mode: first read of a file, grown by doubling until the data set up
# to PixelData parses (files are read only as far as their header goes).
HEADER_FIRST_READ = 64 * 1024


def binary_views(arr: pa.Array) -> list:
    """Zero-copy memoryviews of a binary Arrow array's values (None for nulls),
    sliced from its buffers instead of one scalar object per row."""
    if isinstance(arr, pa.ChunkedArray):
        return [v for chunk in arr.chunks for v in binary_views(chunk)]
    if pa.types.is_large_binary(arr.type):
        off_type = "<i8"
    else:
        off_type = "<i4"
    import numpy as np

    _, offsets_buf, data_buf = arr.buffers()
    n = len(arr)
    offsets = np.frombuffer(offsets_buf, dtype=off_type, count=n + 1 + arr.offset)[arr.offset:]
    data = memoryview(data_buf) if data_buf is not None else memoryview(b"")
    valid = arr.is_valid().to_numpy(zero_copy_only=False) if arr.null_count else None
    starts, ends = offsets[:-1].tolist(), offsets[1:].tolist()
    return [
        None if valid is not None and not valid[i] else data[starts[i]:ends[i]]
        for i in range(n)
    ]


# Concurrent prefix reads per task in header mode: object stores answer each
# request after tens of milliseconds, so a task keeps several in flight.
HEADER_READ_THREADS = 16
# Files whose prefixes are held at once per task (256 x 64 KiB = 16 MiB).
HEADER_WINDOW = 256


def _read_prefix(uri: str, size: int | None, start: int, want: int | None, conf: tuple = ()):
    """(bytes from ``start`` up to ``want``, file size) or the exception."""
    try:
        if size is None:
            size = files.size(uri, conf)
        end = size if want is None else min(size, want)
        return files.read_range(uri, start, max(0, end - start), conf), size
    except Exception as exc:  # raised when the file's turn comes
        return OSError(f"cannot read {uri}: {exc}"), None


def read_header(uri: str, size: int | None, vr_of, stop_at_pixel: bool, prefix=None, keep=None,
                conf: tuple = (), checks=None):
    """Parse a file reading as few bytes as needed: the prefix grows, by the
    bytes still missing, until the data set (up to PixelData) parses, a filter
    fails or the file ends. ``prefix`` is an already fetched ``(bytes, size)``
    start of the file."""
    if prefix is None:
        prefix = _read_prefix(uri, size, 0, HEADER_FIRST_READ if stop_at_pixel else None, conf)
    data, total = prefix
    while True:
        if isinstance(data, Exception):
            raise data
        try:
            parsed = tk.parse(memoryview(data), vr_of, stop_at_pixel, keep, checks)
            if parsed.stopped or len(data) >= total:
                return parsed
        except tk.PARSE_FAULTS:
            if len(data) >= total:
                raise
        more, total = _read_prefix(uri, total, len(data), max(len(data), 1) * 2, conf)
        if isinstance(more, Exception):
            raise more
        if not more:
            raise OSError(f"cannot read {uri}: it ended at {len(data)} of {total} bytes")
        data += more


def fetch_prefixes(paths: list, lengths: list | None, stop_at_pixel: bool, conf: tuple = ()) -> list:
    """First bytes of every file of a batch, read concurrently."""
    from concurrent.futures import ThreadPoolExecutor

    want = HEADER_FIRST_READ if stop_at_pixel else None
    sizes = lengths if lengths is not None else [None] * len(paths)
    if len(paths) <= 1:
        return [_read_prefix(p, n, 0, want, conf) for p, n in zip(paths, sizes)]
    with ThreadPoolExecutor(max_workers=min(HEADER_READ_THREADS, len(paths))) as pool:
        return list(pool.map(lambda a: _read_prefix(a[0], a[1], 0, want, conf), zip(paths, sizes)))


SLOT_TYPE = pa.struct(
    [
        ("vr", pa.string()),
        ("str", pa.string()),
        ("ints", pa.list_(pa.int64())),
        ("dbls", pa.list_(pa.float64())),
        ("bin", pa.binary()),
    ]
)
SLOT_DDL = "struct<vr:string,str:string,ints:array<bigint>,dbls:array<double>,bin:binary>"


RAW_TYPES = {"str": pa.string(), "ints": pa.list_(pa.int64()), "dbls": pa.list_(pa.float64()), "bin": pa.binary()}
RAW_DDL = {"str": "string", "ints": "array<bigint>", "dbls": "array<double>", "bin": "binary"}
_SLOT_PLACE = {"str": 1, "ints": 2, "dbls": 3, "bin": 4}
NAME_TYPE = pa.struct([(g, pa.string()) for g in values.NO_NAME])
STRING_MAP = pa.map_(pa.string(), pa.string())


def final_type(vr: str) -> pa.DataType:
    """Arrow type of a finished column of dictionary VR ``vr``."""
    if vr == "PN":
        return NAME_TYPE
    if vr in INT_VRS:
        return pa.list_(pa.int32())
    return RAW_TYPES[values.raw_kind(vr)]


@dataclass(frozen=True)
class Column:
    """A requested keyword; ``vr`` is its single dictionary VR."""

    keyword: str
    tag: int
    dict_vr: str
    vr: str

    def __post_init__(self):
        object.__setattr__(self, "kind", values.raw_kind(self.vr))  # its raw value


@dataclass
class Spec:
    """What the kernel reads of a file.

    ``want_vrs`` False leaves ``vrs`` empty (neither it nor ``keywords`` is read
    downstream). ``final``: finished column values instead of raw ones.
    ``elements``: all dictionary elements as a map, for tall tables. Rows that
    fail a predicate are left out; those on a present element end its file's
    reading. ``conf``: options of the file systems."""

    tags: dict                      # tag -> (keyword, dictionary VR); bounded by the standard
    columns: list
    stop_at_pixel: bool = True
    private: bool = False
    content: bool = False
    want_vrs: bool = True
    final: bool = False
    elements: bool = False
    predicates: tuple = ()
    conf: tuple = ()
    passthrough: tuple = ()


def column_name(i: int) -> str:
    return f"__c{i}"


def kernel_schema_ddl(spec: Spec, passthrough_ddl: list[str]) -> str:
    cols = ["path string", "isDicom boolean", "vrs map<string,string>", "kerrors map<string,string>"]
    cols += [f"{column_name(i)} {RAW_DDL[c.kind]}" for i, c in enumerate(spec.columns)]
    if spec.elements:
        cols.append(f"attrs map<string,{SLOT_DDL}>")
    if spec.private:
        cols.append("privateTagsJson string")
    if spec.content:
        cols.append("content binary")
    return ", ".join(cols + passthrough_ddl)


class _Maps:
    """Map column built flat: offsets, keys and values."""

    def __init__(self):
        self.offsets, self.keys, self.values = [0], [], []

    def add(self, key, value) -> None:
        self.keys.append(key)
        self.values.append(value)

    def close(self) -> None:
        self.offsets.append(len(self.keys))

    def array(self, mask=None) -> pa.MapArray:
        return self.of(pa.array(self.values, pa.string()), mask)

    def of(self, items: pa.Array, mask=None) -> pa.MapArray:
        return pa.MapArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.array(self.keys, pa.string()),
                                       items, mask=mask)


class Decoder:
    """Files -> one Arrow array per requested column."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.place = {c.tag: i for i, c in enumerate(spec.columns)}
        by_keyword = {k: t for t, (k, _) in spec.tags.items()}
        self.finish = [values.finisher(c.vr) for c in spec.columns]
        # only the requested elements need to be read when neither the
        # keyword and VR lists nor other elements are wanted
        self.keep = None
        if not (spec.want_vrs or spec.private or spec.elements):
            self.keep = frozenset(self.place)
        self.of_column: dict = {}   # column number -> its predicates
        self.of_file = []
        for p in spec.predicates:
            tag = by_keyword.get(p.column[0])
            if tag in self.place:
                self.of_column.setdefault(self.place[tag], []).append(p)
            else:
                self.of_file.append(p)
        self.checks = {spec.columns[i].tag: self._check(i) for i, ps in self.of_column.items()
                       if not any(p.takes_null for p in ps)}

    def vr_of(self, tag):
        hit = self.spec.tags.get(tag)
        return hit[1] if hit else None

    def key_of(self, tag):
        hit = self.spec.tags.get(tag)
        return hit[0] if hit else tk.hex_key(tag)

    def _check(self, i: int):
        """Check of an element while its file is being read; what cannot be
        judged yet passes, and is judged with the whole row."""
        def check(elem, before) -> bool:
            cs = tk.charset_of(before)
            if elem.kind != "bytes" or not elem.value.isascii() and cs is tk.DEFAULT:
                return True
            value, error = self.value(i, elem, cs, [])
            return all(p.holds(value) for p in self.of_column[i])

        return check

    def raw(self, i: int, elem, cs, faults: list):
        c = self.spec.columns[i]
        if elem.kind == "bytes" and elem.vr == c.vr and c.kind in ("ints", "dbls"):
            return tk._numbers(elem)
        slot = tk.slot(elem, c.dict_vr, cs, lambda items: tk.items_text(items, cs, self.key_of), faults)
        value = slot[_SLOT_PLACE[c.kind]]
        return values.first(value) if c.vr in MULTI_STRING_VRS else value  # a column holds the first one

    def value(self, i: int, elem, cs, faults: list):
        """(finished value, error)."""
        try:
            return self.finish[i](self.raw(i, elem, cs, faults))
        except VALUE_FAULTS as exc:
            return None, tk.error_text(exc)

    def batch(self, n: int, parse, path_of) -> dict:
        """Arrays of ``n`` files. ``parse(i)`` raises for what is not DICOM;
        ``keep`` tells the rows that pass the predicates (None: all)."""
        spec = self.spec
        tags, place, final = spec.tags, self.place, spec.final
        defaults = [f(None)[0] for f in self.finish] if final else [None] * len(spec.columns)
        columns: list = [None] * len(spec.columns)     # made when a file has the element
        is_dicom, keep, private = [], [], []
        vrs, errors, attrs = _Maps(), _Maps(), _Maps()
        slots: list[list] = [[], [], [], [], []]
        others = []   # rows without a data set
        judged = bool(self.of_column)
        raw, value_of = self.raw, self.value
        for i in range(n):
            good = False
            wanted = True
            found: dict = {}
            broken: set = set()
            try:
                parsed = parse(i)
                good = True
            except tk.Rejected:
                wanted = False
            except tk.PARSE_FAULTS:  # not DICOM: the row stays, isDicom = false
                pass
            if not good:
                others.append(i)
                private.append(None)
            else:
                cs = parsed.charset
                own, prev_tag = [], -1
                for e in parsed.elements:  # sorted by tag
                    if e.tag == prev_tag:  # a repeated tag: keep the first
                        continue
                    prev_tag = e.tag
                    hit = tags.get(e.tag)
                    if hit is None:
                        own.append(e)
                        continue
                    keyword, dict_vr = hit
                    if spec.want_vrs:
                        vrs.add(keyword, e.vr)
                    if spec.elements:
                        self._slot(e, keyword, dict_vr, cs, attrs, slots)
                    at = place.get(e.tag)
                    if at is None:
                        continue
                    faults: list = []
                    if final:
                        value, error = value_of(at, e, cs, faults)
                    else:
                        try:
                            value, error = raw(at, e, cs, faults), None
                        except VALUE_FAULTS as exc:  # one bad value: column null + error
                            value, error = None, tk.error_text(exc)
                    if error is None and faults and spec.columns[at].vr not in ("DA", "TM"):  # those fail to parse
                        error = faults[0]
                    if error is not None:
                        errors.add(keyword, error)
                    if judged:
                        found[at] = value
                        if value is None:
                            broken.add(at)
                    column = columns[at]
                    if column is None:
                        column = columns[at] = [defaults[at]] * n
                    column[i] = value
                if spec.private:
                    private.append(tk.json_text(own, cs, tk.hex_key))
            is_dicom.append(good)
            if spec.want_vrs:
                vrs.close()
            if spec.elements:
                attrs.close()
            errors.close()
            if wanted and self.of_file:
                row = {"path": path_of(i), "isDicom": good}
                wanted = all(p.holds(row[p.column[0]]) for p in self.of_file)
            if wanted and self.of_column:
                wanted = self._passes(good, found, broken)
            keep.append(wanted)
        mask = pa.array([not x for x in is_dicom], pa.bool_())
        if not spec.want_vrs:
            vrs.offsets = [0] * (n + 1)
        out = {"isDicom": pa.array(is_dicom, pa.bool_()), "vrs": vrs.array(mask)}
        # the columns of a file that is not DICOM are null, its errors are none
        out["errors"] = errors.array(None if final else mask)
        for k, c in enumerate(spec.columns):
            out[column_name(k)] = self._array(k, c, columns[k], defaults[k], n, others)
        if spec.elements:
            out["attrs"] = attrs.of(pa.StructArray.from_arrays(
                [pa.array(s, f.type) for s, f in zip(slots, SLOT_TYPE)], fields=list(SLOT_TYPE)), mask)
        if spec.private:
            out["private"] = pa.array(private, pa.string())
        out["keep"] = None if all(keep) else pa.array(keep, pa.bool_())
        return out

    def _passes(self, good: bool, found: dict, broken: set) -> bool:
        for at, predicates in self.of_column.items():
            if not good or at in broken:
                value = None
            elif at in found:
                value = found[at] if self.spec.final else self.finish[at](found[at])[0]
            else:
                value = self.finish[at](None)[0]
            if not all(p.holds(value) for p in predicates):
                return False
        return True

    def _array(self, k: int, c: Column, column, default, n: int, others: list) -> pa.Array:
        kind = final_type(c.vr) if self.spec.final else RAW_TYPES[c.kind]
        if column is None and (default is None or not others):
            return pa.repeat(pa.scalar(default, kind), n)
        if column is None:
            column = [default] * n
        if default is not None:
            for i in others:
                column[i] = None
        return pa.array(column, kind)

    def _slot(self, e, keyword, dict_vr, cs, attrs: _Maps, slots: list) -> None:
        try:
            slot = tk.slot(e, dict_vr, cs, lambda items: tk.items_text(items, cs, self.key_of))
        except VALUE_FAULTS:
            slot = (e.vr, None, None, None, None)
        attrs.add(keyword, None)
        for values_, v in zip(slots, slot):
            values_.append(v)


# What a value that does not convert can raise.
VALUE_FAULTS = (ValueError, OverflowError, struct.error)


def header_parser(decoder: Decoder, paths: list, lengths: list | None):
    """``parse(i)`` that reads each file only as far as its header goes; prefixes
    are fetched a window at a time."""
    spec = decoder.spec
    window: list = []
    start = 0

    def parse(i):
        nonlocal window, start
        if not window or i >= start + len(window):
            start, hi = i, min(len(paths), i + HEADER_WINDOW)
            window = fetch_prefixes(paths[i:hi], lengths[i:hi] if lengths else None, spec.stop_at_pixel, spec.conf)
        prefix, window[i - start] = window[i - start], None
        return read_header(paths[i], lengths[i] if lengths else None, decoder.vr_of, spec.stop_at_pixel, prefix,
                           decoder.keep, spec.conf, decoder.checks)

    return parse


# Files whose values are Python objects at once, whatever the session's batch size.
KERNEL_ROWS = 1024


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = KERNEL_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut, without copies, to at most ``rows`` rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def make_kernel(spec: Spec):
    """The batch function of ``decode_frame``: raw columns for the SQL decoders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(spec)
        for batch in row_slices(batches):
            paths = batch.column("path").to_pylist() if "path" in batch.schema.names else None
            if "content" in batch.schema.names:
                contents = batch.column("content")
                views = binary_views(contents)

                def parse(i):
                    if views[i] is None:
                        raise tk.NotDicom("no content")
                    return tk.parse(views[i], decoder.vr_of, spec.stop_at_pixel, decoder.keep, decoder.checks)
            else:
                lengths = batch.column("length").to_pylist() if "length" in batch.schema.names else None
                parse = header_parser(decoder, paths, lengths)
            got = decoder.batch(batch.num_rows, parse, lambda i: paths[i])
            names = ["path", "isDicom", "vrs", "kerrors"]
            arrays = [batch.column("path"), got["isDicom"], got["vrs"], got["errors"]]
            for k in range(len(spec.columns)):
                names.append(column_name(k))
                arrays.append(got[column_name(k)])
            if spec.elements:
                names.append("attrs")
                arrays.append(got["attrs"])
            if spec.private:
                names.append("privateTagsJson")
                arrays.append(got["private"])
            if spec.content:
                names.append("content")
                arrays.append(contents)
            for c in spec.passthrough:
                names.append(c)
                arrays.append(batch.column(c))
            out = pa.RecordBatch.from_arrays(arrays, names=names)
            yield out if got["keep"] is None else out.filter(got["keep"])

    return run
