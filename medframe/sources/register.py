"""``spark.read.format("dicomFile")``: a data source of PySpark's own kind.

``install(spark)`` registers it with the session; batch and streaming readers,
options, user schemas and the refusal to write are then Spark's own. Files are
listed when a read is planned, and dealt to partitions of (path, length); each
executor opens its files and reads ranges of them (``medframe.sources.files``),
stopping at PixelData or at the first element that fails a filter Spark pushed.
Partitions give Arrow batches of finished columns.

Columns: those of ``medframe.sources.dicom.schema`` for the options, then the
partition columns. PySpark does not tell a source which columns a query
needs: name them by ``.schema(...)`` or by the option ``columns``
(``"PatientID,StudyDate"``) when reading much, or use ``dicom.read``.

Filters on text columns, groups of person names, ``path``, ``isDicom`` and
partition columns are taken over (``spark.sql.python.filterPushdown.enabled``,
which ``install`` switches on); all others stay with Spark.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructType

from medframe import dictionary as dictmod
from medframe import ship
from medframe.sources import dicom, files, kernel, listing
from medframe.sources import tokenise as tk
from medframe.sources.predicates import Predicate

SHORT_NAME = "dicomFile"
MOST_FILES = 256              # files of a partition that is read by headers
LEAST_PARTITIONS = 32         # so that few files still use several cores
WHOLE_BYTES = 64 << 20        # bytes of a partition that reads whole files
BATCH_BYTES = 16 << 20        # bytes of whole files in one output batch

_COMPARISONS = {ds.EqualTo: "=", ds.EqualNullSafe: "<=>", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=",
                ds.LessThan: "<", ds.LessThanOrEqual: "<=", ds.In: "in", ds.StringStartsWith: "startswith",
                ds.StringEndsWith: "endswith", ds.StringContains: "contains"}


def from_filter(f: ds.Filter) -> Predicate:
    """Spark's filter as a predicate."""
    if isinstance(f, ds.Not):
        p = from_filter(f.child)
        return Predicate(p.column, p.op, p.value, not p.negated)
    if isinstance(f, (ds.IsNull, ds.IsNotNull)):
        return Predicate(tuple(f.attribute), "is null" if isinstance(f, ds.IsNull) else "is not null")
    value = tuple(f.value) if isinstance(f, ds.In) else f.value
    return Predicate(tuple(f.attribute), _COMPARISONS[type(f)], value)


@dataclass
class FileSlice(ds.InputPartition):
    """Files of one task."""

    found: list

    def __init__(self, found: list):
        super().__init__(found)
        self.found = found


class _Scan:
    """What a read needs on the driver and on executors."""

    def __init__(self, schema: StructType, options: dict):
        self.options = dict(options)
        self.schema = schema
        d = dictmod.active()
        allowed = {e.keyword: e for e in d.column_elements(True)}
        self.elements = [allowed[f.name] for f in schema.fields if f.name in allowed]
        self.names = [f.name for f in schema.fields]
        own = {dicom.CONTENT, dicom.PRIVATE, *dicom.METADATA_COLUMNS, *allowed}
        self.partition_types = {f.name: f.dataType.simpleString() for f in schema.fields if f.name not in own}
        self.predicates: list[Predicate] = []
        self.pruning: list[Predicate] = []

    def take(self, filters: list) -> Iterator:
        """Keeps the filters it can judge; gives the others back."""
        by_keyword = {e.keyword: e for e in self.elements}
        for f in filters:
            p = from_filter(f)
            name = p.column[0]
            if name in self.partition_types and len(p.column) == 1:
                self.pruning.append(p)
            elif (name in (dicom.PATH, dicom.ISDICOM) and len(p.column) == 1) or (
                    name in by_keyword and dicom.filterable(by_keyword[name].single_vr, p.column)):
                self.predicates.append(p)
            else:
                yield f

    @property
    def whole(self) -> bool:
        """Whether files are read beyond their header."""
        return dicom.CONTENT in self.names or "PixelData" in self.names

    def listed(self) -> list:
        """Files of the read, partition folders pruned; values typed."""
        out = []
        for found, names in listing.walk(self.options):
            missing = set(self.partition_types) - set(names)
            if missing:
                raise ValueError(f"Unsupported field name: {sorted(missing)} are no DICOM keyword or partition columns")
            values = dict(zip(names, found.values))
            typed = {n: listing.partition_value(values[n], k) for n, k in self.partition_types.items()}
            if all(p.holds(typed[p.column[0]]) for p in self.pruning):
                out.append(files.Found(found.path, found.length, found.modified, tuple(typed.values())))
        return out

    def slices(self, found: list) -> list[FileSlice]:
        found = sorted(found, key=lambda f: f.path)
        if not self.whole:
            size = max(1, min(MOST_FILES, -(-len(found) // LEAST_PARTITIONS)))
            return [FileSlice(found[i:i + size]) for i in range(0, len(found), size)]
        out, held, size = [], [], 0
        for f in found:
            if held and size + f.length > WHOLE_BYTES:
                out.append(FileSlice(held))
                held, size = [], 0
            held.append(f)
            size += f.length
        return [*out, FileSlice(held)] if held else out

    def spec(self) -> kernel.Spec:
        d = dictmod.active()
        return kernel.Spec(
            tags={e.tag: (e.keyword, e.vr) for e in d.elements},
            columns=[kernel.Column(e.keyword, e.tag, e.vr, e.single_vr) for e in self.elements],
            stop_at_pixel="PixelData" not in self.names,
            private=dicom.PRIVATE in self.names,
            content=dicom.CONTENT in self.names,
            want_vrs=dicom.VRS in self.names or dicom.KEYWORDS in self.names,
            final=True,
            predicates=tuple(self.predicates),
            conf=files.conf_of(self.options),
        )

    def batches(self, found: list) -> Iterator[pa.RecordBatch]:
        """Arrow batches of the read's columns."""
        decoder = kernel.Decoder(self.spec())
        if not self.whole:
            for i in range(0, len(found), MOST_FILES):
                some = found[i:i + MOST_FILES]
                parse = kernel.header_parser(decoder, [f.path for f in some], [f.length for f in some])
                yield self._batch(decoder, some, parse, None)
            return
        some, contents, size = [], [], 0
        for f in found:
            some.append(f)
            contents.append(files.read_range(f.path, 0, None, decoder.spec.conf))
            size += len(contents[-1])
            if size >= BATCH_BYTES:
                yield self._batch(decoder, some, self._parser(decoder, contents), contents)
                some, contents, size = [], [], 0
        if some:
            yield self._batch(decoder, some, self._parser(decoder, contents), contents)

    @staticmethod
    def _parser(decoder, contents):
        spec = decoder.spec
        return lambda i: tk.parse(memoryview(contents[i]), decoder.vr_of, spec.stop_at_pixel, decoder.keep, decoder.checks)

    def _batch(self, decoder, some: list, parse, contents) -> pa.RecordBatch:
        got = decoder.batch(len(some), parse, lambda i: some[i].path)
        of = {c.keyword: got[kernel.column_name(k)] for k, c in enumerate(decoder.spec.columns)}
        arrays = []
        for name in self.names:
            if name == dicom.PATH:
                arrays.append(pa.array([f.path for f in some], pa.string()))
            elif name == dicom.ISDICOM:
                arrays.append(got["isDicom"])
            elif name == dicom.KEYWORDS:
                vrs = got["vrs"]
                arrays.append(pa.ListArray.from_arrays(vrs.offsets, vrs.keys, mask=pc.invert(got["isDicom"])))
            elif name == dicom.VRS:
                arrays.append(got["vrs"])
            elif name == dicom.ERRORS:
                arrays.append(got["errors"])
            elif name == dicom.CONTENT:
                arrays.append(pa.array(contents, pa.binary()))
            elif name == dicom.PRIVATE:
                arrays.append(got["private"])
            elif name in self.partition_types:
                at = list(self.partition_types).index(name)
                arrays.append(pa.array([f.values[at] for f in some], _ARROW[self.partition_types[name]]))
            else:
                arrays.append(of[name])
        out = pa.RecordBatch.from_arrays(arrays, names=self.names)
        return out if got["keep"] is None else out.filter(got["keep"])


_SPARK = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "date": DateType(), "string": StringType()}
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "date": pa.date32(), "string": pa.string()}


class DicomReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.scan = _Scan(schema, options)

    def pushFilters(self, filters):
        return list(self.scan.take(filters))

    def partitions(self):
        return self.scan.slices(self.scan.listed())

    def read(self, partition):
        if partition is not None:   # None: no files
            yield from self.scan.batches(partition.found)


class DicomStreamReader(ds.DataSourceStreamReader):
    """New files of the paths, each once.

    Without more, files are taken in order of (modification time, path) and an
    offset is the last one taken, so a file that appears later with an older time
    is not seen. With the option ``fileLog`` (a folder in shared storage, one per
    query) the files of every offset are written there, and a file is new unless
    it is in the log, whatever its time."""

    def __init__(self, schema: StructType, options: dict):
        self.scan = _Scan(schema, options)
        self.log = listing._option(options, "fileLog")
        self.conf = files.conf_of(options)
        self.seen: set | None = None
        self.count = 0

    def initialOffset(self):
        return {"batch": 0} if self.log else {"modified": 0.0, "path": ""}

    # ---- by file log

    def _entry(self, n: int) -> str:
        return f"{self.log.rstrip('/')}/{n:012d}.json"

    def _logged(self, n: int) -> list:
        system, path = files.locate(self._entry(n), self.conf)
        with system.open_input_stream(path) as f:
            kinds = self.scan.partition_types.values()
            return [files.Found(p, size, at, tuple(map(listing.partition_value, values, kinds)))
                    for p, size, at, values in json.loads(f.read())]

    def _load(self) -> None:
        system, path = files.locate(self.log, self.conf)
        system.create_dir(path, recursive=True)
        self.seen, self.count = set(), 0
        entries = sorted(u for u, e in files.entries(self.log, self.conf) if e.base_name.endswith(".json"))
        for i in range(1, len(entries) + 1):
            self.seen |= {f.path for f in self._logged(i)}
            self.count = i

    def _append(self, new: list) -> None:
        """The next entry, moved into place whole."""
        self.count += 1
        system, path = files.locate(self._entry(self.count), self.conf)
        part = f"{path}.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as f:
            f.write(json.dumps([[x.path, x.length, x.modified, [v if v is None else str(v) for v in x.values]]
                                for x in new]).encode())
        system.move(part, path)
        self.seen |= {f.path for f in new}

    # ---- offsets

    def latestOffset(self):
        found = self.scan.listed()
        if not self.log:
            last = max(((f.modified, f.path) for f in found), default=None)
            self.last = max(last or (0.0, ""), getattr(self, "last", (0.0, "")))
            return {"modified": self.last[0], "path": self.last[1]}
        if self.seen is None:
            self._load()
        new = [f for f in found if f.path not in self.seen]
        if new:
            self._append(new)
        return {"batch": self.count}

    def partitions(self, start, end):
        if self.log:
            found = [f for n in range(start["batch"] + 1, end["batch"] + 1) for f in self._logged(n)]
        else:
            low, high = ((o["modified"], o["path"]) for o in (start, end))
            found = [f for f in self.scan.listed() if low < (f.modified, f.path) <= high]
        return self.scan.slices(found)

    def read(self, partition):
        if partition is not None:
            yield from self.scan.batches(partition.found)


class DicomSource(ds.DataSource):
    """``dicomFile``; ``defaults``: options a session sets for all its reads."""

    defaults: dict = {}

    def __init__(self, options):
        super().__init__(options)
        self.all_options = {**self.defaults, **dict(options)}

    @classmethod
    def name(cls):
        return SHORT_NAME

    def schema(self):
        opts = self.all_options
        flags = [dicom.bool_option(opts, o) for o in
                 (dicom.OPTION_INCLUDE_PIXEL_DATA, dicom.OPTION_INCLUDE_CONTENT, dicom.OPTION_INCLUDE_PRIVATE_TAGS)]
        full = dicom.schema(*flags)
        wanted = listing._option(opts, "columns")
        if wanted is not None:
            named = [c.strip() for c in wanted.split(",") if c.strip()]
            unknown = [c for c in named if c not in full.names]
            if unknown:
                raise ValueError(f"Unsupported field name: {unknown} are not columns of the scan")
            full = StructType([full[c] for c in named])
        partitions = listing.partition_columns(list(listing.walk(opts)))
        for name, kind in partitions.items():
            if name not in full.names:
                full = full.add(name, _SPARK[kind])
        return full

    def reader(self, schema):
        return DicomReader(schema, self.all_options)

    def streamReader(self, schema):
        return DicomStreamReader(schema, self.all_options)


def send(spark: SparkSession, source: type) -> None:
    """Register a data source with a session."""
    # Spark plans streams in a Python process that gets no shipped files, only this path
    env = spark.sparkContext.environment
    before, package = env.get("PYTHONPATH"), ship.archive(spark)
    try:
        if package:
            env["PYTHONPATH"] = os.pathsep.join(p for p in (package, before) if p)
        spark.dataSource.register(source)
    finally:
        env.pop("PYTHONPATH", None)
        if before is not None:
            env["PYTHONPATH"] = before


def install(spark: SparkSession | None = None) -> None:
    """Register the format with a session (default: the active one) and let
    Spark push filters to it. The session's settings for file systems become
    the source's defaults."""
    spark = spark or SparkSession.active()
    # a class of this session's own, sent to Spark by value with its defaults
    own = type("DicomSource", (DicomSource,), {
        "defaults": dicom.file_system_options(spark, None), "__module__": "__main__"})
    send(spark, own)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
