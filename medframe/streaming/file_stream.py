"""New files of a path as a stream of (path, length), each once.

Spark's own file source holds the status of every file on the driver while it lists
them, and again those of a micro-batch. Here the stream's planner lists a few folders at
a time and writes what is new to a log in shared storage; of a file that was taken it
keeps 24 bytes. Tasks get ranges of the log, so the size of a micro-batch does not
matter to the driver.

An offset is (folder of the log, number of its last entry): a restarted query goes on
with its own log, which has to live as long as the query's checkpoint. An entry is an
Arrow file with batches of ``LOG_ROWS`` files. The rules of Spark's file source hold: a
path is new once, whatever becomes of the file; a file more than 7 days older than the
newest one taken before is not new; one that is gone when its task begins gives no row.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

from medframe import ship
from medframe.session import ensure_checkpoint_dir
from medframe.sources import dicom, files, listing, register

NAME = "medframeFiles"
SCHEMA = "path string, length bigint"
LOG_ROWS = 256               # files of a batch of the log
TASK_FILES = 32              # files of a task, at least
LISTED_FOLDERS = 4           # folders whose entries are held at once
JUDGED_FILES = 8192          # files that are told to be new or not at once
SNAPSHOT_ENTRIES = 10        # entries after which the taken files are written in one
MOST_AGE = 7 * 24 * 3600 * 1000
STAT_THREADS = 16

_LOG = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])
_ROWS = pa.schema([("path", pa.string()), ("length", pa.int64())])
_SEEN = np.dtype([("key", "S16"), ("at", "i8")])


def _keys(paths: list) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(p.encode(), digest_size=16).digest() for p in paths), "S16")


class FileStreamReader(ds.DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.conf = files.conf_of(options)
        self.log: str | None = None
        self.known = 0               # entries that the query's checkpoint knows of
        self.count: int | None = None

    # ---- the log

    def _folder(self) -> str:
        if self.log is None:
            self.log = f"{listing._option(self.options, 'fileLog').rstrip('/')}/medframe-filelog-{uuid.uuid4().hex}"
        return self.log

    def _name(self, n: int, kind: str) -> str:
        return f"{self._folder()}/{n:012d}.{kind}"

    def _entry(self, uri: str) -> pa.RecordBatchFileReader:
        system, path = files.locate(uri, self.conf)
        return pa.ipc.open_file(system.open_input_file(path))

    def _load(self) -> None:
        """What is new is judged by the entries of the log."""
        self.taken, self.latest = np.empty(0, _SEEN), 0
        names = {e.base_name for _, e in files.entries(self._folder(), self.conf)}
        self.count = 0
        while f"{self.count + 1:012d}.arrow" in names:
            self.count += 1
        if self.count < self.known:
            raise FileNotFoundError(f"entry {self.count + 1} of the stream's file log {self.log} is gone; it has to "
                                    "live as long as the query's checkpoint")
        at = next((n for n in range(self.count, 0, -1) if f"{n:012d}.seen" in names), 0)
        if at:
            system, path = files.locate(self._name(at, "seen"), self.conf)
            with system.open_input_stream(path) as f:
                self._remember([np.frombuffer(f.read(), _SEEN)])
        for n in range(at + 1, self.count + 1):
            entry = self._entry(self._name(n, "arrow"))
            self._remember([self._seen(b.column("path").to_pylist(), b.column("modified").to_numpy())
                            for b in map(entry.get_batch, range(entry.num_record_batches))])

    @staticmethod
    def _seen(paths: list, modified) -> np.ndarray:
        out = np.empty(len(paths), _SEEN)
        out["key"], out["at"] = _keys(paths), modified
        return out

    def _remember(self, some: list) -> None:
        taken = np.concatenate([self.taken, *some])
        self.latest = max(self.latest, int(taken["at"].max(initial=0)))
        taken = taken[taken["at"] >= self.latest - MOST_AGE]  # older ones are not new by their age
        self.taken = taken[np.argsort(taken["key"])]
        self.taken_keys = np.ascontiguousarray(self.taken["key"])

    def _new(self, found: list) -> tuple[list, np.ndarray] | None:
        """The new ones among listed files, and what to remember of them."""
        found = [f for f in found if int(f.modified * 1000) >= self.latest - MOST_AGE]
        if not found:
            return None
        seen = self._seen([f.path for f in found], [int(f.modified * 1000) for f in found])
        if len(self.taken):
            i = np.searchsorted(self.taken_keys, seen["key"])
            new = self.taken_keys[np.minimum(i, len(self.taken) - 1)] != seen["key"]
            found, seen = [f for f, is_new in zip(found, new) if is_new], seen[new]
        return (found, seen) if found else None

    def _move(self, part: str, uri: str) -> None:
        """A file of the log is there whole or not at all."""
        system, path = files.locate(uri, self.conf)
        system.move(files.locate(part, self.conf)[1], path)

    def _append(self) -> None:
        """Writes the next entry if files are new."""
        walk = (found for found, _ in listing.walk_ahead(self.options, LISTED_FOLDERS))
        listed = iter(lambda: list(islice(walk, JUDGED_FILES)), [])
        new = filter(None, map(self._new, listed))
        first = next(new, None)
        if first is None:
            return
        system, path = files.locate(self._folder(), self.conf)
        system.create_dir(path, recursive=True)
        uri = self._name(self.count + 1, "arrow")
        part = f"{uri}.{uuid.uuid4().hex}"
        system, path = files.locate(part, self.conf)
        with system.open_output_stream(path) as f, pa.ipc.new_file(f, _LOG) as out:
            def write(some):
                out.write_batch(pa.record_batch([[x.path for x in some], [x.length for x in some],
                                                 [int(x.modified * 1000) for x in some]], schema=_LOG))

            held, remember = [], []
            while first is not None:
                held += first[0]
                remember.append(first[1])
                full = len(held) - len(held) % LOG_ROWS
                for i in range(0, full, LOG_ROWS):
                    write(held[i:i + LOG_ROWS])
                held = held[full:]
                first = next(new, None)
            if held:
                write(held)
        self._move(part, uri)
        self.count += 1
        self._remember(remember)
        if self.count % SNAPSHOT_ENTRIES == 0:
            uri = self._name(self.count, "seen")
            part = f"{uri}.{uuid.uuid4().hex}"
            system, path = files.locate(part, self.conf)
            with system.open_output_stream(path) as f:
                f.write(self.taken.tobytes())
            self._move(part, uri)

    # ---- offsets

    def initialOffset(self):
        return {"log": self._folder(), "batch": 0}

    def latestOffset(self):
        if self.count is None:
            self._load()
        self._append()
        return {"log": self._folder(), "batch": self.count}

    def partitions(self, start, end):
        """Called with the checkpoint's last offset twice before anything else of a restarted query."""
        if "log" not in end:
            raise ValueError("the query's checkpoint is of Spark's own file source: the option maxFilesPerTrigger "
                             "goes on with that")
        if self.log is None:
            self.log = end["log"]
        self.known = max(self.known, end["batch"])
        out = []
        for n in range(start["batch"] + 1, end["batch"] + 1):
            uri = self._name(n, "arrow")
            entry = self._entry(uri)
            last = entry.num_record_batches - 1
            rows = last * LOG_ROWS + entry.get_batch(last).num_rows
            size = max(TASK_FILES, -(-rows // int(listing._option(self.options, "tasks"))))
            out += [ds.InputPartition((uri, i, min(i + size, rows))) for i in range(0, rows, size)]
        return out

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        uri, first, last = partition.value
        entry = self._entry(uri)
        with ThreadPoolExecutor(STAT_THREADS) as pool:
            for i in range(first // LOG_ROWS, -(-last // LOG_ROWS)):
                start = max(0, first - i * LOG_ROWS)
                paths = entry.get_batch(i).column("path").slice(start, last - i * LOG_ROWS - start).to_pylist()
                now = zip(paths, pool.map(lambda p: files.info(p, self.conf), paths))
                there = [(p, x.size) for p, x in now if x.type == pafs.FileType.File]
                yield pa.record_batch([[p for p, _ in there], [size for _, size in there]], schema=_ROWS)


class FileSource(ds.DataSource):
    """``defaults``: how to reach file systems."""

    defaults: dict = {}

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return FileStreamReader({**self.defaults, **dict(self.options)})


# Options of a stream that this source knows; with any other, Spark's file source reads it.
_OPTIONS = {"pathglobfilter", "filelog", "headeronly", dicom.OPTION_INCLUDE_PIXEL_DATA.lower(),
            dicom.OPTION_INCLUDE_CONTENT.lower(), dicom.OPTION_INCLUDE_PRIVATE_TAGS.lower()}


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme belongs to the default file system."""
    if files.split_uri(path)[0] != "file":
        return path
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def _have_partitions(spark: SparkSession, folders: list, conf: tuple) -> bool:
    """Whether a folder has partition folders."""
    def run(batches):
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                if any(e.type == pafs.FileType.Directory and "=" in e.base_name and not listing.hidden(e.base_name)
                       for _, e in files.entries(uri, conf)):
                    yield pa.record_batch([[uri]], names=["uri"])

    if not folders:
        return False
    ship.ensure(spark)
    tasks = min(len(folders), 2 * spark.sparkContext.defaultParallelism)
    found = spark.createDataFrame([(u,) for u in folders], "uri string").repartition(tasks).mapInArrow(run, "uri string")
    return found.count() > 0


def new_files(spark: SparkSession, path: str, options: dict, conf: dict, tasks: int) -> DataFrame | None:
    """The stream of the files of ``path``, read by at most ``tasks`` tasks; None where
    Spark's own file source is to read them: with options of that source, partition
    columns, the log of a file sink, without a shared folder for the log, or if there
    is no such path. The log lies in the option ``fileLog`` or under ``spark.checkpoint.dir``."""
    if any(k.lower() not in _OPTIONS and not k.lower().startswith(files.PREFIXES) for k in options):
        return None
    try:
        log = _qualified(spark, listing._option(options, "fileLog") or ensure_checkpoint_dir(spark))
    except RuntimeError:
        return None
    path, key = _qualified(spark, path), files.conf_of(conf)
    if not files.supported(log, conf) or not files.supported(path, conf):
        return None
    if files.info(f"{path.rstrip('/')}/_spark_metadata", key).type != pafs.FileType.NotFound:
        return None
    try:
        folders = [u for u, e in listing.matches(path, key) if e.type == pafs.FileType.Directory]
    except FileNotFoundError:
        return None
    if _have_partitions(spark, folders, key):
        return None
    register.send(spark, type("FileSource", (FileSource,), {"defaults": dict(key), "__module__": "__main__"}))
    reader = spark.readStream.format(NAME).option("fileLog", log).option("tasks", str(tasks))
    if name_filter := listing._option(options, "pathGlobFilter"):
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)
