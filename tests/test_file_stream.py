"""The file log of ``read_stream``: little on the driver, every file once."""

import os
import pickle
import time

import dcmwrite as W
import pytest

from medframe.sources import listing
from medframe.streaming import file_stream as S
from medframe.streaming.dicom_stream import read_stream

DAY = 24 * 3600


def put(folder, *names, age=0.0):
    for n in names:
        p = folder / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(W.ct_slice(2, 2))
        os.utime(p, (time.time() - age, time.time() - age))


def reader(tmp_path, path, **options):
    return S.FileStreamReader({"path": str(path), "fileLog": str(tmp_path / "log"), "tasks": "8", **options})


def paths(r, lo, hi):
    return sorted(os.path.basename(p) for part in r.partitions(lo, hi) for b in r.read(part) for p in b.column("path").to_pylist())


def run(spark, stream, tmp_path, trigger=None):
    q = (stream.writeStream.trigger(**(trigger or {"availableNow": True})).format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    if trigger:
        q.processAllAvailable()
        q.stop()
    else:
        q.awaitTermination()
    out = spark.read.schema("path string").parquet(str(tmp_path / "out")).collect()
    return sorted(os.path.basename(r.path) for r in out), q.recentProgress


def test_driver_holds_no_files_of_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    put(src, *(f"s{i % 3}/{i}.dcm" for i in range(90)))
    names, progress = run(spark, read_stream(spark, f"{src}/s*", columns=["path"]), tmp_path)
    assert names == sorted(f"{i}.dcm" for i in range(90))
    # Spark's file source lists all files on the driver, and those of a micro-batch again
    assert not any("FileStreamSource" in s.description for p in progress for s in p.sources)


def test_plan_of_a_micro_batch_does_not_grow_with_its_files(tmp_path):
    src = tmp_path / "in"
    put(src, *(f"{i}.dcm" for i in range(600)))
    r = reader(tmp_path, src)
    end = r.latestOffset()
    parts = r.partitions(r.initialOffset(), end)
    assert len(parts) == 8 and len(pickle.dumps(parts)) < 3000 and r.taken.nbytes == 24 * 600
    assert paths(r, r.initialOffset(), end) == sorted(f"{i}.dcm" for i in range(600))
    batches = [b.num_rows for p in parts for b in r.read(p)]
    assert sum(batches) == 600 and max(batches) <= S.LOG_ROWS


def test_listing_is_few_folders_ahead(tmp_path, monkeypatch):
    src, listed = tmp_path / "in", []
    put(src, *(f"s{i:02d}/{i}.dcm" for i in range(30)))
    entries = listing.files.entries
    monkeypatch.setattr(listing.files, "entries", lambda uri, conf: listed.append(uri) or entries(uri, conf))
    taken = 0
    for _ in listing.walk_ahead({"path": f"{src}/s*"}, 4):
        taken += 1  # a file in each folder
        assert len(listed) <= 1 + taken + 4  # one for the glob
    assert taken == 30


@pytest.mark.parametrize("trigger", [None, {"processingTime": "0 seconds"}])
def test_each_file_once_over_restarts(spark, tmp_path, trigger):
    src = tmp_path / "in"
    put(src, "a.dcm", "b.dcm")

    def again():
        return run(spark, read_stream(spark, str(src), columns=["path"], options={"fileLog": str(tmp_path / "log")}),
                   tmp_path, trigger)[0]

    assert again() == ["a.dcm", "b.dcm"]
    assert again() == ["a.dcm", "b.dcm"]
    put(src, "c.dcm", age=DAY)          # moved in with an older time
    put(src, "b.dcm")                   # written again
    put(src, "old.dcm", age=9 * DAY)    # not new for Spark's file source either
    assert again() == ["a.dcm", "b.dcm", "c.dcm"]


def test_same_files_and_ages_as_sparks_source(spark, tmp_path):
    src = tmp_path / "in"
    put(src, "a.dcm", "_hidden.dcm", ".dot.dcm", "n.txt", age=3 * DAY)
    put(src, "older.dcm", age=30 * DAY)  # in the first batch a file may have any age
    put(src, "deep/x.dcm")
    for glob in (str(src), f"{src}/*", f"{src}/*.dcm", f"{src}/{{a,older}}.dcm"):
        got = []
        for kind, more in (("own", {}), ("spark", {"maxFilesPerTrigger": "1000"})):
            to = tmp_path / f"{kind}-{abs(hash(glob))}"
            stream = read_stream(spark, glob, columns=["path"], options={"pathGlobFilter": "*.dcm", **more})
            q = (stream.writeStream.trigger(availableNow=True).format("parquet").option("path", f"{to}/out")
                 .option("checkpointLocation", f"{to}/ckpt").start())
            q.awaitTermination()
            assert ("FileStreamSource" in str(q.lastProgress)) == bool(more)
            got.append(sorted(r.path for r in spark.read.schema("path string").parquet(f"{to}/out").collect()))
        assert got[0] == got[1] and got[0], glob


def test_replays_and_snapshots(tmp_path, monkeypatch):
    monkeypatch.setattr(S, "SNAPSHOT_ENTRIES", 2)
    src = tmp_path / "in"
    put(src, "0.dcm")
    r = reader(tmp_path, src)
    offsets = [r.initialOffset(), r.latestOffset()]
    for i in range(1, 6):
        put(src, f"{i}.dcm")
        offsets.append(r.latestOffset())
    assert r.latestOffset() == offsets[-1]
    again = reader(tmp_path, src)  # restarted: only the offsets are known
    assert again.partitions(offsets[-1], offsets[-1]) == []
    assert again.latestOffset() == offsets[-1] and again.taken.tobytes() == r.taken.tobytes()
    for i in range(6):
        assert paths(again, offsets[i], offsets[i + 1]) == [f"{i}.dcm"]
    assert paths(again, offsets[0], offsets[-1]) == [f"{i}.dcm" for i in range(6)]
    (src / "3.dcm").unlink()  # gone before its task began
    assert paths(again, offsets[2], offsets[-1]) == ["2.dcm", "4.dcm", "5.dcm"]


def test_a_written_entry_that_no_offset_names_is_the_next(tmp_path):
    src = tmp_path / "in"
    put(src, "a.dcm")
    r = reader(tmp_path, src)
    first = r.latestOffset()
    put(src, "b.dcm")
    lost = r.latestOffset()
    again = reader(tmp_path, src)
    again.partitions(first, first)
    put(src, "c.dcm")
    end = again.latestOffset()
    assert end["batch"] == lost["batch"] + 1 and paths(again, first, end) == ["b.dcm", "c.dcm"]


def test_lost_logs_and_other_checkpoints_are_refused(tmp_path):
    src = tmp_path / "in"
    put(src, "a.dcm")
    end = reader(tmp_path, src).latestOffset()
    os.remove(f"{end['log']}/000000000001.arrow".removeprefix("file:"))
    again = reader(tmp_path, src)
    again.partitions(end, end)
    with pytest.raises(FileNotFoundError, match="as long as the query's checkpoint"):
        again.latestOffset()
    with pytest.raises(ValueError, match="maxFilesPerTrigger"):
        reader(tmp_path, src).partitions({"logOffset": 0}, {"logOffset": 0})


def test_partition_columns_and_unmatched_globs(spark, tmp_path):
    src = tmp_path / "in"
    put(src, "day=1/a.dcm", "day=2/b.dcm")
    stream = read_stream(spark, str(src), columns=["path"])
    assert stream.columns == ["path", "day"]
    new = tmp_path / "later"
    new.mkdir()
    stream = read_stream(spark, f"{new}/*", columns=["path"])  # a folder that is still empty
    put(new, "c.dcm")
    assert run(spark, stream, tmp_path)[0] == ["c.dcm"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_stream(spark, str(tmp_path / "gone"), columns=["path"])
