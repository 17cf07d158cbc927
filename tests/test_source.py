"""``spark.read.format("dicomFile")`` as PySpark's own kind of data source."""

import datetime
import os
import time

import dcmwrite as W
import pytest
from test_reader import DOUBLE, study

from medframe.sources import dicom, files, listing, register
from medframe.sources.register import DicomReader, DicomStreamReader


@pytest.fixture(scope="module", autouse=True)
def installed(spark):
    register.install(spark)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("source")
    for i in range(20):
        p = d / f"site={'ab'[i % 2]}" / f"day={i % 3 + 1}"
        p.mkdir(parents=True, exist_ok=True)
        (p / f"{i}.dcm").write_bytes(study(i))
    (d / "site=a" / "day=1" / "note.txt").write_bytes(b"not an image")
    (d / "site=a" / "day=1" / "_hidden.dcm").write_bytes(study(1))
    (d / "site=__HIVE_DEFAULT_PARTITION__" / "day=3").mkdir(parents=True)
    (d / "site=__HIVE_DEFAULT_PARTITION__" / "day=3" / "z.dcm").write_bytes(study(99))
    return str(d)


def rows(df):
    return sorted(map(str, df.collect()))


def test_same_rows_as_read(spark, folder):
    own = spark.read.format("dicomFile").load(folder)
    ours = dicom.read(spark, folder)
    assert own.schema.simpleString() == ours.schema.simpleString()
    assert rows(own) == rows(ours) and own.count() == 22
    assert own.schema["day"].dataType.simpleString() == "int"


@pytest.mark.parametrize("options", [{"includePixelData": "true"}, {"includeContent": "true"}, {"includePrivateTags": "true"},
                                     {"INCLUDEPIXELDATA": "TRUE", "includecontent": "true", "includePrivateTags": "true"}])
def test_options_add_columns(spark, write_files, options):
    private = W.element(0x00091010, "LO", b"mine")
    d = write_files({"ct.dcm": W.ct_slice(8, 8), "p.dcm": W.part10(private), "x.txt": b"no"})
    own = spark.read.options(**options).format("dicomFile").load(d)
    ours = dicom.read(spark, d, options=options, header_only=False)
    assert own.columns == ours.columns and rows(own) == rows(ours)


def test_user_schema_and_columns(spark, folder):
    narrow = "PatientID string, day int, isDicom boolean, errors map<string,string>, keywords array<string>"
    first = spark.read.schema(narrow).format("dicomFile").load(folder)
    last = spark.read.format("dicomFile").schema(narrow).load(folder)
    assert first.columns == ["PatientID", "day", "isDicom", "errors", "keywords"] and rows(first) == rows(last)
    assert rows(first) == rows(dicom.read(spark, folder).select(first.columns))
    some = spark.read.format("dicomFile").option("columns", "path, StudyDate").load(folder)
    assert some.columns == ["path", "StudyDate", "site", "day"]
    with pytest.raises(Exception, match="Unsupported field name"):
        spark.read.format("dicomFile").schema("PatientID string, Nothing string").load(folder).collect()
    with pytest.raises(Exception, match="Unsupported field name"):
        spark.read.format("dicomFile").option("columns", "Nothing").load(folder)


@pytest.mark.parametrize("where", [
    "StudyDate >= '2024-01-05' and Modality = 'MR'", "site = 'a' and day > 1", "site is null", "not (Modality = 'MR')",
    "PatientName.Alphabetic = ''", "PatientID in ('P1', 'P4')", "isDicom", "not isDicom", "endswith(path, '3.dcm')",
    "PatientID like 'P1%'", "size(Rows) = 0 and PatientID > 'P2'", "Modality = 'CT' or day = 2", "length(PatientID) = 2",
])
def test_filters_change_nothing_but_the_work(spark, folder, where):
    columns = ["path", "isDicom", "StudyDate", "Modality", "PatientID", "PatientName", "Rows", "site", "day"]
    own = spark.read.format("dicomFile").load(folder).where(where).select(columns)
    assert rows(own) == rows(dicom.read(spark, folder).where(where).select(columns))


def test_filters_are_taken_over_and_handed_back(spark, folder):
    from pyspark.sql import datasource as ds

    reader = DicomReader(dicom.schema().add("site", "string").add("day", "integer"), {"path": folder})
    mine = [ds.GreaterThanOrEqual(("StudyDate",), "2024-01-05"), ds.EqualTo(("site",), "a"), ds.In(("PatientID",), ("P4", "P6")),
            ds.Not(ds.IsNull(("Modality",))), ds.EqualTo(("PatientName", "Alphabetic"), "N4^A"), ds.EqualTo(("isDicom",), True)]
    others = [ds.IsNotNull(("Rows",)), ds.IsNotNull(("PatientName",)), ds.EqualTo(("vrs",), "x")]
    assert reader.pushFilters(mine + others) == others
    slices = reader.partitions()
    assert all("site=a" in f.path for s in slices for f in s.found)  # partitions pruned before a file is opened
    found = [r for s in slices for b in reader.read(s) for r in b.column(b.schema.get_field_index("PatientID")).to_pylist()]
    assert found == ["P4"]
    plan = (spark.read.format("dicomFile").load(folder).where("Modality = 'CT' and size(Rows) = 0").select("path")
            ._jdf.queryExecution().executedPlan().toString())
    assert "size(Rows" in plan and "= CT" not in plan.split("BatchScan")[0]


def test_listing_options(spark, folder, tmp_path):
    def names(path, **options):
        return sorted({os.path.basename(r.path) for r in spark.read.format("dicomFile").options(**options).option(
            "columns", "path").load(path).collect()})

    assert names(folder, pathGlobFilter="1?.dcm") == sorted(f"{i}.dcm" for i in range(10, 20))
    assert names(f"{folder}/site=a/day=[12]/*.dcm") == sorted(
        f"{i}.dcm" for i in range(20) if i % 2 == 0 and i % 3 < 2)
    assert names(f"{folder}/site={{a,b}}/day=1/1*") == sorted(f"{i}.dcm" for i in range(20) if i % 3 == 0 and str(i)[0] == "1")
    nested = tmp_path / "n"
    (nested / "deep").mkdir(parents=True)
    (nested / "a.dcm").write_bytes(study(0))
    (nested / "deep" / "b.dcm").write_bytes(study(1))
    assert names(str(nested)) == ["a.dcm"] and names(str(nested), recursiveFileLookup="true") == ["a.dcm", "b.dcm"]
    os.utime(nested / "a.dcm", (1_000_000_000, 1_000_000_000))
    assert names(str(nested), modifiedAfter="2010-01-01T00:00:00") == []
    assert names(str(nested), modifiedBefore="2010-01-01T00:00:00") == ["a.dcm"]
    one = spark.read.format("dicomFile").option("columns", "path").load(str(nested / "a.dcm"))
    assert one.count() == 1 and one.first().path == dicom.read(spark, str(nested / "a.dcm"), columns=["path"]).first().path
    two = spark.read.format("dicomFile").load([str(nested / "a.dcm"), str(nested / "deep")]).select("path")
    assert two.count() == 2
    (tmp_path / "empty").mkdir()
    assert spark.read.format("dicomFile").load(str(tmp_path / "empty")).count() == 0
    with pytest.raises(Exception, match="Path does not exist"):
        spark.read.format("dicomFile").load(str(tmp_path / "gone")).count()
    with pytest.raises(Exception, match="Path does not exist"):
        spark.read.format("dicomFile").load(f"{folder}/*.nothing").count()


def test_globs_and_partition_types():
    for glob, yes, no in (("*.dcm", "a.dcm", "a.dcmx"), ("a?c", "abc", "ac"), ("[!a-c]x", "dx", "bx"), ("[^a]", "b", "a"),
                          ("{ab,c*}d", "cxd", "xd"), ("a\\*b", "a*b", "axb"), ("a.b", "a.b", "axb")):
        assert listing.glob_pattern(glob).match(yes) and not listing.glob_pattern(glob).match(no), glob
    for texts, kind in (({"1", "-2"}, "int"), ({"1", str(1 << 40)}, "bigint"), ({"1", "2.5"}, "double"),
                        ({"2024-02-29"}, "date"), ({"2024-02-30"}, "string"), ({"1", "x"}, "string"), (set(), "string")):
        assert listing._type(texts) == kind
    assert listing.partition_value("2024-02-29", "date") == datetime.date(2024, 2, 29)


def test_any_scheme_with_the_readers_options(spark, folder, tmp_path_factory):
    import sys

    d = tmp_path_factory.mktemp("double2")
    (d / "store_double2.py").write_text(DOUBLE)
    spark.sparkContext.addPyFile(str(d / "store_double2.py"))
    sys.path.insert(0, str(d))
    options = {"fs.store.factory": "store_double2:make", "fs.store.key": "k-bucket", "fs.store.root": folder}
    df = spark.read.format("dicomFile").options(**options).load("store://bucket/site=a/*/*.dcm")
    assert {r.PatientID for r in df.select("PatientID").collect()} == {f"P{i}" for i in range(0, 20, 2)}
    with pytest.raises(Exception, match="no credentials"):
        spark.read.format("dicomFile").options(**options | {"fs.store.key": "x"}).load("store://bucket/").count()


# ------------------------------------------------------------------ stream


def run_stream(spark, source, checkpoint, sink, **options):
    df = (spark.readStream.format("dicomFile").options(**options).schema("path string, PatientID string, isDicom boolean")
          .load(source))
    q = (df.writeStream.trigger(availableNow=True).format("parquet").option("checkpointLocation", checkpoint)
         .option("path", sink).start())
    q.awaitTermination()
    return sorted(os.path.basename(r.path) for r in spark.read.schema("path string").parquet(sink).collect())


@pytest.mark.parametrize("log", [False, True])
def test_stream_takes_each_file_once_over_restarts(spark, tmp_path, log):
    src, sink, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    options = {"fileLog": str(tmp_path / "log")} if log else {}
    os.mkdir(src)
    names = [f"{i:02d}.dcm" for i in range(79)]
    for n in names[:40]:
        with open(f"{src}/{n}", "wb") as f:
            f.write(W.ct_slice())
    assert run_stream(spark, src, ckpt, sink, **options) == names[:40]
    assert run_stream(spark, src, ckpt, sink, **options) == names[:40]  # nothing new
    for n in names[40:]:
        with open(f"{src}/{n}", "wb") as f:
            f.write(W.ct_slice())
    assert run_stream(spark, src, ckpt, sink, **options) == names
    if log:  # a file moved in with an old time is seen too
        with open(f"{src}/old.dcm", "wb") as f:
            f.write(W.ct_slice())
        os.utime(f"{src}/old.dcm", (1_000_000_000, 1_000_000_000))
        assert run_stream(spark, src, ckpt, sink, **options) == [*names, "old.dcm"]


def test_stream_offsets_replay_the_same_files(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.dcm").write_bytes(study(1))
    schema = dicom.schema()
    for options in ({"path": str(src)}, {"path": str(src), "fileLog": str(tmp_path / "log")}):
        reader = DicomStreamReader(schema, options)
        start, first = reader.initialOffset(), reader.latestOffset()
        time.sleep(0.02)
        (src / f"{len(options)}b.dcm").write_bytes(study(2))
        second = reader.latestOffset()
        assert second == reader.latestOffset()
        again = DicomStreamReader(schema, options)  # restarted: only the offsets are known

        def paths(r, lo, hi):
            return [os.path.basename(f.path) for s in r.partitions(lo, hi) for f in s.found]

        assert paths(again, start, first) == paths(reader, start, first) and "a.dcm" in paths(again, start, first)
        assert paths(again, first, second) == [f"{len(options)}b.dcm"]
        assert again.latestOffset() == second and paths(again, second, second) == []


def test_schema_is_the_ddl(spark):
    from pyspark.sql.types import StructType

    assert dicom.schema(True, True, True) == StructType.fromDDL(dicom.schema_ddl(True, True, True))


def test_slices_are_bounded(monkeypatch):
    found = [files.Found(f"f{i}", 10 << 20, 0.0) for i in range(10_000)]
    reader = DicomReader(dicom.schema(), {"path": "x"})
    slices = reader.scan.slices(found)
    assert max(len(s.found) for s in slices) <= register.MOST_FILES and sum(len(s.found) for s in slices) == 10_000
    assert len(reader.scan.slices(found[:40])) >= 20
    whole = DicomReader(dicom.schema(include_content=True), {"path": "x"})
    assert max(sum(f.length for f in s.found) for s in whole.scan.slices(found)) <= register.WHOLE_BYTES


def test_formats_work_in_a_fresh_process_from_another_folder(tmp_path, folder):
    """Planner and stream processes find the package without this folder."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(register.__file__)))
    code = f'''
import sys
sys.path.insert(0, {os.path.dirname(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from medframe.sources import register
register.install(spark)
schema = "path string, isDicom boolean"
print("batch", spark.read.schema(schema).format("dicomFile").load({folder!r}).count())
q = (spark.readStream.schema(schema).format("dicomFile").load({folder!r}).writeStream.trigger(availableNow=True)
     .format("memory").queryName("t").option("checkpointLocation", {str(tmp_path / "c")!r}).start())
q.awaitTermination()
print("stream", spark.table("t").count())
'''
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert "batch 22" in out.stdout and "stream 22" in out.stdout
