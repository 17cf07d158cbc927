"""Reading by ranges on any scheme, filters judged while a file is read, nesting
of any depth, character sets, and wide schemas."""

import datetime
import json
import os
import struct
import time

import dcmwrite as W
import pytest

from medframe.functions import values
from medframe.sources import charsets, dicom, files, kernel
from medframe.sources import tokenise as tk
from medframe.sources.predicates import predicate

VRS = {e.tag: e.vr for e in dicom.dictmod.active().elements}


# ------------------------------------------------------------------ depth


def nested(depth, undefined):
    body = W.element(0x00080104, "LO", b"end ")
    for _ in range(depth):
        body = W.sequence(0x00081140, [W.item(body, undefined)], undefined=undefined)
    return W.part10(body + W.element(0x00100020, "LO", W.text("P1", "LO")))


@pytest.mark.parametrize("undefined", [True, False])
def test_nesting_of_any_depth(spark, write_files, undefined):
    d = write_files({"deep.dcm": nested(5000, undefined)})
    row = dicom.read(spark, d, columns=["isDicom", "PatientID", "ReferencedImageSequence"]).first()
    assert row.isDicom and row.PatientID == "P1"
    text = row.ReferencedImageSequence
    assert text.count('{"ReferencedImageSequence":{"vr":"SQ","Value":[') == 4999
    assert text.endswith('{"CodeMeaning":{"vr":"LO","Value":["end"]}}' + "]}}" * 4999 + "]")
    narrow = dicom.read(spark, d, columns=["isDicom", "PatientID"]).first()  # the sequence is only walked
    assert narrow.isDicom and narrow.PatientID == "P1"


def test_broken_nesting_is_not_dicom():
    whole = nested(4, True)
    for cut in range(len(W.part10(b"")) + 1, len(whole) - len(W.element(0x00100020, "LO", b"P1"))):
        with pytest.raises(tk.PARSE_FAULTS):
            tk.parse(whole[:cut], VRS.get)
    with pytest.raises(tk.NotDicom):
        tk.parse(W.part10(W.element(0x00081140, "SQ", W.item(b"", True)[:8], undefined=True)), VRS.get)


def test_item_delimiter_in_a_defined_item():
    inner = W.element(0x00080104, "LO", b"ab") + struct.pack("<HHI", 0xFFFE, 0xE00D, 0)
    data = W.part10(W.sequence(0x00081140, [W.item(inner)]) + W.element(0x00100020, "LO", b"P1"))
    assert [e.tag for e in tk.parse(data, VRS.get).elements] == [0x00081140, 0x00100020]


# ------------------------------------------------------------------ character sets

# Names of PS3.5 annexes H, I and K: Specific Character Set, bytes, text.
NAMES = [
    ("\\ISO 2022 IR 87",
     "59616D6164615E5461726F753D1B24423B3345441B28425E1B244242404F3A1B28423D1B24422464245E24401B28425E1B2442243F246D24261B2842",
     "Yamada^Tarou=山田^太郎=やまだ^たろう"),
    ("ISO 2022 IR 13\\ISO 2022 IR 87",
     "D4CFC0DE5EC0DBB33D1B24423B3345441B284A5E1B244242404F3A1B284A3D1B24422464245E24401B284A5E1B2442243F246D24261B284A",
     "ﾔﾏﾀﾞ^ﾀﾛｳ=山田^太郎=やまだ^たろう"),
    ("\\ISO 2022 IR 149",
     "486F6E675E47696C646F6E673D1B242943FBF35E1B242943D1CED4D73D1B242943C8AB5E1B242943B1E6B5BF",
     "Hong^Gildong=洪^吉洞=홍^길동"),
    ("\\ISO 2022 IR 58", "5A68616E675E5869616F446F6E673D1B242941D5C55E1B242941D0A1B6AB3D", "Zhang^XiaoDong=张^小东="),
    ("ISO 2022 IR 100\\ISO 2022 IR 126", "4AE972F46D653D1B2D46C4E9EF5EE9", "Jérôme=Διο^é"),
    ("ISO_IR 192", "57616E675EE5B08FE69DB1", "Wang^小東"),
    ("GB18030", "57616E675ECDF53DD0A15E", "Wang^王=小^"),
    ("ISO_IR 144", "BBEE6365D2", "Люceв"),
]


@pytest.mark.parametrize("terms, data, text", NAMES)
def test_names_of_the_standard(terms, data, text):
    assert charsets.charset(terms).decode(bytes.fromhex(data), True) == (text, True)


def test_two_sets_in_one_file(spark, write_files):
    terms, data, text = NAMES[0]
    name = bytes.fromhex(data)
    item = W.element(0x00080005, "CS", W.text("ISO_IR 100", "CS")) + W.element(0x00080104, "LO", "Größe ".encode("latin-1"))
    ds = (W.element(0x00080005, "CS", W.text(terms, "CS")) + W.element(0x00081030, "LO", W.pad(bytes.fromhex("1B24423B3345441B2842"), "LO"))
          + W.sequence(0x00081140, [W.item(item)]) + W.element(0x00100010, "PN", W.pad(name, "PN")))
    row = dicom.read(spark, write_files({"a.dcm": W.part10(ds)}),
                     columns=["PatientName", "StudyDescription", "ReferencedImageSequence", "errors"]).first()
    assert "=".join(row.PatientName) == text and row.StudyDescription == "山田" and not row.errors
    assert json.loads(row.ReferencedImageSequence)[0]["CodeMeaning"]["Value"] == ["Größe"]


@pytest.mark.parametrize("terms, data", [
    ("", b"M\xfcller"), ("ISO_IR 192", b"M\xfcller"), ("ISO_IR 999", b"M\xfcller"), ("\\ISO 2022 IR 87", b"\x1b$B\x7f\x7f\x1b(B"),
    ("\\ISO 2022 IR 87", b"\x1b$(Zab")])
def test_undecodable_bytes_are_told(spark, write_files, terms, data):
    ds = W.element(0x00080005, "CS", W.text(terms, "CS")) + W.element(0x00100010, "PN", W.pad(data, "PN")) + W.element(
        0x00100020, "LO", b"fine")
    d = write_files({"a.dcm": W.part10(ds)})
    row = dicom.read(spark, d, columns=["isDicom", "PatientName", "PatientID", "errors"]).first()
    assert row.isDicom and row.PatientID == "fine" and "�" in row.PatientName.Alphabetic
    assert list(row.errors) == ["PatientName"] and "CharacterCodingException" in row.errors["PatientName"]


def test_undecodable_date_has_one_error(spark, write_files):
    d = write_files({"a.dcm": W.part10(W.element(0x00080020, "DA", b"2020\xff101"))})
    row = dicom.read(spark, d, columns=["StudyDate", "errors"]).first()
    assert row.StudyDate is None and "index 4" in row.errors["StudyDate"]


# ------------------------------------------------------------------ filters


def study(i, extra=b""):
    return W.part10(W.element(0x00080020, "DA", W.text(f"2024010{i % 9 + 1}", "DA"))
                    + W.element(0x00080060, "CS", W.text(["CT", "MR"][i % 2], "CS")) + extra
                    + (W.element(0x00100010, "PN", W.text(f"N{i}^A", "PN")) if i % 3 else b"")
                    + W.element(0x00100020, "LO", W.text(f"P{i}", "LO"))
                    + W.element(0x00200010, "SH", W.text(f"S{i}", "SH")))


FILTERS = [
    ([("StudyDate", ">=", "2024-01-05")], "StudyDate >= '2024-01-05'"),
    ([("Modality", "=", "MR"), ("StudyDate", "<", "2024-01-07")], "Modality = 'MR' and StudyDate < '2024-01-07'"),
    ([("Modality", "=", "MR", True)], "not (Modality = 'MR')"),
    ([("PatientID", "in", ["P1", "P4", "P100"])], "PatientID in ('P1', 'P4', 'P100')"),
    ([("PatientID", "startswith", "P1")], "startswith(PatientID, 'P1')"),
    ([("PatientID", "endswith", "1", True)], "not endswith(PatientID, '1')"),
    ([("StudyID", "contains", "1")], "contains(StudyID, '1')"),
    ([(("PatientName", "Alphabetic"), "=", "")], "PatientName.Alphabetic = ''"),
    ([(("PatientName", "Alphabetic"), ">", "N5")], "PatientName.Alphabetic > 'N5'"),
    ([("StudyDate", "is null")], "StudyDate is null"),
    ([("StudyDate", "is not null")], "StudyDate is not null"),
    ([("StudyDate", "<=>", None, True)], "not (StudyDate <=> null)"),
    ([("isDicom", "=", False)], "isDicom = false"),
    ([("path", "contains", "3.dcm")], "contains(path, '3.dcm')"),
    ([("StudyDate", "=", "2024-01-01", True), ("Modality", "is null", None, True)],
     "not (StudyDate = '2024-01-01') and Modality is not null"),
]


@pytest.fixture(scope="module")
def studies(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("studies")
    for i in range(20):
        (d / f"{i}.dcm").write_bytes(study(i))
    (d / "bad_date.dcm").write_bytes(W.part10(W.element(0x00080020, "DA", b"2024.1.1")))
    (d / "text.txt").write_bytes(b"not an image")
    (d / "cut.dcm").write_bytes(study(5)[:-6])
    return str(d)


@pytest.mark.parametrize("filters, where", FILTERS, ids=[w for _, w in FILTERS])
@pytest.mark.parametrize("header_only", [True, False])
def test_filters_equal_where(spark, studies, filters, where, header_only):
    columns = ["path", "isDicom", "PatientID", "StudyDate", "Modality", "PatientName", "StudyID"]
    all_rows = dicom.read(spark, studies, columns=columns, header_only=header_only)
    some = dicom.read(spark, studies, columns=columns, header_only=header_only, filters=filters)
    want = sorted(map(str, all_rows.where(where).collect()))
    assert sorted(map(str, some.collect())) == want
    # the filtered column need not be among the wanted ones
    few = dicom.read(spark, studies, columns=["path"], header_only=header_only, filters=filters)
    assert len(few.collect()) == len(want)


def test_filters_on_other_columns_are_refused(spark, studies):
    for bad in ("Rows", "Nothing", "PatientName", ("PatientID", "x")):
        with pytest.raises(ValueError, match="cannot filter"):
            dicom.read(spark, studies, filters=[(bad, "=", "x")])
    with pytest.raises(ValueError, match="unknown filter"):
        dicom.read(spark, studies, filters=[("PatientID", "like", "x")])


def decoder(columns, filters=(), **kw):
    d = dicom.dictmod.active()
    cols = [d.by_keyword[c] for c in columns]
    return kernel.Decoder(kernel.Spec({e.tag: (e.keyword, e.vr) for e in d.elements},
                                      [kernel.Column(e.keyword, e.tag, e.vr, e.single_vr) for e in cols],
                                      predicates=tuple(predicate(*f) for f in filters), **kw))


def test_reading_ends_at_the_first_element_that_fails(monkeypatch, tmp_path):
    fill = W.element(0x00081030, "LO", b"x" * 60_000) * 1 + W.element(0x00091010, "OB", bytes(3_000_000))
    path = tmp_path / "big.dcm"
    path.write_bytes(study(0, fill))
    got = []
    read = files.read_range
    monkeypatch.setattr(files, "read_range", lambda *a: got.append(len(x := read(*a))) or x)
    # another modality is wanted: two elements and the first prefix are enough
    dec = decoder(["Modality", "PatientID"], [("Modality", "=", "MR")])
    with pytest.raises(tk.Rejected) as e:
        kernel.read_header(str(path), None, dec.vr_of, True, checks=dec.checks)
    assert e.value.tags == 2 and sum(got) == kernel.HEADER_FIRST_READ
    got.clear()
    parsed = kernel.read_header(str(path), None, dec.vr_of, True, checks=decoder(["Modality"], [("Modality", "=", "CT")]).checks)
    assert len(parsed.elements) == 6 and sum(got) == path.stat().st_size  # each byte once
    # a set named later, or text beyond ASCII before it is known, is judged with the whole file
    odd = W.part10(W.element(0x00080060, "CS", b"M\xc4") + W.element(0x00080005, "CS", b"ISO_IR 100"))
    tk.parse(odd, dec.vr_of, checks=dec.checks)


# ------------------------------------------------------------------ ranges

DOUBLE = '''
import pyarrow.fs as pafs


def make(authority, options):
    """A store that only opens with the right key."""
    if options.get("fs.store.key") != "k-" + authority:
        raise PermissionError("no credentials for " + authority)
    return pafs.SubTreeFileSystem(options["fs.store.root"], pafs.LocalFileSystem()), ""
'''


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """A scheme of our own; executors get its module like any other package."""
    import sys

    folder = tmp_path_factory.mktemp("double")
    path = folder / "store_double.py"
    path.write_text(DOUBLE)
    spark.sparkContext.addPyFile(str(path))
    sys.path.insert(0, str(folder))
    return {"fs.store.factory": "store_double:make", "fs.store.key": "k-bucket"}


def test_options_reach_the_file_system(spark, studies, store):
    names = [n for n in sorted(os.listdir(studies)) if n[0].isdigit()]
    listed = spark.createDataFrame([(f"store://bucket/{n}", os.path.getsize(f"{studies}/{n}")) for n in names],
                                   "path string, length long")
    options = store | {"fs.store.root": studies}
    df = dicom.decode_frame(listed, ["path", "PatientID"], header_only=True, options=options)
    assert {r.PatientID for r in df.collect()} == {f"P{i}" for i in range(20)}
    with pytest.raises(Exception, match="no credentials"):
        dicom.decode_frame(listed, ["PatientID"], header_only=True, options=options | {"fs.store.key": "wrong"}).collect()
    with pytest.raises(Exception, match="no file system for 'store'"):
        dicom.decode_frame(listed, ["PatientID"], header_only=True).collect()


def test_schemes_and_their_options():
    assert files.split_uri("s3a://b/k/x.dcm") == ("s3a", "b", "/k/x.dcm")
    assert files.split_uri("/d/a%20b:c.dcm") == ("file", "", "/d/a%20b:c.dcm")
    assert files.split_uri("file:/d/a.dcm")[2] == "/d/a.dcm" and files.split_uri("file:///d/a.dcm")[2] == "/d/a.dcm"
    for uri in ("s3a://b", "gs://b", "hdfs://n", "abfss://c@a.dfs.core.windows.net", "/d", "file:/d"):
        assert files.supported(uri)
    assert not files.supported("viewfs://n/d") and files.supported("viewfs://n", {"fs.viewfs.factory": "m:f"})
    conf = files._Conf(files.conf_of({"fs.s3a.access.key": "a", "fs.s3a.bucket.b.access.key": "b", "header": "no"}))
    assert conf.s3("b", "access.key") == "b" and conf.s3("c", "access.key") == "a" and conf.get("header") is None


def test_plan_reads_no_content(spark, studies):
    plan = dicom.read(spark, studies, columns=["PatientID"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_credentials_of_the_session_are_taken(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.s3a.bucket.mine.access.key", "from-session")
    try:
        conf = dicom.file_system_options(spark, {"fs.s3a.secret.key": "option", "pathGlobFilter": "*"})
        assert conf["fs.s3a.bucket.mine.access.key"] == "from-session" and conf["fs.s3a.secret.key"] == "option"
        assert "pathGlobFilter" not in conf
    finally:
        hadoop.unset("fs.s3a.bucket.mine.access.key")


# ------------------------------------------------------------------ wide schemas


def test_wide_reads_cost_little_more_than_narrow_ones(spark):
    """All columns of narrow files: the kernel makes only what files hold."""
    n, reps = 2000, 3
    data = [study(i) for i in range(n)]
    all_columns = [e.keyword for e in dicom.dictmod.active().column_elements()]

    def seconds(columns, **kw):
        best = 9e9
        for _ in range(reps):
            dec = decoder(columns, **kw)
            t = time.perf_counter()
            dec.batch(n, lambda i: tk.parse(data[i], dec.vr_of, True, dec.keep), None)
            best = min(best, time.perf_counter() - t)
        return best

    two, wide = seconds(["StudyDate", "PatientID"], want_vrs=True), seconds(all_columns, want_vrs=True)
    assert len(all_columns) > 150 and wide < 3 * two, (two, wide)


def test_finished_values_equal_the_sql_decoders(spark, studies):
    columns = ["isDicom", *[e.keyword for e in dicom.dictmod.active().column_elements()]]
    rows = {os.path.basename(r.path): r for r in dicom.read(spark, studies, columns=["path", "errors", *columns]).collect()}
    dec = decoder(columns[1:], final=True)
    names = sorted(rows)
    data = [open(f"{studies}/{n}", "rb").read() for n in names]
    got = dec.batch(len(names), lambda i: tk.parse(data[i], dec.vr_of), None)
    for k, c in enumerate(columns[1:]):
        for n, v in zip(names, got[kernel.column_name(k)].to_pylist()):
            want = rows[n][c]
            assert v == (want.asDict() if hasattr(want, "asDict") else want), (n, c)
    for n, e in zip(names, got["errors"].to_pylist()):
        assert dict(e or ()) == rows[n].errors


def test_date_and_time_of_today():
    now = datetime.datetime(2024, 2, 29, 23, 59, 59, 120000)
    assert values.date(now.strftime("%Y%m%d")) == (now.date().isoformat(), None)
    assert values.time(now.strftime("%H%M%S.%f")) == ("23:59:59.12", None)
