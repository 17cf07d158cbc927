"""Reads that must not lose files, options or numbers."""

import math

import pytest

from medframe.functions import jsonfns, jsontext
from medframe.sources import dicom, files, kernel, register, tokenise


def test_numbers_keep_their_spelling():
    f = lambda k: jsonfns._tag_key_rename(k, {0x00080064: "ConversionType", 0xFFFAFFFA: "X"})
    assert jsontext.rename_keys('{"00080064":[1.10,1E2,123456789012345678901.5,"a"]}', f) == \
        '{"ConversionType":[1.10,1E2,123456789012345678901.5,"a"]}'
    assert f("000000080064") == "ConversionType" and f("FFFAFFFA") == "X"
    for k in (" 00080064", "0008_0064", "0x80064", ""):
        assert f(k) == k


def test_long_tags_are_not_cut(spark):
    df = spark.createDataFrame([("00080064FF",), ("80064",), ("000000080064",)], "tag string")
    got = [r["keyword"] for r in jsonfns.tag_to_keyword(df, "tag").collect()]
    assert got == ["00080064FF", "ConversionType", "ConversionType"]


def test_local_paths_are_not_decoded():
    for name in ("a b", "a#b", "a%20b", "é"):
        assert files.locate(f"file:/d/{name}.dcm")[1] == f"/d/{name}.dcm"
        assert files.locate(f"/d/{name}.dcm")[1] == f"/d/{name}.dcm"


def test_unreadable_file_raises(spark):
    files = spark.createDataFrame([("file:/nowhere/x.dcm", 10)], "path string, length long")
    with pytest.raises(Exception, match="cannot read"):
        dicom.decode_frame(files, ["path", "isDicom"], header_only=True).collect()


@pytest.mark.parametrize("name", ["a b", "a#b", "a%20b", "aé"])
def test_odd_names_read(spark, write_files, name):
    folder = write_files({f"{name}.dcm": b"\x08\x00\x20\x00DA\x08\x0020120706"})
    for header_only in (True, False):
        rows = dicom.read(spark, folder, columns=["path", "isDicom", "StudyDate"], header_only=header_only).collect()
        assert [(r["isDicom"], str(r["StudyDate"])) for r in rows] == [(True, "2012-07-06")]


def test_options_before_format(spark, write_files):
    folder = write_files({"a.dcm": b"\x08\x00\x20\x00DA\x08\x0020120706"})
    register.install()
    df = spark.read.option("includeContent", True).format("dicomFile").load(folder)
    assert "content" in df.columns


def test_json_numbers_are_finite():
    assert math.isfinite(tokenise._ds_number("1e3"))
    with pytest.raises(ValueError):
        tokenise._ds_number("1e999")


def test_narrow_schema_before_format(spark, write_files):
    folder = write_files({"s/a.dcm": b"\x08\x00\x20\x00DA\x08\x0020120706"})
    register.install()
    narrow = "path string, isDicom boolean, StudyDate string"
    df = spark.readStream.schema(narrow).format("dicomFile").load(folder + "/s")
    assert df.columns == ["path", "isDicom", "StudyDate"]
    assert spark.read.schema(narrow).format("dicomFile").load(folder).columns == ["path", "isDicom", "StudyDate"]


def test_partition_column_in_schema(spark, write_files):
    folder = write_files({f"site={s}/a.dcm": b"\x08\x00\x20\x00DA\x08\x0020120706" for s in ("x", "y")})
    df = dicom.read(spark, folder, columns=["site", "StudyDate"])
    assert df.columns == ["site", "StudyDate"]
    assert sorted(r["site"] for r in df.collect()) == ["x", "y"]


def test_stream_reads_headers_by_default(spark, write_files):
    from medframe.streaming.dicom_stream import read_stream

    folder = write_files({"s/a.dcm": b"\x08\x00\x20\x00DA\x08\x0020120706"}) + "/s"
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    narrowed = "Project [path#"
    assert "content#" not in plan(read_stream(spark, folder, columns=["StudyDate"])).split("MapInArrow")[1].split(narrowed)[1].split("]")[0]
    whole = read_stream(spark, folder, columns=["StudyDate"], options={"headerOnly": "false"})
    assert "content#" in plan(whole).split("MapInArrow")[1].split(narrowed)[1].split("]")[0]


def test_broken_sequence_is_invalid_whatever_is_read(spark):
    good = b"\x08\x00\x20\x00DA\x08\x0020120706"
    broken = b"\x08\x00\x05\x03SQ\x00\x00\x08\x00\x00\x00" + b"\x01\x02\x03\x04\x00\x00\x00\x00"
    files = spark.createDataFrame([("a", bytearray(good + broken))], "path string, content binary")
    for columns in (["isDicom", "StudyDate"], ["isDicom", "keywords"]):
        assert dicom.decode_frame(files, columns).first()["isDicom"] is False


def test_numbers_beyond_32_bits_in_text():
    e = tokenise.Elem(0x00280010, "LO", b"5000000000", True)
    with pytest.raises(tokenise.ConversionError):
        tokenise.slot(e, "US", tokenise.DEFAULT, None)
    assert tokenise.slot(e, "SV", tokenise.DEFAULT, None)[2] == [5000000000]


def test_long_rows_keep_unsigned_values(spark):
    rows = [("f", {"a": ("UL", None, [-294967296], None, None), "b": ("UV", None, [-1], None, None),
                   "c": ("SL", None, [-5, 7], None, None)})]
    df = spark.createDataFrame(rows, f"path string, elements map<string,{kernel.SLOT_DDL}>")
    got = {r["keyword"]: r["value"] for r in dicom.elements_long(df).collect()}
    assert got == {"a": "4000000000", "b": "18446744073709551615", "c": "-5\\7"}


def test_standard_columns_without_a_rule_are_named(spark):
    from medframe.operators import deid

    df = spark.createDataFrame([("CT", "p")], "Modality string, PatientID string")
    assert deid.unlisted_columns(df) == ["Modality"]
    with pytest.warns(UserWarning, match="Modality"):
        assert deid.deidentify(df).columns == ["Modality", "PatientID"]


def test_inverted_images_give_no_frames():
    import dcmwrite as W
    from medframe.operators import frames

    ds = (W.element(0x00280004, "CS", W.text("MONOCHROME1", "CS")) + W.element(0x00280010, "US", W.nums("H", 1))
          + W.element(0x00280011, "US", W.nums("H", 2)) + W.element(0x00280100, "US", W.nums("H", 8))
          + W.element(0x7FE00010, "OB", b"ab"))
    assert frames.decode_frames(W.part10(ds), lambda tag: None) == []
