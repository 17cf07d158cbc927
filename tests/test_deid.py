"""De-identification (A1-A10), after the reference's deidentifier tests."""

import pytest
from pyspark.sql import Row

import dcmwrite as W
from medframe.dictionary import DeidElement, DeidOption as O
from medframe.operators import deid
from medframe.sources import dicom


def _elem(options):
    return DeidElement(0, "test", "test", "X", options)


def test_default_action_without_options():
    assert deid.choose_action(_elem({O.RetainUids: "D"}), {}) == "X"


def test_option_action():
    assert deid.choose_action(_elem({O.RetainUids: "D"}), {O.RetainUids: True}) == "D"
    assert deid.replacement("D", "LO") == ("literal", "Anonymized")


def test_priority_of_two_options():
    e = _elem({O.RetainUids: "D", O.RetainDevId: "Z"})
    assert deid.choose_action(e, {O.RetainUids: True, O.RetainDevId: True}) == "Z"
    assert deid.replacement("Z", "LO") == ("literal", "")


def test_irrelevant_options_ignored():
    e = _elem({O.RetainUids: "D", O.RetainDevId: "Z"})
    cfg = {O.RetainUids: True, O.RetainDevId: True, O.RetainLongFullDates: True,
           O.RetainLongModifDates: True}
    assert deid.choose_action(e, cfg) == "Z"


def test_disabled_option_ignored():
    assert deid.choose_action(_elem({O.RetainUids: "K"}), {O.RetainUids: False}) == "X"


def _scan(spark, write_files):
    ds = b"".join([
        W.element(0x00080023, "DA", W.text("20220101", "DA")),
        W.element(0x00080033, "TM", W.text("101010", "TM")),
        W.element(0x00080050, "SH", W.text("ACC1", "SH")),
        W.element(0x00100010, "PN", W.text("Doe^John", "PN")),
        W.element(0x00184000, "LT", W.text("comment", "LT")),
        W.element(0x0050001B, "LO", W.text("cc", "LO")),
        W.element(0x006A0005, "LO", W.text("label", "LO")),
        W.element(0x04000562, "DT", W.text("20220101101010", "DT")),
    ])
    d = write_files({"f.dcm": W.part10(ds)})
    return dicom.read(spark, d, options={"includeContent": True})


def test_basic_profile_on_a_scan(spark, write_files):
    df = deid.deidentify(_scan(spark, write_files))
    row = df.first()
    assert row.ContentDate == "0001-01-01" and row.ContentTime == "00:00:00"
    assert row.AttributeModificationDateTime == "0001-01-01T00:00:00"
    assert row.AnnotationGroupLabel == "Anonymized" and row.AccessionNumber == ""
    assert row.PatientName == ""  # PN struct becomes a literal
    assert "ContainerComponentID" not in df.columns
    assert "AcquisitionComments" not in df.columns
    # not in the de-id table or metadata: unchanged (compat), incl. content
    assert "content" in df.columns and "path" in df.columns and "Modality" in df.columns
    # Z on a VR without an empty value (SQ) drops the column
    assert "ReferencedStudySequence" not in df.columns


def test_clean_desc_option(spark, write_files):
    row = deid.deidentify(_scan(spark, write_files), {O.CleanDesc: True}).first()
    assert row.AcquisitionComments == "ToClean"


def test_strict_mode_drops_unknown_columns(spark, write_files):
    df = deid.deidentify(_scan(spark, write_files), strict=True)
    assert "content" not in df.columns and "Modality" not in df.columns
    assert "ContentDate" in df.columns


def test_column_order_kept(spark):
    df = spark.createDataFrame([Row(b="1", AccessionNumber="x", a="2")])
    assert deid.deidentify(df).columns == ["b", "AccessionNumber", "a"]


@pytest.fixture()
def uid_df(spark):
    return spark.createDataFrame([("uidValue",), ("",), (None,)], "ConcatenationUID string")


def test_pseudonym_changes_value(uid_df):
    vals = [r.ConcatenationUID for r in deid.deidentify(uid_df).collect()]
    assert vals[0] != "uidValue" and len(vals[0]) == 64
    assert vals[1] == "" and vals[2] is None


def test_pseudonym_deterministic_with_salt(uid_df):
    a = deid.deidentify(uid_df, salt="aSaltValue").first().ConcatenationUID
    b = deid.deidentify(uid_df, salt="aSaltValue").first().ConcatenationUID
    c = deid.deidentify(uid_df, salt="aSecondSaltValue").first().ConcatenationUID
    assert a == b and a != c
    import hashlib

    assert a == hashlib.sha256(b"uidValueaSaltValue").hexdigest()


def test_action_table_and_long_form(spark):
    plan = {r.keyword: r for r in deid.action_table(spark, {O.CleanDesc: True}).collect()}
    assert plan["AcquisitionComments"].action == "C"
    assert plan["AccessionNumber"].kind == "literal" and plan["AccessionNumber"].literal == ""
    tall = spark.createDataFrame(
        [(1, "AccessionNumber", "A1"), (1, "ContainerComponentID", "c"), (1, "Modality", "CT")],
        "id int, keyword string, value string")
    out = {r.keyword: r for r in deid.deidentify_long(tall, {O.CleanDesc: True}).collect()}
    assert out["AccessionNumber"].value == "" and out["AccessionNumber"].action == "Z"
    assert "ContainerComponentID" not in out
    assert out["Modality"].value == "CT" and out["Modality"].action == ""


def test_options_by_name(spark):
    df = spark.createDataFrame([("1.2.3",)], "SOPInstanceUID string")
    assert deid.deidentify(df, ["RetainUids"]).first().SOPInstanceUID == "1.2.3"


def test_scan_to_long_to_deid(spark, write_files):
    ds = b"".join([
        W.element(0x00080050, "SH", W.text("ACC1", "SH")),
        W.element(0x00100010, "PN", W.text("Doe^John", "PN")),
        W.element(0x00184000, "LT", W.text("comment", "LT")),
        W.element(0x00280010, "US", W.nums("H", 512)),
        W.element(0x00280030, "DS", W.text("0.5\\0.5", "DS")),
    ])
    d = write_files({"f.dcm": W.part10(ds)})
    scanned = dicom.decode_frame(dicom.binary_files(spark, d), keep_elements=True)
    tall = dicom.elements_long(scanned)
    got = {r.keyword: (r.vr, r.value) for r in tall.collect()}
    assert got["Rows"] == ("US", "512") and got["PixelSpacing"] == ("DS", "0.5\\0.5")
    out = {r.keyword: r for r in deid.deidentify_long(tall).collect()}
    assert out["AccessionNumber"].value == "" and out["PatientName"].value == ""
    assert "AcquisitionComments" not in out and out["Rows"].value == "512"


def test_top_level_api(spark, write_files):
    import medframe as mf

    d = write_files({"f.dcm": W.part10(W.element(0x00080050, "SH", W.text("ACC1", "SH")))})
    df = mf.deidentify(mf.read(spark, d, columns=["AccessionNumber"]), {mf.DeidOption.RetainUids: True})
    assert df.first().AccessionNumber == ""


def test_elements_long_sequences_and_bad_files(spark, write_files):
    seq = W.sequence(0x00120064, [W.item(W.element(0x00120063, "LO", W.text("M1", "LO")))])
    d = write_files({"s.dcm": W.part10(seq), "x.txt": b"not dicom at all"})
    scanned = dicom.decode_frame(dicom.binary_files(spark, d), keep_elements=True)
    rows = dicom.elements_long(scanned).collect()
    assert [(r.keyword, r.vr) for r in rows] == [("DeidentificationMethodCodeSequence", "SQ")]
    assert rows[0].value == '[{"DeidentificationMethod":{"vr":"LO","Value":["M1"]}}]'
    assert rows[0].path.endswith("s.dcm")
