"""Scan (S1-S17, F1-F3): end-to-end on synthesised files, golden values of the
reference's data source tests."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import dcmwrite as W
from medframe.sources import dicom

PRIVATE_GOLDEN = ('{"00090010":{"vr":"LO","Value":["someCreator"]},'
                  '"00091000":{"vr":"DA","Value":["20220101"]}}')


def test_reads_patient_and_study(spark, write_files):
    d = write_files({"ct/1-001.dcm": W.ct_slice()})
    row = dicom.read(spark, d + "/ct").select("path", "PatientName", "StudyDate", "StudyTime").first()
    assert row.PatientName.Alphabetic == "Pancreas-CT-CB_001"
    assert row.StudyDate == "2012-07-06"
    assert row.StudyTime == "11:18:23.36"


def test_select_star_and_path(spark, write_files):
    d = write_files({"ct/1-001.dcm": W.ct_slice()})
    df = dicom.read(spark, d + "/ct/*.dcm")
    row = df.first()
    assert row.path.endswith("ct/1-001.dcm") and row.path.startswith("file:")
    assert df.columns[:5] == ["path", "isDicom", "keywords", "vrs", "errors"]
    assert "PixelData" not in df.columns


def test_keywords_and_vrs(spark, write_files):
    d = write_files({"ct/1-001.dcm": W.ct_slice()})
    row = dicom.read(spark, d, options={"recursiveFileLookup": "true"}).select("keywords", "vrs").first()
    assert "PatientName" in row.keywords
    assert "XRay3DAcquisitionSequence" not in row.keywords
    assert row.keywords == sorted(row.keywords, key=row.keywords.index)  # tag order kept
    assert row.keywords.index("StudyDate") < row.keywords.index("PatientName")
    assert row.vrs["PatientName"] == "PN"


def test_parse_error_golden(spark, write_files):
    # no preamble, no meta group: like the reference's writeTo file
    ds = W.element(0x00080030, "TM", W.text("12:00:00", "TM"))
    d = write_files({"bad.dcm": ds})
    row = dicom.read(spark, d).select("errors", "StudyTime").first()
    assert row.errors["StudyTime"] == (
        "java.time.format.DateTimeParseException: Text '12:00:00' could not be parsed at index 2"
    )
    assert row.StudyTime is None


def test_errors_only_for_requested_columns(spark, write_files):
    ds = W.element(0x00080030, "TM", W.text("12:00:00", "TM"))
    d = write_files({"bad.dcm": ds})
    row = dicom.read(spark, d, columns=["errors", "PatientName"]).first()
    assert row.errors == {}


def test_pixel_data_needs_option(spark, write_files):
    d = write_files({"ct.dcm": W.ct_slice()})
    with pytest.raises(AnalysisException):
        dicom.read(spark, d).select("path", "PixelData").first()
    row = dicom.read(spark, d, options={"includePixelData": True}).select("PixelData").first()
    assert len(row.PixelData) == 4 * 4 * 2
    assert "PixelData" in dicom.schema(include_pixel_data=True).fieldNames()


def test_content_option(spark, write_files):
    data = W.ct_slice()
    d = write_files({"ct.dcm": data})
    assert "content" in dicom.schema(include_content=True).fieldNames()
    row = dicom.read(spark, d, options={"INCLUDECONTENT": "true"}).select("path", "content").first()
    assert bytes(row.content) == data


def test_unparsable_boolean_option_is_false(spark, write_files):
    d = write_files({"ct.dcm": W.ct_slice()})
    assert "content" not in dicom.read(spark, d, options={"includeContent": "yes"}).columns


def test_private_tags_golden(spark, write_files):
    ds = (W.element(0x00090010, "LO", W.text("someCreator", "LO"))
          + W.element(0x00091000, "DA", W.text("20220101", "DA")))
    d = write_files({"p.dcm": W.part10(ds)})
    assert "privateTagsJson" in dicom.schema(include_private_tags=True).fieldNames()
    row = dicom.read(spark, d, options={"includePrivateTags": True}).select("path", "privateTagsJson").first()
    assert row.privateTagsJson == PRIVATE_GOLDEN


def test_non_dicom_file_survives(spark, write_files):
    d = write_files({"nonDicom/test.txt": b"this is not a DICOM file\n"})
    row = dicom.read(spark, d + "/nonDicom/test.txt").select("path", "isDicom", "keywords", "vrs", "errors", "PatientName").first()
    assert row.path.endswith("nonDicom/test.txt")
    assert row.isDicom is False
    assert row.keywords is None and row.vrs is None and row.errors == {}
    assert row.PatientName is None


SEQ = 0x00120064
METHOD, ACTION, ACTION_SEQ = 0x00120063, 0x00080307, 0x00080305


def _flat_seq(undefined=False):
    # item data sets in tag order, as a writer produces them
    it1 = W.element(ACTION, "CS", W.text("Action1", "CS")) + W.element(METHOD, "LO", W.text("Method1", "LO"))
    it2 = W.element(ACTION, "CS", W.text("Action2", "CS")) + W.element(METHOD, "LO", W.text("Method2", "LO"))
    return W.sequence(SEQ, [W.item(it1, undefined), W.item(it2, undefined)], undefined=undefined)


FLAT_GOLDEN = ('[{"DeidentificationAction":{"vr":"CS","Value":["Action1"]},'
               '"DeidentificationMethod":{"vr":"LO","Value":["Method1"]}},'
               '{"DeidentificationAction":{"vr":"CS","Value":["Action2"]},'
               '"DeidentificationMethod":{"vr":"LO","Value":["Method2"]}}]')
NESTED_GOLDEN = ('[{"DeidentificationActionSequence":{"vr":"SQ","Value":['
                 '{"DeidentificationAction":{"vr":"CS","Value":["Level2Action1"]}},'
                 '{"DeidentificationAction":{"vr":"CS","Value":["Level2Action2"]}}]},'
                 '"DeidentificationMethod":{"vr":"LO","Value":["Level1Method"]}}]')


@pytest.mark.parametrize("undefined", [False, True])
def test_sequence_json_flat(spark, write_files, undefined):
    d = write_files({"s.dcm": W.part10(_flat_seq(undefined))})
    row = dicom.read(spark, d).select("path", "DeidentificationMethodCodeSequence").first()
    assert row.DeidentificationMethodCodeSequence == FLAT_GOLDEN


def test_sequence_json_nested(spark, write_files):
    inner = W.sequence(ACTION_SEQ, [
        W.item(W.element(ACTION, "CS", W.text("Level2Action1", "CS"))),
        W.item(W.element(ACTION, "CS", W.text("Level2Action2", "CS")), undefined=True),
    ], undefined=True)
    outer_item = inner + W.element(METHOD, "LO", W.text("Level1Method", "LO"))
    ds = W.element(METHOD, "LO", W.text("UnrelatedToSequence", "LO")) + W.sequence(SEQ, [W.item(outer_item)])
    d = write_files({"n.dcm": W.part10(ds)})
    row = dicom.read(spark, d).select("DeidentificationMethodCodeSequence", "DeidentificationMethod").first()
    assert row.DeidentificationMethodCodeSequence == NESTED_GOLDEN
    assert row.DeidentificationMethod == "UnrelatedToSequence"


def test_sequence_json_empty_and_absent(spark, write_files):
    d = write_files({"e.dcm": W.part10(W.sequence(SEQ, [])),
                     "a.dcm": W.part10(W.element(METHOD, "LO", W.text("x", "LO")))})
    rows = {r.path.rsplit("/", 1)[1]: r for r in
            dicom.read(spark, d).select("path", "DeidentificationMethodCodeSequence").collect()}
    assert rows["e.dcm"].DeidentificationMethodCodeSequence == "[]"
    assert rows["a.dcm"].DeidentificationMethodCodeSequence == ""


def _values_dataset(explicit=True, le=True):
    e = lambda tag, vr, v: W.element(tag, vr, v, explicit, le)
    return b"".join([
        e(0x00080018, "UI", W.text("1.2.3", "UI")),
        e(0x00080020, "DA", W.text("20220101", "DA")),
        e(0x00080030, "TM", W.text("120000", "TM")),
        e(0x00100010, "PN", W.text("somePersonName", "PN")),
        e(0x00189087, "FD", W.nums("d", 395.0, le=le)),
        e(0x00189219, "SS", W.nums("h", -492, le=le)),
        e(0x00209165, "AT", W.nums("H", 0x0000, 0x0001, le=le)),
        e(0x00280010, "US", W.nums("H", 492, le=le)),
        e(0x0040A163, "UL", W.nums("I", 4294967295, 492, le=le)),
        e(0x00700022, "FL", W.nums("f", 395.0, 1.5, le=le)),
        e(0x00720082, "SV", W.nums("q", 93, -93, le=le)),
        e(0x00720083, "UV", W.nums("Q", 93, le=le)),
    ])


@pytest.mark.parametrize("ts", [W.EXPLICIT_LE, W.IMPLICIT_LE, W.EXPLICIT_BE, W.DEFLATED])
def test_transfer_syntaxes(spark, write_files, ts):
    explicit = ts != W.IMPLICIT_LE
    le = ts != W.EXPLICIT_BE
    d = write_files({"v.dcm": W.part10(_values_dataset(explicit, le), ts)})
    row = dicom.read(spark, d).first()
    assert row.isDicom
    assert row.SOPInstanceUID == "1.2.3"
    assert row.StudyDate == "2022-01-01" and row.StudyTime == "12:00:00"
    assert tuple(row.PatientName) == ("somePersonName", "", "")
    assert row.DiffusionBValue == [395.0]
    assert row.TagAngleSecondAxis == [-492]
    assert row.DimensionIndexPointer == "00000001"
    assert row.Rows == [492]
    assert row.RationalDenominatorValue == [-1, 492]  # UL wraps like a JVM int
    assert row.GraphicData == [395.0, 1.5]
    assert row.SelectorSVValue == [93, -93] and row.SelectorUVValue == [93]
    # absent attributes: "" for strings, [] for numbers, null for bytes
    assert row.AccessionNumber == "" and row.SliceThickness == ""
    assert row.RedPaletteColorLookupTableData is None and row.Columns == []
    assert tuple(row.ReferringPhysicianName) == ("", "", "")


@pytest.mark.parametrize("header_only", [False, True])
def test_corrupt_files_never_fail(spark, write_files, header_only):
    data = W.ct_slice()
    # zero-byte files are skipped by Spark's file listing, so start at 1 byte
    files = {f"t/{n:04d}.dcm": data[:n] for n in range(1, len(data) + 1)}
    d = write_files(files)
    rows = dicom.read(spark, d + "/t", columns=["isDicom", "PatientID"], header_only=header_only).collect()
    assert len(rows) == len(files)
    for r in rows:
        assert r.isDicom in (True, False)
        if r.isDicom:
            assert r.PatientID in ("", "Pancreas-CT-CB_001")


def test_partition_columns_and_pruning(spark, write_files):
    d = write_files({"study=1/a.dcm": W.ct_slice(), "study=2/b.dcm": W.ct_slice()})
    df = dicom.read(spark, d, columns=["PatientID"])
    assert "study" in df.columns
    one = dicom.read(spark, d, columns=["PatientID"], where="study = 2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "study" in plan
    assert [r.study for r in one.collect()] == [2]


def test_file_filters_before_parsing(spark, write_files):
    d = write_files({"big.dcm": W.ct_slice(64, 64), "small.dcm": W.ct_slice(2, 2)})
    df = dicom.read(spark, d, columns=["Rows"], where="length > 4000")
    assert [r.Rows for r in df.collect()] == [[64]]


def test_user_schema_and_unknown_keyword(spark, write_files):
    d = write_files({"ct.dcm": W.ct_slice()})
    s = "path string, PatientName struct<Alphabetic:string,Ideographic:string,Phonetic:string>, StudyDate string"
    from pyspark.sql.types import StructType

    df = dicom.read(spark, d, schema=StructType.fromDDL(s))
    assert df.columns == ["path", "PatientName", "StudyDate"]
    with pytest.raises(ValueError, match="Unsupported field name"):
        dicom.read(spark, d, columns=["NotAKeyword"])


def test_options_reach_file_listing(spark, write_files):
    d = write_files({"a.dcm": W.ct_slice(), "b.txt": b"text"})
    df = dicom.read(spark, d, options={"pathGlobFilter": "*.dcm"}, columns=["isDicom"])
    assert df.count() == 1


def test_header_only_reads_same_values(spark, write_files):
    d = write_files({"ct.dcm": W.ct_slice(64, 64), "x.txt": b"nope"})
    cols = ["path", "isDicom", "PatientName", "StudyDate", "Rows", "keywords"]
    a = sorted(dicom.read(spark, d, columns=cols, header_only=False).collect())
    b = sorted(dicom.read(spark, d, columns=cols, header_only=True).collect())
    assert a == b


def test_short_name_and_write_refused(spark, write_files):
    from medframe.sources import register

    register.install()
    d = write_files({"ct.dcm": W.ct_slice()})
    df = spark.read.format("dicomFile").option("includePixelData", True).load(d)
    assert df.select("PixelData").first().PixelData is not None
    narrow = spark.read.format("dicomFile").option("columns", "path, PatientID").load(d)
    assert narrow.columns == ["path", "PatientID"]
    with pytest.raises(AnalysisException):
        df.write.format("dicomFile").save(os.path.join(d, "out"))


def test_multi_valued_strings_keep_all_values(spark, write_files):
    ds = W.element(0x00080008, "CS", W.text("ORIGINAL\\PRIMARY\\AXIAL", "CS"))
    d = write_files({"m.dcm": W.part10(ds)})
    df = dicom.decode_frame(dicom.binary_files(spark, d), columns=["ImageType"], keep_elements=True)
    row = df.select("ImageType", F.split(F.col("elements")["ImageType"]["str"], r"\\").alias("all")).first()
    assert row.ImageType == "ORIGINAL"
    assert row.all == ["ORIGINAL", "PRIMARY", "AXIAL"]


def test_utf8_character_set(spark, write_files):
    ds = (W.element(0x00080005, "CS", W.text("ISO_IR 192", "CS"))
          + W.element(0x00100010, "PN", W.text("Müller^Jörg", "PN", "utf-8")))
    d = write_files({"u.dcm": W.part10(ds)})
    assert dicom.read(spark, d).first().PatientName.Alphabetic == "Müller^Jörg"


def test_encapsulated_pixel_data_is_skipped(spark, write_files):
    frag = W.item(b"") + W.item(b"\xff\xd8\xff\xd9")
    ds = (W.element(0x00100020, "LO", W.text("enc", "LO"))
          + W.element(0x7FE00010, "OB", frag + b"\xfe\xff\xdd\xe0\x00\x00\x00\x00", undefined=True))
    d = write_files({"j.dcm": W.part10(ds, W.JPEG_BASELINE)})
    row = dicom.read(spark, d).first()
    assert row.isDicom and row.PatientID == "enc"


def test_bad_value_is_a_column_error_not_a_bad_file(spark, write_files):
    ds = (W.element(0x00100020, "LO", W.text("ok", "LO"))
          + W.element(0x00280010, "IS", W.text("abc", "IS"))
          + W.element(0x00280011, "IS", W.text("64", "IS")))
    d = write_files({"v.dcm": W.part10(ds)})
    row = dicom.read(spark, d, columns=["isDicom", "errors", "PatientID", "Rows", "Columns"]).first()
    assert row.isDicom and row.PatientID == "ok"
    assert row.Rows is None and row.Columns == [64]
    assert row.errors == {"Rows": 'java.lang.NumberFormatException: For input string: "abc"'}


def test_iso2022_japanese_names(spark, write_files):
    name = "Yamada^Tarou=山田^太郎=やまだ^たろう"
    ds = (W.element(0x00080005, "CS", W.text("\\ISO 2022 IR 87", "CS"))
          + W.element(0x00100010, "PN", W.pad(name.encode("iso2022_jp"), "PN")))
    d = write_files({"jp.dcm": W.part10(ds)})
    assert tuple(dicom.read(spark, d).first().PatientName) == ("Yamada^Tarou", "山田^太郎", "やまだ^たろう")


def test_known_tag_stored_as_un_uses_dictionary_vr(spark, write_files):
    ds = (W.element(0x00080020, "UN", W.text("20120706", "DA"))
          + W.element(0x00280010, "UN", W.nums("H", 512)))
    d = write_files({"un.dcm": W.part10(ds)})
    row = dicom.read(spark, d, columns=["vrs", "StudyDate", "Rows"]).first()
    assert row.StudyDate == "2012-07-06" and row.Rows == [512]
    assert row.vrs == {"StudyDate": "UN", "Rows": "UN"}


def test_implicit_vr_private_and_undefined_un_sequence(spark, write_files):
    e = lambda tag, vr, v: W.element(tag, vr, v, explicit=False)
    inner = e(0x00080100, "SH", W.text("CODE1", "SH"))
    un_seq = (W.element(0x00091010, "UN", b"", explicit=False, undefined=True)
              + W.item(inner, undefined=True) + b"\xfe\xff\xdd\xe0\x00\x00\x00\x00")
    ds = (e(0x00090010, "LO", W.text("ACME", "LO")) + un_seq
          + e(0x00100020, "LO", W.text("imp", "LO")))
    d = write_files({"i.dcm": W.part10(ds, W.IMPLICIT_LE)})
    row = dicom.read(spark, d, options={"includePrivateTags": True}).first()
    assert row.isDicom and row.PatientID == "imp"
    assert row.privateTagsJson == (
        '{"00090010":{"vr":"LO","Value":["ACME"]},'
        '"00091010":{"vr":"SQ","Value":[{"00080100":{"vr":"SH","Value":["CODE1"]}}]}}')


@pytest.mark.parametrize("cols", [["PatientID"], ["StudyDate", "Rows"], ["PixelData", "Columns"]])
def test_projected_read_equals_full_read(spark, write_files, cols):
    d = write_files({"ct.dcm": W.ct_slice(), "v.dcm": W.part10(_values_dataset())})
    full = dicom.read(spark, d, options={"includePixelData": True}).select("path", *cols)
    part = dicom.read(spark, d, columns=["path"] + cols, include_pixel_data=True)
    assert sorted(full.collect()) == sorted(part.collect())


def test_bare_data_set_starting_with_group_length(spark, write_files):
    body = W.element(0x00100020, "LO", W.text("glen", "LO"), explicit=False)
    ds = W.element(0x00100000, "UL", W.nums("I", len(body)), explicit=False) + body
    d = write_files({"g.dcm": ds})
    row = dicom.read(spark, d, columns=["isDicom", "PatientID"]).first()
    assert row.isDicom and row.PatientID == "glen"


def test_header_only_refuses_pixel_data(spark, write_files):
    d = write_files({"ct.dcm": W.ct_slice()})
    with pytest.raises(ValueError, match="PixelData"):
        dicom.read(spark, d, columns=["PixelData"], include_pixel_data=True, header_only=True)
    # the default picks whole-file reads when pixel data is requested
    assert dicom.read(spark, d, columns=["PixelData"], include_pixel_data=True).first().PixelData
