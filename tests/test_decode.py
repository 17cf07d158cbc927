"""VR decoders as SQL (V1-V11) on plain values, and dictionary facts."""

import pytest

from medframe import dictionary as D
from medframe.functions import decode


def _one(spark, expr):
    return spark.sql(f"select {expr} as v").first().v


@pytest.mark.parametrize("raw, iso", [
    ("20120706", "2012-07-06"),
    ("20220231", "2022-02-28"),   # smart resolution clamps the day
    ("20240231", "2024-02-29"),
    ("20230431", "2023-04-30"),
    ("00010101", "0001-01-01"),
    ("", ""),
    (None, ""),
    ("2012.07.06", None),
    ("20221301", None),
    ("20220132", None),
    ("00000101", None),
    ("2022010", None),
])
def test_date_values(spark, raw, iso):
    v = "null" if raw is None else decode.sql_str(raw)
    assert _one(spark, decode.date_value_sql(f"cast({v} as string)")) == iso


@pytest.mark.parametrize("raw, msg", [
    ("2012.07.06", "Text '2012.07.06' could not be parsed at index 4"),
    ("12:00:00", "Text '12:00:00' could not be parsed at index 0"),
    ("2022010", "Text '2022010' could not be parsed at index 6"),
    ("202201011", "Text '202201011' could not be parsed at index 0"),
    ("20221301", "Text '20221301' could not be parsed: Invalid value for MonthOfYear (valid values 1 - 12): 13"),
    ("20220132", "Text '20220132' could not be parsed: Invalid value for DayOfMonth (valid values 1 - 28/31): 32"),
    ("00000101", "Text '00000101' could not be parsed: Invalid value for YearOfEra "
                 "(valid values 1 - 999999999/1000000000): 0"),
])
def test_date_errors(spark, raw, msg):
    out = _one(spark, decode.date_error_sql(decode.sql_str(raw)))
    assert out == "java.time.format.DateTimeParseException: " + msg


@pytest.mark.parametrize("raw, iso", [
    ("111823.360000", "11:18:23.36"),
    ("122734.625000", "12:27:34.625"),   # six fraction digits
    ("120000", "12:00:00"),
    ("120000.5", "12:00:00.5"),
    ("120000.000.00.0", "12:00:00"),     # independent optional fraction sections
    ("240000", "00:00:00"),
    ("12:00:00", None),
    ("1200", None),
    ("12", None),
    ("250000", None),
    ("126000", None),
    ("120000.1234567", None),
    ("", ""),
])
def test_time_values(spark, raw, iso):
    assert _one(spark, decode.time_value_sql(decode.sql_str(raw))) == iso


@pytest.mark.parametrize("raw, msg", [
    ("12:00:00", "Text '12:00:00' could not be parsed at index 2"),
    ("1200", "Text '1200' could not be parsed at index 4"),
    ("120000.1234567", "Text '120000.1234567' could not be parsed, unparsed text found at index 13"),
    ("250000", "Text '250000' could not be parsed: Invalid value for HourOfDay (valid values 0 - 23): 25"),
    ("126000", "Text '126000' could not be parsed: Invalid value for MinuteOfHour (valid values 0 - 59): 60"),
    ("120060", "Text '120060' could not be parsed: Invalid value for SecondOfMinute (valid values 0 - 59): 60"),
])
def test_time_errors(spark, raw, msg):
    out = _one(spark, decode.time_error_sql(decode.sql_str(raw)))
    assert out == "java.time.format.DateTimeParseException: " + msg


def test_valid_values_have_no_error(spark):
    assert _one(spark, decode.time_error_sql("'111823.36'")) is None
    assert _one(spark, decode.date_error_sql("'20220231'")) is None


@pytest.mark.parametrize("raw, groups", [
    ("somePersonName", ("somePersonName", "", "")),
    ("Doe^John", ("Doe^John", "", "")),
    ("Doe^John^^^", ("Doe^John", "", "")),
    (" Doe ^ John =Yamada^Tarou=やまだ^たろう", ("Doe^John", "Yamada^Tarou", "やまだ^たろう")),
    ("Doe^^Jr", ("Doe^^Jr", "", "")),
    ("", ("", "", "")),
])
def test_person_name(spark, raw, groups):
    row = _one(spark, decode.person_name_sql(decode.sql_str(raw)))
    assert tuple(row) == groups


def test_first_value_of_multi_valued(spark):
    assert _one(spark, decode.first_value("'  A \\\\B'")) == "A"


def test_dictionary_first_elements():
    d = D.builtin()
    assert d.elements[0].tag == 0x00080001 and d.elements[0].vr == "UL"
    first = d.deid_elements[0]
    assert first.keyword == "AccessionNumber" and first.action == "Z"
    assert first.name == "Accession Number" and first.tag == 0x00080050


@pytest.mark.parametrize("code, action", [
    ("Z", "Z"), ("Z/D", "Z"), ("D", "D"), ("D/X", "D"), ("C", "C"), ("U", "U"),
    ("X", "X"), ("X/Z", "X"), ("X/D", "X"), ("X/Z/D", "X"), ("X/Z/U*", "X"), ("K", "K"),
    ("", None), ("Q", "X"),
])
def test_action_code_collapse(code, action):
    assert D.collapse_action(code) == action


def test_patterned_tags_drop_out():
    assert D.parse_hex_tag("(50xx,0005)") is None
    assert D.parse_hex_tag("(0008,0050)") == 0x00080050
    assert D.parse_hex_tag("(FFFA,FFFA)") == 0xFFFAFFFA  # no signed-int trap


def test_schema_types():
    s = {f.name: f.dataType.simpleString() for f in __import__("medframe.sources.dicom", fromlist=["x"]).schema().fields}
    assert s["PatientName"] == decode.PN_STRUCT
    assert s["StudyDate"] == "string" and s["DiffusionBValue"] == "array<double>"
    assert s["Rows"] == "array<int>" and s["SelectorSVValue"] == "array<bigint>"
    assert s["EncapsulatedDocument"] == "binary" and s["DeidentificationMethodCodeSequence"] == "string"
    assert "SmallestImagePixelValue" not in s  # "US or SS": no column
