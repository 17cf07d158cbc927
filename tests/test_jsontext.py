"""Rewriting of JSON texts: keys and elements at every depth, all else as spelt."""

import hashlib
import json
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medframe.dictionary import DeidOption as O
from medframe.functions import jsonfns, jsontext
from medframe.operators import deid

KEEP = [
    ('{"a":1.10,"b":1E2,"c":12345678901234567890.50}', None),
    ('{"a":"\\u0000\\u0041","b\\u0000":1}', None),
    ('{"a":1,"a":2}', None),
    (' { "a" : [ 1 , "x : y" , { } , [ ] ] }\n', '{"a":[1,"x : y",{},[]]}'),
    ('"a"', None), ("[]", None), ("true", None), ('{"q":"\\":\\\\"}', None), ("-0.5e+3", None),
    ("1" * 5000, None),
]
BAD = ["", " ", "{", '{"a":1', '{"a" 1}', "[1,]", "[1 2]", '{"a":1,}', "NaN", "[Infinity]", "-Infinity", "01", "+1", '"\n"', '"\\x"',
       "{'a':1}", '{"a":1}}', "[1]]", '{1:2}', '{"a"}', "tru", "not json", '{"a":}', "[,1]", '"a":1', '["a":1]', '"open', "[}", "﻿[]"]


def deep(n, open_="[", close="]", inner=""):
    return open_ * n + inner + close * n


@pytest.mark.parametrize("text, compact", KEEP)
def test_all_but_keys_stays(text, compact):
    assert jsontext.rename_keys(text, lambda k: k) == (compact or text)
    assert jsontext._valid_deep(text)


@pytest.mark.parametrize("text", BAD)
def test_invalid_texts_give_null(text):
    assert jsontext.rename_keys(text, str.upper) is None
    assert not jsontext._valid_deep(text)


def test_any_depth():
    text = deep(5000, '{"k":', "}", '{"k":[1.10,"k"]}')
    assert jsontext.rename_keys(text, {"k": "key"}.get) == text.replace('"k":', '"key":')
    for bad in (deep(5000)[:-1], deep(5000) + "]", deep(5000, inner="NaN"), deep(5000, inner="1,")):
        assert jsontext.rename_keys(bad, str.upper) is None


values = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=6),
                      lambda v: st.lists(v, max_size=4) | st.dictionaries(st.text(string.ascii_letters + '":\\ \x00é', max_size=4), v, max_size=4),
                      max_leaves=20)


def renamed(v):
    if isinstance(v, dict):
        return {k + "!": renamed(x) for k, x in v.items()}
    return [renamed(x) for x in v] if isinstance(v, list) else v


@settings(max_examples=200, deadline=None)
@given(values, st.sampled_from([None, 2]), st.booleans())
def test_rename_equals_parsed_values(v, indent, plain):
    text = json.dumps(v, indent=indent, ensure_ascii=plain)
    assert jsontext.valid(text) and jsontext._valid_deep(text)
    assert json.loads(jsontext.rename_keys(text, lambda k: k + "!")) == renamed(v)
    assert jsontext.rename_keys(text, lambda k: k) == json.dumps(v, separators=(",", ":"), ensure_ascii=plain)


@settings(max_examples=300, deadline=None)
@given(st.text('[]{}",:1 truefalsn\\-.eE', max_size=12))
def test_both_validators_agree(text):
    assert jsontext.valid(text) == jsontext._valid_deep(text)


def test_one_key_rule(spark):
    tags = ["+00080064", "00080064", "80064", "000000080064", "00080064FF", "-00080064", "0008_0064", "7fe00010", "", "FFFFFFFFFF", None, "00080064\n"]
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    columns = {r.tag: r.keyword for r in jsonfns.tag_to_keyword(df, "tag").collect()}
    keys = spark.createDataFrame([(json.dumps({t: 1}),) for t in tags if t is not None], "j string")
    for t, r in zip([t for t in tags if t is not None], keys.select(jsonfns.rename_json_keys("j").alias("r")).collect()):
        assert list(json.loads(r.r)) == [columns[t]], t
    assert columns["+00080064"] == columns["80064"] == "ConversionType" and columns["0008_0064"] == "0008_0064"
    assert columns[None] is None


def test_a_deep_or_bad_text_fails_no_job(spark):
    df = spark.createDataFrame([(1, deep(3000)), (2, "not json"), (3, None), (4, '{"00080064":1}')], "i int, j string")
    got = dict(df.select("i", jsonfns.rename_json_keys(F.col("j")).alias("r")).collect())
    assert got == {1: deep(3000), 2: None, 3: None, 4: '{"ConversionType":1}'}


# ------------------------------------------------------------------ elements

ITEM = ('{"PatientName":{"vr":"PN","Value":[{"Alphabetic":"A^B"}]},"StudyDate":{"vr":"DA","Value":["20240101"]},'
        '"00100020":{"vr":"LO","Value":["P1"]},"Rows":{"vr":"US","Value":[1.0]},"SOPInstanceUID":{"vr":"UI","Value":["1.2","3"]},'
        '"InstitutionName":{"vr":"LO","Value":["H"]},"00091010":{"vr":"LO","Value":["own"]},"PersonName":{"vr":"PN","Value":[{"Alphabetic":"C"}]}}')


def sha(x, salt="s"):
    return hashlib.sha256((x + salt).encode()).hexdigest()


def test_elements_of_an_item():
    rule = deid.sequence_rule(deid.sequence_actions(), "s")
    got = jsontext.rewrite_elements(f"[ {ITEM} , {{}} ]", rule)
    assert got == (f'[{{"PatientName":{{"vr":"PN"}},"StudyDate":{{"vr":"DA","Value":["00010101"]}},"00100020":{{"vr":"LO"}},'
                   f'"Rows":{{"vr":"US","Value":[1.0]}},"SOPInstanceUID":{{"vr":"UI","Value":["{sha("1.2")}","{sha("3")}"]}},'
                   '"00091010":{"vr":"LO","Value":["own"]},"PersonName":{"vr":"PN","Value":[{"Alphabetic":"Anonymized"}]}},{}]')


def nested_items(depth, sequence="XRay3DAcquisitionSequence"):
    return deep(depth, f'[{{"Rows":{{"vr":"US"}},"{sequence}":{{"vr":"SQ","Value":', "}}]", f"[{ITEM}]")


def names(text):
    return {k for k in ("PatientName", "StudyDate", "00100020", "SOPInstanceUID", "InstitutionName", "00091010", "PersonName")
            if f'"{k}"' in text}


def test_every_depth_and_strict():
    loose = deid.sequence_rule(deid.sequence_actions(), "s")
    got = jsontext.rewrite_elements(nested_items(3000), loose)
    assert got.count("XRay3DAcquisitionSequence") == 3000 and "A^B" not in got and '"P1"' not in got and "InstitutionName" not in got
    strict = deid.sequence_rule(deid.sequence_actions(), "s", strict=True)
    assert jsontext.rewrite_elements(f"[{ITEM}]", strict) and not names(
        jsontext.rewrite_elements(f"[{ITEM}]", strict)) & {"InstitutionName", "00091010"}
    assert jsontext.rewrite_elements(nested_items(5), strict) == "[{}]"  # an unlisted sequence goes whole
    keep = deid.sequence_rule(deid.sequence_actions({O.RetainUids: True}), "s", strict=True)
    got = jsontext.rewrite_elements(nested_items(50, "ReferencedImageSequence"), keep)
    assert got.count("ReferencedImageSequence") == 50 and "Rows" not in got and '["1.2","3"]' in got
    # a sequence to remove is removed with all in it
    assert jsontext.rewrite_elements(nested_items(1, "ReferencedStudySequence"), loose) == '[{"Rows":{"vr":"US"}}]'


def test_odd_elements():
    rule = deid.sequence_rule(deid.sequence_actions(), "s")
    cases = {
        "not json": None, "[]": "[]", "{}": "{}", '"x"': '"x"',
        '{"PatientID":"plain"}': "{}",                                   # no VR: nothing to put in its place
        '{"PatientID":{"Value":["x"],"vr":"LO"}}': '{"PatientID":{"vr":"LO"}}',
        '{"SOPInstanceUID":{"vr":"UI"}}': '{"SOPInstanceUID":{"vr":"UI"}}',
        '{"SOPInstanceUID":{"vr":"UN","InlineBinary":"AAAA"}}': "{}",
        '{"StudyDate":{"vr":"DA","Value":[null]}}': '{"StudyDate":{"vr":"DA","Value":["00010101"]}}',
        '{"Rows":{"vr":"US","Value":[1,2]},"PatientID":{"vr":"LO","Value":["x"]}}': '{"Rows":{"vr":"US","Value":[1,2]},"PatientID":{"vr":"LO"}}',
        '{"00091000":{"vr":"UT","Value":["\\"PatientID\\":{"]}}': '{"00091000":{"vr":"UT","Value":["\\"PatientID\\":{"]}}',
        '{"patientid":{"vr":"LO","Value":["x"]},"7fe00010":{"vr":"OW"}}': '{"patientid":{"vr":"LO","Value":["x"]},"7fe00010":{"vr":"OW"}}',
    }
    for text, want in cases.items():
        assert jsontext.rewrite_elements(text, rule) == want, text


def test_columns_of_sequences(spark):
    df = spark.createDataFrame([(1, f"[{ITEM}]", "P1"), (2, "", "P2"), (3, None, None), (4, "broken", "P4")],
                               "i int, XRay3DAcquisitionSequence string, PatientID string")
    plain = {r.i: r for r in deid.deidentify(df, salt="s").collect()}
    assert plain[1].XRay3DAcquisitionSequence == f"[{ITEM}]"
    rows = {r.i: r for r in deid.deidentify(df, salt="s", sequences=True).collect()}
    assert "A^B" not in rows[1].XRay3DAcquisitionSequence and rows[1].PatientID == ""
    assert [rows[i].XRay3DAcquisitionSequence for i in (2, 3, 4)] == ["", None, None]
    refs = df.withColumnRenamed("XRay3DAcquisitionSequence", "ReferencedImageSequence")
    strict = deid.deidentify(refs, {O.RetainUids: True}, salt="s", strict=True)
    assert strict.columns == ["ReferencedImageSequence", "PatientID"]
    assert not names(strict.where("ReferencedImageSequence like '[{%'").first().ReferencedImageSequence) & {"00091010"}
