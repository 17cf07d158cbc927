"""The byte builder against a row-at-a-time writer."""

import math
import struct

import dcmwrite as W
import pytest

from medframe.sources import dicom, encode as enc

ROWS = [(1, "ab", [1, -2], 1.5, b"xyz", 0x00100020), (2, "", [], None, b"", None), (3, None, None, -0.25, None, 0x7FE00010),
        (4, "é山", [40_000, 3_000_000_000], math.inf, b"\x00", 0), (None, "x" * 501, [7] * 300, 0.0, bytes(70_000), 1)]


def written(row):
    i, text, numbers, real, data, tag = row
    out = b""
    if text is not None:
        out += W.element(0x00080018, "UI", W.pad(text.encode(), "UI"))
        out += W.element(0x00081030, "LO", W.pad(text.encode(), "LO"))
    if real is not None:
        out += W.element(0x00189087, "FD", struct.pack("<d", real))
    if numbers is not None:
        out += W.element(0x00280010, "US", b"".join(struct.pack("<H", n & 0xFFFF) for n in numbers))
    if tag is not None:
        out += W.element(0x00720050, "AT", struct.pack("<HH", tag >> 16, tag & 0xFFFF))
    if data is not None:
        out += W.element(0x00420011, "OB", W.pad(data, "OB"))
    if i is not None:
        out += W.element(0x0040A162, "SL", struct.pack("<i", -i))
        out += W.element(0x0040A164, "SV", struct.pack("<q", i << 40))
    return out


def tags(data):
    """The elements of written(), in tag order."""
    import re

    from medframe.sources import tokenise as tk

    elems = tk.parse(W.part10(data), {e.tag: e.vr for e in dicom.dictmod.active().elements}.get).elements
    assert re and elems == sorted(elems, key=lambda e: e.tag)
    return [(e.tag, e.vr, e.value) for e in elems]


def test_files_equal_a_plain_writer(spark):
    df = spark.createDataFrame(ROWS, "i int, t string, n array<long>, r double, b binary, g long").repartition(2)
    attrs = [enc.attr(0x00081030, "t", vr="LO"), enc.attr(0x00080018, "t", vr="UI"), enc.attr(0x00280010, "n", vr="US", multi=True),
             enc.attr(0x00189087, "if(r is null, null, array(r))", vr="FD"), enc.attr(0x00420011, "b", vr="OB"),
             enc.attr(0x0040A162, "-i", vr="SL"), enc.attr(0x0040A164, "shiftleft(cast(i as bigint), 40)", vr="SV"),
             enc.attr(0x00720050, "g", vr="AT")]
    for part10 in (False, True):
        got = enc.encode(df, attrs, part10=part10).collect()
        assert len(got) == len(ROWS)
        for r in got:
            row = (r.i, r.t, r.n, r.r, None if r.b is None else bytes(r.b), r.g)
            content = bytes(r.content)
            if part10:
                assert content[128:132] == b"DICM"
                content = content[enc.file_length(0):]
            assert tags(content) == tags(written(row)) and len(content) == len(written(row))


def test_empty_table_and_no_attributes(spark):
    df = spark.range(3)
    assert [len(r.content) for r in enc.encode(df, []).collect()] == [enc.file_length(0)] * 3
    assert enc.encode(df.where("id < 0"), [enc.attr("PatientID", "'x'")]).collect() == []


def test_values_too_long_for_their_vr_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(Exception, match="too long for LO"):
        enc.encode(df, [enc.attr("PatientID", "repeat('x', 70000)")]).collect()
