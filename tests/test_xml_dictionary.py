"""Dictionary loaders from the standard's XML (D1, D3, D4), small samples."""

from medframe import dictionary as D
from medframe.sources import xml_dictionary as X

PART06 = """<?xml version="1.0" encoding="utf-8"?>
<book xmlns="http://docbook.org/ns/docbook"><chapter label="6"><table label="6-1"><tbody>
<tr><td><para>(0008,0001)</para></td><td><para>Length to End</para></td><td><para>LengthTo&#8203;End</para></td><td><para>UL</para></td><td><para>1</para></td><td><para>RET</para></td></tr>
<tr><td><para><emphasis role="italic">(0008,0050)</emphasis></para></td><td><para>Accession Number</para></td><td><para>AccessionNumber</para></td><td><para>SH</para></td><td><para>1</para></td><td/></tr>
<tr><td><para>(0028,0106)</para></td><td><para>Smallest Image Pixel Value</para></td><td><para>SmallestImagePixelValue</para></td><td><para>US or SS</para></td><td><para>1</para></td><td/></tr>
<tr><td><para>(50xx,0005)</para></td><td><para>Curve Dimensions</para></td><td><para>CurveDimensions</para></td><td><para>US</para></td><td><para>1</para></td><td><para>RET</para></td></tr>
<tr><td><para>(0018,9445)</para></td><td><para></para></td><td><para></para></td><td><para></para></td><td><para></para></td><td><para>RET</para></td></tr>
<tr><td><para>(FFFA,FFFA)</para></td><td><para>Digital Signatures Sequence</para></td><td><para>DigitalSignaturesSequence</para></td><td><para>SQ</para></td><td><para>1</para></td><td/></tr>
</tbody></table></chapter><chapter label="10"><table label="10-1"><tbody>
<tr><td><para>(0008,0060)</para></td><td><para>Modality</para></td><td><para>Modality</para></td><td><para>CS</para></td><td><para>1</para></td><td/></tr>
</tbody></table></chapter></book>"""

PART15 = """<?xml version="1.0" encoding="utf-8"?>
<book xmlns="http://docbook.org/ns/docbook"><appendix label="E"><table label="E.1-1"><tbody>
<tr><td><para>Accession Number</para></td><td><para>(0008,0050)</para></td><td><para>N</para></td><td><para>Y</para></td><td><para>Z</para></td><td/><td/><td/><td/><td/><td/><td/><td/><td/><td/></tr>
<tr><td><para>Overlay Data</para></td><td><para>(60xx,3000)</para></td><td><para>N</para></td><td><para>Y</para></td><td><para>X</para></td><td/><td/><td/><td/><td/><td/><td/><td/><td/><td><para>C</para></td></tr>
<tr><td><para>Length to End</para></td><td><para>(0008,0001)</para></td><td><para>Y</para></td><td><para>N</para></td><td><para>X/Z/U*</para></td><td/><td><para>K</para></td><td/><td/><td/><td><para>K</para></td><td><para>C</para></td><td/><td/><td><para>C</para></td></tr>
</tbody></table><table label="E.2-1"><tbody><tr><td><para>x</para></td><td><para>(0008,0020)</para></td></tr></tbody></table></appendix></book>"""


def test_load_from_xml(spark, tmp_path):
    p6, p15 = tmp_path / "part06.xml", tmp_path / "part15.xml"
    p6.write_text(PART06)
    p15.write_text(PART15)
    d = X.load(spark, str(p6), str(p15), install=False)
    assert [e.keyword for e in d.elements] == [
        "LengthToEnd", "AccessionNumber", "SmallestImagePixelValue", "DigitalSignaturesSequence"]
    assert d.elements[0].tag == 0x00080001 and d.elements[0].vr == "UL"
    assert d.by_keyword["DigitalSignaturesSequence"].tag == 0xFFFAFFFA
    assert d.by_keyword["SmallestImagePixelValue"].single_vr is None
    assert [x.keyword for x in d.deid_elements] == ["AccessionNumber", "LengthToEnd"]
    lte = d.deid_by_keyword["LengthToEnd"]
    assert lte.action == "X"
    assert lte.option_actions == {D.DeidOption.CleanGraph: "C", D.DeidOption.RetainLongModifDates: "C",
                                  D.DeidOption.RetainLongFullDates: "K", D.DeidOption.RetainUids: "K"}


def test_loaded_dictionary_drives_schema(spark, tmp_path):
    from medframe.sources import dicom

    p6 = tmp_path / "part06.xml"
    p6.write_text(PART06)
    d = X.load(spark, str(p6), install=False)
    names = dicom.schema(dictionary=d).fieldNames()
    assert names == ["path", "isDicom", "keywords", "vrs", "errors", "LengthToEnd", "AccessionNumber",
                     "DigitalSignaturesSequence"]
