"""Files spelt byte by byte from PS3.5 (explicit VR little endian), with no
code shared with the library's encoder or the test writer."""

import json

import pytest

from medframe.sources import dicom

META = "02000000554C04001C000000" "0200100055491400" + b"1.2.840.10008.1.2.1\0".hex()

# tag, VR, length (with two reserved bytes for the long forms), value
ELEMENTS = (
    "08002000 4441 0800 3230323430323239"                   # StudyDate 20240229
    "08003000 544D 0600 323335393539"                       # StudyTime 235959
    "08005000 5348 0400 412D3120"                           # AccessionNumber 'A-1 '
    "08005400 4145 0400 4E4F4445"                           # RetrieveAETitle NODE
    "08006000 4353 0200 4D52"                               # Modality MR
    "08007000 4C4F 0400 41636D65"                           # Manufacturer Acme
    "08008100 5354 0200 5264"                               # InstitutionAddress Rd
    "08009000 504E 0400 526F5E4A"                           # ReferringPhysicianName Ro^J
    "08001011 5351 0000 12000000 FEFF00E0 0A000000"         # ReferencedStudySequence, one item
    "08000401 4C4F 0200 6162"                               # in it: CodeMeaning ab
    "10001010 4153 0400 30343259"                           # PatientAge 042Y
    "10003010 4453 0400 37302E35"                           # PatientWeight 70.5
    "18008790 4644 0800 000000000000F83F"                   # DiffusionBValue 1.5
    "18001992 5353 0200 FEFF"                               # TagAngleSecondAxis -2
    "20001300 4953 0200 3132"                               # InstanceNumber 12
    "28001000 5553 0200 0002"                               # Rows 512
    "400060A1 5554 0000 02000000 6F6B"                      # TextValue ok
    "400062A1 534C 0400 FDFFFFFF"                           # RationalNumeratorValue -3
    "400063A1 554C 0400 70110100"                           # RationalDenominatorValue 70000
    "42001100 4F42 0000 02000000 4142"                      # EncapsulatedDocument AB
    "70002200 464C 0800 0000803F 000000BF"                  # GraphicData 1.0, -0.5
    "72008200 5356 0000 08000000 FFFFFFFFFFFFFFFF"          # SelectorSVValue -1
    "72008300 5556 0000 08000000 0000000000010000"          # SelectorUVValue 2^40
)

FILE = bytes(128) + b"DICM" + bytes.fromhex(META) + bytes.fromhex(ELEMENTS)

EXPECTED = {
    "StudyDate": "2024-02-29", "StudyTime": "23:59:59", "AccessionNumber": "A-1",
    "RetrieveAETitle": "NODE", "Modality": "MR", "Manufacturer": "Acme", "InstitutionAddress": "Rd",
    "PatientAge": "042Y", "DiffusionBValue": [1.5], "TagAngleSecondAxis": [-2], "Rows": [512],
    "TextValue": "ok", "RationalNumeratorValue": [-3], "RationalDenominatorValue": [70000],
    "GraphicData": [1.0, -0.5], "SelectorSVValue": [-1], "SelectorUVValue": [1 << 40],
    "PatientWeight": "70.5", "InstanceNumber": "12",
}


@pytest.fixture()
def path(write_files):
    return write_files({"golden.dcm": FILE}) + "/golden.dcm"


@pytest.mark.parametrize("header_only", [True, False])
def test_values_of_each_vr(spark, path, header_only):
    names = list(EXPECTED) + ["ReferringPhysicianName", "EncapsulatedDocument", "ReferencedStudySequence"]
    row = dicom.read(spark, path, columns=["isDicom", "errors", *names], header_only=header_only).first()
    assert row.isDicom and not row.errors
    assert {k: row[k] for k in EXPECTED} == EXPECTED
    assert row.ReferringPhysicianName.Alphabetic == "Ro^J"
    assert bytes(row.EncapsulatedDocument) == b"AB"
    assert json.loads(row.ReferencedStudySequence) == [{"CodeMeaning": {"vr": "LO", "Value": ["ab"]}}]


def test_every_element_has_its_vr(spark, path):
    row = dicom.read(spark, path).select("vrs").first()
    found = {k: v for k, v in row.vrs.items() if not k.startswith(("FileMeta", "TransferSyntax"))}
    assert len(found) == 22
    assert {found["DiffusionBValue"], found["GraphicData"], found["SelectorUVValue"]} == {"FD", "FL", "UV"}


def test_list_of_paths_without_a_listing(spark, path):
    files = spark.createDataFrame([(path, len(FILE))], "path string, length long")
    row = dicom.decode_frame(files, ["isDicom", "Rows"], header_only=True).first()
    assert row.isDicom and row.Rows == [512]
