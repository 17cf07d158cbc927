"""DICOM data dictionary (PS3.6) and de-identification table (PS3.15 E.1-1).

The full standard documents are not shipped. A curated subset is built in, and
``medframe.sources.xml_dictionary`` loads the complete tables from the published
DocBook XML as Spark jobs when a user has the files.

Both tables are small dimension tables: their size is bounded by the standard
(about 5,000 data elements), so they are shipped to executors as closures or
broadcast joins, never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import IntEnum
from functools import lru_cache

# Value representations that map to exactly one Spark type (PS3.5 6.2).
SINGLE_VRS = frozenset(
    "AE AS AT CS DA DS DT FD FL IS LO LT OB OD OF OL OV OW PN SH SL SQ SS ST SV "
    "TM UC UI UL UN UR US UT UV".split()
)
STRING_VRS = frozenset("AE AS AT CS DS DT IS LO LT SH ST UC UI UR UT".split())
INT_VRS = frozenset("SL SS US UL".split())
LONG_VRS = frozenset("SV UV".split())
FLOAT_VRS = frozenset("FL FD".split())
# VRs whose values may hold several backslash-separated values.
MULTI_STRING_VRS = frozenset("AE AS AT CS DA DS DT IS LO PN SH TM UC UI".split())
# VRs whose explicit-VR encoding uses a 4-byte length (PS3.5 7.1.2).
LONG_LENGTH_VRS = frozenset("OB OD OF OL OV OW SQ SV UC UN UR UT UV".split())


@dataclass(frozen=True)
class StdElement:
    tag: int
    keyword: str
    vr: str
    vm: str
    name: str = ""

    @property
    def single_vr(self) -> str | None:
        """The VR when it is a single one, ``OB`` for ``OB or OW``, else None."""
        if self.vr in SINGLE_VRS:
            return self.vr
        if self.vr == "OB or OW":
            return "OB"
        return None

    @property
    def hex_tag(self) -> str:
        return f"{self.tag:08X}"


class DeidOption(IntEnum):
    """PS3.15 application-level confidentiality options, by priority (1 first)."""

    CleanGraph = 1
    CleanStructCont = 2
    CleanDesc = 3
    RetainLongModifDates = 4
    RetainLongFullDates = 5
    RetainPatChars = 6
    RetainInstId = 7
    RetainDevId = 8
    RetainUids = 9


@dataclass(frozen=True)
class DeidElement:
    tag: int
    name: str
    keyword: str
    action: str
    option_actions: dict = field(default_factory=dict, hash=False)


# ---------------------------------------------------------------------------
# Fixed values from the DICOM standard, PS3.6 "Registry of DICOM Data
# Elements" (chapter 6), file meta elements (chapter 7) and directory
# elements (chapter 8). Curated subset; columns: tag | VR | VM | keyword | name.
# ---------------------------------------------------------------------------
_STD_ELEMENTS = """
00080001|UL|1|LengthToEnd|Length to End
00080005|CS|1-n|SpecificCharacterSet|Specific Character Set
00080008|CS|2-n|ImageType|Image Type
00080012|DA|1|InstanceCreationDate|Instance Creation Date
00080013|TM|1|InstanceCreationTime|Instance Creation Time
00080014|UI|1|InstanceCreatorUID|Instance Creator UID
00080016|UI|1|SOPClassUID|SOP Class UID
00080018|UI|1|SOPInstanceUID|SOP Instance UID
00080020|DA|1|StudyDate|Study Date
00080021|DA|1|SeriesDate|Series Date
00080022|DA|1|AcquisitionDate|Acquisition Date
00080023|DA|1|ContentDate|Content Date
0008002A|DT|1|AcquisitionDateTime|Acquisition DateTime
00080030|TM|1|StudyTime|Study Time
00080031|TM|1|SeriesTime|Series Time
00080032|TM|1|AcquisitionTime|Acquisition Time
00080033|TM|1|ContentTime|Content Time
00080050|SH|1|AccessionNumber|Accession Number
00080054|AE|1-n|RetrieveAETitle|Retrieve AE Title
00080060|CS|1|Modality|Modality
00080064|CS|1|ConversionType|Conversion Type
00080070|LO|1|Manufacturer|Manufacturer
00080080|LO|1|InstitutionName|Institution Name
00080081|ST|1|InstitutionAddress|Institution Address
00080090|PN|1|ReferringPhysicianName|Referring Physician's Name
00080092|ST|1|ReferringPhysicianAddress|Referring Physician's Address
00080094|SH|1-n|ReferringPhysicianTelephoneNumbers|Referring Physician's Telephone Numbers
00080100|SH|1|CodeValue|Code Value
00080102|SH|1|CodingSchemeDesignator|Coding Scheme Designator
00080104|LO|1|CodeMeaning|Code Meaning
00080119|UC|1|LongCodeValue|Long Code Value
00080120|UR|1|URNCodeValue|URN Code Value
00080201|SH|1|TimezoneOffsetFromUTC|Timezone Offset From UTC
00080305|SQ|1|DeidentificationActionSequence|Deidentification Action Sequence
00080307|CS|1|DeidentificationAction|Deidentification Action
00081010|SH|1|StationName|Station Name
00081030|LO|1|StudyDescription|Study Description
0008103E|LO|1|SeriesDescription|Series Description
00081040|LO|1|InstitutionalDepartmentName|Institutional Department Name
00081048|PN|1-n|PhysiciansOfRecord|Physician(s) of Record
00081050|PN|1-n|PerformingPhysicianName|Performing Physician's Name
00081060|PN|1-n|NameOfPhysiciansReadingStudy|Name of Physician(s) Reading Study
00081070|PN|1-n|OperatorsName|Operators' Name
00081080|LO|1-n|AdmittingDiagnosesDescription|Admitting Diagnoses Description
00081090|LO|1|ManufacturerModelName|Manufacturer's Model Name
00081110|SQ|1|ReferencedStudySequence|Referenced Study Sequence
00081120|SQ|1|ReferencedPatientSequence|Referenced Patient Sequence
00081140|SQ|1|ReferencedImageSequence|Referenced Image Sequence
00081150|UI|1|ReferencedSOPClassUID|Referenced SOP Class UID
00081155|UI|1|ReferencedSOPInstanceUID|Referenced SOP Instance UID
00081161|UL|1-n|SimpleFrameList|Simple Frame List
00082111|ST|1|DerivationDescription|Derivation Description
00083010|UI|1-n|IrradiationEventUID|Irradiation Event UID
00100010|PN|1|PatientName|Patient's Name
00100020|LO|1|PatientID|Patient ID
00100021|LO|1|IssuerOfPatientID|Issuer of Patient ID
00100030|DA|1|PatientBirthDate|Patient's Birth Date
00100032|TM|1|PatientBirthTime|Patient's Birth Time
00100040|CS|1|PatientSex|Patient's Sex
00101000|LO|1-n|OtherPatientIDs|Other Patient IDs
00101001|PN|1-n|OtherPatientNames|Other Patient Names
00101005|PN|1|PatientBirthName|Patient's Birth Name
00101010|AS|1|PatientAge|Patient's Age
00101020|DS|1|PatientSize|Patient's Size
00101030|DS|1|PatientWeight|Patient's Weight
00101040|LO|1|PatientAddress|Patient's Address
00101060|PN|1|PatientMotherBirthName|Patient's Mother's Birth Name
00102000|LO|1-n|MedicalAlerts|Medical Alerts
00102110|LO|1-n|Allergies|Allergies
00102154|SH|1-n|PatientTelephoneNumbers|Patient's Telephone Numbers
00102160|SH|1|EthnicGroup|Ethnic Group
00102180|SH|1|Occupation|Occupation
001021A0|CS|1|SmokingStatus|Smoking Status
001021B0|LT|1|AdditionalPatientHistory|Additional Patient History
001021C0|US|1|PregnancyStatus|Pregnancy Status
001021D0|DA|1|LastMenstrualDate|Last Menstrual Date
00104000|LT|1|PatientComments|Patient Comments
00120062|CS|1|PatientIdentityRemoved|Patient Identity Removed
00120063|LO|1-n|DeidentificationMethod|De-identification Method
00120064|SQ|1|DeidentificationMethodCodeSequence|De-identification Method Code Sequence
00180010|LO|1|ContrastBolusAgent|Contrast/Bolus Agent
00180015|CS|1|BodyPartExamined|Body Part Examined
00180050|DS|1|SliceThickness|Slice Thickness
00180060|DS|1|KVP|KVP
00181000|LO|1|DeviceSerialNumber|Device Serial Number
00181002|UI|1|DeviceUID|Device UID
00181020|LO|1-n|SoftwareVersions|Software Versions
00181030|LO|1|ProtocolName|Protocol Name
00181088|IS|1|HeartRate|Heart Rate
00184000|LT|1|AcquisitionComments|Acquisition Comments
0018700A|SH|1|DetectorID|Detector ID
00189074|DT|1|FrameAcquisitionDateTime|Frame Acquisition DateTime
00189087|FD|1|DiffusionBValue|Diffusion b-value
00189219|SS|1|TagAngleSecondAxis|Tag Angle Second Axis
00189507|SQ|1|XRay3DAcquisitionSequence|X-Ray 3D Acquisition Sequence
0020000D|UI|1|StudyInstanceUID|Study Instance UID
0020000E|UI|1|SeriesInstanceUID|Series Instance UID
00200010|SH|1|StudyID|Study ID
00200011|IS|1|SeriesNumber|Series Number
00200013|IS|1|InstanceNumber|Instance Number
00200032|DS|3|ImagePositionPatient|Image Position (Patient)
00200037|DS|6|ImageOrientationPatient|Image Orientation (Patient)
00200052|UI|1|FrameOfReferenceUID|Frame of Reference UID
00201041|DS|1|SliceLocation|Slice Location
00204000|LT|1|ImageComments|Image Comments
00209158|LT|1|FrameComments|Frame Comments
00209161|UI|1|ConcatenationUID|Concatenation UID
00209164|UI|1|DimensionOrganizationUID|Dimension Organization UID
00209165|AT|1|DimensionIndexPointer|Dimension Index Pointer
00280002|US|1|SamplesPerPixel|Samples per Pixel
00280004|CS|1|PhotometricInterpretation|Photometric Interpretation
00280006|US|1|PlanarConfiguration|Planar Configuration
00280008|IS|1|NumberOfFrames|Number of Frames
00280009|AT|1-n|FrameIncrementPointer|Frame Increment Pointer
00280010|US|1|Rows|Rows
00280011|US|1|Columns|Columns
00280030|DS|2|PixelSpacing|Pixel Spacing
00280100|US|1|BitsAllocated|Bits Allocated
00280101|US|1|BitsStored|Bits Stored
00280102|US|1|HighBit|High Bit
00280103|US|1|PixelRepresentation|Pixel Representation
00280106|US or SS|1|SmallestImagePixelValue|Smallest Image Pixel Value
00280107|US or SS|1|LargestImagePixelValue|Largest Image Pixel Value
00281050|DS|1-n|WindowCenter|Window Center
00281051|DS|1-n|WindowWidth|Window Width
00281052|DS|1|RescaleIntercept|Rescale Intercept
00281053|DS|1|RescaleSlope|Rescale Slope
00281201|OW|1|RedPaletteColorLookupTableData|Red Palette Color Lookup Table Data
00321032|PN|1|RequestingPhysician|Requesting Physician
00321060|LO|1|RequestedProcedureDescription|Requested Procedure Description
00380010|LO|1|AdmissionID|Admission ID
00384000|LT|1|VisitComments|Visit Comments
00400006|PN|1|ScheduledPerformingPhysicianName|Scheduled Performing Physician's Name
00400244|DA|1|PerformedProcedureStepStartDate|Performed Procedure Step Start Date
00400245|TM|1|PerformedProcedureStepStartTime|Performed Procedure Step Start Time
00400253|SH|1|PerformedProcedureStepID|Performed Procedure Step ID
00400254|LO|1|PerformedProcedureStepDescription|Performed Procedure Step Description
00400512|LO|1|ContainerIdentifier|Container Identifier
0040051A|LO|1|ContainerDescription|Container Description
0040A120|DT|1|DateTime|DateTime
0040A121|DA|1|Date|Date
0040A122|TM|1|Time|Time
0040A123|PN|1|PersonName|Person Name
0040A124|UI|1|UID|UID
0040A160|UT|1|TextValue|Text Value
0040A161|FD|1-n|FloatingPointValue|Floating Point Value
0040A162|SL|1-n|RationalNumeratorValue|Rational Numerator Value
0040A163|UL|1-n|RationalDenominatorValue|Rational Denominator Value
0040A730|SQ|1|ContentSequence|Content Sequence
00420011|OB|1|EncapsulatedDocument|Encapsulated Document
0050001B|LO|1|ContainerComponentID|Container Component ID
00660040|OL|1|LongPrimitivePointIndexList|Long Primitive Point Index List
006A0005|LO|1|AnnotationGroupLabel|Annotation Group Label
006A0006|UT|1|AnnotationGroupDescription|Annotation Group Description
00700001|SQ|1|GraphicAnnotationSequence|Graphic Annotation Sequence
00700022|FL|2-n|GraphicData|Graphic Data
00700084|PN|1|ContentCreatorName|Content Creator's Name
00720082|SV|1-n|SelectorSVValue|Selector SV Value
00720083|UV|1-n|SelectorUVValue|Selector UV Value
04000561|SQ|1|OriginalAttributesSequence|Original Attributes Sequence
04000562|DT|1|AttributeModificationDateTime|Attribute Modification DateTime
04000563|LO|1|ModifyingSystem|Modifying System
04000564|LO|1|SourceOfPreviousValues|Source of Previous Values
7FE00008|OF|1|FloatPixelData|Float Pixel Data
7FE00009|OD|1|DoubleFloatPixelData|Double Float Pixel Data
7FE00010|OB or OW|1|PixelData|Pixel Data
FFFAFFFA|SQ|1|DigitalSignaturesSequence|Digital Signatures Sequence
FFFCFFFC|OB|1|DataSetTrailingPadding|Data Set Trailing Padding
00020000|UL|1|FileMetaInformationGroupLength|File Meta Information Group Length
00020001|OB|1|FileMetaInformationVersion|File Meta Information Version
00020002|UI|1|MediaStorageSOPClassUID|Media Storage SOP Class UID
00020003|UI|1|MediaStorageSOPInstanceUID|Media Storage SOP Instance UID
00020010|UI|1|TransferSyntaxUID|Transfer Syntax UID
00020012|UI|1|ImplementationClassUID|Implementation Class UID
00020013|SH|1|ImplementationVersionName|Implementation Version Name
00020016|AE|1|SourceApplicationEntityTitle|Source Application Entity Title
00041130|CS|1|FileSetID|File-set ID
00041220|SQ|1|DirectoryRecordSequence|Directory Record Sequence
"""

# ---------------------------------------------------------------------------
# Fixed values from the DICOM standard, PS3.15 Table E.1-1 "Application Level
# Confidentiality Profile Attributes". Curated subset, in the table's order;
# columns: name | tag | basic profile action | Rtn. UIDs | Rtn. Dev. Id. |
# Rtn. Inst. Id. | Rtn. Pat. Chars. | Rtn. Long. Full Dates |
# Rtn. Long. Modif. Dates | Clean Desc. | Clean Struct. Cont. | Clean Graph.
# ---------------------------------------------------------------------------
_DEID_ELEMENTS = """
Accession Number|00080050|Z|||||||||
Acquisition Comments|00184000|X|||||||C||
Acquisition Date|00080022|X/D|||||K|C|||
Acquisition DateTime|0008002A|X/D|||||K|C|||
Acquisition Time|00080032|X/D|||||K|C|||
Additional Patient History|001021B0|X|||||||C||
Admission ID|00380010|X|||||||||
Admitting Diagnoses Description|00081080|X|||||||C||
Allergies|00102110|X|||||||C||
Annotation Group Description|006A0006|X|||||||C||
Annotation Group Label|006A0005|D|||||||C||
Attribute Modification DateTime|04000562|D|||||K|C|||
Concatenation UID|00209161|U|K||||||||
Container Component ID|0050001B|X|||||||||
Container Description|0040051A|X|||||||C||
Container Identifier|00400512|Z|||||||||
Content Creator's Name|00700084|Z|||||||||
Content Date|00080023|Z/D|||||K|C|||
Content Sequence|0040A730|X||||||||C|
Content Time|00080033|Z/D|||||K|C|||
Contrast/Bolus Agent|00180010|Z/D|||||||C||
Date|0040A121|D|||||K|C|||
DateTime|0040A120|D|||||K|C|||
Derivation Description|00082111|X|||||||C||
Detector ID|0018700A|X/D||K|||||||
Device Serial Number|00181000|X/Z/D||K|||||||
Device UID|00181002|U|K|K|||||||
Digital Signatures Sequence|FFFAFFFA|X|||||||||
Dimension Organization UID|00209164|U|K||||||||
Ethnic Group|00102160|X||||K|||||
Frame Comments|00209158|X|||||||C||
Frame of Reference UID|00200052|U|K||||||||
Graphic Annotation Sequence|00700001|D|||||||||C
Image Comments|00204000|X|||||||C||
Instance Creation Date|00080012|X/D|||||K|C|||
Instance Creation Time|00080013|X/D|||||K|C|||
Instance Creator UID|00080014|U|K||||||||
Institution Address|00080081|X|||K||||||
Institution Name|00080080|X/Z/D|||K||||||
Institutional Department Name|00081040|X|||K||||||
Irradiation Event UID|00083010|U|K||||||||
Issuer of Patient ID|00100021|X|||||||||
Last Menstrual Date|001021D0|X|||||K|C|||
Media Storage SOP Instance UID|00020003|U|K||||||||
Medical Alerts|00102000|X|||||||C||
Modifying System|04000563|Z||K|||||||
Name of Physician(s) Reading Study|00081060|X|||||||||
Occupation|00102180|X|||||||C||
Operators' Name|00081070|X/Z/D|||||||||
Original Attributes Sequence|04000561|X|||||||||
Other Patient IDs|00101000|X|||||||||
Other Patient Names|00101001|X|||||||||
Patient Comments|00104000|X|||||||C||
Patient ID|00100020|Z|||||||||
Patient's Address|00101040|X|||||||||
Patient's Age|00101010|X||||K|||||
Patient's Birth Date|00100030|Z|||||||||
Patient's Birth Name|00101005|X|||||||||
Patient's Birth Time|00100032|X|||||||||
Patient's Mother's Birth Name|00101060|X|||||||||
Patient's Name|00100010|Z|||||||||
Patient's Sex|00100040|Z||||K|||||
Patient's Size|00101020|X||||K|||||
Patient's Telephone Numbers|00102154|X|||||||||
Patient's Weight|00101030|X||||K|||||
Performed Procedure Step Description|00400254|X|||||||C||
Performed Procedure Step ID|00400253|X|||||||||
Performed Procedure Step Start Date|00400244|X|||||K|C|||
Performed Procedure Step Start Time|00400245|X|||||K|C|||
Performing Physician's Name|00081050|X|||||||||
Person Name|0040A123|D|||||||||
Physician(s) of Record|00081048|X|||||||||
Pregnancy Status|001021C0|X||||K|||||
Protocol Name|00181030|X/D|||||||C||
Referenced Image Sequence|00081140|X/Z/U*|K||||||||
Referenced Patient Sequence|00081120|X|||||||||
Referenced SOP Instance UID|00081155|U|K||||||||
Referenced Study Sequence|00081110|X/Z|||||||||
Referring Physician's Address|00080092|X|||||||||
Referring Physician's Name|00080090|Z|||||||||
Referring Physician's Telephone Numbers|00080094|X|||||||||
Requested Procedure Description|00321060|X/Z|||||||C||
Requesting Physician|00321032|X|||||||||
Scheduled Performing Physician's Name|00400006|X|||||||||
Series Date|00080021|X/D|||||K|C|||
Series Description|0008103E|X|||||||C||
Series Instance UID|0020000E|U|K||||||||
Series Time|00080031|X/D|||||K|C|||
Smoking Status|001021A0|X||||K|||||
Software Versions|00181020|X||K|||||||
SOP Instance UID|00080018|U|K||||||||
Source of Previous Values|04000564|Z|||||||||
Station Name|00081010|X/Z/D||K|||||||
Study Date|00080020|Z|||||K|C|||
Study Description|00081030|X|||||||C||
Study ID|00200010|Z|||||||||
Study Instance UID|0020000D|U|K||||||||
Study Time|00080030|Z|||||K|C|||
Text Value|0040A160|X|||||||C||
Time|0040A122|D|||||K|C|||
Timezone Offset From UTC|00080201|X|||||K|C|||
UID|0040A124|U|K||||||||
Visit Comments|00384000|X|||||||C||
"""

# Option columns of _DEID_ELEMENTS after the basic action, in table order.
DEID_TABLE_OPTION_COLUMNS = (
    DeidOption.RetainUids,
    DeidOption.RetainDevId,
    DeidOption.RetainInstId,
    DeidOption.RetainPatChars,
    DeidOption.RetainLongFullDates,
    DeidOption.RetainLongModifDates,
    DeidOption.CleanDesc,
    DeidOption.CleanStructCont,
    DeidOption.CleanGraph,
)

# PS3.15 action codes and the single action each one stands for
# (the stricter reading; "" means no action given).
ACTION_CODE_COLLAPSE = {
    "Z": "Z", "Z/D": "Z",
    "D": "D", "D/X": "D",
    "C": "C",
    "U": "U",
    "X": "X", "X/Z": "X", "X/D": "X", "X/Z/D": "X", "X/Z/U*": "X",
    "K": "K",
}


def collapse_action(code: str | None) -> str | None:
    """Map a PS3.15 action code to one of D Z X K C U; None when blank.

    An unknown code fails closed: it is treated as X (remove).
    """
    if code is None:
        return None
    code = code.strip()
    if code == "":
        return None
    return ACTION_CODE_COLLAPSE.get(code, "X")


def parse_hex_tag(text: str) -> int | None:
    """``(0008,0050)`` or ``00080050`` -> int; None for patterned tags (``50xx``)."""
    t = text.replace("(", "").replace(")", "").replace(",", "").replace("​", "").strip()
    if len(t) != 8:
        return None
    try:
        return int(t, 16)
    except ValueError:
        return None


class Dictionary:
    """A data dictionary plus a de-identification table, with lookups."""

    def __init__(self, std: list[StdElement], deid: list[DeidElement]):
        self.elements = list(std)
        self.by_keyword = {e.keyword: e for e in self.elements}
        self.by_tag = {e.tag: e for e in self.elements}
        self.deid_elements = list(deid)
        self.deid_by_keyword = {d.keyword: d for d in self.deid_elements if d.keyword}

    def keyword_of(self, tag: int) -> str | None:
        e = self.by_tag.get(tag)
        return e.keyword if e else None

    def vr_of(self, keyword: str) -> str | None:
        e = self.by_keyword.get(keyword)
        return e.vr if e else None

    def column_elements(self, include_pixel_data: bool = False) -> list[StdElement]:
        """Elements that become scan columns: a single VR, or ``OB or OW``."""
        out = [e for e in self.elements if e.single_vr is not None]
        if not include_pixel_data:
            out = [e for e in out if e.keyword != "PixelData"]
        return out

    def tag_table(self) -> list[tuple[str, str, str]]:
        """(hex tag, keyword, vr) rows, for broadcast joins."""
        return [(e.hex_tag, e.keyword, e.vr) for e in self.elements]


def _parse_std(text: str) -> list[StdElement]:
    out = []
    for line in text.strip().splitlines():
        tag, vr, vm, keyword, name = line.split("|")
        out.append(StdElement(int(tag, 16), keyword, vr, vm, name))
    return out


def _parse_deid(text: str, std: list[StdElement]) -> list[DeidElement]:
    by_tag = {e.tag: e.keyword for e in std}
    out = []
    for line in text.strip().splitlines():
        cells = line.split("|")
        name, tag_text, basic = cells[0], cells[1], cells[2]
        tag = parse_hex_tag(tag_text)
        if tag is None or not name:
            continue
        options = {}
        for opt, code in zip(DEID_TABLE_OPTION_COLUMNS, cells[3:12]):
            action = collapse_action(code)
            if action is not None:
                options[opt] = action
        out.append(
            DeidElement(tag, name, by_tag.get(tag, ""), collapse_action(basic) or "X", options)
        )
    return out


@lru_cache(maxsize=1)
def builtin() -> Dictionary:
    std = _parse_std(_STD_ELEMENTS)
    return Dictionary(std, _parse_deid(_DEID_ELEMENTS, std))


_active: Dictionary | None = None


def active() -> Dictionary:
    """The dictionary in use: the built-in one unless ``use()`` set another."""
    return _active if _active is not None else builtin()


def use(d: Dictionary | None) -> None:
    """Install a dictionary (for example one loaded from the standard's XML)."""
    global _active
    _active = d
