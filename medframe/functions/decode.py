"""Value decoding by VR, as Spark SQL expression strings.

Every decoder is a plain SQL expression so that it runs inside whole-stage
codegen, and is built as a string (``selectExpr``) because building thousands of
``Column`` objects on the driver is slow for wide dictionaries.

Input: ``e`` is an SQL expression for one element's raw value (the first value
of a multi-valued text, else text, ints, doubles or bytes; null when absent), and
``ok`` is an SQL boolean that is false for files that could not be parsed.

Semantics (PS3.5 value rules, first value of multi-valued strings):

- string VRs: first value, padding removed; absent -> ``''``
- PN: struct of the three component groups, each trimmed; absent -> ``''``
- FL FD: ``array<double>``; SL SS US UL: ``array<int>``; SV UV: ``array<bigint>``;
  absent -> ``[]``
- DA: ISO date from ``yyyyMMdd``, day clamped to the month's last day
  (smart resolution); anything else -> null plus an error message
- TM: ISO time from ``HHmmss`` with an optional fraction; else null plus error
- SQ: JSON array text; OB OW and any other VR: bytes
- for a file that is not DICOM every column is null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from medframe.dictionary import (
    FLOAT_VRS,
    INT_VRS,
    LONG_VRS,
    MULTI_STRING_VRS,
)

PN_STRUCT = "struct<Alphabetic:string,Ideographic:string,Phonetic:string>"

# Message prefixes of the Java time parser the output matches.
_PARSE_EXC = "java.time.format.DateTimeParseException: Text '"
# Java ValueRange texts of the checked fields.
_RANGE_YEAR_OF_ERA = "Invalid value for YearOfEra (valid values 1 - 999999999/1000000000): "
_RANGE_MONTH = "Invalid value for MonthOfYear (valid values 1 - 12): "
_RANGE_DAY = "Invalid value for DayOfMonth (valid values 1 - 28/31): "
_RANGE_HOUR = "Invalid value for HourOfDay (valid values 0 - 23): "
_RANGE_MINUTE = "Invalid value for MinuteOfHour (valid values 0 - 59): "
_RANGE_SECOND = "Invalid value for SecondOfMinute (valid values 0 - 59): "

# Fraction sections of the time pattern, in parse order ("." then
# N digits). Each is optional and tried in turn; the pattern names 5 twice, so a
# text may hold two fractions of that width.
_TM_FRACTION_WIDTHS = (6, 5, 5, 4, 3, 2, 1)

# 64-bit integers to 32 bits without overflow errors: the low bits count, as in a JVM cast.
_INT32 = "cast(if(x & 4294967295 > 2147483647, (x & 4294967295) - 4294967296, x & 4294967295) as int)"



def sql_str(s: str) -> str:
    """Quote a Python string as a Spark SQL literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def first_value(raw: str) -> str:
    """First backslash-separated value, spaces trimmed."""
    return f"trim(split_part({raw}, '\\\\', 1))"


def _abbrev(v: str) -> str:
    return f"(case when length({v}) > 64 then concat(substr({v}, 1, 64), '...') else {v} end)"


def _at_index(v: str, idx: str) -> str:
    tail = sql_str("' could not be parsed at index ")
    return f"concat({sql_str(_PARSE_EXC)}, {_abbrev(v)}, {tail}, {idx})"


def _unparsed(v: str, idx: str) -> str:
    tail = sql_str("' could not be parsed, unparsed text found at index ")
    return f"concat({sql_str(_PARSE_EXC)}, {_abbrev(v)}, {tail}, {idx})"


def _resolve(v: str, msg: str, value: str) -> str:
    tail = sql_str("' could not be parsed: " + msg)
    return f"concat({sql_str(_PARSE_EXC)}, {_abbrev(v)}, {tail}, {value})"


# ---------------------------------------------------------------- dates (DA)


def date_error_sql(v: str) -> str:
    """Error text for a DA value ``v`` (already the first value), else null."""
    lead = f"length(regexp_extract({v}, '^[0-9]*', 0))"
    y, m, d = f"int(substr({v},1,4))", f"int(substr({v},5,2))", f"int(substr({v},7,2))"
    return (
        "(case "
        f"when {v} is null or {v} = '' then null "
        f"when {v} rlike '^[0-9]{{8}}$' and {y} > 0 and {m} between 1 and 12 and {d} between 1 and 31 "
        "then null "
        f"when {lead} < 4 or {lead} > 8 then {_at_index(v, '0')} "
        f"when not (substr({v},5,2) rlike '^[0-9]{{2}}$') then {_at_index(v, '4')} "
        f"when not (substr({v},7,2) rlike '^[0-9]{{2}}$') then {_at_index(v, '6')} "
        f"when length({v}) > 8 then {_unparsed(v, '8')} "
        f"when {y} = 0 then {_resolve(v, _RANGE_YEAR_OF_ERA, y)} "
        f"when {m} < 1 or {m} > 12 then {_resolve(v, _RANGE_MONTH, m)} "
        f"when {d} < 1 or {d} > 31 then {_resolve(v, _RANGE_DAY, d)} "
        "else null end)"
    )


def date_value_sql(v: str) -> str:
    """ISO date text for a DA value ``v``; ``''`` when empty; null when invalid.

    Fast path: a well-formed day up to 28 needs only string slicing; days 29
    to 31 are clamped to the month's last day (smart resolution)."""
    y, m, d = f"int(substr({v},1,4))", f"int(substr({v},5,2))", f"int(substr({v},7,2))"
    last = f"day(last_day(make_date({y}, {m}, 1)))"
    iso = f"concat(substr({v},1,4), '-', substr({v},5,2), '-', substr({v},7,2))"
    return (
        "(case "
        f"when {v} is null or {v} = '' then '' "
        f"when not ({v} rlike '^[0-9]{{8}}$') or {y} = 0 or {m} < 1 or {m} > 12 or {d} < 1 or {d} > 31 "
        "then null "
        f"when {d} <= 28 then {iso} "
        f"else date_format(make_date({y}, {m}, least({d}, {last})), 'yyyy-MM-dd') "
        "end)"
    )


# ---------------------------------------------------------------- times (TM)


def _tm_parts(v: str):
    hh, mm, ss = f"int(substr({v},1,2))", f"int(substr({v},3,2))", f"int(substr({v},5,2))"
    return hh, mm, ss


def _tm_sections(v: str) -> str:
    """The optional fraction sections of the pattern, parsed in order as the
    Java parser does: a section consumes "." plus exactly N digits; a section
    whose value conflicts with an earlier one is rolled back. Result:
    ``struct<pos: 1-based position after the last section, nano: 9-digit
    fraction or null>``."""
    widths = ", ".join(str(w) for w in _TM_FRACTION_WIDTHS)
    digits = "substr({v}, acc.pos + 1, w)".format(v=v)
    padded = f"rpad({digits}, 9, '0')"
    step = (
        f"case when substr({v}, acc.pos, 1) = '.' and length({digits}) = w "
        f"and {digits} rlike '^[0-9]+$' and (acc.nano is null or acc.nano = {padded}) "
        f"then named_struct('pos', acc.pos + 1 + w, 'nano', {padded}) else acc end"
    )
    return (
        f"aggregate(array({widths}), named_struct('pos', 7, 'nano', cast(null as string)), "
        f"(acc, w) -> {step})"
    )


_TM_SIMPLE = "'^[0-9]{6}([.][0-9]{1,6})?$'"


def _tm_frac(v: str) -> str:
    """Fraction digits without trailing zeros ('' when none)."""
    return f"coalesce(trim(TRAILING '0' FROM {_tm_sections(v)}.nano), '')"


def _tm_simple_frac(v: str) -> str:
    return f"trim(TRAILING '0' FROM substr({v}, 8))"


def time_error_sql(v: str) -> str:
    """Error text for a TM value ``v`` (already the first value), else null."""
    hh, mm, ss = _tm_parts(v)
    end = f"({_tm_sections(v)}.pos - 1)"
    frac = (f"(case when {v} rlike {_TM_SIMPLE} then {_tm_simple_frac(v)} "
            f"else {_tm_frac(v)} end)")
    zero = f"({ss} = 0 and {mm} = 0 and {frac} = '')"
    return (
        "(case "
        f"when {v} is null or {v} = '' then null "
        f"when {v} rlike {_TM_SIMPLE} and {hh} < 24 and {mm} < 60 and {ss} < 60 "
        "then null "
        f"when not (substr({v},1,2) rlike '^[0-9]{{2}}$') then {_at_index(v, '0')} "
        f"when not (substr({v},3,2) rlike '^[0-9]{{2}}$') then {_at_index(v, '2')} "
        f"when not (substr({v},5,2) rlike '^[0-9]{{2}}$') then {_at_index(v, '4')} "
        f"when {end} < length({v}) then {_unparsed(v, end)} "
        f"when {mm} > 59 then {_resolve(v, _RANGE_MINUTE, mm)} "
        f"when {hh} = 24 and {zero} then null "
        f"when {hh} > 23 then {_resolve(v, _RANGE_HOUR, hh)} "
        f"when {ss} > 59 then {_resolve(v, _RANGE_SECOND, ss)} "
        "else null end)"
    )


def time_value_sql(v: str) -> str:
    """ISO time text for a TM value ``v``; ``''`` when empty; null when invalid.

    Fast path: ``HHmmss`` with at most one fraction of 1 to 6 digits (always
    parseable); other shapes go through the section-by-section rule."""
    hh, mm, ss = _tm_parts(v)
    simple = f"{v} rlike {_TM_SIMPLE}"
    fixed_ok = f"substr({v},1,6) rlike '^[0-9]{{6}}$'"
    frac = f"(case when {simple} then {_tm_simple_frac(v)} else {_tm_frac(v)} end)"
    zero = f"({ss} = 0 and {mm} = 0 and {frac} = '')"
    return (
        "(case "
        f"when {v} is null or {v} = '' then '' "
        f"when not ({simple}) and (not {fixed_ok} or {_tm_sections(v)}.pos - 1 <> length({v})) then null "
        f"when {hh} = 24 and {zero} then '00:00:00' "
        f"when {hh} > 23 or {mm} > 59 or {ss} > 59 then null "
        f"else concat(substr({v},1,2), ':', substr({v},3,2), ':', substr({v},5,2), "
        f"case when {frac} = '' then '' else concat('.', {frac}) end) end)"
    )


# ---------------------------------------------------------------- person names


def person_name_sql(v: str) -> str:
    """PN first value ``v`` -> struct of the three groups (``''`` when missing)."""
    groups = f"split(coalesce({v}, ''), '=')"

    def group(i: int) -> str:
        g = f"get({groups}, {i})"
        comps = f"transform(split({g}, '\\\\^'), x -> trim(x))"
        return f"coalesce(regexp_replace(array_join({comps}, '^'), '\\\\^+$', ''), '')"

    return (
        f"if({v} is null or {v} = '', named_struct('Alphabetic', '', 'Ideographic', '', 'Phonetic', ''), "
        f"named_struct('Alphabetic', {group(0)}, 'Ideographic', {group(1)}, 'Phonetic', {group(2)}))"
    )


# ---------------------------------------------------------------- by VR


def value_sql(vr: str, e: str, ok: str = "isDicom") -> str:
    """Decode raw value ``e`` of dictionary VR ``vr`` (see module doc)."""
    if vr in ("LT", "ST", "UT", "UR"):
        body = f"coalesce(rtrim({e}), '')"
    elif vr == "PN":
        body = person_name_sql(e)
    elif vr == "DA":
        body = date_value_sql(e)
    elif vr == "TM":
        body = time_value_sql(e)
    elif vr in MULTI_STRING_VRS or vr == "SQ":
        body = f"coalesce({e}, '')"
    elif vr in FLOAT_VRS:
        body = f"coalesce({e}, cast(array() as array<double>))"
    elif vr in INT_VRS:
        body = f"coalesce(transform({e}, x -> {_INT32}), cast(array() as array<int>))"
    elif vr in LONG_VRS:
        body = f"coalesce({e}, cast(array() as array<bigint>))"
    else:  # OB OW OD OF OL OV UN and anything else: raw bytes
        body = e
    return f"if({ok}, {body}, null)"


def error_sql(vr: str, e: str) -> str | None:
    """Error message expression for a requested column, None if it cannot fail."""
    if vr == "DA":
        return date_error_sql(e)
    if vr == "TM":
        return time_error_sql(e)
    return None


# Up to this many columns of dates and times are decoded by expressions of their
# own; more go through one lambda per VR, since the code generated for many
# copies of these long expressions is too large for the JVM to compile.
INLINE_PARSED = 4


@dataclass
class Parsed:
    """How the columns that can fail to parse are decoded: ``arrays`` to add to
    the raw columns, ``values`` by keyword (empty: ``value_sql``), ``errors`` map."""

    arrays: list
    values: dict
    errors: str


def parsed_arrays(columns: list[tuple[str, str]], raw: dict, ok: str = "isDicom") -> Parsed:
    """For requested (keyword, vr) columns with raw values in columns ``raw``."""
    none = "cast(map() as map<string,string>)"
    mine = [(k, vr) for k, vr in columns if vr in ("DA", "TM")]
    if not mine:
        return Parsed([], {}, none)
    if len(mine) <= INLINE_PARSED:
        pairs = ", ".join(f"{sql_str(k)}, {error_sql(vr, raw[k])}" for k, vr in mine)
        return Parsed([], {}, f"if({ok}, map_filter(map({pairs}), (k, v) -> v is not null), {none})")
    arrays, out, errors = [], {}, []
    for vr, value, error in (("DA", date_value_sql, date_error_sql), ("TM", time_value_sql, time_error_sql)):
        keywords = [k for k, v in mine if v == vr]
        if not keywords:
            continue
        name = f"__parsed_{vr}"
        arrays.append(f"transform(array({', '.join(raw[k] for k in keywords)}), "
                      f"v -> named_struct('value', {value('v')}, 'error', {error('v')})) as {name}")
        out |= {k: f"if({ok}, {name}[{i}].value, null)" for i, k in enumerate(keywords)}
        texts = ", ".join(map(sql_str, keywords))
        errors.append(f"zip_with(array({texts}), {name}, (k, p) -> named_struct('key', k, 'value', p.error))")
    entries = f"filter(concat({', '.join(errors)}), p -> p.value is not null)"
    return Parsed(arrays, out, f"if({ok}, map_from_entries({entries}), {none})")


def spark_type(vr: str) -> str:
    """Spark SQL type name of a decoded column of dictionary VR ``vr``."""
    if vr == "PN":
        return PN_STRUCT
    if vr in FLOAT_VRS:
        return "array<double>"
    if vr in INT_VRS:
        return "array<int>"
    if vr in LONG_VRS:
        return "array<bigint>"
    if vr in ("DA", "TM", "SQ") or vr in MULTI_STRING_VRS or vr in ("LT", "ST", "UT", "UR"):
        return "string"
    return "binary"


def data_type(vr: str) -> DataType:
    """Spark type of a decoded column; needs no session, unlike DDL."""
    if vr == "PN":
        return StructType([StructField(g, StringType()) for g in ("Alphabetic", "Ideographic", "Phonetic")])
    simple = {"array<double>": ArrayType(DoubleType()), "array<int>": ArrayType(IntegerType()),
              "array<bigint>": ArrayType(LongType()), "string": StringType(), "binary": BinaryType()}
    return simple[spark_type(vr)]
