"""Property tests: the SQL DA/TM decoders against a step-by-step model of the
Java time parser they must match (patterns ``yyyyMMdd`` and
``HHmmss[.SSSSSS][.SSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]``, smart resolution).

Each example is a batch of strings checked in one Spark query."""

import calendar

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medframe.functions import decode, values

PREFIX = "java.time.format.DateTimeParseException: Text '"


def _txt(v):
    return v if len(v) <= 64 else v[:64] + "..."


def _digits(s):
    return s != "" and all("0" <= c <= "9" for c in s)


def model_da(v):
    """(value, error) the Java parser gives for a DA value."""
    if v == "":
        return "", None
    lead = 0
    while lead < len(v) and "0" <= v[lead] <= "9":
        lead += 1
    d = min(lead, 23)
    if d < 4:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed at index 0"
    year_len = min(lead, max(4, d - 4))
    if year_len > 4:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed at index 0"
    for idx in (4, 6):
        if not _digits(v[idx:idx + 2]) or len(v[idx:idx + 2]) < 2:
            return None, f"{PREFIX}{_txt(v)}' could not be parsed at index {idx}"
    if len(v) > 8:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed, unparsed text found at index 8"
    y, m, dd = int(v[:4]), int(v[4:6]), int(v[6:8])
    if y == 0:
        return None, (f"{PREFIX}{_txt(v)}' could not be parsed: Invalid value for YearOfEra "
                      f"(valid values 1 - 999999999/1000000000): 0")
    if not 1 <= m <= 12:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed: Invalid value for MonthOfYear (valid values 1 - 12): {m}"
    if not 1 <= dd <= 31:
        return None, (f"{PREFIX}{_txt(v)}' could not be parsed: Invalid value for DayOfMonth "
                      f"(valid values 1 - 28/31): {dd}")
    dd = min(dd, calendar.monthrange(y, m)[1])
    return f"{y:04d}-{m:02d}-{dd:02d}", None


def model_tm(v):
    """(value, error) the Java parser gives for a TM value."""
    if v == "":
        return "", None
    for idx in (0, 2, 4):
        if len(v) < idx + 2 or not _digits(v[idx:idx + 2]):
            return None, f"{PREFIX}{_txt(v)}' could not be parsed at index {idx}"
    pos, nano = 6, None
    for w in (6, 5, 5, 4, 3, 2, 1):
        if pos < len(v) and v[pos] == "." and _digits(v[pos + 1:pos + 1 + w]) and len(v) >= pos + 1 + w:
            val = int(v[pos + 1:pos + 1 + w].ljust(9, "0"))
            if nano is not None and nano != val:
                continue  # conflicting field: the optional section rolls back
            nano, pos = val, pos + 1 + w
    if pos < len(v):
        return None, f"{PREFIX}{_txt(v)}' could not be parsed, unparsed text found at index {pos}"
    hh, mm, ss, nano = int(v[:2]), int(v[2:4]), int(v[4:6]), nano or 0
    if mm > 59:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed: Invalid value for MinuteOfHour (valid values 0 - 59): {mm}"
    if hh == 24 and mm == 0 and ss == 0 and nano == 0:
        return "00:00:00", None
    if hh > 23:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed: Invalid value for HourOfDay (valid values 0 - 23): {hh}"
    if ss > 59:
        return None, f"{PREFIX}{_txt(v)}' could not be parsed: Invalid value for SecondOfMinute (valid values 0 - 59): {ss}"
    frac = f"{nano:09d}".rstrip("0")
    return f"{hh:02d}:{mm:02d}:{ss:02d}" + (f".{frac}" if frac else ""), None


def _check(spark, texts, value_sql, error_sql, model, finish):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string")
    rows = df.selectExpr("i", "v", f"{value_sql('v')} as val", f"{error_sql('v')} as err").collect()
    for r in rows:
        want = model(r.v)
        assert (r.val, r.err) == want, (r.v, (r.val, r.err), want)
        assert finish(r.v) == want, (r.v, finish(r.v), want)


digit = st.sampled_from("0123456789")
noise = st.sampled_from("0123456789.:+- ")
date_like = st.one_of(
    st.builds(lambda y, m, d: f"{y:04d}{m:02d}{d:02d}", st.integers(0, 9999), st.integers(0, 14), st.integers(0, 33)),
    st.text(noise, min_size=1, max_size=12),
    st.text(digit, min_size=1, max_size=12),
)
frac = st.lists(st.text(digit, min_size=1, max_size=7), max_size=3).map(lambda bs: "".join("." + b for b in bs))
time_like = st.one_of(
    st.builds(lambda h, m, s, f: f"{h:02d}{m:02d}{s:02d}{f}", st.integers(0, 25), st.integers(0, 61),
              st.integers(0, 61), frac),
    st.text(noise, min_size=1, max_size=16),
)

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(date_like, min_size=50, max_size=150))
def test_date_decoders_match_parser_model(spark, texts):
    _check(spark, texts, decode.date_value_sql, decode.date_error_sql, model_da, values.date)


@SETTINGS
@given(st.lists(time_like, min_size=50, max_size=150))
def test_time_decoders_match_parser_model(spark, texts):
    _check(spark, texts, decode.time_value_sql, decode.time_error_sql, model_tm, values.time)


name_like = st.text(st.sampled_from("ab ^=\\\\é山"), max_size=20)


@SETTINGS
@given(st.lists(name_like, min_size=50, max_size=150))
def test_name_decoders_agree(spark, texts):
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    first = decode.first_value("v")
    for r in df.selectExpr("v", f"{first} as f", f"{decode.person_name_sql(first)} as n").collect():
        assert values.first(r.v) == r.f and values.person(values.first(r.v)) == r.n.asDict()
