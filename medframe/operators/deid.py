"""De-identification by the PS3.15 application-level confidentiality profile.

``deidentify(df)`` is planned on the driver from ``df.schema`` alone and is a
single projection: no job runs, no data moves, literals fold into the plan and
the source columns of literals are pruned from the scan.

For each column named by a keyword that is in both the data dictionary (with a
single VR) and the de-identification table, the action is the one of the
first enabled option (by priority) that gives one, else the basic profile's:

- Z: empty value of the VR; no empty value for that VR -> column dropped
- D: dummy value of the VR; none -> column dropped
- C: ``"ToClean"``;  U: SHA-256 hex of value || salt (null and ``""`` kept)
- X: column dropped;  K: kept
Other columns pass unchanged (``strict=True`` drops them instead).

``sequences=True`` (the default with ``strict``) applies the same actions to the
elements inside the JSON of sequence columns that are kept, at every depth.

``deidentify_long`` applies the same plan to a tall table (one row per
element), as a broadcast join with the action table.
"""

from __future__ import annotations

import json
import warnings

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from medframe import dictionary as dictmod
from medframe import ship
from medframe.dictionary import DeidElement, DeidOption
from medframe.functions import jsontext
from medframe.functions.decode import quote_ident, sql_str

# What the profile writes in place of a value, (empty, dummy) by
# VR. None: it has no such value for the VR, so the column goes.
REPLACEMENTS: dict[str, tuple] = {
    "CS": ("", "Anonymized"),
    "DA": ("0001-01-01", "0001-01-01"),
    "DT": (None, "0001-01-01T00:00:00"),
    "FD": (None, 0),
    "FL": (None, 0),
    "IS": (None, "0"),
    "LO": ("", "Anonymized"),
    "PN": ("", "Anonymized"),
    "SH": ("", "Anonymized"),
    "SS": (None, 0),
    "ST": (None, ""),
    "TM": ("00:00:00", "00:00:00"),
    "UI": ("", None),
    "UL": (0, None),
    "US": (None, 0),
}
TO_CLEAN = "ToClean"  # fixed value: stands where a text has to be cleaned by hand

# Rows of an action table that may be broadcast; the table is bounded by the
# standard (about 5,000 rows) so this only guards user-made dictionaries.
BROADCAST_MAX_ROWS = 200_000


def normalise_config(config) -> dict:
    """Accept {DeidOption|name: bool} or an iterable of options."""
    if config is None:
        return {}
    if isinstance(config, dict):
        items = config.items()
    else:
        items = ((o, True) for o in config)
    out = {}
    for k, v in items:
        opt = k if isinstance(k, DeidOption) else DeidOption[str(k)]
        out[opt] = bool(v)
    return out


def choose_action(elem: DeidElement, config: dict) -> str:
    """A2: first enabled option (priority order) with an action, else basic."""
    for opt in sorted(DeidOption):
        if config.get(opt, False) and opt in elem.option_actions:
            return elem.option_actions[opt]
    return elem.action


def replacement(action: str, vr: str):
    """(kind, literal) for an action on a VR: kind is keep, drop, literal or hash."""
    if action == "K":
        return ("keep", None)
    if action == "X":
        return ("drop", None)
    if action == "C":
        return ("literal", TO_CLEAN)
    if action == "U":
        return ("hash", None)
    empty, dummy = REPLACEMENTS.get(vr, (None, None))
    value = empty if action == "Z" else dummy
    return ("drop", None) if value is None else ("literal", value)


def _literal_sql(v) -> str:
    return str(v) if isinstance(v, int) else sql_str(v)


def _hash_sql(col_sql: str, salt: str, is_string: bool) -> str:
    c = col_sql if is_string else f"cast({col_sql} as string)"
    return (
        f"case when {c} is null or {c} <> '' "
        f"then sha2(concat({c}, {sql_str(salt)}), 256) else '' end"
    )


def plan_columns(
    df: DataFrame,
    config=None,
    salt: str = "",
    dictionary: dictmod.Dictionary | None = None,
    strict: bool = False,
) -> list[tuple[str, str, str]]:
    """(column, action, SQL expression or '') for each input column."""
    d = dictionary or dictmod.active()
    cfg = normalise_config(config)
    out = []
    for field in df.schema.fields:
        name = field.name
        std = d.by_keyword.get(name)
        deid = d.deid_by_keyword.get(name)
        q = quote_ident(name)
        if std is not None and std.vr in dictmod.SINGLE_VRS and deid is not None:
            action = choose_action(deid, cfg)
            kind, lit = replacement(action, std.vr)
            if kind == "keep":
                out.append((name, action, q))
            elif kind == "drop":
                out.append((name, action, ""))
            elif kind == "literal":
                out.append((name, action, f"{_literal_sql(lit)} as {q}"))
            else:
                is_str = isinstance(field.dataType, StringType)
                out.append((name, action, f"{_hash_sql(q, salt, is_str)} as {q}"))
        elif strict:
            out.append((name, "X", ""))
        else:
            out.append((name, "", q))
    return out


def deidentify(
    df: DataFrame,
    config=None,
    salt: str = "",
    dictionary: dictmod.Dictionary | None = None,
    strict: bool = False,
    sequences: bool | None = None,
) -> DataFrame:
    """A1: de-identify a DataFrame whose columns are DICOM keywords.

    Column order is kept. ``strict=True`` also drops every column with no
    known action (``content``, ``privateTagsJson``, unknown keywords).
    ``sequences`` (default: ``strict``): also inside kept sequences, see
    ``sequence_rule``.
    """
    if not strict and (dictionary or dictmod.active()) is dictmod.builtin():
        if unlisted := unlisted_columns(df):
            warnings.warn("the built-in de-identification table is a subset of the standard's and has no row for "
                          f"{', '.join(unlisted)}: passed unchanged (strict=True drops them)", stacklevel=2)
    plan = [p for p in plan_columns(df, config, salt, dictionary, strict) if p[2]]
    out = df.selectExpr(*[e for _, _, e in plan])
    if sequences if sequences is not None else strict:
        d = dictionary or dictmod.active()
        kept = [n for n, action, _ in plan if action in ("", "K") and n in d.by_keyword and d.by_keyword[n].vr == "SQ"]
        rewrite = _sequence_udf(df.sparkSession, sequence_actions(config, d), salt, strict)
        out = out.withColumns({n: rewrite(F.col(quote_ident(n))) for n in kept})
    return out


# How DICOM JSON spells the replacements that columns hold in ISO form.
JSON_REPLACEMENTS = {
    ("DA", "0001-01-01"): "00010101",
    ("DT", "0001-01-01T00:00:00"): "00010101000000",
    ("TM", "00:00:00"): "000000",
}


TEXT_VRS = dictmod.MULTI_STRING_VRS - {"AT", "DA", "DS", "DT", "IS", "TM", "UI"} | {"LT", "ST", "UR", "UT"}


def sequence_actions(config=None, dictionary: dictmod.Dictionary | None = None) -> dict[str, str]:
    """Action of every listed element, by keyword and by hex tag."""
    d = dictionary or dictmod.active()
    cfg = normalise_config(config)
    out = {}
    for deid in d.deid_elements:
        std = d.by_keyword.get(deid.keyword)
        if std is not None:
            action = choose_action(deid, cfg)
            if action == "C" and std.vr == "SQ":
                action = "K"  # cleaned element by element
            out[std.keyword] = out[std.hex_tag] = action
    return out


def sequence_rule(actions: dict[str, str], salt: str = "", strict: bool = False):
    """What becomes of an element inside a sequence, for ``jsontext``: as for a
    column of its keyword, the VR being the one in the text. A value that becomes
    empty leaves the element without one; a hash replaces each text of a value
    and drops sequences and bytes. Elements without an action pass, those inside
    them are decided in turn; ``strict`` drops them."""
    def replaced(action, text):
        vr = jsontext.element_vr(text)
        kind, value = replacement(action, vr or "")
        if kind == "drop" or (value == TO_CLEAN and vr not in TEXT_VRS):
            return None
        value = JSON_REPLACEMENTS.get((vr, value), value)
        if value == "":
            return f'{{"vr":"{vr}"}}'
        if vr == "PN":
            value = {"Alphabetic": value}
        elif vr == "IS":
            value = int(value)
        return json.dumps({"vr": vr, "Value": [value]}, separators=(",", ":")) if vr else None

    def decide(key):
        action = actions.get(key) or actions.get(key.upper())
        if action is None:
            return ("drop" if strict else "keep"), None
        if action == "K":
            return "keep", None
        if action == "X":
            return "drop", None
        if action == "U":
            return "replace", lambda text: jsontext.hashed_element(text, salt)
        return "replace", lambda text: replaced(action, text)

    return decide


def _sequence_udf(spark: SparkSession, actions: dict[str, str], salt: str, strict: bool):
    ship.ensure(spark)

    @F.pandas_udf(StringType())
    def rewrite(texts: pd.Series) -> pd.Series:
        decide = sequence_rule(actions, salt, strict)
        return texts.map(lambda t: t if t is None or t == "" else jsontext.rewrite_elements(t, decide))

    return rewrite


def unlisted_columns(df: DataFrame, dictionary: dictmod.Dictionary | None = None) -> list[str]:
    """Columns that are standard keywords without a row in the
    de-identification table; ``deidentify`` passes them unless ``strict``."""
    d = dictionary or dictmod.active()
    return [c for c in df.columns if c in d.by_keyword and c not in d.deid_by_keyword]


def collapse_sql(code: str) -> str:
    """A10 as SQL: the single action of a PS3.15 code; blank gives null, an
    unknown code X (remove)."""
    known = ", ".join(f"{sql_str(k)}, {sql_str(v)}" for k, v in dictmod.ACTION_CODE_COLLAPSE.items())
    return f"case when trim({code}) <> '' then coalesce(try_element_at(map({known}), trim({code})), 'X') end"


def action_table(
    spark: SparkSession,
    config=None,
    dictionary: dictmod.Dictionary | None = None,
) -> DataFrame:
    """A2 as a table: keyword, vr, basic action, chosen action, replacement.

    Built from the dictionary on the driver (bounded by the standard)."""
    d = dictionary or dictmod.active()
    cfg = normalise_config(config)
    rows = []
    for deid in d.deid_elements:
        std = d.by_keyword.get(deid.keyword)
        if std is None or std.vr not in dictmod.SINGLE_VRS:
            continue
        action = choose_action(deid, cfg)
        kind, lit = replacement(action, std.vr)
        rows.append((deid.keyword, std.vr, deid.action, action, kind,
                     None if lit is None else str(lit)))
    from medframe.session import local_frame

    schema = "keyword string, vr string, basic string, action string, kind string, literal string"
    return local_frame(spark, rows, ["keyword", "vr", "basic", "action", "kind", "literal"], schema)


def deidentify_long(
    df: DataFrame,
    config=None,
    salt: str = "",
    keyword_col: str = "keyword",
    value_col: str = "value",
    dictionary: dictmod.Dictionary | None = None,
) -> DataFrame:
    """De-identify a tall table of string values (one row per element).

    A left join with the action table, broadcast since its size is bounded by
    the dictionary (checked); rows whose action drops them are filtered out,
    keywords with no action pass unchanged. Adds an ``action`` column.
    """
    d = dictionary or dictmod.active()
    plan = action_table(df.sparkSession, config, d).select(
        F.col("keyword").alias("__k"), "action", "kind", "literal"
    )
    if len(d.deid_elements) <= BROADCAST_MAX_ROWS:
        plan = F.broadcast(plan)
    v = F.col(value_col)
    hashed = F.when(v.isNull() | (v != ""), F.sha2(F.concat(v, F.lit(salt)), 256)).otherwise("")
    joined = df.join(plan, F.col(keyword_col) == F.col("__k"), "left")
    new_value = (
        F.when(F.col("kind") == "literal", F.col("literal"))
        .when(F.col("kind") == "hash", hashed)
        .otherwise(v)
    )
    return (
        joined.where(F.col("kind").isNull() | (F.col("kind") != "drop"))
        .withColumn(value_col, new_value)
        .withColumn("action", F.coalesce(F.col("action"), F.lit("")))
        .drop("__k", "kind", "literal")
    )
