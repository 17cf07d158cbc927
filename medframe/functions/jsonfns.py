"""DICOM JSON helpers.

- ``elements_json``: elements -> DICOM JSON object text (``to_json`` of a map,
  keys in tag order; ``{}`` when empty)
- ``items_json``: items -> JSON array text (``[]`` when empty)
- ``rename_json_keys``: rename object keys at every depth with a mapping
  (default: hex tag -> dictionary keyword, else unchanged); Arrow-batched
  pandas UDF since the depth is not known to the SQL planner
- ``tag_to_keyword``: hex tag column -> keyword, else the tag itself; a join
  with the dictionary, broadcast because its size is bounded (checked)
All output is compact JSON.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from medframe import dictionary as dictmod
from medframe import ship
from medframe.functions import jsontext
from medframe.functions.decode import sql_str

BROADCAST_MAX_ROWS = 200_000


def element_sql(vr: str, values_sql: str | None) -> str:
    """SQL struct for one element; ``values_sql`` is an array expression (or
    None for an element without a value)."""
    if values_sql is None:
        return f"named_struct('vr', {sql_str(vr)})"
    return f"named_struct('vr', {sql_str(vr)}, 'Value', {values_sql})"


def elements_json(elements: list[tuple[int, str, str | None]]) -> str:
    """SQL text of ``{"GGGGEEEE": {"vr":..,"Value":[..]}, ...}``.

    ``elements`` are (tag, vr, SQL array of values or None); an element whose
    value array is null is left out. Each element is rendered by ``to_json``
    on its own (value types differ by VR) and the texts are joined in tag
    order, which keeps the output compact and ordered."""
    if not elements:
        return "'{}'"
    parts = []
    for tag, vr, values in sorted(elements, key=lambda x: x[0]):
        key = sql_str(f'"{tag:08X}":')
        if values is None:
            parts.append(f"concat({key}, to_json({element_sql(vr, None)}))")
        else:
            parts.append(
                f"if({values} is null, null, concat({key}, to_json({element_sql(vr, values)})))"
            )
    return f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


def items_json(items: list[list[tuple[int, str, str | None]]]) -> str:
    """SQL text of a JSON array of item objects; ``[]`` when empty."""
    if not items:
        return "'[]'"
    return "concat('[', concat_ws(',', " + ", ".join(elements_json(it) for it in items) + "), ']')"


# The tags a hex text names: an optional plus sign, then hex digits, of which
# leading zeros do not count. One rule for keys (J3) and columns.
_HEX_TAG = r"^[+]?0*([0-9A-Fa-f]{1,8})\z"
_HEX_KEY = re.compile(_HEX_TAG.replace(r"\z", r"\Z"))


def _tag_key_rename(key: str, by_tag: dict) -> str:
    """Hex tag -> keyword when the dictionary has it, else the key unchanged."""
    m = _HEX_KEY.match(key)
    return by_tag.get(int(m.group(1), 16), key) if m else key


def rename_json_keys(col: Column | str, mapping: dict | None = None, spark=None) -> Column:
    """Rename keys of a JSON text column at every depth.

    ``mapping`` maps old key -> new key; by default hex tags become keywords.
    Invalid JSON gives null. Everything but the keys stays as it is spelt; space
    between tokens goes. See ``medframe.functions.jsontext``."""
    if spark := spark or SparkSession.getActiveSession():
        ship.ensure(spark)
    if mapping is None:
        by_tag = {e.tag: e.keyword for e in dictmod.active().elements}

        def f(k):
            return _tag_key_rename(k, by_tag)
    else:
        table = dict(mapping)

        def f(k):
            return table.get(k, k)

    @F.pandas_udf(StringType())
    def _rename_udf(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else jsontext.rename_keys(t, f))

    c = F.col(col) if isinstance(col, str) else col
    return _rename_udf(c)


def dictionary_frame(spark, dictionary: dictmod.Dictionary | None = None) -> DataFrame:
    """The data dictionary as a small DataFrame: tag (hex), keyword, vr, vm, name."""
    d = dictionary or dictmod.active()
    from medframe.session import local_frame

    rows = [(e.hex_tag, e.keyword, e.vr, e.vm, e.name) for e in d.elements]
    return local_frame(spark, rows, ["tag", "keyword", "vr", "vm", "name"],
                       "tag string, keyword string, vr string, vm string, name string")


def tag_to_keyword(df: DataFrame, tag_col: str, out_col: str = "keyword",
                   dictionary: dictmod.Dictionary | None = None) -> DataFrame:
    """Add ``out_col`` = dictionary keyword of the hex tag in ``tag_col``,
    else the tag text itself. Broadcast join on the (bounded) dictionary."""
    d = dictionary or dictmod.active()
    dim = dictionary_frame(df.sparkSession, d).select(
        F.col("tag").alias("__tag"), F.col("keyword").alias("__kw")
    )
    if len(d.elements) <= BROADCAST_MAX_ROWS:
        dim = F.broadcast(dim)
    digits = F.regexp_extract(F.col(tag_col), _HEX_TAG, 1)
    key = F.when(digits != "", F.lpad(F.upper(digits), 8, "0"))
    return (
        df.join(dim, key == F.col("__tag"), "left")
        .withColumn(out_col, F.coalesce(F.col("__kw"), F.col(tag_col)))
        .drop("__tag", "__kw")
    )
