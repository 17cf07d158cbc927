"""Load the data dictionary (PS3.6) and the de-identification table (PS3.15
E.1-1) from the standard's DocBook XML as Spark jobs (D1, D3, D4).

The built-in ``xml`` source reads table rows in parallel; declaring ``td`` as
``array<string>`` keeps each cell's inner markup as text, which SQL cleans:
tags removed, zero-width spaces removed, blanks collapsed. Rows without a
``(gggg,eeee)`` hex tag (patterned tags such as ``(50xx,xxxx)``) or without a
keyword drop out. The results have a few thousand rows (bounded by the
standard); they are collected once to build the driver-side ``Dictionary``
that plans schemas and de-identification.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medframe import dictionary as dictmod

# Chapters of PS3.6 that hold registries of elements.
REGISTRY_CHAPTERS = ("6", "7", "8", "9")
_TAG_RE = r"^\(?[0-9A-Fa-f]{4},[0-9A-Fa-f]{4}\)?$"


def _clean(c):
    """Cell markup -> text."""
    no_tags = F.regexp_replace(c, "<[^>]*>", " ")
    no_zw = F.regexp_replace(no_tags, "​", "")
    unescaped = F.regexp_replace(F.regexp_replace(F.regexp_replace(no_zw, "&lt;", "<"), "&gt;", ">"), "&amp;", "&")
    return F.trim(F.regexp_replace(unescaped, r"\s+", " "))


def _tag_int(c):
    """'(0008,0050)' -> 0x00080050 as bigint (no sign trap: FFFAFFFA stays)."""
    hexs = F.regexp_replace(c, r"[(),\s]", "")
    return F.conv(hexs, 16, 10).cast("bigint")


def std_elements_frame(spark: SparkSession, part06_xml: str) -> DataFrame:
    """PS3.6 registry rows as ``ord, tag, name, keyword, vr, vm, note``."""
    chapters = (
        spark.read.format("xml").option("rowTag", "chapter")
        .schema("_label string, table array<struct<tbody: struct<tr: array<struct<td: array<string>>>>>>")
        .load(part06_xml)
        .where(F.col("_label").isin(*REGISTRY_CHAPTERS))
    )
    rows = chapters.select("_label", F.posexplode(F.flatten(F.transform("table", lambda t: t["tbody"]["tr"]))).alias(
        "pos", "tr")).select(
        (F.col("_label").cast("bigint") * 1_000_000 + F.col("pos")).alias("ord"),
        F.transform("tr.td", _clean).alias("cells")).where(F.size("cells") >= 5)
    out = rows.select(
        "ord",
        F.col("cells")[0].alias("tag_text"),
        F.col("cells")[1].alias("name"),
        F.col("cells")[2].alias("keyword"),
        F.col("cells")[3].alias("vr"),
        F.col("cells")[4].alias("vm"),
        F.coalesce(F.get(F.col("cells"), 5), F.lit("")).alias("note"),
    )
    return (
        out.where(F.col("tag_text").rlike(_TAG_RE) & (F.col("keyword") != ""))
        .select("ord", _tag_int(F.col("tag_text")).alias("tag"), "name", "keyword", "vr", "vm", "note")
    )


def deid_elements_frame(spark: SparkSession, part15_xml: str, table_label: str = "E.1-1") -> DataFrame:
    """D3: PS3.15 table E.1-1 rows as ``ord, name, tag, basic, opt_1 .. opt_9``
    with the option columns in priority order (CleanGraph first: column 14,
    down to RetainUids: column 6; column 5 is not read)."""
    tables = (
        spark.read.format("xml").option("rowTag", "table")
        .schema("_label string, tbody struct<tr: array<struct<td: array<string>>>>")
        .load(part15_xml)
        .where(F.col("_label") == table_label)
    )
    rows = tables.select(F.posexplode("tbody.tr").alias("ord", "tr")).select(
        "ord", F.transform("tr.td", _clean).alias("cells")
    )
    cols = [
        "ord",
        F.col("cells")[0].alias("name"),
        _tag_int(F.col("cells")[1]).alias("tag"),
        F.coalesce(F.get(F.col("cells"), 4), F.lit("")).alias("basic"),
    ]
    for prio, idx in enumerate(range(14, 5, -1), start=1):
        cols.append(F.coalesce(F.get(F.col("cells"), idx), F.lit("")).alias(f"opt_{prio}"))
    return (
        rows.where(F.get(F.col("cells"), 1).rlike(_TAG_RE) & (F.col("cells")[0] != ""))
        .select(*cols)
    )


def load(spark: SparkSession, part06_xml: str, part15_xml: str | None = None,
         install: bool = True) -> dictmod.Dictionary:
    """Build a ``Dictionary`` from the standard's XML files and (by default)
    make it the active one. Without PS3.15 the built-in de-id table is kept."""
    std_rows = std_elements_frame(spark, part06_xml).orderBy("ord").collect()
    std = [dictmod.StdElement(int(r.tag), r.keyword, r.vr, r.vm, r.name) for r in std_rows]
    by_tag = {e.tag: e.keyword for e in std}
    if part15_xml:
        deid = []
        for r in deid_elements_frame(spark, part15_xml).orderBy("ord").collect():
            options = {}
            for opt in dictmod.DeidOption:
                action = dictmod.collapse_action(r[f"opt_{int(opt)}"])
                if action is not None:
                    options[opt] = action
            deid.append(dictmod.DeidElement(int(r.tag), r.name, by_tag.get(int(r.tag), ""),
                                            dictmod.collapse_action(r.basic) or "X", options))
    else:
        deid = [
            dictmod.DeidElement(d.tag, d.name, by_tag.get(d.tag, d.keyword), d.action, d.option_actions)
            for d in dictmod.builtin().deid_elements
        ]
    d = dictmod.Dictionary(std, deid)
    if install:
        dictmod.use(d)
    return d
