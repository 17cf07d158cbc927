"""Secrets in every version of every text; each content is scanned once.

A text is addressed by its SHA-256 (its *blob*). The *ledger* is a Parquet table
with a row per scanned blob: the rules, each with its version, that were run on
it, and the spans they found. A scan addresses all rows, asks the ledger which
pairs of blob and rule version are still missing, reads one copy of the text of
those blobs alone, runs the missing rules and appends what they found. Findings
then go back to all rows of a blob, so a copy costs a digest and a join. A new
version of a rule is a new pair: only that rule runs again.

Everything is built-in columns. A span's place comes from the lengths of the
matches and of the pieces between them, summed by a window over one blob and
rule, so that a text with very many matches costs no more than sorting them.
Patterns take linear time. Texts move once, one copy of a blob per map task
(partial aggregation); the rows that meet the findings are an id and a digest.
Blobs with many copies are cut into parts: those with over a thousandth of all
rows, of which there are at most a thousand, are known by broadcast.

Edge cases: null is the empty text, which has no spans. Rows are judged one by
one, so null, repeated and equal ids stay as they are; columns other than id and
text are not read. An empty table gives no rows. A ledger that two runs extended
at once may hold a pair twice; readers take each span once. Offsets are code
points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medframe.llm.batches import join_copies, remove, store

LEDGER = "blob binary, rules array<string>, found array<struct<start:int,end:int,rule:string>>"
BROADCAST_BLOBS = 100_000  # missing pairs of at most this many blobs are broadcast (about 10 MB)


@dataclass(frozen=True)
class Rule:
    """Spans are the leftmost matches of ``pattern`` whose ``group`` has
    ``least`` characters or more; only texts with ``quick`` can have one."""

    kind: str
    version: str
    pattern: str
    quick: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_NAME = "(?i)(password|passwd|secret|token|api_?key)[\"']?+ *+[:=] *+[\"']?+"
_VALUE = "[A-Za-z0-9+/_.=-]"
BASE = (
    Rule("assign", "1", f"{_NAME}({_VALUE}++)", f"{_NAME}{_VALUE}{{12}}", 2, 12),
    Rule("access", "1", "AKIA[A-Z0-9]{14,}+", "AKIA[A-Z0-9]{14}"),
    Rule("hex", "1", "[0-9a-f]{16,}+", "[0-9a-f]{16}"),
)
ADDED = (
    Rule("github", "1", "gh[opsu]_[A-Za-z0-9]{36,}+", "gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", "1", "xox[abprs]-[A-Za-z0-9-]{20,}+", "xox[abprs]-[A-Za-z0-9-]{20}"),
    Rule("pem", "1", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
RULES = BASE + ADDED


def _matches(text: Column, rule: Rule) -> Column:
    """Per match: characters since the last one, its own, and whether it is kept."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
    zipped = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), kept.alias("kept"))
    return F.filter(zipped, lambda x: x["size"].isNotNull())  # the text after the last match


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows of the ledger for ``blob, text, rules`` (names of the rules to run);
    ``blobs`` is partitioned by blob and nothing here moves rows again."""
    marks = F.array(*[
        F.struct(F.lit(r.name).alias("rule"),
                 F.when(F.array_contains("rules", r.name) & F.col("text").rlike(r.quick),
                        _matches(F.col("text"), r)).alias("matches"))
        for r in rules])
    hits = (
        blobs.select("blob", "rules", F.explode_outer(F.filter(marks, lambda m: m["matches"].isNotNull())).alias("m"))
        .select("blob", "rules", "m.rule", F.posexplode_outer("m.matches").alias("place", "hit"))
    )
    so_far = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    spans = hits.select("blob", "rules", "rule", "hit", F.sum(F.col("hit.gap") + F.col("hit.size")).over(so_far).alias("end"))
    span = F.struct((F.col("end") - F.col("hit.size")).cast("int").alias("start"), F.col("end").cast("int").alias("end"), "rule")
    return spans.groupBy("blob").agg(
        F.first("rules").alias("rules"), F.collect_list(F.when(F.col("hit.kept"), span)).alias("found"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def missing(versions: DataFrame, known: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, rules`` for the blobs of ``versions`` that lack some rule."""
    names = [r.name for r in rules]
    seen = (known.select("blob", F.explode("rules").alias("rule")).where(F.col("rule").isin(names))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    wanted = F.array(*map(F.lit, names))
    left = F.when(F.col("seen").isNull(), wanted).otherwise(F.array_except(wanted, "seen"))
    return (versions.select("blob").distinct().join(seen.hint("merge"), "blob", "left")
            .select("blob", left.alias("rules")).where(F.size("rules") > 0))


def extend(rows: DataFrame, versions: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> int | None:
    """Scan what the ledger lacks of ``rows`` (blob, text) and append it. Returns
    the number of blobs scanned; None for a new ledger (all of them)."""
    spark = rows.sparkSession
    known = read_ledger(spark, ledger)
    one = F.first("text").alias("text")
    if known is None:
        blobs = rows.groupBy("blob").agg(one).withColumn("rules", F.array(*[F.lit(r.name) for r in rules]))
        scan_blobs(blobs, rules).write.mode("append").parquet(ledger)
        return None
    todo, path = store(missing(versions, known, rules), "missing")
    count = todo.count()
    if count:
        if count <= BROADCAST_BLOBS:  # few new texts: only they move
            blobs = rows.join(F.broadcast(todo), "blob").groupBy("blob").agg(one, F.first("rules").alias("rules"))
        else:
            blobs = rows.groupBy("blob").agg(one).join(todo.hint("merge"), "blob")
        scan_blobs(blobs, rules).write.mode("append").parquet(ledger)
    remove(spark, path)
    return count


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, blob, found`` per row of ``docs``; ``found`` holds the spans
    ``start, rank, end, kind`` in order (``rank``: the rule's place in ``rules``).
    ``ledger`` is the folder of the ledger, made on first use and then extended."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    versions, _ = store(rows.select("id", "blob"), "versions")
    extend(rows, versions, ledger, rules)
    names = F.array(*[F.lit(r.name) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    known = docs.sparkSession.read.schema(LEDGER).parquet(ledger).select("blob", F.explode("found").alias("f"))
    known = known.withColumn("rank", F.array_position(names, F.col("f.rule")).cast("int")).where("rank > 0")
    found = known.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
        F.col("f.start").alias("start"), F.col("rank"), F.col("f.end").alias("end"),
        F.element_at(kinds, F.col("rank")).alias("kind")))).alias("found"))
    nothing = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return join_copies(versions, found, "blob").select("id", "blob", F.coalesce("found", nothing).alias("found"))


def joined(found: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans and all spans."""
    found = F.col("found")

    def count(rank):
        return F.size(F.filter(found, lambda f: f["rank"] == rank)).cast("long")

    return scanned.select(
        "id", *[count(i + 1).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(joined(F.filter(found, lambda f: f["rank"] <= len(BASE))), 256).alias("base_sha256"),
        joined(found).alias("spans"))
