"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies. Among all rates
that give every source its target number of words, those nearest to one copy
each (least relative entropy, at most ``MAX_RATE``) are exponentially tilted
by size: ``rate = min(MAX_RATE, exp(tilt[source] * size / mean))``. The tilts
solve a convex dual; each Newton step sums gradient and curvature over the
sizes of all documents in Spark, a bracket guards the step.

Rates become whole copies level by level, a level being the documents of one
source and size: the words owed so far, largest size first, fix the copies of
a level, so a source ends within about half its smallest documents of its
target. Within a level the extra copies go to the documents first in an order
by hash. Levels are ranked in parts for this, so no source or size is ever ranked
in one task. What is known of a source (its words, target and tilt) is a row
on the driver: sources are few.

Edge cases: a null text has size 0; documents of size 0 keep their rate but
add no words. A null source is a source, the last one. No documents, or only
empty ones: targets are 0 and nothing is taken. Rows that share an id are
separate documents; equal rows may differ in copies. Everything depends on
ids, sizes and sources only, so reruns agree.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import join_copies, remove, store

MAX_RATE = 3.0
WEIGHTS = (5.0, 2.0, 1.0)
TOLERANCE = 1e-6    # relative error of a source's words at which Newton stops
MAX_STEPS = 80
PART_ROWS = 1000    # documents of a level ranked together

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, text_col: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: list[tuple[str | None, int]], weights=WEIGHTS, cap: float = MAX_RATE) -> dict:
    """Target words of each source. ``totals``: words by source. Sources by
    code point, null last, take the repeating weights; a target stops at
    ``cap`` times the source's words and the excess is shared again."""
    order = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    words = dict(order)
    left, free, out = float(sum(words.values())), set(words), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * unit >= cap * words[s]}
        if not full:
            return out | {s: weight[s] * unit for s in free}
        for s in full:
            out[s] = cap * words[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out


def _key(col: str) -> F.Column:
    """Sources as a join key without nulls."""
    return F.when(F.col(col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(col)))


def solve(levels: DataFrame, target: dict[str, float], cap: float = MAX_RATE) -> dict[str, float]:
    """Tilt of each source: Newton on the dual. ``levels(source, size, n)``
    counts the documents of a source and size; ``source`` is the join key."""
    spark = levels.sparkSession
    facts = {r["source"]: r for r in levels.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n")).collect()}
    mean = {s: max(1.0, r["words"] / r["n"]) for s, r in facts.items()}
    tilt, low, high = {}, {}, {}
    active = set()
    for s, r in facts.items():
        tilt[s], low[s], high[s] = 0.0, -math.inf, math.inf
        if target[s] >= cap * r["words"]:
            tilt[s] = math.inf
        elif target[s] <= 0:
            tilt[s] = -math.inf
        else:
            active.add(s)
    for _ in range(MAX_STEPS):
        if not active:
            break
        now = spark.createDataFrame(pd.DataFrame(
            [(s, tilt[s], mean[s]) for s in active], columns=["source", "tilt", "mean"]),
            "source string, tilt double, mean double")  # one row per source
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * z, F.lit(math.log(cap))))
        words = F.col("n") * F.col("size") * rate
        sums = levels.join(now, "source").groupBy("source").agg(
            F.sum(words).alias("words"),
            F.sum(F.when(F.col("tilt") * z < math.log(cap), words * z).otherwise(0.0)).alias("slope")).collect()
        for r in sums:
            s, miss = r["source"], r["words"] - target[r["source"]]
            if abs(miss) <= TOLERANCE * target[s]:
                active.discard(s)
                continue
            if miss > 0:
                high[s] = tilt[s]
            else:
                low[s] = tilt[s]
            step = tilt[s] - miss / r["slope"] if r["slope"] > 0 else math.inf
            if not low[s] < step < high[s] or abs(step) > 1e6:
                step = ((low[s] + high[s]) / 2 if math.isfinite(low[s]) and math.isfinite(high[s])
                        else 2 * tilt[s] + (1 if miss < 0 else -1))
            if step == tilt[s]:
                active.discard(s)
            tilt[s] = step
    return {s: tilt[s] / mean[s] if math.isfinite(tilt[s]) else tilt[s] for s in tilt}


def _copies_of_levels(target: dict[str, float], tilt: dict[str, float], cap: float):
    """Copies of each level of a source, largest size first: the words owed by
    the rates of the levels so far, less those given, in whole copies."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("size", ascending=False)
        source = g["source"].iloc[0]
        size, n = g["size"].to_numpy(np.float64), g["n"].to_numpy(np.int64)
        t = tilt[source]
        with np.errstate(all="ignore"):
            power = np.where(size > 0, t * size, 0.0)
        rate = np.exp(np.minimum(power, math.log(cap)))
        owed = np.cumsum(n * size * rate)
        if owed[-1] > 0:
            owed *= target[source] / owed[-1]
        given, copies = 0.0, []
        for i in range(len(g)):
            want = (owed[i] - given) / size[i] if size[i] > 0 else n[i] * rate[i]
            c = int(min(max(0, math.floor(want + 0.5)), math.floor(cap) * n[i]))
            given += c * size[i]
            copies.append(c)
        return g.assign(rate=rate, copies=copies)[["source", "size", "n", "rate", "copies"]]

    return run


def _planned(slim: DataFrame, weights, cap: float) -> DataFrame:
    """``slim(id, row, source, size)``, stored, with ``source_size, target, rate,
    copies``; ``row`` tells rows of one id apart (null where it need not)."""
    spark = slim.sparkSession
    ship.ensure(spark)
    levels, levels_path = store(slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "levels")
    totals = [(r["source"], r["words"]) for r in levels.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("words")).collect()]  # one row per source
    goal = targets(totals, weights, cap)
    keyed = levels.select(_key("source").alias("source"), "size", "n")
    named = {"n" if s is None else "s" + s: s for s, _ in totals}
    target = {k: goal[s] for k, s in named.items()}
    tilt = solve(keyed, target, cap)
    plan, _ = store(keyed.groupBy("source").applyInPandas(
        _copies_of_levels(target, tilt, cap), "source string, size long, n long, rate double, copies long"), "plan")
    remove(spark, levels_path)
    facts = spark.createDataFrame(
        pd.DataFrame([(k, dict(totals)[s], target[k]) for k, s in named.items()],
                     columns=["key", "source_size", "target"]),
        "key string, source_size long, target double")
    level = F.concat_ws(":", "size", "key")
    rows = slim.withColumn("key", _key("source")).withColumn("level", level)
    plan = plan.select(F.col("source").alias("key"), "size", "n", "rate", "copies").withColumn("level", level)
    out = join_copies(rows, plan.drop("key", "size"), "level")
    # A document's place in its level: a level is ranked in parts, and the rows of
    # the parts before come from one small row per part, so every level gives
    # exactly the copies planned, whatever its size.
    out = out.withColumn("part", F.pmod(F.xxhash64("id", "row", F.lit(7)), F.ceil(F.col("n") / PART_ROWS)))
    earlier = Window.partitionBy("level").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = out.groupBy("level", "part").agg(F.count(F.lit(1)).alias("m")).select(
        "level", "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("level", "part").orderBy(F.xxhash64("id"), "id", "row")
    out = out.withColumn("place", F.row_number().over(order)).join(parts.hint("merge"), ["level", "part"])
    more = F.col("place") + F.col("before") <= F.col("copies") % F.col("n")
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(more, 1).otherwise(0)
    return out.withColumn("given", copies.cast("int")).join(facts, "key").select(
        "id", "row", "source", "size", "source_size", "target", "rate", F.col("given").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, cap: float = MAX_RATE) -> DataFrame:
    """One row per document: ``id, source, size, source_size, target, rate,
    copies``."""
    slim, _ = store(docs.select(F.col(id_col).alias("id"), F.lit(None).cast("long").alias("row"),
                                F.col(source_col).alias("source"), sizes(docs, text_col).alias("size")), "sizes")
    return _planned(slim, weights, cap).drop("row")


def repeat(docs: DataFrame, weights=WEIGHTS, cap: float = MAX_RATE) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` with every row as often as the mix
    takes it. Rows whose ``doc_id`` is null or occurs again are written with a
    number of their own first, so each gets its own copies."""
    def slimmed(df, row):
        return df.select(F.col("doc_id").alias("id"), row.cast("long").alias("row"), "source", sizes(df).alias("size"))

    twice, _ = store(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("__n")).where(
        "__n > 1").select("doc_id"), "twice")
    single = docs.where("doc_id is not null")
    odd = docs.where("doc_id is null")
    # always merge joins: the plan is the same at every size
    if not twice.isEmpty():
        odd = odd.unionByName(single.join(twice.hint("merge"), "doc_id", "left_semi").select(docs.columns))
        single = single.join(twice.hint("merge"), "doc_id", "left_anti").select(docs.columns)
    slim = slimmed(single, F.lit(None))
    some = not odd.isEmpty()
    row, own, key, times = (f"{n}_{uuid.uuid4().hex}" for n in ("row", "own", "id", "times"))  # no clash with the columns
    if some:
        odd, _ = store(odd.withColumn(row, F.monotonically_increasing_id()), "rows")
        slim = slim.unionByName(slimmed(odd, F.col(row)))
    slim, _ = store(slim, "sizes")
    plan, _ = store(_planned(slim, weights, cap).where("copies > 0").select(
        F.col("id").alias(key), F.col("row").alias(own), F.col("copies").alias(times)), "copies")
    out = single.join(plan.where(F.col(own).isNull()).hint("merge"), F.col("doc_id") == F.col(key)).select(*docs.columns, times)
    if some:
        out = out.unionByName(odd.join(plan.where(F.col(own).isNotNull()).hint("merge"), F.col(row) == F.col(own)).select(
            *docs.columns, times))
    return out.withColumn(row, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)
