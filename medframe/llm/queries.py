"""Registered queries of this subpackage: ``opN_<name>(spark, sf_dir)``, each
over its whole table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medframe.llm import ann, bpe, clusters, lm, mixing, neardup, pii, quality, repair, secrets, topk, urlfilter, warc
from medframe.llm.batches import new_path

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(_table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"), "rate", "copies")


def op2_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                          public_tokenizers.PATTERN)


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.write(_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return warc.read(index, folder, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_int8_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op7_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.scored(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").withColumn("held_out", lm.held_out(F.col("doc_id")))


def op8_term_at_a_time_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op9_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text", shingle=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_url_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = urlfilter.split_urls(_table(spark, sf_dir, "pages"), "page_id", "url")
    found = urlfilter.judge(split, URL_RULES, urlfilter.labelled_by_rules(split, URL_RULES))
    return found.withColumnRenamed("id", "page_id")


def op11_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"), new_path(spark, "ledger"))
    return secrets.digest(found).withColumnRenamed("id", "doc_id")


def op12_four_russians_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    return repair.report(repair.damage(table), table).withColumnRenamed("conv", "conv_id")


def op13_incremental_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.cluster(_table(spark, sf_dir, "embeddings"), k=16, dim=64, scale=64, rounds=3)
    return found.withColumnRenamed("id", "vec_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_entropy_mix": op1_entropy_mix,
        "op2_quality_qda": op2_quality_qda,
        "op3_rank_queue_bpe": op3_rank_queue_bpe,
        "op4_pii_spans": op4_pii_spans,
        "op5_indexed_warc": op5_indexed_warc,
        "op6_int8_block_neighbours": op6_int8_block_neighbours,
        "op7_bloom_lm": op7_bloom_lm,
        "op8_term_at_a_time_top_k": op8_term_at_a_time_top_k,
        "op9_minmax_near_duplicates": op9_minmax_near_duplicates,
        "op10_url_logistic": op10_url_logistic,
        "op11_blob_ledger_secrets": op11_blob_ledger_secrets,
        "op12_four_russians_repair": op12_four_russians_repair,
        "op13_incremental_clusters": op13_incremental_clusters,
    }


# A vector takes part if it is not null and all its components are finite.
_VECTORS = """
select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
where embedding is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
"""

ORACLES: dict[str, str] = {
    "op5_indexed_warc": """
with p as (select page_id, coalesce(html, '') as t from pages),
d as (select page_id, strlen(t) as n, sha1(t) as h from p),
m as (select h, min(page_id) as first from d group by h)
select page_id, n as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)),
    'string_agg', '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from d join m using (h)
""",
    "op6_int8_block_neighbours": f"""
with v as ({_VECTORS}),
w as (select * from v where len(list_filter(v, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, c.vec_id, list_distance(q.v, c.v) as score
      from w q join w c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
""",
    "op8_term_at_a_time_top_k": f"""
with v as ({_VECTORS}),
w as (select vec_id, list_transform(v, lambda x: floor(256 * x)) as v from v),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
      from w q join w c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
""",
}


def _secret_spans(rank: int, kind: str, pattern: str, group: int = 0, least: int = 1) -> str:
    """DuckDB SQL: the spans of one kind in ``t(r, t)``, from the lengths of the
    matches and of the pieces between them."""
    return f"""
select r, {rank} as rank, '{kind}' as kind, s as start, s + length(m[i]) as stop from (
  select r, m, g, i, list_sum(list_transform(p[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as s
  from (select r, m, g, p, unnest(generate_series(1, len(m))) as i from (
    select r, regexp_extract_all(t, $${pattern}$$, 0) as m, regexp_extract_all(t, $${pattern}$$, {group}) as g,
      regexp_split_to_array(t, $${pattern}$$) as p from t))) where length(g[i]) >= {least}"""


_EITHER_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word).replace("_", "_?")
                        for word in ("password", "passwd", "secret", "token", "api_key"))
ORACLES["op11_blob_ledger_secrets"] = f"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
f as ({" union all ".join([
    _secret_spans(1, "assign", f"({_EITHER_CASE})[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    _secret_spans(2, "access", "AKIA[A-Z0-9]+", 0, 18),
    _secret_spans(3, "hex", "[0-9a-f]+", 0, 16),
    _secret_spans(4, "github", "gh[opsu]_[A-Za-z0-9]{36,}"),
    _secret_spans(5, "slack", "xox[abprs]-[A-Za-z0-9-]{20,}"),
    _secret_spans(6, "pem", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
])}),
j as (select r, count(*) filter (where rank = 1) as a, count(*) filter (where rank = 2) as k,
  count(*) filter (where rank = 3) as h,
  string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, rank)
    filter (where rank <= 3) as base,
  string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, rank) as spans
  from f group by r)
select doc_id, coalesce(a, 0) as n_assign, coalesce(k, 0) as n_access, coalesce(h, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join j using (r)
"""

# A row at a time, forward: per place of the pattern the least (cost, letters) and the turns they leave.
_NONE = "{'c': 1000000000, 'a': '~', 't': ''}"


def _edit(place: str, letter: str, cost: str, line: str = "''") -> str:
    return f"{{'c': {place}.c + {cost}, 'a': {place}.a || '{letter}', 't': {place}.t || {line}}}"


def _row_edits(to: str, name: str, places: tuple) -> list[str]:
    out = [_edit(to, "D", "3")]
    for p in places:
        out.append(f"case when fault < 2 and initial = '{to}' then "
                   + _edit(p, "K", "fault", "chr(10) || role || ':' || text") + f" else {_NONE} end")
        if to != "s":
            out.append(f"case when fault < 2 then {_edit(p, 'R', '2 + fault', f'chr(10) || {name!r} || chr(58) || text')} "
                       f"else {_NONE} end")
    return out


_U, _A = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
ORACLES["op12_four_russians_repair"] = f"""
with recursive k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  xor(4294967295::bigint, list_reduce([4294967295::bigint] || list_transform(
    string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint),
    lambda h, b: list_reduce([xor(h, b)] || list_transform(range(8), lambda z: 0::bigint),
      lambda x, z: xor(x >> 1, 3988292384::bigint * (x & 1))))) % 20 as pick from conversations),
d as (select conv_id, turn, case when pick = 4 then 'user' else role end as role,
  case when pick = 1 then '' when pick = 2 then translate(text, '.!?', '') else text end as text,
  unnest(range(case when pick = 0 then 0 when pick = 3 then 2 else 1 end)) as copy from k),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i,
  row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
  left(role, 1) as initial, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
  not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') as cut from d),
r as (select *, case when blank or seen > 1 then 2 when cut then 1 else 0 end as fault,
  lag(initial) over (partition by conv_id order by i) || initial as pair from o),
n as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
  count(*) filter (where blank) as blank, count(*) filter (where not blank and seen > 1) as duplicate,
  count(*) filter (where fault = 1) as truncated,
  count(*) filter (where i > 1 and pair not in ('su', 'ua', 'au')) as illegal, max(i) as rows from r group by conv_id),
p as (
  select conv_id, 0::bigint as i, {{'c': 0, 'a': '', 't': ''}} as z, {_NONE} as s,
    {{'c': 2, 'a': 'I', 't': {_U}}} as u, {{'c': 4, 'a': 'II', 't': {_U} || {_A}}} as a
  from (select distinct conv_id from conversations)
  union all
  select conv_id, i, z, s,
    list_min([u, {_edit("z", "I", "2", _U)}, {_edit("s", "I", "2", _U)}, {_edit("a", "I", "2", _U)}]) as u,
    list_min([a, {_edit("u", "I", "2", _A)}, {_edit("z", "II", "4", f"{_U} || {_A}")},
      {_edit("s", "II", "4", f"{_U} || {_A}")}]) as a
  from (select p.conv_id, r.i, {_edit("z", "D", "3")} as z, list_min([{", ".join(_row_edits("s", "", ("z",)))}]) as s,
      list_min([{", ".join(_row_edits("u", "user", ("z", "s", "a")))}]) as u,
      list_min([{", ".join(_row_edits("a", "assistant", ("u",)))}]) as a
    from p join r on p.conv_id is not distinct from r.conv_id and r.i = p.i + 1)),
e as (select p.conv_id, list_min([z, a]) as b from p left join n on p.conv_id is not distinct from n.conv_id
  where p.i = coalesce(n.rows, 0))
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, b.c as cost, b.a as audit,
  sha256(substr(b.t, 2)) as repaired_sha256
from e left join n on e.conv_id is not distinct from n.conv_id
"""


def _round(n: int) -> str:
    """DuckDB SQL: assignment ``a{n}`` by the centroids ``c{n}``, and the next centroids."""
    return f"""
a{n} as (select r, j, d from (select r, j, d, row_number() over (partition by r order by d, j) as best from (
  select r, j, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
  from v, c{n})) where best = 1),
c{n + 1} as (select c{n}.j, coalesce(m.c, c{n}.c) as c from c{n} left join (
  select j, list(divide(s - (((s % n) + n) % n), n) order by place) as c from (
    select j, place, sum(e) as s, count(*) as n from (
      select a{n}.j, unnest(x) as e, unnest(range(64)) as place from a{n} join v using (r)) group by j, place)
  group by j) m using (j))"""


ORACLES["op13_incremental_clusters"] = f"""
with v as (select row_number() over () as r, vec_id, list_transform(v, lambda x: floor(64 * x)::bigint) as x
  from ({_VECTORS}) where len(v) = 64),
c0 as (select row_number() over (order by h, x) - 1 as j, x as c from (
  select sha256('1:' || vec_id) as h, x from v order by h nulls last, x limit 16)),
{", ".join(_round(n) for n in range(4))}
select vec_id, a3.j::int as cluster, d as distance, (sum(d) over (partition by a3.j))::bigint as cluster_inertia,
  (sum(d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a3 join v using (r) join c3 using (j)
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
