"""The queries of the operators over their whole tables, and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.bpe import encode_digest

    return encode_digest(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.decontam import contamination_digest

    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.suffix_dedup import dedup_digest

    return dedup_digest(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.langid import language_digest

    return language_digest(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.ngram_join import link_documents

    return link_documents(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.quality_rules import rules_digest

    return rules_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.toxicity import toxicity_digest

    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules of the pages query (fixed values).
URL_RULES = ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"), URL_RULES)


#: Both texts of the conversation that the query adds (a fixed value).
EXTRA_TEXT = "\\### Assistant: </turn> ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.chat import chat_digest

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text")
    )
    return chat_digest(rows.unionByName(extra))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.quality_classifier import quality_digest

    return quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.spelling import group_variants

    return group_variants(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandspark.llm.hard_negatives import mine, seventh_next

    return mine(table(spark, sf_dir, "embeddings"), relabel=seventh_next)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language_id": op3_language_id,
    "op4_ngram_join": op4_ngram_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_chat": op8_chat,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
    "op11_html": op11_html,
    "op12_spelling": op12_spelling,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = """
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h, cast(octet_length(encode(coalesce(text, ''))) as bigint) as n from documents),
places as (select doc_id, unnest(list_transform(range(n - 99), lambda i: {'i': i, 'k': md5(substr(h, 2 * i + 1, 200))})) as p from texts where n >= 100),
windows as (select doc_id, p.i as i, row_number() over (partition by p.k order by doc_id, p.i) as nth from places),
again as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as gap from windows where nth > 1),
runs as (select doc_id, i, sum(case when gap <= 100 then 0 else 1 end) over (partition by doc_id order by i) as run from again),
spans as (select doc_id, min(i) as a, max(i) + 100 as b from runs group by doc_id, run),
kept as (
  select doc_id, lag(b, 1, 0) over (partition by doc_id order by a) as a, a as b from spans
  union all select t.doc_id, coalesce(max(s.b), 0), any_value(t.n) from texts t left join spans s using (doc_id) group by t.doc_id),
rest as (select k.doc_id, string_agg(substr(t.h, 2 * k.a + 1, 2 * (k.b - k.a)), '' order by k.a) as h from kept k join texts t using (doc_id) group by k.doc_id)
select t.doc_id, t.n as n_bytes, cast(coalesce(g.gone, 0) as bigint) as n_removed, coalesce(g.spans, 0) as n_spans, sha256(unhex(r.h)) as kept_sha256
from texts t join rest r using (doc_id) left join (select doc_id, sum(b - a) as gone, count(*) as spans from spans group by doc_id) g using (doc_id)
"""

_OP4 = f"""
with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) as s from words where len(w) >= 3
  union all select doc_id, array_to_string(w, ' ') from words where len(w) in (1, 2)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)),
edges as (select a, b from links union select b, a from links),
reach(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, e.b from reach r join edges e on r.other = e.a)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from (select doc_id, min(other) as component_id from reach group by doc_id) left join sizes using (doc_id)
"""

_OP8 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{EXTRA_TEXT}' union all select -7, 1, 'assistant', '{EXTRA_TEXT}'),
sized as (
  select *, row_number() over (partition by conv_id order by turn nulls last, role, text) as n,
    14 + length(role) + length(text) + (2 * length(role) + length(text) - length(replace(role, '\\', '')) - length(replace(role, ':', '')) - length(replace(text, '\\', '')))
      + (length(role || text) - length(replace(role, '</turn>', '') || replace(text, '</turn>', ''))) // 7
      + coalesce(list_sum([len(x) - 2 for x in regexp_extract_all(role, '#{{3,}}')]), 0) + coalesce(list_sum([len(x) - 2 for x in regexp_extract_all(text, '#{{3,}}')]), 0) as chars
  from turns)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  length(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256, cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""

_OP10 = f"""
with docs as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
items as (select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
tests as (
  select distinct item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) as s
  from (select item_id, w, least(len(w), 13) as n from items where len(w) > 0)),
places as (
  select doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'i': i, 's': array_to_string(w[i : i + n - 1], ' ')}})) as p
  from docs, (select distinct n from tests) where len(w) >= n),
found as (select p.doc_id, p.p.i as i, p.n, t.item_id from places p join tests t on p.n = t.n and p.p.s = t.s),
hit as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from found) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""

# The given pages all have one article of headings, paragraphs, bold text and line breaks, and few character references.
_OP11 = """
with articles as (select page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') as a from pages),
blocks as (
  select page_id, i, regexp_replace(regexp_replace(regexp_replace(b, '</?b>', '', 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g') as b
  from (select page_id, unnest(b) as b, unnest(range(len(b))) as i from (select page_id, regexp_split_to_array(coalesce(a, ''), '</?(?:h1|p)>') as b from articles))),
texts as (
  select page_id, i, trim(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) as t
  from blocks),
joined as (select page_id, string_agg(t, ' ' order by i) as text from texts where t <> '' group by page_id)
select page_id, url, coalesce(text, '') as text, cast(length(coalesce(text, '')) as bigint) as n_chars
from pages left join joined using (page_id)
"""

_OP12 = f"""
with recursive steps(i, k, c) as (
  select i, 0, i from range(256) t(i)
  union all select i, k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from steps where k < 8),
crc as (select list(c order by i) as t from steps where k = 8),
runs as (
  select doc_id, r, count(*) as k from (select doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) as r from documents)
  where length(r) >= 6 group by doc_id, r),
hashed as (
  select r, k, xor(list_reduce(
    list_transform(range(octet_length(encode(doc_id || ':' || r))), lambda i: cast('0x' || substr(hex(encode(doc_id || ':' || r)), 2 * i + 1, 2) as bigint)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) as h
  from runs, crc),
words as (
  select w as word, cast(sum(k) as bigint) as n
  from (select k, case when h % 199 = 0 then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) else r end as w from hashed)
  where length(w) >= 6 group by w having sum(k) >= 5),
places as (select word, n, unnest(range(1, length(word) + 1)) as i from words),
masks as (select word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) as m from places),
cuts as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) as m from places),
near as (
  select a.word, b.word as other, b.n as other_n from masks a join masks b on a.m = b.m and a.word <> b.word
  union all select c.word, w.word, w.n from cuts c join words w on c.m = w.word
  union all select w.word, c.word, c.n from cuts c join words w on c.m = w.word),
best as (
  select word, count(*) as n_near, max(other_n) as top, min(other) filter (other_n = most) as other
  from (select *, max(other_n) over (partition by word) as most from near) group by word),
forms as (
  select word, n, case when top >= 5 * n then other end as form, case when top >= 5 * n then top end as form_n, coalesce(n_near, 0) as n_near
  from words left join best using (word)),
chain(word, up) as (select word, word from forms union all select c.word, f.form from chain c join forms f on f.word = c.up where f.form is not null)
select f.word, f.form, c.up as root, f.n, f.n_near, f.form_n
from forms f join chain c on c.word = f.word join forms e on e.word = c.up and e.form is null
"""

_OP13 = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id as vec_id, b.label as label,
    cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) as bigint) as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where label <> anchor_label and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 5
"""

#: What needs a model or the tokenizer has no SQL; its tests hold it against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": _OP2,
    "op4_ngram_join": _OP4,
    "op8_chat": _OP8,
    "op10_decontaminate": _OP10,
    "op11_html": _OP11,
    "op12_spelling": _OP12,
    "op13_hard_negatives": _OP13,
}
