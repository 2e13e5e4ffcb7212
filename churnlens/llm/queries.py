"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import bpe, ordinal, token_counts, twins
from churnlens.llm.backoff import backoff_scores
from churnlens.llm.crf_extract import extract
from churnlens.llm.line_dedup import without_common_lines
from churnlens.llm.lsa_decontam import decontaminate
from churnlens.llm.near_dup import near_duplicates
from churnlens.llm.quality_rules import quality_rules
from churnlens.llm.source_audit import source_audit
from churnlens.llm.store import folder
from churnlens.llm.url_filter import judge
from churnlens.llm.vector_codes import compress
from churnlens.llm.warc import round_trip
from churnlens.session import ship_package

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                         public_tokenizers.PATTERN)
    return token_counts.length_histogram(lengths)


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(_table(spark, sf_dir, "documents"))


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op4_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE)))


def op5_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_common_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_cut", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op6_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ordinal.classify(docs, ordinal.train(docs, _table(spark, sf_dir, "labels")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages"), folder(spark, "warc"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(_table(spark, sf_dir, "embeddings"))


def op13_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_length_histogram": op1_length_histogram,
    "op2_stupid_backoff": op2_stupid_backoff,
    "op3_superminhash": op3_superminhash,
    "op4_rank_array_bpe": op4_rank_array_bpe,
    "op5_line_alignment": op5_line_alignment,
    "op6_ngram_ratio": op6_ngram_ratio,
    "op7_latent_decontamination": op7_latent_decontamination,
    "op8_crf_main_text": op8_crf_main_text,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_warc": op10_warc,
    "op11_source_audit": op11_source_audit,
    "op12_vector_codes": op12_vector_codes,
    "op13_url_templates": op13_url_templates,
}

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_stupid_backoff": f"""
with d as (
  select row_number() over () as r, doc_id, {_WORDS.format(text="coalesce(text, '')")} as ws from documents),
w as (
  select r, unnest(ws) as w3, unnest(range(1, len(ws) + 1)) as i from d),
g as (
  select r, i, w3, lag(w3) over o as w2, lag(w3, 2) over o as w1 from w window o as (partition by r order by i)),
n1 as (select w3, count(*) as c from g group by all),
n2 as (select w2, w3, count(*) as c from g where w2 is not null group by all),
n3 as (select w1, w2, w3, count(*) as c from g where w1 is not null group by all),
o1 as (select r, w3, count(*) as c from g group by all),
o2 as (select r, w2, w3, count(*) as c from g where w2 is not null group by all),
o3 as (select r, w1, w2, w3, count(*) as c from g where w1 is not null group by all),
t as (select count(*) as n from g),
own as (select r, len(ws) as n from d),
e as (
  select g.r, g.i, t.n - own.n as others,
         n1.c - o1.c as c1, n2.c - o2.c as c2, n3.c - o3.c as c3
  from g, t
  join own on own.r = g.r
  join n1 on n1.w3 = g.w3 join o1 on o1.r = g.r and o1.w3 = g.w3
  left join n2 on n2.w2 = g.w2 and n2.w3 = g.w3 left join o2 on o2.r = g.r and o2.w2 = g.w2 and o2.w3 = g.w3
  left join n3 on n3.w1 = g.w1 and n3.w2 = g.w2 and n3.w3 = g.w3
  left join o3 on o3.r = g.r and o3.w1 = g.w1 and o3.w2 = g.w2 and o3.w3 = g.w3),
s as (
  select r, c1, least(3, i) as m, others, c2, c3,
         lag(c1) over (partition by r order by i) as b1, lag(c2) over (partition by r order by i) as b2
  from e),
l as (
  select r, c1, case when c3 > 0 then ln(0.4) * (m - 3) + ln(c3) - ln(b2)
                     when c2 > 0 then ln(0.4) * (m - 2) + ln(c2) - ln(b1)
                     when c1 > 0 then ln(0.4) * (m - 1) + ln(c1) - ln(others)
                     else ln(0.4) * m - ln(others + 1) end as x
  from s)
select d.doc_id, len(d.ws) as n_words, count(*) filter (where l.c1 = 0) as unseen,
       round(sum(l.x) / nullif(len(d.ws), 0), 6) as mean_log_score
from d left join l on l.r = d.r group by d.r, d.doc_id, d.ws""",
    "op3_superminhash": f"""
with recursive w as (
  select doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws
  from documents where doc_id is not null),
s as (
  select distinct doc_id, unnest(case when len(ws) >= 5
      then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (
  select a.doc_id as u, b.doc_id as v, count(*) as i
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
link as (
  select u, v from shared join n x on x.doc_id = u join n y on y.doc_id = v
  where 100 * i >= 85 * (x.n + y.n - i)),
reach(doc_id, other) as (
  select doc_id, doc_id from w
  union
  select r.doc_id, l.v from reach r join link l on l.u = r.other)
select w.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(reach.other) as component_id,
       w.doc_id = min(reach.other) as kept
from w join reach on reach.doc_id = w.doc_id left join n on n.doc_id = w.doc_id
group by w.doc_id""",
    "op10_warc": """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
g as (
  select payload, max(page_id) as kept_id from p
  where octet_length(payload) >= 1000 and page_id is not null group by payload)
select p.page_id, octet_length(p.payload)::bigint as payload_bytes, sha1(p.payload) as payload_digest,
       case when p.page_id < g.kept_id then 'revisit' else 'response' end as record_type,
       case when p.page_id < g.kept_id then g.kept_id end as refers_to
from p left join g on g.payload = p.payload""",
    "op11_source_audit": twins.SOURCE_AUDIT,
    "op12_vector_codes": twins.VECTOR_CODES,
    "op13_url_templates": twins.URL_FILTER,
}
