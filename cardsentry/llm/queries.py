"""One query for each operator: key -> function of (spark, sf_dir)."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, lexical, lm, mixing, neardup, quality, sharding, suffixdedup, tokencount, tokens, toxicity, warc, whitening
from .common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return tokens.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "runs", "key")


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Target weights by tree level; the domain is the source number's last digit modulo 4.
MIX_WEIGHTS = mixing.Weights(domain={"0": 40, "1": 30, "2": 20, "3": 10}, lang={"en": 50, "de": 20, "fr": 20, "es": 10}, source={}, other=1)


def mix_domain():
    return F.pmod(F.ascii(F.right("source", F.lit(1))), F.lit(4)).cast("string")


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    chosen = mixing.mixture(table(spark, sf_dir, "documents"), mix_domain(), MIX_WEIGHTS, budget_permille=600, max_epochs=4, seed=1)
    return chosen.where("copies > 0").drop("key")


def _fill_sql(name: str, below: str, parent: str, weight: str, budget: str) -> str:
    """CTEs that share out a level: <name>_a orders the children, <name> has each child's part."""
    by = f"partition by {parent}" if parent else ""
    keys = f"{parent}, " if parent else ""
    on = f"join {below} using ({parent})" if parent else ""
    return f"""
{name}_a as (
  select *, coalesce(sum(cap) over ({by} order by cap::double / w, child rows between unbounded preceding and 1 preceding), 0)::hugeint used,
    sum(w) over ({by} order by cap::double / w, child rows between current row and unbounded following)::hugeint open
  from (select {keys} {name} child, sum(tokens * 4)::hugeint cap, ({weight})::hugeint w from leaves group by all)),
{name}_b as (select a.*, ({budget})::hugeint b, a.used * w + cap * open <= ({budget})::hugeint * w sat from {name}_a a {on}),
{name}_t as (
  select {keys} child {name}, case when sat then cap else
    ((b - sum(case when sat then cap else 0 end) over ({by})::hugeint) * w) // (sum(case when sat then 0 else w end) over ({by})::hugeint) end got
  from {name}_b)"""


SQL["op4_mixing"] = f"""
with sized as (
  select doc_id, (ascii(right(source, 1)) % 4)::varchar domain, lang, source,
    md5({" || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "text", "lang", "source"))}) key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens
  from documents),
leaves as (select domain, lang, source, sum(n_tokens)::hugeint tokens from sized group by all),
{_fill_sql("domain", "", "", "case domain when '0' then 40 when '1' then 30 when '2' then 20 when '3' then 10 else 1 end", "(select sum(tokens) * 600 // 1000 from leaves)")},
{_fill_sql("lang", "domain_t", "domain", "case lang when 'en' then 50 when 'de' then 20 when 'fr' then 20 when 'es' then 10 else 1 end", "got")},
{_fill_sql("source", "lang_t", "domain, lang", "1", "got")},
plan as (select l.*, (got // tokens)::bigint epochs, (got % tokens)::bigint rest from leaves l join source_t using (domain, lang, source)),
placed as (
  select s.*, epochs, rest, coalesce(sum(n_tokens) over (partition by domain, lang, source
    order by md5('1:' || (epochs + 1) || ':' || key), key rows between unbounded preceding and 1 preceding), 0) before
  from sized s join plan using (domain, lang, source))
select doc_id, domain, lang, source, n_tokens, (epochs + case when before < rest then 1 else 0 end)::bigint copies
from placed where epochs + case when before < rest then 1 else 0 end > 0
"""


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sharding.byte_shards(table(spark, sf_dir, "documents"), 40)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return warc.warc_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op9_warc"] = """
with p as (select page_id, strlen(coalesce(html, ''))::bigint payload_bytes, sha256(coalesce(html, '')) payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 100 and page_id <> first then first end refers_to
from f
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), use=fold != 1)
    return out.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffixdedup.repeated_bytes(table(spark, sf_dir, "documents"), 50)


@query
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lm.scores(table(spark, sf_dir, "documents"), F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1)


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


_TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL["op11_lexical_search"] = f"""
with docs as (select row_number() over () rid, doc_id, {_TERMS_SQL} terms from documents where text is not null),
corpus as (select count(*)::bigint n_docs, sum(len(terms))::bigint n_all from docs where len(terms) > 0),
tf as (select rid, doc_id, len(terms)::bigint n, term, count(*)::bigint tf from (select rid, doc_id, terms, unnest(terms) term from docs) group by rid, doc_id, len(terms), term),
df as (select term, count(*)::bigint df from tf group by term),
items as (select row_number() over () iid, item_id, {_TERMS_SQL} terms from benchmark where text is not null),
asked as (select iid, item_id, unnest(terms) term from items),
scored as (
  select iid, item_id, rid, doc_id,
    sum(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_all))))::bigint score
  from asked join tf using (term) join df using (term) cross join corpus group by iid, item_id, rid, doc_id),
ranked as (select *, row_number() over (partition by iid order by score desc, doc_id nulls last, rid)::integer rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", 4)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 512)
