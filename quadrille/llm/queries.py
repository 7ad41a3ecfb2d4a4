"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import (
    bbit_minhash, fill_middle, fingerprints, html_text, language, merkle, neighbours, ngram_join, packing, pieces, sharding,
    toxicity, url_filter)
from quadrille.llm.registry import ORACLES, QUERIES, query, table


def tokenizer_path(name: str) -> str:
    """Where an installed vocabulary file is, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def queries():
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


@query("op4_nearest_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The digest moves in place of the text, which stays the first part of the key.
    placed = sharding.histogram_sort(
        docs.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.xxhash64("text").alias("text_hash"),
                    F.octet_length("text").alias("n_bytes")),
        40, [F.col("text_hash"), F.col("doc_id")], F.coalesce("n_bytes", F.lit(0)) + 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digest(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


OP11_SQL = """
with hashed as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
numbers as (
  select doc_id, text, length(text) as n,
    cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
    cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from hashed),
cuts as (
  select doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form from numbers),
parts as (
  select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1) as suffix from cuts)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts"""


@query("op11_fill_in_middle", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


OP12_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) end as grams
  from words),
classes as (select min(doc_id) as id, grams, len(grams) as n from sets where len(grams) > 0 group by grams),
entries as (select id, n, unnest(grams) as gram from classes),
links as (
  select a.id as u, b.id as v from entries a join entries b on a.gram = b.gram and a.id <> b.id
  group by a.id, b.id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (
  select id as u, id as v from classes
  union select reach.u, links.v from reach join links on reach.v = links.u),
components as (select u as id, min(v) as component from reach group by u)
select s.doc_id, cast(len(s.grams) as bigint) as n_shingles, coalesce(c.component, s.doc_id) as component_id,
  coalesce(c.component, s.doc_id) = s.doc_id as kept
from sets s left join classes k on s.grams = k.grams left join components c on c.id = k.id"""


@query("op12_bbit_near_duplicates", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.bbit_near_duplicates(table(spark, sf_dir, "documents"))


@query("op13_merkle_manifest", merkle.manifest_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digests(table(spark, sf_dir, "documents"))
