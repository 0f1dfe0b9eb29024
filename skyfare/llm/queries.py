"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, covertree, crf, decontam, licences, mixing, packing, pii, prefix_trie, quality,
               simhash, toxicity, url_reputation)
from .common import Workspace, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@register("op1_language_id")
def q_language_id(spark, d):
    return crf.identify(read(spark, d, "documents"))


@register("op2_decontaminate")
def q_decontaminate(spark, d):
    return decontam.decontaminate(read(spark, d, "documents"), read(spark, d, "benchmark"),
                                  Workspace(spark, "op2"))


@register("op3_simhash")
def q_simhash(spark, d):
    rows = simhash.near_duplicates(read(spark, d, "documents"), Workspace(spark, "op3"))
    return rows.select("doc_id", simhash.hex16(rows["fp"]).alias("fingerprint"), "component_id")


@register("op4_personal_data")
def q_personal_data(spark, d):
    return pii.report(read(spark, d, "documents"), Workspace(spark, "op4"))


@register("op5_mix_sources", mixing.mix_sql())
def q_mix_sources(spark, d):
    return mixing.mix(read(spark, d, "documents"), Workspace(spark, "op5"))


def word_bpe() -> str:
    """The public vocabulary that token files are written with."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op6_pack_tokens")
def q_pack_tokens(spark, d):
    path = Workspace(spark, "op6").path("tokens")
    packing.write_tokens(read(spark, d, "documents"), path, packing.Packing(word_bpe()))
    return packing.document_digests(spark, path)


@register("op7_licences")
def q_licences(spark, d):
    return licences.licence_report(read(spark, d, "documents"))


@register("op8_top_k", """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, MIN(v) AS qv FROM v WHERE vec_id % 50 = 0 GROUP BY 1),
s AS (SELECT query_id, vec_id, CAST(list_sum(list_transform(list_zip(qv, v),
  lambda p: COALESCE(p[1], 0) * COALESCE(p[2], 0))) AS BIGINT) AS score FROM q, v WHERE query_id <> vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def q_top_k(spark, d):
    rows = read(spark, d, "embeddings")
    vectors = rows.select("vec_id", covertree.scaled(F.col("embedding")).alias("v"))
    return covertree.top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0, Workspace(spark, "op8"))


@register("op9_toxicity")
def q_toxicity(spark, d):
    return toxicity.toxicity(read(spark, d, "documents"), read(spark, d, "labels"), Workspace(spark, "op9"))


@register("op10_url_reputation", url_reputation.judge_pages_sql())
def q_url_reputation(spark, d):
    return url_reputation.judge_pages(
        read(spark, d, "pages"), url_reputation.label_outcomes(read(spark, d, "labels")),
        Workspace(spark, "op10"))


@register("op11_prefix_trie", prefix_trie.conversation_trie_sql())
def q_prefix_trie(spark, d):
    return prefix_trie.conversation_trie(read(spark, d, "conversations"), Workspace(spark, "op11"))


def tokenizer_pair() -> alignment.Alignment:
    """The two public vocabularies that are aligned."""
    import public_tokenizers
    return alignment.Alignment(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op12_align_tokenizers")
def q_align_tokenizers(spark, d):
    return alignment.align(read(spark, d, "documents"), Workspace(spark, "op12"), tokenizer_pair())


@register("op13_quality_rules", quality.judge_sql())
def q_quality_rules(spark, d):
    return quality.judge(read(spark, d, "documents"), Workspace(spark, "op13"))
