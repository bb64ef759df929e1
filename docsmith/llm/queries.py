"""The registered query of each operator: production parameters, whole tables.

Each derives its contract's digest columns from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm import (alignment, hnsw, html_extract, mixing, orchard, packing, pii,
                          quality_model, quality_rules, sharding, simhash, suffix_dedup, topk)
from docsmith.llm.common import table, text_or_empty


def op1_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                        "n_templates")


def op2_information_theoretic_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find(spark, table(spark, sf_dir, "documents"))
    kinds = [pii.number_of(F.col("spans"), kind).alias(f"n_{kind}") for kind, *_ in pii.KINDS]
    spans = F.array_sort(F.concat("spans", "term_spans"))
    return rows.select("doc_id", *kinds, F.sha2(pii.written(F.col("spans")), 256).alias("base_sha256"),
                       pii.written(spans).alias("spans"),
                       F.size("term_spans").cast("long").alias("n_term"))


def op3_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"), length=400)


def op4_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(spark, table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "labels"), threshold=0.7)


def op5_no_random_access_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), k=5, scale=256, every=50)


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_counts(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


def op7_hypergeometric_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shard(spark, rows, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(spark, table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept",
                         F.concat_ws(",", "rejected_by").alias("rejected_by"))


def op9_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), capacity=1024)


def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(spark, table(spark, sf_dir, "documents"),
                                       shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op11_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark, table(spark, sf_dir, "documents"))


def op12_orchard_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.clustered(spark, table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256,
                             width=64, salt="2")


def op13_sharded_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(spark, table(spark, sf_dir, "embeddings"), k=20, every=20)


QUERIES = {f.__name__: f for f in (
    op1_template_removal, op2_information_theoretic_pii,
    op3_prefix_free_parsing, op4_boosted_quality, op5_no_random_access_topk, op6_curriculum_mix,
    op7_hypergeometric_shuffle, op8_risk_controlled_rules, op9_cost_balanced_packing,
    op10_covering_simhash, op11_shared_cut_alignment, op12_orchard_clustering, op13_sharded_hnsw)}
