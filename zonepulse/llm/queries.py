"""The numbered operators on the given tables, each with its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm import bpe_transducer, language_id, line_dedup, merkle_manifest, near_duplicates, nearest, ngram_join, orc_tokens, packing, quality_model, quality_rules, token_alignment, warc_fixity
from zonepulse.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, by thresholds drawn from the corpus itself."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of every document, and the checksum of the text that stays."""
    done = line_dedup.deduplicate(table(spark, sf_dir, "documents"), line_dedup.WHOLE)
    return done.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that differ between the pages' WARC files and a damaged replica of them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    good, bad = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    warc_fixity.write(pages, good)
    warc_fixity.write(warc_fixity.damaged(pages), bad)
    return warc_fixity.compare(spark, good, bad).select("record_id", "status", "length_a", "length_b", "hash_a", "hash_b")


def op6_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents through ORC files."""
    path = scratch_path(spark, "orc-tokens")
    orc_tokens.write(table(spark, sf_dir, "documents"), path)
    return orc_tokens.digests(spark, path)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over links of near-equal shingle sets."""
    return near_duplicates.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return nearest.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the labels that are not held out."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text through the transducer and back."""
    return bpe_transducer.round_trip(table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over links of a Jaccard similarity of 0.8."""
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups of every whole text under two tokenizers, and how usual their links are in the corpus."""
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), digest=True)
    return token_alignment.corpus_links(aligned).withColumnRenamed("groups", "groups_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verdict of every document under one root."""
    return merkle_manifest.proofs(merkle_manifest.manifest(table(spark, sf_dir, "documents")))


LLM_QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_quality_model": op3_quality_model,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc_fixity": op5_warc_fixity,
    "op6_orc_tokens": op6_orc_tokens,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_nearest": op8_nearest,
    "op9_language_id": op9_language_id,
    "op10_bpe_transducer": op10_bpe_transducer,
    "op11_ngram_join": op11_ngram_join,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
LLM_SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle_sql(),
    "op4_line_dedup": line_dedup.oracle_sql(line_dedup.WHOLE),
    "op5_warc_fixity": warc_fixity.oracle_sql(),
    "op11_ngram_join": ngram_join.oracle_sql(),
    "op13_merkle_manifest": merkle_manifest.oracle_sql(),
}
