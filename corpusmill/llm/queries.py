"""Registered queries of this subpackage. Where DuckDB SQL can express the rows, ``oracle_sql`` has it; the tests compare all others with brute force."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import feistel_shards, length_packing, lexical_search, license_scan, lm_difference, merkle_manifest, multi_index, multiset_hash, repetition, simhash, suffix_dedup, toxicity, word_bpe
from .common import read_table

TOKENIZER = "word_bpe_49k.json"


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.window_digest(read_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.shard_documents(read_table(spark, sf_dir, "documents"))


def op9_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op10_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return lm_difference.score_documents(read_table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(read_table(spark, sf_dir, "documents")).drop("longest_repeat")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest_proofs(read_table(spark, sf_dir, "documents"))


def queries() -> dict:
    ops = (
        op1_multi_index, op2_simhash, op3_multiset_hash, op4_suffix_dedup, op5_license_scan, op6_word_bpe, op7_toxicity,
        op8_feistel_shards, op9_length_packing, op10_lm_difference, op11_lexical_search, op12_repetition, op13_merkle_manifest,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op11_lexical_search": lexical_search.ORACLE_SQL, "op12_repetition": repetition.ORACLE_SQL}
