"""The operators of this package as queries over whole tables: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import alignment, langid, lm, minhash, mixing, piece_codec, quality, sharding, tiling, token_ids, topk, toxicity, vector_codes
from llm.common import table
from monthline.session import scratch_path


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_files(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "token-ids")
    token_ids.write(table(spark, sf_dir, "documents"), target)
    return token_ids.read(spark, target)


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op7_bound_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_clause_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"))


def op12_equal_average_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.statistics(table(spark, sf_dir, "documents"))


SPARK = {
    query.__name__: query
    for query in (
        op1_source_mix,
        op2_compression_language,
        op3_rule_quality,
        op4_sharding,
        op5_token_files,
        op6_context_mixing,
        op7_bound_topk,
        op8_string_tiling,
        op9_clause_toxicity,
        op10_minhash_dedup,
        op11_piece_codec,
        op12_equal_average_codes,
        op13_merge_path_alignment,
    )
}

SQL = {"op1_source_mix": mixing.SQL, "op7_bound_topk": topk.SQL, "op12_equal_average_codes": vector_codes.SQL}
