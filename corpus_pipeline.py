"""From raw documents to mixed training shards: each stage works on all that the one before kept.

Stages are written as Parquet and read again in between, so a lost executor
costs no more than a part of one stage. All but the last return the columns of
the documents as they are.

Defined results: documents without text pass the first three stages; documents without a
key are near copies of nothing; of rows that repeat a key and a text one stays;
documents without words are taken as often as others of their source; columns that the
stages do not know stay; no documents give no shards.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm import minhash, mixing, sharding, tiling, toxicity  # noqa: E402
from llm.common import stored, table  # noqa: E402


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores as toxic go."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return minhash.deduplicate(docs, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold the greater part of a benchmark item go."""
    return tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy with its shard."""
    return sharding.place(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixture", mixture),
    ("shards", shards),
]

#: No SQL: clause grammars, MinHash components, greedy tiling and turn-taking tables have no counterpart there.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
