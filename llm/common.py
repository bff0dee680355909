"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthline.session import scratch_path

#: Words are runs of bytes other than blank and 0x09 to 0x0D, in Spark's and DuckDB's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text modulo n; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string")) % n


def held_out(key: str, n: int, part: int) -> Column:
    """True where the remainder is ``part``; a NULL key is not held out, but not learned from either."""
    return F.coalesce(remainder(key, n) == part, F.lit(False))


def learned_from(key: str, n: int, part: int) -> Column:
    return F.coalesce(remainder(key, n) != part, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_{uuid.uuid4().hex[:6]}"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files.

    Cuts the lineage, survives lost executors, and gives Spark the true size, by
    which it chooses between broadcast and shuffle in later joins.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    name = "_llm_worker_memory"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__.setdefault("kept", {})


def clear_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label): one row per key whose labels are not null and agree."""
    known = labels.where("doc_id is not null and label is not null")
    return known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
