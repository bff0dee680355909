"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized
table; the shards take turns, each claiming the first slot of its order that is
still free. A document is placed by one hash and one look at the table. Taking a
shard away moves its own documents and few others.

Defined results: rows with equal keys, and so all copies of a document, go to
one shard; null keys share one slot; null and long texts, extra columns and
empty tables make no difference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from llm.common import fresh

SHARDS = 64
SLOTS = 65_537
#: A table of at most so many slots (under 20 MB) is broadcast; a larger one is joined as Spark decides.
BROADCAST_SLOTS = 1 << 20


def _number(label: str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{label}:{text}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The index of the owning shard for each slot. Its size is a parameter, not the data's."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be named apart and not outnumber the slots")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime, so that every step visits every slot")
    at = [_number("offset", s) % slots for s in shards]
    step = [_number("skip", s) % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    free = slots
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                return owner


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("null"))), F.lit(slots)).cast("int")


def place(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """The documents with the columns ``slot`` and ``shard`` (renamed where the documents have such columns)."""
    spark: SparkSession = docs.sparkSession
    names = list(shards or shard_names())
    slot, shard, same = fresh(docs, "slot", "shard", "table_slot")
    owner = spark.createDataFrame(list(enumerate(lookup_table(names, slots))), "i int, s int").select(
        F.col("i").alias(same), F.col("s").alias(shard)
    )
    if slots <= BROADCAST_SLOTS:
        owner = F.broadcast(owner)
    return docs.withColumn(slot, slot_of(F.col(key), slots)).join(owner, F.col(slot) == F.col(same)).drop(same)


def write_shards(placed: DataFrame, path: str, parts: int = 8, slot: str = "slot", shard: str = "shard") -> None:
    """One folder per shard; a shard is written by ``parts`` tasks, so none of them holds a whole shard."""
    tasks = placed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = F.pmod(F.xxhash64(*[c for c, kind in placed.dtypes if "map<" not in kind and "variant" not in kind]), F.lit(parts))
    placed.repartition(int(tasks), F.col(shard), spread).write.partitionBy(shard).parquet(path)


def shard_files(docs: DataFrame, path: str, shards: Sequence[str] | None = None) -> DataFrame:
    """Write (doc_id, text) into shards and tell what the files hold: (doc_id, slot, shard, n_bytes, text_crc32)."""
    spark = docs.sparkSession
    write_shards(place(docs.select("doc_id", "text"), shards=shards), path)
    text = F.col("text").cast("binary")
    schema = T.StructType([docs.schema["doc_id"], docs.schema["text"], T.StructField("slot", T.IntegerType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path).select("doc_id", "slot", "shard", F.octet_length(text).cast("long").alias("n_bytes"), F.crc32(text).alias("text_crc32"))
