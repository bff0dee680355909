"""Tables that hold what real ones hold as well: nulls, empty and very long texts, repeats, strange columns."""

from __future__ import annotations

import random
import string

from pyspark.sql import functions as F

LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
SMALL = "/root/testdata/sf0.001"
#: Names that operators use for columns of their own.
EXTRA = ["size", "copies", "target", "slot", "SHARD", "score", "kept", "component_id", "gone", "turn", "salt", "label", "held_out", "rate", "task"]


def awkward(spark, copies: int = 1):
    rows = [
        (None, "a text without a key that is long enough", "en", "s1"),
        (1, None, None, None),
        (2, "", "en", "s1"),
        (3, " \t\n", "en", "s2"),
        (4, "one", "de", None),
        (5, "Ünï çödé — “quotes” 日本語 \x1c odd blank <|endoftext|> end", "fr", "s2"),
        (6, "the same text stands here twice or more often", "en", "s1"),
        (7, "The same text stands here twice or more often", "en", "s1"),
        (7, "The same text stands here twice or more often", "en", "s1"),
        (8, LONG, "en", "s3"),
        (-9, "12345 67890 !!!", "", "s3"),
    ]
    df = spark.createDataFrame(rows * copies, "doc_id long, text string, lang string, source string")
    df = df.withColumns({name: F.lit(f"own {name}") for name in EXTRA})
    return df.withColumn("n_chars", F.length("text")).withColumn("nested", F.array(F.struct(F.lit(1).alias("x"))))


def empty(spark):
    return awkward(spark).where("false")


def labels(spark):
    rows = [(1, 1, 0), (2, None, None), (4, 1, 1), (4, 0, 0), (6, 0, 1), (7, 1, 0), (None, 1, 1), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    words = ["".join(random.Random(k).choices(string.ascii_lowercase, k=3 + k % 6)) for k in (rng.randrange(vocabulary) for _ in range(n))]
    return " ".join(words)
