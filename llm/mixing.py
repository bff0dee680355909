"""Mixing sources to target weights, with DataFrame functions only.

Tokens are added up per source, the budget is shared by weight, and each
document is emitted ``floor(rate)`` times plus one copy drawn by a hash with the
fraction as its probability. ``rate`` is its source's target over its size.

Shares are settled over one row per source in one task: the weights are given by
hand in the order of the sources, which so are thousands, not as many as documents.

Defined results: a null or empty text has size 0 and is taken 0 words; null
sources form one source, last in order; rows with equal keys share one draw; a
null key draws like the text ``null``; an empty table gives an empty table;
columns of the documents are kept whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.common import WORD, fresh, stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2.0
SEED = "mix-1"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP
) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size).

    Partial sums leave one row per source and task, so a source with a third of
    all rows is no hot spot. The windows run over one row per source.

    ``target = least(cap * size, level * weight)``: with the sources ordered by the
    level at which they reach their cap, the level is that of the first source
    that stays below its own when all before it are capped.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")
    )
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(budget) * F.sum("source_size").over(whole) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(onward)
    return (
        per_source.withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("below", F.when(F.col("level") * F.col("weight") <= F.lit(cap) * F.col("source_size"), F.col("level")))
        .withColumn("final", F.first("below", ignorenulls=True).over(whole))
        .withColumn("target", F.least(F.lit(cap) * F.col("source_size"), F.col("final") * F.col("weight")))
        .select(
            "source",
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        )
    )


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw(key, seed) < rate - whole, 1).otherwise(0)).cast("int")


def with_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with size, source_size, target, rate and copies, and the names these columns got.

    The per-source table is written first, so Spark knows its size: a small one
    is broadcast and the texts are not shuffled, a large one is joined by shuffle.
    """
    names = dict(zip(("size", "copies", "source_size", "target", "rate", "same"), fresh(docs, "size", "copies", "source_size", "target", "rate", "same_source"), strict=True))
    sized = docs.withColumn(names["size"], word_count(text))
    targets = stored(source_targets(sized.select(F.col(source).alias("source"), F.col(names["size"]).alias("size"))), "mix-targets")
    right = targets.select(F.col("source").alias(names["same"]), *[F.col(c).alias(names[c]) for c in ("source_size", "target", "rate")])
    joined = sized.join(right, F.col(source).eqNullSafe(F.col(names["same"]))).drop(names["same"])
    return joined.withColumn(names["copies"], copies(F.col(names["rate"]), F.col(key), seed)), names


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with its own columns."""
    columns = docs.columns
    taken, names = with_copies(docs, key, text, source, seed)
    (turn,) = fresh(taken, "turn")
    return taken.withColumn(turn, F.explode(F.array_repeat(F.lit(1), F.col(names["copies"])))).select(*columns)


def report(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per document with its size, its source's size and target and the words the mix takes of it."""
    narrow = docs.select("doc_id", "source", "text")
    taken, _ = with_copies(narrow, seed=seed)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s
), l AS (
  SELECT *, row_number() OVER o AS place,
    (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)
), f AS (
  SELECT min_by(level, place) AS final FROM l WHERE level * weight <= 2.0::DOUBLE * source_size
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, final * weight) AS target FROM l, f
), r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM r
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM c
"""
