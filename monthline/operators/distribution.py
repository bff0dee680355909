"""Drift of a whole distribution: quantile sketches of now against those of the first check.

A sketch has a bounded size, however many rows it stands for, and sketches of parts
merge into the sketch of the whole, so tasks combine theirs before the shuffle. Two
distributions are compared by 65 quantiles of each: their distance is the largest
difference of the shares of both that lie below a value, so a spread that shifts while
the mean stays shows in it. What chance and the sketches' error explain is taken off
before it counts as drift.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from monthline.functions import fixed
from monthline.functions.dates import moment
from monthline.functions.labels import label_below
from monthline.operators.forecast import join_on_keys
from monthline.operators.latest import newest

#: Quantiles are taken at sixty-fourths, which binary fractions hold exactly.
PROBES = 64


def sketches(rows: DataFrame, by: Sequence[str] = (), value: str = "y") -> DataFrame:
    """(by, n, sketch) of the values that are numbers; no row for a key without any."""
    known = rows.filter(F.col(value).isNotNull() & ~F.isnan(value))
    sketch = F.kll_sketch_agg_double(value, F.lit(fixed.SKETCH_SIZE))
    return known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch")).filter("n > 0")


def merge_sketches(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the same keys over several parts as one."""
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(fixed.SKETCH_SIZE)).alias("sketch"))


def distance(one: Column, other: Column) -> Column:
    """Largest difference between the shares of two sketches' quantiles that are at most a value, between 0 and 1."""
    ranks = F.array(*[F.lit(k / PROBES) for k in range(PROBES + 1)])
    a, b = F.kll_sketch_get_quantile_double(one, ranks), F.kll_sketch_get_quantile_double(other, ranks)
    upto = lambda values, x: F.size(F.filter(values, lambda v: v <= x))
    return F.array_max(F.transform(F.concat(a, b), lambda x: F.abs(upto(a, x) - upto(b, x)))) / F.lit(PROBES + 1.0)


def beyond_chance(apart: Column, n: Column, m: Column) -> Column:
    """The part of a distance, in percent, that neither samples of these sizes nor the sketches' error explain."""
    chance = F.lit(fixed.CHANCE_FACTOR) * F.sqrt((n + m) / (n * m))
    error = F.lit(2 * fixed.SKETCH_RANK_ERROR + 1 / PROBES)
    return F.greatest(apart - chance - error, F.lit(0.0)) * 100


def distribution_step(rows: DataFrame, log: DataFrame, by: Sequence[str], now: datetime | None = None) -> DataFrame:
    """One check of every key against its first sketch; keys the log does not know get theirs now.

    (by, check_date, n, sketch, distance, drift_score, drift_status). A key that
    has no values any more yields nothing.
    """
    current = sketches(rows, by)
    first = (
        log.filter(F.col("drift_status") == fixed.DRIFT_BASELINE)
        .groupBy(*by)
        .agg(newest(F.struct(F.col("n").alias("m"), F.col("sketch").alias("base")), None, "check_date").alias("_first"))
    )
    paired = join_on_keys(current, first, by, "left") if by else current.withColumn("_first", first.scalar())
    known = F.col("_first").isNotNull()
    apart = F.when(known, distance(F.coalesce("_first.base", "sketch"), F.col("sketch"))).otherwise(F.lit(0.0))
    score = F.when(known, beyond_chance(F.col("distance"), F.col("n"), F.col("_first.m"))).otherwise(F.lit(0.0))
    labels = [(limit, name) for limit, name in fixed.DRIFT_LABELS]
    status = F.when(known, label_below(F.col("drift_score"), labels, fixed.DRIFT_WORST)).otherwise(F.lit(fixed.DRIFT_BASELINE))
    return (
        paired.withColumn("distance", apart)
        .withColumn("drift_score", score)
        .select(*by, moment(now).alias("check_date"), "n", "sketch", "distance", "drift_score", status.alias("drift_status"))
    )
