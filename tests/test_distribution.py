"""Quantile sketches: their error, merging, and drift that the mean does not show."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from monthline import schemas
from monthline.functions import fixed
from monthline.operators.distribution import beyond_chance, distance, distribution_step, merge_sketches, sketches

BY = ["brand", "state"]


def frame(spark, series):
    rows = [(b, s, float(y) if y is not None else None) for (b, s), values in series.items() for y in values]
    return spark.createDataFrame(rows, "brand string, state string, y double")


def nothing(spark):
    return spark.createDataFrame([], schemas.SERIES_DISTRIBUTION)


@pytest.mark.parametrize("parts", [1, 7])
def test_error_of_the_ranks(spark, parts):
    rng = random.Random(1)
    values = [rng.lognormvariate(0, 2) for _ in range(60_000)]
    df = spark.createDataFrame([(v, k % parts) for k, v in enumerate(values)], "y double, part int").repartition(4)
    whole = merge_sketches(sketches(df, ["part"]))
    points = [sorted(values)[int(len(values) * p)] for p in (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99)]
    row = whole.select("n", F.kll_sketch_get_rank_double("sketch", F.array(*map(F.lit, points))).alias("ranks"), F.length("sketch").alias("size")).first()
    exact = [sum(v <= x for v in values) / len(values) for x in points]
    assert row.n == 60_000 and row.size < 10_000
    assert max(abs(a - b) for a, b in zip(row.ranks, exact, strict=True)) <= 2 * fixed.SKETCH_RANK_ERROR


def test_a_wider_spread_with_the_same_mean_is_flagged(spark):
    rng = random.Random(2)
    narrow = {("B", "S"): [100 + rng.gauss(0, 1) for _ in range(400)], (None, "S"): [100 + rng.gauss(0, 1) for _ in range(400)], ("C", None): range(50)}
    wide = {("B", "S"): [100 + 20 * (y - 100) for y in narrow["B", "S"]], (None, "S"): [100 + rng.gauss(0, 1) for _ in range(400)], ("N", "N"): [1, 2]}
    first = distribution_step(frame(spark, narrow), nothing(spark), BY)
    assert {r.drift_status for r in first.collect()} == {"BASELINE"}
    found = {(r.brand, r.state): r for r in distribution_step(frame(spark, wide), first, BY).collect()}
    assert found["B", "S"].drift_status == "CRITICAL" and found["B", "S"].distance > 0.3
    assert found[None, "S"].drift_status == "NORMAL"
    assert found["N", "N"].drift_status == "BASELINE" and ("C", None) not in found


def test_few_rows_are_no_drift(spark):
    first = distribution_step(frame(spark, {("B", "S"): [1, 2, 3]}), nothing(spark), BY)
    assert distribution_step(frame(spark, {("B", "S"): [4, 5, 6]}), first, BY).first().drift_status == "NORMAL"


def test_values_that_are_no_numbers_do_not_count(spark):
    df = frame(spark, {("B", "S"): [1, None, float("nan"), 3], ("E", "S"): [None]})
    assert [(r.brand, r.n) for r in sketches(df, BY).collect()] == [("B", 2)]
    assert sketches(df.filter("false")).collect() == []


def test_distance_of_short_series_is_exact(spark):
    rng = random.Random(3)
    for _ in range(3):
        a, b = ([rng.randrange(30) for _ in range(rng.randrange(1, 120))] for _ in range(2))
        one, other = (sketches(frame(spark, {("B", "S"): v})).select(F.col("sketch").alias(n), F.col("n").alias("n_" + n)) for v, n in ((a, "a"), (b, "b")))
        row = one.join(other).select(distance(F.col("a"), F.col("b")).alias("d"), beyond_chance(F.lit(0.0), F.col("n_a"), F.col("n_b")).alias("c")).first()
        qa, qb = ([sorted(v)[max(0, -(-k * len(v) // 64) - 1)] for k in range(65)] for v in (a, b))
        expected = max(abs(sum(y <= x for y in qa) - sum(y <= x for y in qb)) for x in qa + qb) / 65
        assert abs(row.d - expected) < 1e-9 and row.c == 0
