"""Cleaning, monthly totals, lags, row ids and incremental totals."""

from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from conftest import SMALL, ordered, rows_of
from monthline import schemas
from monthline.operators import features as fe
from monthline.operators.row_id import nulls_last, with_row_id
from monthline.operators.series import with_history, with_history_chunked
from monthline.parity import inputs as src


def raw(spark, rows):
    return spark.createDataFrame([(*r, "f.csv", None) for r in rows], schemas.RAW_SALES)


def agg(spark, rows):
    return spark.createDataFrame([(b, s, p, Decimal(t), 1) for b, s, p, t in rows], schemas.AGG_SALES)


def test_clean_normalises_and_drops(spark):
    rows = [
        (" b1 ", "prod", " ca ", "loc", "apr-23", "23-24", "1,000.50"),
        ("b1", "prod", "ca", "loc", None, "23-24", "1"),
        ("b1", "prod", "ca", "loc", "Apr-23", None, "1"),
        ("b1", "prod", "ca", "loc", "Apr-23", "23-24", "n/a"),
        ("b1", "prod", "ca", "loc", "Apr-23", "23-24", "nan"),
        (None, None, None, None, "2024/05", "23-24", "2"),
    ]
    got = ordered(fe.clean_sales(raw(spark, rows)), "brand", "product", "state", "month_num", "year", "net_sales", "period")
    assert got == [
        ("B1", "PROD", "CA", 4, 2023, Decimal("1000.50"), "2023-04"),
        (None, None, None, None, 20, Decimal("2.00"), None),
    ]


def test_clean_schema(spark):
    clean = fe.clean_sales(raw(spark, []))
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in schemas.CLEAN_SALES]


def test_nulls_form_groups(spark):
    rows = [(None, "p", "s", "l", "Apr-23", "23-24", "1"), (None, "p", "s", "l", "Apr-23", "23-24", "2")]
    got = rows_of(fe.agg_sales(fe.clean_sales(raw(spark, rows))))
    assert got == [(None, "S", "2023-04", Decimal("3.00"), 2)]


def test_lags_are_positional_and_exclude_the_current_row(spark):
    months = ["2023-01", "2023-02", "2023-04", "2023-05", "2024-01"]
    base = fe.feature_base(agg(spark, [("B", "S", m, str(10 ** i)) for i, m in enumerate(months)]))
    got = rows_of(
        fe.feature_history(base).orderBy("ds"), "period", "lag_1", "lag_2", "lag_3", "rolling_avg_3"
    )
    assert got == [
        ("2023-01", None, None, None, None),
        ("2023-02", 1.0, None, None, 1.0),
        ("2023-04", 10.0, 1.0, None, 5.5),
        ("2023-05", 100.0, 10.0, 1.0, 37.0),
        ("2024-01", 1000.0, 100.0, 10.0, 370.0),
    ]


def test_undated_rows_come_last_by_period(spark):
    rows = [("B", "S", p, y) for p, y in [("202023-05", "5"), ("2023-02", "2"), (None, "6"), ("202023-04", "4"), ("2023-01", "1")]]
    history = fe.feature_history(fe.feature_base(agg(spark, rows)))
    got = dict(rows_of(history, "period", "lag_1"))
    assert got == {"2023-01": None, "2023-02": 1.0, "202023-04": 2.0, "202023-05": 4.0, None: 5.0}


@pytest.mark.parametrize(("length", "kept"), [(1, 0), (3, 0), (4, 1), (5, 2)])
def test_three_earlier_months_are_needed(spark, length, kept):
    rows = [("B", "S", f"2023-{m:02d}", "1") for m in range(1, length + 1)]
    assert fe.feature_rows(agg(spark, rows)).count() == kept


def test_feature_store_layout_and_ids(spark, now):
    rows = [(b, "S", f"2023-{m:02d}", str(m)) for b in ("A", None, "B") for m in range(1, 6)]
    store = fe.feature_store(agg(spark, rows), now=now)
    assert [(f.name, f.dataType) for f in store.schema] == [(f.name, f.dataType) for f in schemas.FEATURE_STORE]
    got = rows_of(store.orderBy("feature_id"), "feature_id", "brand", "ds", "y", "quarter", "created_at")
    assert got == [
        (1, "A", date(2023, 4, 1), 4.0, 2, now),
        (2, "A", date(2023, 5, 1), 5.0, 2, now),
        (3, "B", date(2023, 4, 1), 4.0, 2, now),
        (4, "B", date(2023, 5, 1), 5.0, 2, now),
        (5, None, date(2023, 4, 1), 4.0, 2, now),
        (6, None, date(2023, 5, 1), 5.0, 2, now),
    ]


def test_empty_input(spark):
    assert fe.feature_store(agg(spark, [])).count() == 0


def _series(spark, seed, hot_share):
    """Random series in which one key holds a large share of the rows, with NULL keys and dates."""
    rng = random.Random(seed)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < hot_share else rng.choice(["a", "b", "c", None, f"k{i}"])
        ds = None if rng.random() < 0.2 else date(1950 + i % 90, 1 + i % 12, 1)
        rows.append((key, rng.choice(["x", None]), ds, f"p{i:05d}", rng.choice([None, float(i), -1.5])))
    return spark.createDataFrame(rows, "brand string, state string, ds date, period string, y double")


@pytest.mark.parametrize("chunk_rows", [4, 7, 100, 10_000])
def test_chunked_history_equals_the_window(spark, chunk_rows):
    df = _series(spark, chunk_rows, 0.4)
    keys, order = ["brand", "state"], ["ds", "period"]
    plain = with_history(df, keys, order, "y")
    chunked = with_history_chunked(df, keys, order, "y", chunk_rows=chunk_rows)
    columns = [*plain.columns[:8], F.round("rolling_avg_3", 9)]
    assert ordered(plain, *columns) == ordered(chunked, *columns)


@pytest.mark.parametrize("partitions", [None, 1, 8, 23])
def test_row_id_equals_row_number(spark, partitions):
    df = _series(spark, 5, 0.5).repartition(5)
    order = ["brand", "state", "ds", "period"]
    ours = with_row_id(df, order, "id", partitions).select("id", *order)
    expected = df.select(F.row_number().over(Window.orderBy(*nulls_last(order))).cast("long").alias("id"), *order)
    assert ordered(ours) == ordered(expected)


def test_row_id_with_equal_keys_is_dense(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"))
    got = rows_of(with_row_id(df, ["k"], "n", 8).orderBy("n"), "n", "k")
    assert [n for n, _ in got] == list(range(1, 1001))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_copies_of_one_row_are_spread(spark):
    df = spark.range(0, 8000, 1, 8).select(F.lit("hot").alias("k"))
    numbered = with_row_id(df, ["k"], "n", 8)
    sizes = [c for _, c in rows_of(numbered.groupBy(F.spark_partition_id().alias("p")).count())]
    assert sum(sizes) == 8000 and max(sizes) <= 4000
    assert numbered.agg(F.countDistinct("n"), F.max("n")).first()[:] == (8000, 8000)


def test_one_hot_value_is_spread(spark):
    df = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"), "id")
    sizes = [c for _, c in rows_of(with_row_id(df, ["k"], "n", 8).groupBy(F.spark_partition_id().alias("p")).count())]
    assert len(sizes) == 8 and max(sizes) < 2000


def test_row_id_of_nothing(spark):
    assert with_row_id(spark.range(0), ["id"], "n").count() == 0


def test_row_id_sorts_data_in_many_partitions(spark):
    """Only one count per partition may meet in a single task, never the rows."""
    plan = with_row_id(spark.range(1000), ["id"], "n", 8)._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("SinglePartition"):]
    assert "_rows" in single or "_bucket" in single
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_totals_do_not_depend_on_how_the_input_is_split(spark, seed):
    clean = fe.clean_sales(src.raw_sales(spark, SMALL)).withColumn("lot", F.floor(F.rand(seed) * 3))
    clean = clean.checkpoint()
    whole = ordered(fe.agg_sales(clean.drop("lot")))
    merged = fe.agg_sales(clean.filter("lot = 0").drop("lot"))
    for lot in (1, 2):
        merged = fe.merge_agg(merged, clean.filter(f"lot = {lot}").drop("lot"))
    assert ordered(merged) == whole
    assert merged.schema["total_sales"].dataType == schemas.AGG_SALES["total_sales"].dataType


def test_series_lengths_and_preview(spark):
    rows = [(b, "S", f"2023-{m:02d}", "1") for b, n in (("A", 5), ("B", 7)) for m in range(1, n + 1)]
    features = fe.feature_rows(agg(spark, rows))
    assert rows_of(fe.series_lengths(features)) == [("B", "S", 4), ("A", "S", 2)]
    assert rows_of(fe.feature_preview(features, 3), "brand", "ds") == [
        ("A", date(2023, 4, 1)),
        ("B", date(2023, 4, 1)),
        ("A", date(2023, 5, 1)),
    ]
