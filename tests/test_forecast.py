"""Forecast operators on series with a known form."""

from __future__ import annotations

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL, ordered, rows_of
from monthline.operators import forecast as fc
from monthline.operators.piecewise import fit_piecewise
from monthline.parity import inputs as src

FACTORS = [0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.2, 1.1, 1.0, 0.9, 0.8]


def month(i):
    return date(2015 + i // 12, 1 + i % 12, 1)


def series(spark, key, values, skip=()):
    rows = [(key, month(i), float(v)) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(rows, "k string, ds date, y double")


@pytest.mark.parametrize(("n", "train"), [(1, 0), (2, 1), (4, 3), (5, 4), (10, 8), (14, 11)])
def test_split_sizes(spark, n, train):
    split = fc.time_split(series(spark, "a", range(n)), ["k"])
    assert split.filter("is_train").count() == train
    assert all(is_train == (rn <= train) for rn, is_train in rows_of(split, "rn", "is_train"))


def test_trend_of_a_line_and_of_a_single_month(spark):
    df = series(spark, "line", [100 + 5 * i for i in range(24)]).union(series(spark, "one", [7])).union(
        series(spark, None, [1, 2, 3])
    )
    got = {r.k: (r.n_train, round(r.slope, 9)) for r in fc.fit_trend(df, ["k"]).collect()}
    assert got == {"line": (24, 5.0), "one": (1, 0.0), None: (3, 1.0)}
    only = fc.fit_trend(df, ["k"]).filter("k = 'one'").first()
    assert only.intercept == 7.0


def test_season_has_mean_one(spark):
    flat = series(spark, "a", [100 * FACTORS[i % 12] for i in range(60)])
    season = fc.fit_month_seasonality(flat, ["k"])
    assert season.count() == 12
    assert abs(season.agg(F.avg("month_factor")).first()[0] - 1) < 1e-9


def test_forecast_follows_line_and_unseen_months_count_as_one(spark):
    line = series(spark, "a", [100 + 5 * i for i in range(6)])
    models = fc.fit_trend_seasonal(line, ["k"])
    frame = fc.future_frame(line, ["k"], 3)
    got = rows_of(fc.forecast(frame, *models, ["k"]).orderBy("ds"), "ds", F.round("yhat", 6))
    assert got == [(month(6), 130.0), (month(7), 135.0), (month(8), 140.0)]


def test_future_frame_per_series(spark):
    df = series(spark, "a", range(3)).withColumn("n", F.lit(2)).union(
        series(spark, "b", range(13)).withColumn("n", F.lit(0))
    )
    assert ordered(fc.future_frame(df, ["k"], "n")) == [("a", month(3)), ("a", month(4))]


def test_backtest_by_hand(spark):
    """Eight months on a line, then a hold-out that lies 10 above it."""
    values = [10.0 * i for i in range(8)] + [90.0, 100.0]
    row = fc.backtest(series(spark, "a", values), ["k"], min_rows=8).first()
    assert (row.n_train, row.n, row.zero_actuals) == (8, 2, 0)
    assert row.mae == pytest.approx(10.0)
    assert row.rmse == pytest.approx(10.0)
    assert row.mape == pytest.approx((10 / 90 + 10 / 100) / 2 * 100)


def test_zero_actuals_are_counted_and_left_out(spark):
    df = spark.createDataFrame([("a", 0.0, 5.0), ("a", 10.0, 5.0)], "k string, y double, yhat double")
    row = fc.error_metrics(df, ["k"]).first()
    assert (row.mae, row.mape, row.zero_actuals, row.n) == (5.0, 50.0, 1, 2)


def test_alignment_differs_only_with_gaps(spark):
    values = [100 + 5 * i for i in range(20)]
    whole = series(spark, "a", values)
    by_date, by_place = (fc.score_holdout(whole, ["k"], align, 8) for align in ("date", "position"))
    columns = ("k", "ds", F.round("yhat", 6))
    assert ordered(by_date, *columns) == ordered(by_place, *columns)

    gap = series(spark, "a", values, skip={17})
    dated = rows_of(fc.score_holdout(gap, ["k"], "date", 8).orderBy("ds"), "ds", F.round("yhat", 6))
    placed = rows_of(
        fc.score_holdout(gap, ["k"], "position", 8).orderBy("ds"), "ds", "forecast_ds", F.round("yhat", 6)
    )
    assert dated[-1] == (month(19), 195.0)
    assert placed[-1] == (month(19), month(18), 190.0)


def test_null_keys_are_scored_and_undated_rows_are_not(spark):
    df = series(spark, None, range(1, 21)).union(
        spark.createDataFrame([(None, None, 5.0)], "k string, ds date, y double")
    )
    row = fc.backtest(df, ["k"]).first()
    assert (row.k, row.n_train, row.n) == (None, 16, 4)


def test_short_series_are_refused(spark):
    """The floor counts the whole series, as the guard does."""
    df = series(spark, "short", range(9)).union(series(spark, "ten", range(1, 11))).union(series(spark, "long", range(1, 21)))
    assert ordered(fc.backtest(df, ["k"]), "k", "n_train", "n") == [("long", 16, 4), ("ten", 8, 2)]
    assert ordered(fc.enough_history(df, ["k"])) == [("long", 20), ("ten", 10)]


def test_global_series_drops_undated_rows(spark):
    df = series(spark, "a", [1, 2]).union(series(spark, "b", [10, 20])).union(
        spark.createDataFrame([("a", None, 99.0)], "k string, ds date, y double")
    )
    assert rows_of(fc.global_series(df).orderBy("ds")) == [(month(0), 11.0), (month(1), 22.0)]


def test_the_series_is_read_once(spark, folder):
    """Trend, season and hold-out share one shuffle of the series."""
    series(spark, "a", range(1, 41)).write.parquet(folder("s"))
    scored = fc.score_holdout(spark.read.parquet(folder("s")), ["k"])
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_piecewise_follows_a_seasonal_line(spark):
    values = [(1000 + 10 * i) * FACTORS[i % 12] for i in range(72)]
    fitted = fit_piecewise(series(spark, "a", values).union(series(spark, "short", range(5))), ["k"])
    assert {r.k for r in fitted.select("k").distinct().collect()} == {"a"}
    assert fitted.count() == 72
    error = fc.error_metrics(fitted.filter("not is_train"), ["k"]).first()
    assert error.mape < 3.0


def test_prediction_rows(spark, now):
    scored = spark.createDataFrame([("B", month(0), 10.0, 8.0)], "brand string, ds date, y double, yhat double")
    assert rows_of(fc.prediction_rows(scored, "v1", now)) == [("v1", now, "B", None, "2015-01", 8.0, 10.0, 2.0)]


def dense_piecewise(rows, n_train, knots=25, waves=6, ridge=1.0):
    """The same penalized loss, written out term by term and solved as one long least-squares system per turn."""
    months = [(d.year - 2000) * 12 + d.month for d, _ in rows]
    y = np.array([v for _, v in rows])
    t = [(m - months[0]) / max(months[n_train - 1] - months[0], 1) for m in months]
    count = min(knots, max(int(n_train * 0.8) - 1, 0))
    at = [0.8 * k / count for k in range(1, count + 1)]
    line = np.array([[1.0, x] + [max(x - a, 0.0) for a in at] for x in t])
    wave = np.array([[f(2 * math.pi * k * m / 12) for f in (math.sin, math.cos) for k in range(1, waves + 1)] for m in months])
    scale = abs(y[:n_train]).max()
    target, season = y[:n_train] / scale, np.zeros(len(t))
    hold_line = np.sqrt([1e-9, 1e-9] + [ridge] * count)
    hold_wave = np.sqrt([ridge / 100] * (2 * waves))

    def solved(design, goal, hold):
        return np.linalg.lstsq(np.vstack([design, np.diag(hold)]), np.concatenate([goal, np.zeros(len(hold))]), rcond=None)[0]

    loss = math.inf
    while True:
        a = solved(line[:n_train] * (1 + season[:n_train, None]), target, hold_line)
        trend = line @ a
        b = solved(wave[:n_train] * trend[:n_train, None], target - trend[:n_train], hold_wave)
        season = wave @ b
        gap = target - trend[:n_train] * (1 + season[:n_train])
        before, loss = loss, (gap**2).sum() + ((hold_line * a) ** 2).sum() + ((hold_wave * b) ** 2).sum()
        if before - loss <= 1e-7 * (target**2).sum():
            return trend * (1 + season) * scale


def test_piecewise_values_equal_a_dense_solver(spark):
    months = src.month_series(spark, SMALL)
    chosen = [tuple(r) for r in months.groupBy("brand", "state").count().orderBy(F.desc("count"), "brand", "state").limit(6).select("brand", "state").collect()]
    wanted = spark.createDataFrame(chosen, "brand string, state string")
    found = {}
    for r in fit_piecewise(months.join(wanted, ["brand", "state"]), ["brand", "state"]).collect():
        found.setdefault((r.brand, r.state), []).append((r.ds, r.y, r.is_train, r.yhat))
    assert len(found) == 6
    for rows in found.values():
        rows.sort()
        expected = dense_piecewise([(d, y) for d, y, _, _ in rows], sum(is_train for _, _, is_train, _ in rows))
        size = max(abs(y) for _, y, _, _ in rows)
        assert max(abs(r[3] - e) for r, e in zip(rows, expected, strict=True)) < 1e-4 * size
