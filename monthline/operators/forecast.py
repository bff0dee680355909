"""Trend and month-level seasonality for many series at once, with hold-out metrics.

The input of every operator here is a monthly series: at most one row per key
and month start, so a key holds as many rows as it has months. NULL keys are
series like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthline.functions import dates, fixed

# Months are counted from January of this year; any origin gives the same forecasts.
TREND_ORIGIN_YEAR = 2000


def trend_month(day: Column) -> Column:
    return dates.month_index(day) - F.lit(TREND_ORIGIN_YEAR * 12)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the key columns of the left side stay."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


def global_series(features: DataFrame) -> DataFrame:
    """One series: the sum over all keys per date. Undated rows have no place in it."""
    return features.filter(F.col("ds").isNotNull()).groupBy("ds").agg(F.sum("y").alias("y"))


def time_split(
    df: DataFrame,
    keys: Sequence[str],
    num: int = fixed.TRAIN_SHARE[0],
    den: int = fixed.TRAIN_SHARE[1],
) -> DataFrame:
    """Number each series by date and mark its first num/den rows: rn, n, n_train, is_train."""
    whole = Window.partitionBy(*keys)
    return df.withColumns(
        {
            "rn": F.row_number().over(whole.orderBy(F.col("ds").asc_nulls_last())),
            "n": F.count(F.lit(1)).over(whole),
        }
    ).withColumns(
        {
            "n_train": F.expr(f"n * {num} div {den}"),
            "is_train": F.expr(f"rn <= n * {num} div {den}"),
        }
    )


def enough_history(df: DataFrame, keys: Sequence[str], min_rows: int = fixed.MIN_TRAINING_ROWS) -> DataFrame:
    """(keys, n) of the series that are long enough to train on."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)


def _trend_parts() -> dict[str, Column]:
    t, y = trend_month(F.col("ds")), F.col("y")
    return {
        "n_train": F.count(F.lit(1)),
        "_slope": F.regr_slope(y, t),
        "_intercept": F.regr_intercept(y, t),
        "_level": F.avg(y),
        "_first": F.min(t),
        "_last": F.max(t),
    }


def _trend_columns() -> dict[str, Column]:
    """A single month has no slope: level only."""
    several = F.col("_first") < F.col("_last")
    return {
        "slope": F.when(several, F.col("_slope")).otherwise(F.lit(0.0)),
        "intercept": F.when(several, F.col("_intercept")).otherwise(F.col("_level")),
    }


def _trend_value() -> Column:
    return F.col("intercept") + F.col("slope") * trend_month(F.col("ds"))


def long_enough(split: DataFrame, min_rows: int = fixed.MIN_TRAINING_ROWS) -> DataFrame:
    """The rows of ``time_split`` whose whole series has at least ``min_rows`` rows."""
    return split.filter(F.col("n") >= min_rows)


def fit_trend(train: DataFrame, keys: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Linear trend per key: n_train, slope, intercept, and ``extra`` aggregates of the train rows."""
    extra = extra or {}
    parts = [column.alias(name) for name, column in (_trend_parts() | extra).items()]
    return (
        train.groupBy(*keys)
        .agg(*parts)
        .withColumns(_trend_columns())
        .select(*keys, "n_train", "slope", "intercept", *extra)
    )


def fit_month_seasonality(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean ratio to the trend per key and calendar month, scaled to mean 1 per key.

    The trend is taken over a window of the same keys, so the rows are shuffled
    once for trend, month means and scaling.
    """
    series = Window.partitionBy(*keys)
    detrended = (
        train.withColumns({name: column.over(series) for name, column in _trend_parts().items()})
        .withColumns(_trend_columns())
        .select(
            *keys,
            F.month("ds").alias("month"),
            F.try_divide(F.col("y"), _trend_value()).alias("ratio"),
        )
    )
    monthly = detrended.groupBy(*keys, "month").agg(F.avg("ratio").alias("ratio"))
    return monthly.select(
        *keys, "month", F.try_divide(F.col("ratio"), F.avg("ratio").over(series)).alias("month_factor")
    )


def fit_trend_seasonal(train: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(trend per key, factor per key and month)."""
    return fit_trend(train, keys), fit_month_seasonality(train, keys)


def future_frame(df: DataFrame, keys: Sequence[str], periods: int | str) -> DataFrame:
    """(keys, ds) for the months after each series' last one.

    ``periods`` is a number, or the name of a column holding it per series.
    """
    count = F.lit(periods) if isinstance(periods, int) else F.max(periods)
    ends = df.groupBy(*keys).agg(F.max("ds").alias("_last"), count.cast("int").alias("_periods"))
    return ends.select(*keys, F.explode(dates.months_after(F.col("_last"), F.col("_periods"))).alias("ds"))


def forecast(
    frame: DataFrame, trend: DataFrame, season: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``frame`` plus ``yhat`` = trend x month factor; months never seen count as 1.

    The at most 12 factors of a key travel as one map, so frame and model meet in
    a single join on the keys.
    """
    model = _with_factors(trend, season, keys).select(*keys, "slope", "intercept", "_factors")
    return join_on_keys(frame, model, keys).withColumn("yhat", _seasonal_value()).drop("slope", "intercept", "_factors")


def _with_factors(trend: DataFrame, season: DataFrame, keys: Sequence[str]) -> DataFrame:
    factors = season.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("month", "month_factor"))).alias("_factors")
    )
    return join_on_keys(trend, factors, keys, "left")


def _seasonal_value() -> Column:
    return _trend_value() * F.coalesce(F.try_element_at("_factors", F.month("ds")), F.lit(1.0))


def forecast_ahead(train: DataFrame, keys: Sequence[str], periods: int | Column) -> DataFrame:
    """(keys, ds, yhat) for the months after each series' last train month.

    The trend brings the last month and the number of periods along, so the
    months come from the model rows and the series is read once. ``periods`` is a
    number or a column of the train rows, the same all over a series.
    """
    count = F.lit(periods) if isinstance(periods, int) else periods
    trend = fit_trend(train, keys, {"_end": F.max("ds"), "_periods": F.max(count).cast("int")})
    model = _with_factors(trend, fit_month_seasonality(train, keys), keys)
    months = model.select(
        *keys, "slope", "intercept", "_factors", F.explode(dates.months_after(F.col("_end"), F.col("_periods"))).alias("ds")
    )
    return months.select(*keys, "ds", _seasonal_value().alias("yhat"))


def align_forecast(
    pred: DataFrame, actual: DataFrame, keys: Sequence[str], align: str = "date"
) -> DataFrame:
    """Pair forecasts with actuals by date, or by position within each series."""
    if align == "date":
        return join_on_keys(actual, pred.select(*keys, "ds", "yhat"), [*keys, "ds"])
    if align != "position":
        raise ValueError(f"align must be 'date' or 'position', not {align!r}")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("ds").asc_nulls_last()))
    return join_on_keys(
        actual.withColumn("_place", place),
        pred.select(*keys, F.col("ds").alias("forecast_ds"), "yhat", place.alias("_place")),
        [*keys, "_place"],
    ).drop("_place")


def error_metrics(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAE, RMSE and MAPE (percent) per key; zero actuals are left out of MAPE and counted."""
    gap = F.col("y") - F.col("yhat")
    return scored.groupBy(*keys).agg(
        F.avg(F.abs(gap)).alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(gap, F.col("y")))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("y") == 0).alias("zero_actuals"),
    )


def score_holdout(
    df: DataFrame,
    keys: Sequence[str],
    align: str = "date",
    min_rows: int = fixed.MIN_TRAINING_ROWS,
) -> DataFrame:
    """Fit on the first part of each series and forecast the rest: (keys, n_train, ds, y, yhat).

    With ``align="date"`` every held-out month is forecast for its own date; with
    ``"position"`` the months following the train part are used in turn. At least
    one key column is needed: a single series carries its model name. ``min_rows``
    counts all rows of a series, its held-out ones too.
    """
    split = time_split(df.select(*keys, "ds", "y").filter(F.col("ds").isNotNull()), keys)
    split = long_enough(split, min_rows)
    train = split.filter("is_train")
    test = split.filter(~F.col("is_train")).select(*keys, "n_train", "ds", "y")
    if align == "date":
        return forecast(test, *fit_trend_seasonal(train, keys), keys)
    return align_forecast(forecast_ahead(train, keys, F.col("n") - F.col("n_train")), test, keys, align)


def backtest(
    df: DataFrame,
    keys: Sequence[str],
    align: str = "date",
    min_rows: int = fixed.MIN_TRAINING_ROWS,
) -> DataFrame:
    """Hold-out metrics per key: n_train, mae, rmse, mape, n, zero_actuals."""
    return error_metrics(score_holdout(df, keys, align, min_rows), [*keys, "n_train"])


def prediction_rows(scored: DataFrame, version: str, now: datetime | None = None) -> DataFrame:
    """Scored months in the layout of the prediction log; absent keys are NULL."""
    present = set(scored.columns)
    keys = [
        F.col(name) if name in present else F.lit(None).cast("string").alias(name)
        for name in ("brand", "state")
    ]
    return scored.select(
        F.lit(version).alias("model_version"),
        dates.moment(now).alias("prediction_time"),
        *keys,
        F.date_format("ds", "yyyy-MM").alias("period"),
        F.col("yhat").alias("predicted_value"),
        F.col("y").alias("actual_value"),
        (F.col("y") - F.col("yhat")).alias("error"),
    )
