"""Training, forecasting and hold-out metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline.operators.features import SERIES
from monthline.operators.forecast import (
    backtest,
    enough_history,
    fit_month_seasonality,
    fit_trend,
    forecast_ahead,
    future_frame,
    global_series,
    long_enough,
    prediction_rows,
    time_split,
    trend_month,
)
from monthline.operators.piecewise import fit_piecewise
from monthline.operators.registry import candidate_rows, model_name
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import NOW, NOW_SQL, sql_over


def rounded(df, *columns, digits=3):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def train_rows(spark, sf):
    return time_split(src.month_series(spark, sf), SERIES).filter("is_train")


def fit_rows(spark, sf):
    return long_enough(train_rows(spark, sf))


@query(
    "series_global",
    sql_over(
        "features",
        select="SELECT ds, CAST(sum(y) AS DECIMAL(25,2)) AS y FROM features WHERE ds IS NOT NULL GROUP BY ds",
    ),
)
def series_global(spark, sf):
    return global_series(src.features(spark, sf)).withColumn("y", F.col("y").cast("decimal(25,2)"))


@query(
    "train_test_split",
    """
    WITH totals AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ds, CAST(sum(CAST(o_totalprice
        AS DECIMAL(15,2))) AS DOUBLE) AS y FROM orders GROUP BY 1),
      numbered AS (SELECT *, row_number() OVER (ORDER BY ds) AS rn, count(*) OVER () AS n FROM totals)
    SELECT 'orders' AS series, ds, y, rn <= n * 4 // 5 AS is_train FROM numbered""",
)
def train_test_split(spark, sf):
    series = (
        src.table(spark, sf, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("ds"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(15,2)")).cast("double").alias("y"))
        .withColumn("series", F.lit("orders"))
    )
    return time_split(series, ["series"]).select("series", "ds", "y", "is_train")


@query(
    "min_history_guard",
    sql_over(
        "features",
        select="SELECT brand, state, count(*) AS n FROM features GROUP BY brand, state HAVING count(*) >= 10",
    ),
)
def min_history_guard(spark, sf):
    return enough_history(src.features(spark, sf), SERIES)


@query(
    "fit_trend",
    sql_over(
        "trend",
        select="SELECT brand, state, n_train, round(slope, 3) AS slope, round(intercept, 3) AS intercept FROM trend",
    ),
)
def trend(spark, sf):
    return rounded(fit_trend(fit_rows(spark, sf), SERIES), "slope", "intercept")


@query(
    "fit_month_seasonality",
    sql_over(
        "season", select="SELECT brand, state, month, round(month_factor, 5) AS month_factor FROM season"
    ),
)
def seasonality(spark, sf):
    return rounded(fit_month_seasonality(fit_rows(spark, sf), SERIES), "month_factor", digits=5)


@query(
    "future_frame",
    sql_over(
        "split",
        select="""
        SELECT brand, state, CAST(last + to_months(CAST(place AS INTEGER)) AS DATE) AS ds
        FROM (SELECT brand, state, max(ds) FILTER (WHERE is_train) AS last,
                unnest(range(1, count(*) FILTER (WHERE NOT is_train) + 1)) AS place
              FROM split GROUP BY brand, state) WHERE last IS NOT NULL""",
    ),
)
def frame(spark, sf):
    train = train_rows(spark, sf).withColumn("_test", F.col("n") - F.col("n_train"))
    return future_frame(train, SERIES, "_test")


@query(
    "forecast",
    sql_over(
        "season",
        select="""
        SELECT f.brand, f.state, f.ds,
          round((intercept + slope * ((year(f.ds) - 2000) * 12 + month(f.ds))) * coalesce(month_factor, 1), 3) AS yhat
        FROM (SELECT brand, state, CAST(unnest(generate_series(max(ds) + INTERVAL 1 MONTH,
                max(ds) + INTERVAL 12 MONTH, INTERVAL 1 MONTH)) AS DATE) AS ds
              FROM split WHERE is_train GROUP BY brand, state) f
        JOIN trend USING (brand, state)
        LEFT JOIN season s ON s.brand = f.brand AND s.state = f.state AND s.month = month(f.ds)""",
    ),
)
def year_ahead(spark, sf):
    return rounded(forecast_ahead(fit_rows(spark, sf), SERIES, 12), "yhat")


@query(
    "backtest_metrics",
    sql_over(
        "metrics",
        select="SELECT brand, state, n_train, round(mae, 3) AS mae, round(rmse, 3) AS rmse, round(mape, 3) AS mape, "
        "n, zero_actuals FROM metrics",
    ),
)
def backtest_metrics(spark, sf):
    return rounded(backtest(src.month_series(spark, sf), SERIES), "mae", "rmse", "mape")


@query(
    "forecast_piecewise",
    sql_over(
        "split",
        select="SELECT brand, state, ds, round(y, 2) AS y, is_train, true AS is_finite, true AS line_is_met FROM split WHERE n >= 10",
    ),
)
def forecast_piecewise(spark, sf):
    """Every month of the series and of straight lines over the same months has a forecast, and lines are met."""
    months = src.month_series(spark, sf)
    line = (trend_month(F.col("ds")) * 3.0 + 5_000.0).alias("y")
    found = fit_piecewise(months, SERIES)
    straight = fit_piecewise(months.select(*SERIES, "ds", line), SERIES)
    met = straight.select(
        *[F.col(k).alias(f"_{k}") for k in (*SERIES, "ds")], (F.abs(F.col("yhat") - F.col("y")) <= F.col("y") * 1e-3).alias("line_is_met")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*SERIES, "ds")]
    finite = F.col("yhat").isNotNull() & ~F.isnan("yhat") & (F.abs("yhat") < float("inf"))
    return found.join(met, same).select(*SERIES, "ds", F.round("y", 2).alias("y"), "is_train", finite.alias("is_finite"), "line_is_met")


@query(
    "log_predictions",
    sql_over(
        "scored",
        select=f"""
        SELECT 'v1' AS model_version, {NOW_SQL} AS prediction_time, brand, state, strftime(ds, '%Y-%m') AS period,
          round(yhat, 3) AS predicted_value, round(y, 3) AS actual_value, round(y - yhat, 3) AS error FROM scored""",
    ),
)
def log_predictions(spark, sf):
    rows = prediction_rows(src.scored(spark, sf), "v1", NOW)
    return rounded(rows, "predicted_value", "actual_value", "error")


@query(
    "register_candidate",
    sql_over(
        "metrics",
        select=f"""
        SELECT 'sales/' || brand || '/' || state AS model_name, 'v1' AS model_version,
          'TREND_SEASONAL' AS model_type, {NOW_SQL} AS training_date, n_train AS training_records,
          round(mae, 3) AS mae, round(rmse, 3) AS rmse, round(mape, 3) AS mape, 'CANDIDATE' AS status,
          CAST(NULL AS TIMESTAMP) AS promoted_date, 'Newly trained model awaiting comparison' AS notes
        FROM metrics""",
    ),
)
def register_candidate(spark, sf):
    name = model_name("sales", SERIES)
    return rounded(candidate_rows(src.holdout_metrics(spark, sf), name, "v1", NOW), "mae", "rmse", "mape")
