"""Aggregations, windows, pairing, sorting, row ids and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline.operators.features import FEATURE_ORDER, SERIES, feature_preview, series_lengths
from monthline.operators.forecast import align_forecast, error_metrics, forecast_ahead, long_enough, time_split
from monthline.operators.latest import latest, latest_with_status
from monthline.operators.monitoring import distribution_stats, pipeline_summary
from monthline.operators.registry import champion_challenger
from monthline.operators.row_id import with_row_id
from monthline.operators.validation import check_counts, flag_rows
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import near, near_sql, sql_over

ROUNDED_STATS = f"""{near_sql("avg(y)")} AS y_mean, {near_sql("stddev_samp(y)")} AS y_std, min(y) AS y_min,
  max(y) AS y_max, count(*) AS record_count"""

SUMMARY_SQL = sql_over(
    "features",
    "registry",
    "drift_log",
    select="""
    SELECT 'PRODUCTION_MODEL' AS metric, (SELECT model_version FROM registry WHERE status = 'PRODUCTION'
      ORDER BY training_date DESC, model_id DESC LIMIT 1) AS value
    UNION ALL SELECT 'PRODUCTION_MAE', (SELECT CAST(CAST(mae AS DECIMAL(18,2)) AS VARCHAR) FROM registry
      WHERE status = 'PRODUCTION' ORDER BY training_date DESC, model_id DESC LIMIT 1)
    UNION ALL SELECT 'TOTAL_FEATURES', (SELECT CAST(count(*) AS VARCHAR) FROM features)
    UNION ALL SELECT 'RAW_RECORDS', (SELECT CAST(count(*) AS VARCHAR) FROM raw_sales)
    UNION ALL SELECT 'LATEST_DRIFT_STATUS', (SELECT drift_status FROM drift_log
      ORDER BY check_date DESC, drift_id DESC LIMIT 1)
    UNION ALL SELECT 'MODELS_TRAINED', (SELECT CAST(count(*) AS VARCHAR) FROM registry)""",
)


def rounded_stats(stats):
    return stats.withColumns({c: near(c) for c in ("y_mean", "y_std")})


def summary(spark, sf):
    return pipeline_summary(
        src.registry(spark, sf), src.features(spark, sf), src.raw_sales(spark, sf), src.drift_log(spark, sf)
    )


@query("agg_count_all", sql_over("raw_sales", select="SELECT count(*) AS total_records FROM raw_sales"))
def agg_count_all(spark, sf):
    return src.raw_sales(spark, sf).agg(F.count(F.lit(1)).alias("total_records"))


@query("agg_sales_monthly", sql_over("agg_sales", select="SELECT * FROM agg_sales"))
def agg_sales_monthly(spark, sf):
    return src.agg(spark, sf)


@query(
    "agg_series_periods",
    sql_over(
        "features",
        select="SELECT brand, state, count(*) AS periods FROM features GROUP BY brand, state "
        "ORDER BY periods DESC, brand NULLS LAST, state NULLS LAST",
    ),
)
def agg_series_periods(spark, sf):
    return series_lengths(src.features(spark, sf))


@query(
    "agg_global_series",
    sql_over(
        "month_series", select="SELECT ds, CAST(sum(y) AS DECIMAL(25,2)) AS y FROM month_series GROUP BY ds"
    ),
)
def agg_global_series(spark, sf):
    return (
        src.month_series(spark, sf).groupBy("ds").agg(F.sum("y").cast("decimal(25,2)").alias("y"))
    )


@query("agg_distribution_stats", sql_over("features", select=f"SELECT {ROUNDED_STATS} FROM features"))
def agg_distribution_stats(spark, sf):
    return rounded_stats(distribution_stats(src.features(spark, sf)))


@query(
    "agg_null_counts",
    sql_over(
        "raw_sales",
        select="""
        SELECT count(*) FILTER (WHERE material_group IS NULL) AS n_null_material_group,
          count(*) FILTER (WHERE sold_state IS NULL) AS n_null_sold_state,
          count(*) FILTER (WHERE net_sales IS NULL) AS n_null_net_sales,
          count(*) FILTER (WHERE month IS NULL) AS n_null_month,
          count(*) FILTER (WHERE fy IS NULL) AS n_null_fy FROM raw_sales""",
    ),
)
def agg_null_counts(spark, sf):
    counts = check_counts(src.raw_sales(spark, sf))
    return counts.select(*[c for c in counts.columns if c.startswith("n_null_")])


@query(
    "agg_invalid_union",
    sql_over(
        "flagged",
        select="SELECT count(*) FILTER (WHERE bad_net_sales OR bad_month OR bad_fy) AS invalid_records, "
        "count(*) AS total_records FROM flagged",
    ),
)
def agg_invalid_union(spark, sf):
    counts = check_counts(src.raw_sales(spark, sf))
    return counts.select((F.col("total_records") - F.col("valid_records")).alias("invalid_records"), "total_records")


@query(
    "agg_error_metrics",
    sql_over(
        "history",
        select=f"""
        SELECT brand, state, {near_sql("avg(abs(y - lag_1))", 3)} AS mae,
          {near_sql("sqrt(avg((y - lag_1) * (y - lag_1)))", 3)} AS rmse,
          {near_sql("avg(abs((y - lag_1) / nullif(y, 0))) * 100", 3)} AS mape, count(*) AS n,
          count(*) FILTER (WHERE y = 0) AS zero_actuals
        FROM history WHERE lag_1 IS NOT NULL GROUP BY brand, state""",
    ),
)
def agg_error_metrics(spark, sf):
    naive = src.history(spark, sf).filter("lag_1 is not null").withColumn("yhat", F.col("lag_1"))
    return error_metrics(naive, SERIES).withColumns({c: near(c, 3) for c in ("mae", "rmse", "mape")})


@query(
    "agg_min_max_date",
    sql_over("features", select="SELECT min(ds) AS first_ds, max(ds) AS last_ds FROM features"),
)
def agg_min_max_date(spark, sf):
    return src.features(spark, sf).agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))


@query(
    "win_lag_1_2_3",
    sql_over("history", select="SELECT brand, state, period, ds, y, lag_1, lag_2, lag_3 FROM history"),
)
def win_lag(spark, sf):
    return src.history(spark, sf).select("brand", "state", "period", "ds", "y", "lag_1", "lag_2", "lag_3")


@query(
    "win_rolling_avg_3",
    sql_over("history", select="SELECT brand, state, period, round(rolling_avg_3, 4) AS rolling_avg_3 FROM history"),
)
def win_rolling_avg_3(spark, sf):
    return src.history(spark, sf).select(
        "brand", "state", "period", F.round("rolling_avg_3", 4).alias("rolling_avg_3")
    )


ROW_ID_SQL = sql_over(
    "features",
    select="SELECT row_number() OVER (ORDER BY brand NULLS LAST, state NULLS LAST, ds NULLS LAST, "
    "period NULLS LAST) AS feature_id, brand, state, period FROM features",
)


@query("win_row_id", ROW_ID_SQL)
def win_row_id(spark, sf):
    rows = src.features(spark, sf).select("brand", "state", "ds", "period")
    return with_row_id(rows, FEATURE_ORDER).select("feature_id", "brand", "state", "period")


@query("scalable_row_id", ROW_ID_SQL)
def scalable_row_id(spark, sf):
    rows = src.features(spark, sf).select("brand", "state", "ds", "period")
    return with_row_id(rows, FEATURE_ORDER, partitions=16).select("feature_id", "brand", "state", "period")


@query("win_time_split", sql_over("split", select="SELECT brand, state, ds, rn, n, is_train FROM split"))
def win_time_split(spark, sf):
    split = time_split(src.month_series(spark, sf), SERIES)
    return split.select("brand", "state", "ds", F.col("rn").cast("long").alias("rn"), "n", "is_train")


@query(
    "align_forecast_actual",
    sql_over(
        "season",
        select="""
        SELECT a.brand, a.state, a.ds, p.ds AS forecast_ds, round(y, 2) AS y, round(yhat, 3) AS yhat
        FROM (SELECT *, row_number() OVER (PARTITION BY brand, state ORDER BY ds) AS place
              FROM split WHERE NOT is_train) a
        JOIN (SELECT f.brand, f.state, f.ds, place,
                (intercept + slope * ((year(f.ds) - 2000) * 12 + month(f.ds))) * coalesce(month_factor, 1) AS yhat
              FROM (SELECT brand, state, place, CAST(last + to_months(CAST(place AS INTEGER)) AS DATE) AS ds
                    FROM (SELECT brand, state, max(ds) FILTER (WHERE is_train) AS last,
                            unnest(range(1, count(*) FILTER (WHERE NOT is_train) + 1)) AS place
                          FROM split GROUP BY brand, state)) f
              JOIN trend USING (brand, state)
              LEFT JOIN season s ON s.brand = f.brand AND s.state = f.state AND s.month = month(f.ds)) p
        ON p.brand = a.brand AND p.state = a.state AND p.place = a.place""",
    ),
)
def align_forecast_actual(spark, sf):
    split = long_enough(time_split(src.month_series(spark, sf), SERIES))
    pred = forecast_ahead(split.filter("is_train"), SERIES, F.col("n") - F.col("n_train"))
    actual = split.filter(~F.col("is_train")).select(*SERIES, "ds", "y")
    return align_forecast(pred, actual, SERIES, "position").select(
        *SERIES, "ds", "forecast_ds", F.round("y", 2).alias("y"), F.round("yhat", 3).alias("yhat")
    )


@query(
    "champion_challenger_pair",
    sql_over(
        "pairs",
        select="SELECT model_name, production_model_version, candidate_model_version, production_mae, "
        "candidate_mae FROM pairs",
    ),
)
def champion_challenger_pair(spark, sf):
    return champion_challenger(src.registry(spark, sf)).filter("candidate_model_version is not null")


@query(
    "topk_latest",
    sql_over("registry", select="SELECT * FROM registry ORDER BY training_date DESC, model_id DESC LIMIT 5"),
)
def topk_latest(spark, sf):
    return latest(src.registry(spark, sf), "training_date", 5, "model_id")


@query(
    "sort_full",
    sql_over("agg_sales", select="SELECT * FROM agg_sales ORDER BY brand NULLS LAST, state NULLS LAST, period NULLS LAST"),
)
def sort_full(spark, sf):
    return src.agg(spark, sf).orderBy(*[F.col(c).asc_nulls_last() for c in ("brand", "state", "period")])


@query(
    "limit_sample",
    sql_over(
        "raw_sales",
        select="SELECT * FROM raw_sales ORDER BY " + ", ".join(f"{c} NULLS LAST" for c in [*src.FIELDS, "source_file"]) + " LIMIT 10",
    ),
)
def limit_sample(spark, sf):
    """The first ten rows in the order of all columns."""
    raw = src.raw_sales(spark, sf)
    return raw.orderBy(*[F.col(c).asc_nulls_last() for c in raw.columns]).limit(10)


@query(
    "preview_prophet_ready",
    sql_over(
        "features",
        select="SELECT brand, state, ds, y, lag_1, lag_2, lag_3, round(rolling_avg_3, 4) AS rolling_avg_3 "
        "FROM features ORDER BY ds NULLS LAST, brand NULLS LAST, state NULLS LAST, period NULLS LAST LIMIT 20",
    ),
)
def preview_model_input(spark, sf):
    preview = feature_preview(src.features(spark, sf))
    return preview.withColumn("rolling_avg_3", F.round("rolling_avg_3", 4))


@query(
    "latest_per_key",
    sql_over(
        "registry",
        select="SELECT * FROM registry WHERE status = 'ARCHIVED' QUALIFY row_number() OVER "
        "(PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1",
    ),
)
def latest_per_key(spark, sf):
    return latest_with_status(src.registry(spark, sf), "ARCHIVED")


@query("union_all_metrics", SUMMARY_SQL)
def union_all_metrics(spark, sf):
    return summary(spark, sf)


@query(
    "union_distinct_failures",
    sql_over(
        "flagged",
        select="SELECT material_group, sold_state, month, fy, net_sales, source_file FROM flagged "
        "WHERE bad_net_sales OR bad_month OR bad_fy",
    ),
)
def union_distinct_failures(spark, sf):
    return (
        flag_rows(src.raw_sales(spark, sf))
        .filter(~F.col("is_valid"))
        .select("material_group", "sold_state", "month", "fy", "net_sales", "source_file")
    )
