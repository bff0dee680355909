"""Drift, model age, summary and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline import schemas
from monthline.functions import fixed
from monthline.operators import reports
from monthline.operators.distribution import distribution_step
from monthline.operators.features import SERIES
from monthline.operators.monitoring import drift_baseline, drift_check, drift_step, health_run, model_health, summary_view
from monthline.parity import inputs as src
from monthline.parity.aggregates import SUMMARY_SQL, summary
from monthline.parity.catalog import query
from monthline.parity.inputs import BASELINE_BEFORE, NOW, NOW_SQL, near, near_sql, sql_over

HEALTH_SQL = f"""
    SELECT model_name, model_version, mae, training_date, age_days,
      CASE WHEN age_days > 90 THEN 'STALE' WHEN age_days > 30 THEN 'AGING' ELSE 'HEALTHY' END AS health_status
    FROM (SELECT *, CAST(date_diff('day', CAST(training_date AS DATE), CAST({NOW_SQL} AS DATE)) AS INTEGER) AS age_days
          FROM registry WHERE status = 'PRODUCTION'
          QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1)"""


@query(
    "drift_baseline",
    sql_over(
        "features",
        select=f"""
        SELECT {NOW_SQL} AS check_date, metric_name, {near_sql('v')} AS baseline_value, {near_sql('v')} AS current_value,
          0.0::DOUBLE AS drift_score, 'BASELINE' AS drift_status
        FROM (SELECT unnest(['Y_MEAN', 'Y_STD', 'Y_MIN', 'Y_MAX', 'RECORD_COUNT']) AS metric_name,
                unnest([avg(y), stddev_samp(y), min(y), max(y), count(*)::DOUBLE]) AS v FROM features)""",
    ),
)
def baseline(spark, sf):
    rows = drift_baseline(src.features(spark, sf), now=NOW)
    return rows.withColumns({c: near(c) for c in ("baseline_value", "current_value")})


def drift_sql(keys: str, on: str) -> str:
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    prefix = ", ".join(f"c.{k.strip()}" for k in keys.split(",")) + ", " if keys else ""
    return f"""
    SELECT {prefix}{NOW_SQL} AS check_date, 'Y_MEAN' AS metric_name, {near_sql("b")} AS baseline_value,
      {near_sql("m")} AS current_value, {near_sql("abs((m - b) / nullif(b, 0)) * 100")} AS drift_score,
      CASE WHEN abs((m - b) / nullif(b, 0)) * 100 < 10 THEN 'NORMAL'
           WHEN abs((m - b) / nullif(b, 0)) * 100 < 25 THEN 'WARNING' ELSE 'CRITICAL' END AS drift_status
    FROM (SELECT {lead}avg(y) AS m FROM features {group}) c
    JOIN (SELECT {lead}avg(y) AS b FROM features WHERE ds < DATE '{BASELINE_BEFORE}' {group}) b ON {on}"""


def rounded_drift(rows):
    return rows.withColumns({c: near(c) for c in ("baseline_value", "current_value", "drift_score")})


@query("drift_check", sql_over("features", select=drift_sql("", "true")))
def check(spark, sf):
    features = src.features(spark, sf)
    return rounded_drift(drift_check(features, src.baseline_log(features), now=NOW))


@query(
    "drift_check_by_series",
    sql_over(
        "features",
        select=drift_sql(
            "brand, state", "c.brand IS NOT DISTINCT FROM b.brand AND c.state IS NOT DISTINCT FROM b.state"
        ),
    ),
)
def check_by_series(spark, sf):
    features = src.features(spark, sf)
    return rounded_drift(drift_check(features, src.baseline_log(features, SERIES), SERIES, now=NOW))


LATE_BRAND = "BRAND#11"


@query(
    "drift_new_series",
    sql_over(
        "features",
        select=f"""
        SELECT s.brand, s.state, {NOW_SQL} AS check_date, metric_name,
          {near_sql("CASE WHEN b.known THEN b ELSE v END")} AS baseline_value, {near_sql("v")} AS current_value,
          {near_sql("CASE WHEN b.known THEN abs((v - b) / nullif(b, 0)) * 100 ELSE 0 END")} AS drift_score,
          CASE WHEN b.known IS NULL THEN 'BASELINE' WHEN abs((v - b) / nullif(b, 0)) * 100 < 10 THEN 'NORMAL'
            WHEN abs((v - b) / nullif(b, 0)) * 100 < 25 THEN 'WARNING' ELSE 'CRITICAL' END AS drift_status
        FROM (SELECT brand, state, unnest(['Y_MEAN', 'Y_STD', 'Y_MIN', 'Y_MAX', 'RECORD_COUNT']) AS metric_name,
                unnest([avg(y), stddev_samp(y), min(y), max(y), CAST(count(*) AS DOUBLE)]) AS v
              FROM features GROUP BY brand, state) s
        LEFT JOIN (SELECT brand, state, avg(y) AS b, true AS known FROM features
                   WHERE ds < DATE '{BASELINE_BEFORE}' AND brand IS DISTINCT FROM '{LATE_BRAND}' GROUP BY brand, state) b
          ON s.brand IS NOT DISTINCT FROM b.brand AND s.state IS NOT DISTINCT FROM b.state
        WHERE b.known IS NULL OR metric_name = 'Y_MEAN'""",
    ),
)
def drift_new_series(spark, sf):
    """A second check in which some series appear for the first time and get their baseline."""
    features = src.features(spark, sf)
    known = src.baseline_log(features.filter(~F.col("brand").eqNullSafe(LATE_BRAND)), SERIES)
    return rounded_drift(drift_step(features, known, SERIES, NOW))


@query("model_health", sql_over("registry", select=HEALTH_SQL))
def health(spark, sf):
    return model_health(src.registry(spark, sf), NOW)


@query("pipeline_summary", SUMMARY_SQL)
@query("metric_summary", SUMMARY_SQL)
def metric_summary(spark, sf):
    return summary(spark, sf)


@query("pipeline_view", SUMMARY_SQL)
@query("metric_summary_view", SUMMARY_SQL)
def metric_summary_view(spark, sf):
    name = summary_view(spark, "metric_summary", summary(spark, sf))
    return spark.sql(f"SELECT metric, value FROM {name}")


@query(
    "health_run_record",
    sql_over(
        "registry",
        select=f"""
        SELECT {NOW_SQL} AS run_time, 'HEALTH_CHECK' AS phase, health_status AS status,
          CAST(age_days AS BIGINT) AS records_processed, CAST(NULL AS INTEGER) AS duration_seconds,
          CAST(NULL AS VARCHAR) AS error_message FROM ({HEALTH_SQL})""",
    ),
)
def health_run_record(spark, sf):
    return health_run(model_health(src.registry(spark, sf), NOW), NOW)


@query(
    "dash_production_kpi",
    sql_over(
        "registry",
        select="SELECT model_version, mae, training_date FROM registry WHERE status = 'PRODUCTION' "
        "ORDER BY training_date DESC, model_id DESC LIMIT 1",
    ),
)
def dash_production_kpi(spark, sf):
    return reports.production_kpi(src.registry(spark, sf))


@query(
    "dash_row_counts",
    sql_over(
        "features",
        select="SELECT (SELECT count(*) FROM raw_sales) AS raw_records, (SELECT count(*) FROM features) AS features",
    ),
)
def dash_row_counts(spark, sf):
    return reports.row_counts(src.raw_sales(spark, sf), src.features(spark, sf))


@query(
    "dash_model_history",
    sql_over(
        "registry",
        select="SELECT model_version, model_type, status, training_date, mae, rmse, mape, notes FROM registry "
        "ORDER BY training_date DESC, model_id DESC LIMIT 10",
    ),
)
def dash_model_history(spark, sf):
    return reports.model_history(src.registry(spark, sf))


@query(
    "dash_drift_history",
    sql_over(
        "drift_log",
        select=f"SELECT check_date, metric_name, {near_sql('baseline_value')} AS baseline_value, "
        f"{near_sql('current_value')} AS current_value, {near_sql('drift_score')} AS drift_score, drift_status "
        "FROM drift_log ORDER BY check_date DESC, drift_id DESC LIMIT 10",
    ),
)
def dash_drift_history(spark, sf):
    return rounded_drift(reports.drift_history(src.drift_log(spark, sf)))


@query(
    "dash_latest_drift_level",
    sql_over(
        "drift_log",
        select="""
        SELECT drift_status, CASE WHEN drift_status IN ('NORMAL', 'BASELINE') THEN 'success'
          WHEN drift_status = 'WARNING' THEN 'warning' ELSE 'error' END AS level
        FROM drift_log WHERE metric_name = 'Y_MEAN' ORDER BY check_date DESC, drift_id DESC LIMIT 1""",
    ),
)
def dash_latest_drift_level(spark, sf):
    return reports.latest_drift_level(src.drift_log(spark, sf))


@query(
    "dash_comparison_history",
    sql_over(
        "decisions",
        select=f"""
        SELECT {NOW_SQL} AS comparison_date, production_model_version, candidate_model_version, production_mae,
          candidate_mae, round(improvement_percent, 4) AS improvement_percent, decision, decision_reason
        FROM decisions ORDER BY CAST(substr(candidate_model_version, 2) AS BIGINT) DESC LIMIT 10""",
    ),
)
def dash_comparison_history(spark, sf):
    return reports.comparison_history(src.comparisons(spark, sf)).withColumn(
        "improvement_percent", F.round("improvement_percent", 4)
    )


@query(
    "dash_run_history",
    """SELECT o_orderdate AS run_time,
         CASE WHEN o_orderkey % 2 = 0 THEN 'FULL_PIPELINE' ELSE 'HEALTH_CHECK' END AS phase,
         o_orderstatus AS status, o_orderkey % 1000 AS records_processed
       FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""",
)
def dash_run_history(spark, sf):
    return reports.run_history(src.runs(spark, sf))


@query(
    "dash_trigger_history",
    "SELECT ts AS run_time, event_id AS new_rows, event_type AS trigger_type FROM events "
    "ORDER BY ts DESC, event_id DESC LIMIT 10",
)
def dash_trigger_history(spark, sf):
    return reports.trigger_history(src.triggers(spark, sf))


_RANKED = """SELECT brand, state, y, row_number() OVER (PARTITION BY brand, state ORDER BY y) AS i,
      count(*) OVER (PARTITION BY brand, state) AS n FROM {}"""

DISTRIBUTION_SQL = sql_over(
    "features",
    select=f"""
    , early AS (SELECT * FROM features WHERE ds < DATE '{src.BASELINE_BEFORE}'),
    a AS ({_RANKED.format("early")}), b AS ({_RANKED.format("features")}),
    qa AS (SELECT brand, state, n, list(y) AS q FROM a JOIN range(65) p(k) ON i = greatest(1, CAST(ceil(k / 64.0 * n) AS BIGINT)) GROUP BY ALL),
    qb AS (SELECT brand, state, n, list(y) AS q FROM b JOIN range(65) p(k) ON i = greatest(1, CAST(ceil(k / 64.0 * n) AS BIGINT)) GROUP BY ALL),
    far AS (
      SELECT b.brand, b.state, b.n, a.n AS m,
        CASE WHEN a.n IS NULL THEN 0 ELSE list_max(list_transform(list_concat(a.q, b.q), lambda x:
          abs(len(list_filter(a.q, lambda v: v <= x)) - len(list_filter(b.q, lambda v: v <= x))))) / 65.0 END AS distance
      FROM qb b LEFT JOIN qa a ON a.brand IS NOT DISTINCT FROM b.brand AND a.state IS NOT DISTINCT FROM b.state)
    SELECT brand, state, n, round(distance, 6) AS distance,
      CASE WHEN m IS NULL THEN 'BASELINE' WHEN score < 10 THEN 'NORMAL' WHEN score < 25 THEN 'WARNING' ELSE 'CRITICAL' END AS drift_status
    FROM (SELECT *, greatest(distance - {fixed.CHANCE_FACTOR} * sqrt((n + m) / (n * m)) - {2 * fixed.SKETCH_RANK_ERROR + 1 / 64}, 0) * 100 AS score FROM far)""",
)


@query("distribution_drift", DISTRIBUTION_SQL)
def distribution_drift(spark, sf):
    """The features before the cut date as first sketches, all features against them. Series this short are held whole by a sketch."""
    rows = src.features(spark, sf)
    early = rows.filter(F.col("ds") < F.lit(src.BASELINE_BEFORE).cast("date"))
    nothing = spark.createDataFrame([], schemas.SERIES_DISTRIBUTION)
    first = distribution_step(early, nothing, src.SERIES, NOW)
    found = distribution_step(rows, first, src.SERIES, NOW)
    return found.select("brand", "state", "n", F.round("distance", 6).alias("distance"), "drift_status")
