"""Scans, projections, predicates and scalar functions over the derived sales rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline.functions import dates, numbers, text
from monthline.functions.labels import label_below
from monthline.operators.validation import validate
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import NOW, NOW_SQL, sql_over


@query("table_scan", sql_over("raw_sales", select="SELECT * FROM raw_sales"))
def table_scan(spark, sf):
    return src.raw_sales(spark, sf)


@query(
    "project_alias",
    sql_over(
        "base",
        select="SELECT brand, state, period, ds AS month_start, y AS value FROM base",
    ),
)
def project_alias(spark, sf):
    return src.base(spark, sf).select(
        "brand", "state", "period", F.col("ds").alias("month_start"), F.col("y").alias("value")
    )


@query(
    "project_star_plus",
    sql_over("agg_sales", select="SELECT *, total_sales / transaction_count AS mean_sale FROM "
             "(SELECT * REPLACE (CAST(total_sales AS DOUBLE) AS total_sales) FROM agg_sales)"),
)
def project_star_plus(spark, sf):
    totals = src.agg(spark, sf).withColumn("total_sales", F.col("total_sales").cast("double"))
    return totals.select("*", (F.col("total_sales") / F.col("transaction_count")).alias("mean_sale"))


@query(
    "filter_not_null",
    sql_over("raw_sales", select="SELECT * FROM raw_sales WHERE month IS NOT NULL AND fy IS NOT NULL"),
)
def filter_not_null(spark, sf):
    return src.raw_sales(spark, sf).filter(F.col("month").isNotNull() & F.col("fy").isNotNull())


@query("filter_equals", sql_over("registry", select="SELECT * FROM registry WHERE status = 'PRODUCTION'"))
def filter_equals(spark, sf):
    return src.registry(spark, sf).filter(F.col("status") == "PRODUCTION")


@query(
    "filter_castable",
    sql_over(
        "raw_sales",
        select="SELECT * FROM raw_sales WHERE TRY_CAST(replace(net_sales, ',', '') AS DECIMAL(15,2)) IS NOT NULL",
    ),
)
def filter_castable(spark, sf):
    return src.raw_sales(spark, sf).filter(numbers.to_amount(F.col("net_sales")).isNotNull())


@query(
    "simple_case_month",
    sql_over("clean_sales", select="SELECT month_num, count(*) AS row_count FROM clean_sales GROUP BY month_num"),
)
def simple_case_month(spark, sf):
    return src.clean(spark, sf).groupBy("month_num").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "searched_case",
    sql_over(
        "raw_sales",
        select="""
        SELECT month, fy, CASE WHEN upper(substr(month, 1, 3)) IN ('JAN','FEB','MAR') OR month IS NULL
          OR month = '2024/05' THEN '20' || split_part(fy, '-', 2) ELSE '20' || split_part(fy, '-', 1) END
          AS fiscal_year FROM raw_sales""",
    ),
)
def searched_case(spark, sf):
    month_num = dates.month_number(text.part(F.col("month"), 1))
    chosen = F.when(month_num >= 4, text.part(F.col("fy"), 1)).otherwise(text.part(F.col("fy"), 2))
    return src.raw_sales(spark, sf).select("month", "fy", F.concat(F.lit("20"), chosen).alias("fiscal_year"))


@query("cte_chain", sql_over("history", select="SELECT brand, state, period, y, lag_1 FROM history"))
def cte_chain(spark, sf):
    return src.history(spark, sf).select("brand", "state", "period", "y", "lag_1")


@query(
    "scalar_subquery",
    sql_over(
        "registry",
        select="""
        SELECT count(*) AS models, (SELECT model_version FROM registry WHERE status = 'PRODUCTION'
          ORDER BY training_date DESC, model_id DESC LIMIT 1) AS production_version FROM registry""",
    ),
)
def scalar_subquery(spark, sf):
    registry = src.registry(spark, sf)
    newest = (
        registry.filter(F.col("status") == "PRODUCTION")
        .orderBy(F.desc("training_date"), F.desc("model_id"))
        .limit(1)
        .select("model_version")
    )
    return registry.agg(F.count(F.lit(1)).alias("models")).withColumn("production_version", newest.scalar())


@query(
    "regex_predicate",
    sql_over("flagged", select="SELECT month, fy, NOT bad_month AS month_ok, NOT bad_fy AS fy_ok FROM flagged"),
)
def regex_predicate(spark, sf):
    return src.raw_sales(spark, sf).select(
        "month",
        "fy",
        text.is_month_text(F.col("month")).alias("month_ok"),
        text.is_fiscal_year_text(F.col("fy")).alias("fy_ok"),
    )


@query(
    "numeric_text_predicate",
    sql_over("flagged", select="SELECT net_sales, NOT bad_net_sales AS is_number FROM flagged"),
)
def numeric_text_predicate(spark, sf):
    return src.raw_sales(spark, sf).select(
        "net_sales", text.is_number_text(F.col("net_sales")).alias("is_number")
    )


@query("null_safe_not", sql_over("flagged", select="SELECT month, net_sales FROM flagged WHERE bad_month"))
def null_safe_not(spark, sf):
    return src.raw_sales(spark, sf).filter(~text.is_month_text(F.col("month"))).select("month", "net_sales")


@query(
    "threshold_bucket",
    sql_over(
        "drift_log",
        select="""
        SELECT drift_id, CASE WHEN drift_score < 0.5 THEN 'LOW' WHEN drift_score < 2 THEN 'MIDDLE' ELSE 'HIGH' END
          AS bucket FROM drift_log""",
    ),
)
def threshold_bucket(spark, sf):
    limits = [(0.5, "LOW"), (2.0, "MIDDLE")]
    return src.drift_log(spark, sf).select(
        "drift_id", label_below(F.col("drift_score"), limits, "HIGH").alias("bucket")
    )


@query(
    "fn_upper_trim",
    sql_over("raw_sales", select="SELECT upper(trim(sold_state)) AS state, upper(trim(material_group)) AS brand "
             "FROM raw_sales"),
)
def fn_upper_trim(spark, sf):
    return src.raw_sales(spark, sf).select(
        text.upper_trim(F.col("sold_state")).alias("state"), text.upper_trim(F.col("material_group")).alias("brand")
    )


@query(
    "fn_split_part",
    sql_over(
        "raw_sales",
        select="SELECT month, split_part(month, '-', 1) AS head, split_part(month, '-', 2) AS tail, "
        "split_part(fy, '-', 3) AS missing FROM raw_sales",
    ),
)
def fn_split_part(spark, sf):
    return src.raw_sales(spark, sf).select(
        "month",
        text.part(F.col("month"), 1).alias("head"),
        text.part(F.col("month"), 2).alias("tail"),
        text.part(F.col("fy"), 3).alias("missing"),
    )


@query("fn_replace", sql_over("raw_sales", select="SELECT replace(net_sales, ',', '') AS plain FROM raw_sales"))
def fn_replace(spark, sf):
    return src.raw_sales(spark, sf).select(text.strip_commas(F.col("net_sales")).alias("plain"))


@query(
    "fn_concat_null",
    sql_over("raw_sales", select="SELECT material_group || '-' || sold_state AS joined FROM raw_sales"),
)
def fn_concat_null(spark, sf):
    return src.raw_sales(spark, sf).select(
        F.concat("material_group", F.lit("-"), "sold_state").alias("joined")
    )


@query(
    "fn_lpad",
    sql_over("clean_sales", select="SELECT month_num, lpad(CAST(month_num AS VARCHAR), 2, '0') AS padded "
             "FROM clean_sales"),
)
def fn_lpad(spark, sf):
    return src.clean(spark, sf).select(
        "month_num", F.lpad(F.col("month_num").cast("string"), 2, "0").alias("padded")
    )


@query("fn_substr_cast", sql_over("base", select="SELECT period, year, month FROM base"))
def fn_substr_cast(spark, sf):
    return src.base(spark, sf).select("period", "year", "month")


@query("fn_ceil_quarter", sql_over("base", select="SELECT month, quarter, count(*) AS row_count FROM base GROUP BY ALL"))
def fn_ceil_quarter(spark, sf):
    return (
        src.base(spark, sf)
        .withColumn("quarter", dates.quarter_of(F.col("month")))
        .groupBy("month", "quarter")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "fn_try_number",
    sql_over("raw_sales", select="SELECT month, TRY_CAST('20' || split_part(month, '-', 2) AS INTEGER) AS year "
             "FROM raw_sales"),
)
def fn_try_number(spark, sf):
    return src.raw_sales(spark, sf).select(
        "month", numbers.to_whole(F.concat(F.lit("20"), text.part(F.col("month"), 2))).alias("year")
    )


@query(
    "fn_try_decimal",
    sql_over(
        "raw_sales",
        select="SELECT net_sales, TRY_CAST(replace(net_sales, ',', '') AS DECIMAL(15,2)) AS amount FROM raw_sales",
    ),
)
def fn_try_decimal(spark, sf):
    return src.raw_sales(spark, sf).select(
        "net_sales", numbers.to_amount(F.col("net_sales")).alias("amount")
    )


@query("fn_to_date", sql_over("base", select="SELECT period, ds FROM base"))
def fn_to_date(spark, sf):
    return src.agg(spark, sf).select("period", dates.month_start(F.col("period")).alias("ds"))


@query(
    "fn_datediff_days",
    sql_over(
        "registry",
        select=f"SELECT model_id, CAST(date_diff('day', CAST(training_date AS DATE), CAST({NOW_SQL} AS DATE)) "
        "AS INTEGER) AS age_days FROM registry",
    ),
)
def fn_datediff_days(spark, sf):
    return src.registry(spark, sf).select(
        "model_id", dates.age_days(dates.moment(NOW), F.col("training_date")).alias("age_days")
    )


@query("fn_now", sql_over("registry", select=f"SELECT model_id, {NOW_SQL} AS checked_at FROM registry"))
def fn_now(spark, sf):
    return src.registry(spark, sf).select("model_id", dates.moment(NOW).alias("checked_at"))


@query(
    "fn_round_pct",
    sql_over(
        "pairs",
        select="SELECT model_name, CAST(CAST(improvement_percent AS DECIMAL(18,2)) AS VARCHAR) || '%' AS pct FROM pairs",
    ),
)
def fn_round_pct(spark, sf):
    return src.comparisons(spark, sf).select(
        "model_name", F.concat(text.fixed2_text(F.col("improvement_percent")), F.lit("%")).alias("pct")
    )


@query(
    "fn_abs",
    sql_over("pairs", select="SELECT model_name, round(abs(improvement_percent), 4) AS distance FROM pairs"),
)
def fn_abs(spark, sf):
    return src.comparisons(spark, sf).select(
        "model_name", F.round(F.abs("improvement_percent"), 4).alias("distance")
    )


@query(
    "fn_pct_change",
    sql_over(
        "registry",
        select="SELECT model_id, round((mae - rmse) / nullif(mae, 0) * 100, 4) AS change_pct, "
        "round(model_id / nullif(training_records, 0) * 100, 4) AS share_pct FROM registry",
    ),
)
def fn_pct_change(spark, sf):
    return src.registry(spark, sf).select(
        "model_id",
        F.round(numbers.percent_below(F.col("mae"), F.col("rmse")), 4).alias("change_pct"),
        F.round(numbers.percent_of(F.col("model_id"), F.col("training_records")), 4).alias("share_pct"),
    )


@query("fn_sqrt", sql_over("registry", select="SELECT model_id, round(sqrt(mae), 6) AS root FROM registry"))
def fn_sqrt(spark, sf):
    return src.registry(spark, sf).select("model_id", F.round(F.sqrt("mae"), 6).alias("root"))


@query(
    "fn_cast_varchar",
    sql_over(
        "agg_sales",
        select="SELECT CAST(transaction_count AS VARCHAR) AS count_text, "
        "CAST(CAST(CAST(total_sales AS DOUBLE) AS DECIMAL(18,2)) AS VARCHAR) AS total_text FROM agg_sales",
    ),
)
def fn_cast_varchar(spark, sf):
    return src.agg(spark, sf).select(
        F.col("transaction_count").cast("string").alias("count_text"),
        text.fixed2_text(F.col("total_sales").cast("double")).alias("total_text"),
    )


@query(
    "fn_json_array",
    sql_over(
        "flagged",
        select="""
        SELECT source_file, CAST(to_json([x FOR x IN [
            CASE WHEN g > 0 THEN 'MATERIAL_GROUP has ' || g || ' null values' END,
            CASE WHEN s > 0 THEN 'SOLD_STATE has ' || s || ' null values' END,
            CASE WHEN v > 0 THEN 'NET_SALES has ' || v || ' null values' END,
            CASE WHEN m > 0 THEN 'MONTH has ' || m || ' null values' END,
            CASE WHEN f > 0 THEN 'FY has ' || f || ' null values' END,
            CASE WHEN bv > 0 THEN 'NET_SALES: ' || bv || ' non-numeric values' END,
            CASE WHEN bm > 0 THEN 'MONTH: ' || bm || ' invalid format' END,
            CASE WHEN bf > 0 THEN 'FY: ' || bf || ' invalid format' END] IF x IS NOT NULL]) AS VARCHAR) AS errors
        FROM (SELECT source_file, count(*) FILTER (WHERE material_group IS NULL) AS g,
            count(*) FILTER (WHERE sold_state IS NULL) AS s, count(*) FILTER (WHERE net_sales IS NULL) AS v,
            count(*) FILTER (WHERE month IS NULL) AS m, count(*) FILTER (WHERE fy IS NULL) AS f,
            count(*) FILTER (WHERE bad_net_sales) AS bv, count(*) FILTER (WHERE bad_month) AS bm,
            count(*) FILTER (WHERE bad_fy) AS bf
          FROM flagged GROUP BY source_file)""",
    ),
)
def fn_json_array(spark, sf):
    return validate(src.raw_sales(spark, sf), "all", by="source_file", now=NOW).select(
        "source_file", F.to_json("error_details").alias("errors")
    )


@query(
    "fn_version_tag",
    sql_over("registry", select="SELECT model_id, strftime(training_date, 'v%Y%m%d_%H%M%S') AS tag FROM registry"),
)
def fn_version_tag(spark, sf):
    return src.registry(spark, sf).select("model_id", dates.version_tag(F.col("training_date")).alias("tag"))


@query(
    "fn_month_sequence",
    sql_over(
        "month_series",
        select="""
        SELECT brand, state, CAST(unnest(generate_series(max(ds) + INTERVAL 1 MONTH, max(ds) + INTERVAL 6 MONTH,
          INTERVAL 1 MONTH)) AS DATE) AS ds FROM month_series GROUP BY brand, state""",
    ),
)
def fn_month_sequence(spark, sf):
    return (
        src.month_series(spark, sf)
        .groupBy("brand", "state")
        .agg(F.max("ds").alias("last"))
        .select("brand", "state", F.explode(dates.months_after(F.col("last"), F.lit(6))).alias("ds"))
    )


@query(
    "fn_thousands_text",
    sql_over(
        "registry",
        select="SELECT model_id, format('{:,.0f}', mae) AS mae_text, format('{:.2f}', mape) AS mape_text FROM registry",
    ),
)
def fn_thousands_text(spark, sf):
    return src.registry(spark, sf).select(
        "model_id",
        text.grouped_text(F.col("mae")).alias("mae_text"),
        text.fixed2_text(F.col("mape")).alias("mape_text"),
    )
