"""Pipeline inputs derived from the sample tables, in Spark and as SQL fragments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthline.functions import fixed
from monthline.operators.features import agg_sales, clean_sales, feature_base, feature_history, feature_rows
from monthline.operators.forecast import error_metrics, score_holdout
from monthline.operators.monitoring import drift_baseline
from monthline.operators.registry import compare_models
from monthline.session import scratch_path
from monthline.sources.tables import read_table

NOW = datetime(2001, 8, 15, 8, 30)
BASELINE_BEFORE = "2018-07-01"
SERIES = ["brand", "state"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part, supplier and nation."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return (
        lines.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), "l_partkey")
        .join(
            table(spark, sf_dir, "supplier").select(
                F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey")
            ),
            "l_suppkey",
        )
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    )


def keyed_raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales text rows with dirt in fixed places, plus the order key ``k``."""
    k = F.col("k")
    year, month = F.year("l_shipdate") + 20, F.month("l_shipdate")
    month_name = F.elt(month, *[F.lit(name.capitalize()) for name in fixed.MONTH_TOKENS])

    def two_digits(value):
        return F.lpad((value % 100).cast("string"), 2, "0")

    first_year = year - F.when(month < 4, 1).otherwise(0)
    second_year = year + F.when(month >= 4, 1).otherwise(0)
    null = F.lit(None).cast("string")
    return (
        sales_lines(spark, sf_dir)
        .withColumn("k", F.col("l_orderkey"))
        .select(
            "k",
            F.when(k % 97 == 0, null).otherwise(F.lower("p_brand")).alias("material_group"),
            F.col("p_name").alias("material_description"),
            F.when(k % 89 == 0, null)
            .otherwise(F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
            .alias("sold_state"),
            F.col("s_name").alias("supply_location"),
            F.when(k % 83 == 0, "2024/05")
            .when(k % 79 == 0, null)
            .otherwise(F.concat(month_name, F.lit("-"), two_digits(year)))
            .alias("month"),
            F.when(k % 73 == 0, "2023-24")
            .when(k % 71 == 0, null)
            .otherwise(F.concat(two_digits(first_year), F.lit("-"), two_digits(second_year)))
            .alias("fy"),
            F.when(k % 67 == 0, "n/a")
            .when(k % 61 == 0, null)
            .otherwise(F.format_number(F.col("l_extendedprice").cast("decimal(15,2)"), 2))
            .alias("net_sales"),
            F.concat(F.lit("batch_"), (k % 4).cast("string"), F.lit(".csv")).alias("source_file"),
        )
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_raw_sales(spark, sf_dir).drop("k")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(raw_sales(spark, sf_dir))


def agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg_sales(clean(spark, sf_dir))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_base(agg(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_history(base(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_rows(agg(spark, sf_dir))


def month_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly value per brand and state without dirt."""
    return (
        sales_lines(spark, sf_dir)
        .groupBy(
            F.col("p_brand").alias("brand"),
            F.col("n_name").alias("state"),
            F.trunc("l_shipdate", "month").alias("ds"),
        )
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("double").alias("y"))
    )


def scored(spark: SparkSession, sf_dir: str, align: str = "date") -> DataFrame:
    return score_holdout(month_series(spark, sf_dir), SERIES, align)


def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_metrics(scored(spark, sf_dir), [*SERIES, "n_train"])


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model version per order."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        key.alias("model_id"),
        F.concat(F.lit("model_"), (F.col("o_custkey") % 1000).cast("string")).alias("model_name"),
        F.concat(F.lit("v"), key.cast("string")).alias("model_version"),
        F.lit("TREND_SEASONAL").alias("model_type"),
        F.col("o_orderdate").alias("training_date"),
        (key % 500).alias("training_records"),
        price.alias("mae"),
        (price * 1.25).alias("rmse"),
        ((key % 1000) / 10).alias("mape"),
        F.when(key % 10 == 0, "PRODUCTION")
        .when((key % 10).isin(1, 2, 3), "CANDIDATE")
        .otherwise("ARCHIVED")
        .alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("promoted_date"),
        F.lit(None).cast("string").alias("notes"),
    )


def comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decisions on the derived registry, numbered by candidate."""
    return compare_models(registry(spark, sf_dir), now=NOW).withColumn(
        "comparison_id", F.substring("candidate_model_version", 2, 20).cast("long")
    )


def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check per order month: mean order price against the mean of all orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    overall = orders.agg(F.avg("o_totalprice")).scalar()
    monthly = orders.groupBy(F.trunc("o_orderdate", "month").alias("ds")).agg(
        F.avg("o_totalprice").alias("current_value")
    )
    score = F.abs((F.col("current_value") - F.col("baseline_value")) / F.col("baseline_value")) * 100
    return (
        monthly.withColumn("baseline_value", overall)
        .withColumn("drift_score", score)
        .select(
            (F.year("ds") * 12 + F.month("ds")).cast("long").alias("drift_id"),
            F.col("ds").cast("timestamp_ntz").alias("check_date"),
            F.when(F.month("ds") % 3 == 0, "RECORD_COUNT").otherwise("Y_MEAN").alias("metric_name"),
            "baseline_value",
            "current_value",
            "drift_score",
            F.when(F.col("drift_score") < 1, "NORMAL")
            .when(F.col("drift_score") < 3, "WARNING")
            .otherwise("CRITICAL")
            .alias("drift_status"),
        )
    )


def baseline_log(early_and_late: DataFrame, by=()) -> DataFrame:
    """Stored baseline: the features before the cut date."""
    early = early_and_late.filter(F.col("ds") < F.lit(BASELINE_BEFORE).cast("date"))
    return drift_baseline(early, by, NOW).withColumn("drift_id", F.lit(1).cast("long"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("run_id"),
        F.col("o_orderdate").alias("run_time"),
        F.when(key % 2 == 0, "FULL_PIPELINE").otherwise("HEALTH_CHECK").alias("phase"),
        F.col("o_orderstatus").alias("status"),
        (key % 1000).alias("records_processed"),
    )


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trigger per event."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("run_time"), F.col("event_id").alias("new_rows"), F.col("event_type").alias("trigger_type")
    )


# --- sales files written from the derived rows ---------------------------------

FIELDS = [
    "material_group",
    "material_description",
    "sold_state",
    "supply_location",
    "month",
    "fy",
    "net_sales",
]


def write_sales_files(
    spark: SparkSession, sf_dir: str, *, broken: bool = False, lots: tuple[int, ...] | None = None
) -> str:
    """Write the derived rows as CSV with mixed null tokens and return the folder.

    Lines are filed by ``lot`` = order key modulo 4. With ``broken``, some lines
    lack their last field and some have one too many.
    """
    rows = keyed_raw_sales(spark, sf_dir).withColumn("lot", F.col("k") % 4)
    if lots is not None:
        rows = rows.filter(F.col("lot").isin(*lots))
    path = scratch_path(spark, "sales-files")
    append_sales_files(rows, path, broken)
    return path


def append_sales_files(rows: DataFrame, path: str, broken: bool = False) -> None:
    tokens = {"material_group": "NULL", "sold_state": "", "month": "null", "fy": "NULL", "net_sales": ""}
    cells = [
        F.concat(F.lit('"'), F.col("net_sales"), F.lit('"')) if name == "net_sales" else F.col(name)
        for name in FIELDS
    ]
    cells = [
        F.coalesce(cell, F.lit(tokens[name])) if name in tokens else cell
        for name, cell in zip(FIELDS, cells, strict=True)
    ]
    line = F.concat_ws(",", *cells)
    if broken:
        short = F.concat_ws(",", *cells[:-1])
        line = (
            F.when(F.col("k") % 53 == 0, short)
            .when(F.col("k") % 59 == 0, F.concat(line, F.lit(",extra")))
            .otherwise(line)
        )
    (
        rows.select(line.alias("line"), "lot")
        .write.mode("append")
        .partitionBy("lot")
        .options(header=True, sep="\u0001", quote="\u0000", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


#: Rows of a placed file, about.
FILE_ROWS = 250_000


def files_per_lot(spark: SparkSession, sf_dir: str, least: int = 4) -> int:
    """How many files a lot, a quarter of the line items, is placed in, so that files do not grow with the table."""
    return max(least, -(-table(spark, sf_dir, "lineitem").count() // (4 * FILE_ROWS)))


def place_sales_files(rows: DataFrame, folder: str, files: int = 4) -> None:
    """Write the rows of each lot as files of fixed names, in place of those that are there.

    Line breaks inside fields are quoted. A task sorts the rows of a few files.
    """
    spark, staged = rows.sparkSession, scratch_path(rows.sparkSession, "staged-files")
    plain = {"header": True, "quote": '"', "escape": '"', "nullValue": "NULL", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.select(*FIELDS, "lot", F.pmod(F.xxhash64("k"), F.lit(files)).alias("part")).repartition(8 * files, "lot", "part").write.partitionBy("lot", "part").options(**plain).csv(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for status in system.globStatus(path(f"{staged}/lot=*/part=*/*.csv")):
        made = status.getPath()
        target = path(f"{folder}/{made.getParent().getParent().getName()}-{made.getParent().getName()}.csv")
        system.delete(target, False)
        system.rename(made, target)


# Means of two-decimal amounts often lie exactly between two rounded values, where
# the order of summation decides. A small shift before rounding settles them.


def near(name: str, digits: int = 4) -> Column:
    return F.round(F.col(name) + 3 * 10.0 ** -(digits + 2), digits)


def near_sql(expression: str, digits: int = 4) -> str:
    return f"round({expression} + {3 * 10.0 ** -(digits + 2):.{digits + 2}f}, {digits})"


# --- the same inputs as SQL -----------------------------------------------------

NOW_SQL = "TIMESTAMP '2001-08-15 08:30:00'"

FRAGMENTS = {
    "sales_lines": """
        SELECT l_orderkey AS k, l_extendedprice, l_shipdate, p_name, p_brand, s_name, n_name
        FROM lineitem JOIN part ON p_partkey = l_partkey
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "keyed_raw": """
        SELECT k,
          CASE WHEN k % 97 = 0 THEN NULL ELSE lower(p_brand) END AS material_group,
          p_name AS material_description,
          CASE WHEN k % 89 = 0 THEN NULL ELSE '  ' || n_name || ' ' END AS sold_state,
          s_name AS supply_location,
          CASE WHEN k % 83 = 0 THEN '2024/05' WHEN k % 79 = 0 THEN NULL ELSE strftime(sd, '%b-%y') END AS month,
          CASE WHEN k % 73 = 0 THEN '2023-24' WHEN k % 71 = 0 THEN NULL
               ELSE lpad(CAST((year(sd) - CAST(month(sd) < 4 AS INT)) % 100 AS VARCHAR), 2, '0') || '-' ||
                    lpad(CAST((year(sd) + CAST(month(sd) >= 4 AS INT)) % 100 AS VARCHAR), 2, '0') END AS fy,
          CASE WHEN k % 67 = 0 THEN 'n/a' WHEN k % 61 = 0 THEN NULL
               ELSE format('{:,.2f}', l_extendedprice) END AS net_sales,
          'batch_' || (k % 4) || '.csv' AS source_file
        FROM (SELECT *, l_shipdate + INTERVAL 20 YEAR AS sd FROM sales_lines)""",
    "raw_sales": "SELECT * EXCLUDE (k) FROM keyed_raw",
    "clean_sales": """
        SELECT upper(trim(material_group)) AS brand, upper(trim(material_description)) AS product,
          upper(trim(sold_state)) AS state, upper(trim(supply_location)) AS location,
          CAST(month_num AS INTEGER) AS month_num,
          TRY_CAST('20' || split_part(month, '-', 2) AS INTEGER) AS year,
          amount AS net_sales,
          '20' || split_part(fy, '-', CASE WHEN month_num >= 4 THEN 1 ELSE 2 END) || '-' ||
            lpad(CAST(month_num AS VARCHAR), 2, '0') AS period,
          source_file
        FROM (SELECT *, TRY_CAST(replace(net_sales, ',', '') AS DECIMAL(15,2)) AS amount,
                nullif(coalesce(list_position(
                  ['JAN','FEB','MAR','APR','MAY','JUN','JUL','AUG','SEP','OCT','NOV','DEC'],
                  upper(split_part(month, '-', 1))), 0), 0) AS month_num
              FROM raw_sales)
        WHERE month IS NOT NULL AND fy IS NOT NULL AND amount IS NOT NULL""",
    "agg_sales": """
        SELECT brand, state, period, CAST(sum(net_sales) AS DECIMAL(25,2)) AS total_sales,
          count(*) AS transaction_count
        FROM clean_sales GROUP BY brand, state, period""",
    "base": """
        SELECT brand, state, period, CAST(try_strptime(period || '-01', '%Y-%m-%d') AS DATE) AS ds,
          CAST(total_sales AS DOUBLE) AS y,
          TRY_CAST(substr(period, 1, 4) AS INTEGER) AS year,
          TRY_CAST(substr(period, 6, 2) AS INTEGER) AS month,
          CAST(ceil(TRY_CAST(substr(period, 6, 2) AS INTEGER) / 3.0) AS INTEGER) AS quarter
        FROM agg_sales""",
    "history": """
        SELECT *, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 3) OVER w AS lag_3,
          avg(y) OVER (PARTITION BY brand, state ORDER BY ds NULLS LAST, period NULLS LAST
                       ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_avg_3
        FROM base WINDOW w AS (PARTITION BY brand, state ORDER BY ds NULLS LAST, period NULLS LAST)""",
    "features": "SELECT * FROM history WHERE lag_3 IS NOT NULL",
    "month_series": """
        SELECT p_brand AS brand, n_name AS state, CAST(date_trunc('month', l_shipdate) AS DATE) AS ds,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS y
        FROM sales_lines GROUP BY ALL""",
    "split": """
        SELECT *, rn <= n * 4 // 5 AS is_train, n * 4 // 5 AS n_train,
          (year(ds) - 2000) * 12 + month(ds) AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY brand, state ORDER BY ds) AS rn,
                count(*) OVER (PARTITION BY brand, state) AS n FROM month_series)""",
    "trend": """
        SELECT brand, state, count(*) AS n_train,
          CASE WHEN min(t) < max(t) THEN regr_slope(y, t) ELSE 0 END AS slope,
          CASE WHEN min(t) < max(t) THEN regr_intercept(y, t) ELSE avg(y) END AS intercept
        FROM split WHERE is_train AND n >= 10 GROUP BY brand, state""",
    "season": """
        SELECT brand, state, month, ratio / avg(ratio) OVER (PARTITION BY brand, state) AS month_factor
        FROM (SELECT s.brand, s.state, CAST(month(ds) AS INTEGER) AS month,
                avg(y / nullif(intercept + slope * t, 0)) AS ratio
              FROM split s JOIN trend USING (brand, state) WHERE is_train GROUP BY ALL)""",
    "scored": """
        SELECT s.brand, s.state, s.n_train, s.ds, s.y,
          (intercept + slope * t) * coalesce(month_factor, 1) AS yhat
        FROM split s JOIN trend USING (brand, state)
        LEFT JOIN season f ON f.brand = s.brand AND f.state = s.state AND f.month = month(s.ds)
        WHERE NOT is_train""",
    "metrics": """
        SELECT brand, state, n_train, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
          avg(abs((y - yhat) / nullif(y, 0))) * 100 AS mape, count(*) AS n,
          count(*) FILTER (WHERE y = 0) AS zero_actuals
        FROM scored GROUP BY brand, state, n_train""",
    "global_split": """
        SELECT *, rn <= n * 4 // 5 AS is_train, (year(ds) - 2000) * 12 + month(ds) AS t
        FROM (SELECT ds, sum(y) AS y, row_number() OVER (ORDER BY ds) AS rn, count(*) OVER () AS n
              FROM features WHERE ds IS NOT NULL GROUP BY ds)""",
    "global_trend": """
        SELECT count(*) AS n_train, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept
        FROM global_split WHERE is_train""",
    "global_season": """
        SELECT m, ratio / avg(ratio) OVER () AS month_factor
        FROM (SELECT month(ds) AS m, avg(y / (intercept + slope * t)) AS ratio
              FROM global_split, global_trend WHERE is_train GROUP BY 1)""",
    "global_scored": """
        SELECT n_train, ds, y, (intercept + slope * t) * coalesce(month_factor, 1) AS yhat
        FROM global_split CROSS JOIN global_trend LEFT JOIN global_season ON m = month(ds) WHERE NOT is_train""",
    "registry": """
        SELECT o_orderkey AS model_id, 'model_' || (o_custkey % 1000) AS model_name,
          'v' || o_orderkey AS model_version, 'TREND_SEASONAL' AS model_type, o_orderdate AS training_date,
          o_orderkey % 500 AS training_records, o_totalprice AS mae, o_totalprice * 1.25 AS rmse,
          (o_orderkey % 1000) / 10.0::DOUBLE AS mape,
          CASE WHEN o_orderkey % 10 = 0 THEN 'PRODUCTION' WHEN o_orderkey % 10 IN (1, 2, 3) THEN 'CANDIDATE'
               ELSE 'ARCHIVED' END AS status,
          CAST(NULL AS TIMESTAMP) AS promoted_date, CAST(NULL AS VARCHAR) AS notes
        FROM orders""",
    "pairs": """
        SELECT c.model_name, p.model_version AS production_model_version,
          c.model_version AS candidate_model_version, p.mae AS production_mae, c.mae AS candidate_mae,
          (p.mae - c.mae) / nullif(p.mae, 0) * 100 AS improvement_percent
        FROM (SELECT * FROM registry WHERE status = 'CANDIDATE'
              QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1) c
        LEFT JOIN (SELECT * FROM registry WHERE status = 'PRODUCTION'
              QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY training_date DESC, model_id DESC) = 1) p
        ON p.model_name = c.model_name""",
    "decisions": """
        SELECT *,
          CASE WHEN production_model_version IS NULL OR improvement_percent >= 5 THEN 'PROMOTE'
               ELSE 'KEEP_CURRENT' END AS decision,
          CASE WHEN production_model_version IS NULL THEN 'First model - no production to compare'
               WHEN improvement_percent >= 5
                 THEN 'MAE improved by ' || CAST(improvement_percent AS DECIMAL(18,2)) || '%'
               WHEN improvement_percent >= 0
                 THEN 'Improvement only ' || CAST(improvement_percent AS DECIMAL(18,2)) || '% (threshold: 5%)'
               WHEN improvement_percent < 0
                 THEN 'Candidate is worse by ' || CAST(-improvement_percent AS DECIMAL(18,2)) || '%'
               ELSE 'not comparable' END AS decision_reason
        FROM pairs""",
    "drift_log": """
        SELECT CAST(year(ds) * 12 + month(ds) AS BIGINT) AS drift_id, CAST(ds AS TIMESTAMP) AS check_date,
          CASE WHEN month(ds) % 3 = 0 THEN 'RECORD_COUNT' ELSE 'Y_MEAN' END AS metric_name,
          baseline_value, current_value, drift_score,
          CASE WHEN drift_score < 1 THEN 'NORMAL' WHEN drift_score < 3 THEN 'WARNING'
               ELSE 'CRITICAL' END AS drift_status
        FROM (SELECT *, abs((current_value - baseline_value) / baseline_value) * 100 AS drift_score
              FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ds,
                      avg(o_totalprice) AS current_value,
                      (SELECT avg(o_totalprice) FROM orders) AS baseline_value
                    FROM orders GROUP BY 1))""",
    "flagged": r"""
        SELECT *,
          NOT coalesce(regexp_matches(replace(net_sales, ',', ''),
            '(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$'),
            false) AS bad_net_sales,
          NOT coalesce(regexp_matches(upper(month),
            '^(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)-[0-9]{2}$'), false) AS bad_month,
          NOT coalesce(regexp_matches(fy, '^[0-9]{2}-[0-9]{2}$'), false) AS bad_fy
        FROM raw_sales""",
}

NEEDS = {
    "sales_lines": [],
    "keyed_raw": ["sales_lines"],
    "raw_sales": ["keyed_raw"],
    "clean_sales": ["raw_sales"],
    "agg_sales": ["clean_sales"],
    "base": ["agg_sales"],
    "history": ["base"],
    "features": ["history"],
    "month_series": ["sales_lines"],
    "split": ["month_series"],
    "trend": ["split"],
    "season": ["trend"],
    "scored": ["season"],
    "metrics": ["scored"],
    "global_split": ["features"],
    "global_trend": ["global_split"],
    "global_season": ["global_trend"],
    "global_scored": ["global_season"],
    "registry": [],
    "pairs": ["registry"],
    "decisions": ["pairs"],
    "drift_log": [],
    "flagged": ["raw_sales"],
}


def sql_over(*names: str, select: str) -> str:
    """``select`` with the named inputs, and all they need, in its WITH clause."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    clause = ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in wanted)
    return f"WITH {clause}\n{select}"
