"""Validation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline.functions import fixed
from monthline.operators.validation import (
    apply_rules,
    check_counts,
    check_rules,
    failing,
    flag_rows,
    quarantine_sides,
    summarise,
    total_counts,
    validate,
)
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import NOW, sql_over
from monthline.session import scratch_path
from monthline.sources.sales_csv import read_sales_csv
from monthline.sources.tables import load_rules, read_replaced, rules_frame

FLAGS_SQL = """material_group IS NULL AS null_material_group, sold_state IS NULL AS null_sold_state,
  net_sales IS NULL AS null_net_sales, month IS NULL AS null_month, fy IS NULL AS null_fy,
  bad_net_sales, bad_month, bad_fy"""

COUNTS_SQL = """count(*) AS total_records,
  count(*) FILTER (WHERE NOT (bad_net_sales OR bad_month OR bad_fy)) AS valid_records,
  count(*) FILTER (WHERE bad_net_sales OR bad_month OR bad_fy) AS invalid_records,
  round(count(*) FILTER (WHERE bad_net_sales OR bad_month OR bad_fy) / count(*) * 100, 4) AS error_rate,
  CASE WHEN count(*) FILTER (WHERE bad_net_sales OR bad_month OR bad_fy) / count(*) * 100 <= 5
    THEN 'PASSED' ELSE 'FAILED' END AS validation_status"""


@query(
    "csv_null_tokens",
    sql_over(
        "raw_sales",
        select="SELECT material_group, trim(sold_state) AS sold_state, month, fy, net_sales FROM raw_sales",
    ),
)
def csv_null_tokens(spark, sf):
    """The written files hold every token for a missing value; all of them are read as NULL."""
    good, _ = read_sales_csv(spark, src.write_sales_files(spark, sf))
    return good.select("material_group", "sold_state", "month", "fy", "net_sales")


@query(
    "validate_row_flags",
    sql_over("flagged", select=f"SELECT month, fy, net_sales, {FLAGS_SQL}, "
             "NOT (bad_net_sales OR bad_month OR bad_fy) AS is_valid FROM flagged"),
)
def validate_row_flags(spark, sf):
    flagged = flag_rows(src.raw_sales(spark, sf))
    flags = [c for c in flagged.columns if c.startswith(("null_", "bad_"))]
    return flagged.select("month", "fy", "net_sales", *flags, "is_valid")


@query(
    "validate_batch_summary",
    sql_over(
        "flagged",
        select=f"SELECT 'ALL' AS scope, {COUNTS_SQL} FROM flagged UNION ALL "
        f"SELECT source_file, {COUNTS_SQL} FROM flagged GROUP BY source_file",
    ),
)
def validate_batch_summary(spark, sf):
    """Per file, and the whole table summed up from the files."""
    counts = check_counts(src.raw_sales(spark, sf), ["source_file"])
    columns = [
        "total_records",
        "valid_records",
        "invalid_records",
        F.round("error_rate", 4).alias("error_rate"),
        "validation_status",
    ]
    whole = summarise(total_counts(counts), "all", now=NOW).select(F.lit("ALL").alias("scope"), *columns)
    per_file = summarise(counts, "all", ["source_file"], now=NOW).select(
        F.col("source_file").alias("scope"), *columns
    )
    return whole.unionByName(per_file)


@query(
    "validate_error_details",
    sql_over(
        "flagged",
        select="""
        SELECT unnest([x FOR x IN [
            CASE WHEN g > 0 THEN 'MATERIAL_GROUP has ' || g || ' null values' END,
            CASE WHEN s > 0 THEN 'SOLD_STATE has ' || s || ' null values' END,
            CASE WHEN v > 0 THEN 'NET_SALES has ' || v || ' null values' END,
            CASE WHEN m > 0 THEN 'MONTH has ' || m || ' null values' END,
            CASE WHEN f > 0 THEN 'FY has ' || f || ' null values' END,
            CASE WHEN bv > 0 THEN 'NET_SALES: ' || bv || ' non-numeric values' END,
            CASE WHEN bm > 0 THEN 'MONTH: ' || bm || ' invalid format' END,
            CASE WHEN bf > 0 THEN 'FY: ' || bf || ' invalid format' END] IF x IS NOT NULL]) AS message
        FROM (SELECT count(*) FILTER (WHERE material_group IS NULL) AS g,
            count(*) FILTER (WHERE sold_state IS NULL) AS s, count(*) FILTER (WHERE net_sales IS NULL) AS v,
            count(*) FILTER (WHERE month IS NULL) AS m, count(*) FILTER (WHERE fy IS NULL) AS f,
            count(*) FILTER (WHERE bad_net_sales) AS bv, count(*) FILTER (WHERE bad_month) AS bm,
            count(*) FILTER (WHERE bad_fy) AS bf FROM flagged)""",
    ),
)
def validate_error_details(spark, sf):
    return validate(src.raw_sales(spark, sf), "all", now=NOW).select(F.explode("error_details").alias("message"))


RULES_SQL = """
    SELECT 'MATERIAL_GROUP_EXISTS' AS rule_name, count(*) FILTER (WHERE material_group IS NULL) AS failing_rows FROM flagged
    UNION ALL SELECT 'NET_SALES_EXISTS', 0
    UNION ALL SELECT 'MONTH_EXISTS', 0
    UNION ALL SELECT 'FY_EXISTS', 0
    UNION ALL SELECT 'MATERIAL_GROUP_NOT_NULL', count(*) FILTER (WHERE material_group IS NULL) FROM flagged
    UNION ALL SELECT 'SOLD_STATE_NOT_NULL', count(*) FILTER (WHERE sold_state IS NULL) FROM flagged
    UNION ALL SELECT 'NET_SALES_NOT_NULL', count(*) FILTER (WHERE net_sales IS NULL) FROM flagged
    UNION ALL SELECT 'MONTH_NOT_NULL', count(*) FILTER (WHERE month IS NULL) FROM flagged
    UNION ALL SELECT 'FY_NOT_NULL', count(*) FILTER (WHERE fy IS NULL) FROM flagged
    UNION ALL SELECT 'NET_SALES_NUMERIC', count(*) FILTER (WHERE bad_net_sales) FROM flagged
    UNION ALL SELECT 'MONTH_FORMAT', count(*) FILTER (WHERE bad_month) FROM flagged
    UNION ALL SELECT 'FY_FORMAT', count(*) FILTER (WHERE bad_fy) FROM flagged
    UNION ALL SELECT 'NET_SALES_POSITIVE', count(*) FILTER (WHERE NOT coalesce(
      TRY_CAST(replace(net_sales, ',', '') AS DECIMAL(15,2)) > 0, false)) FROM flagged"""


@query("validation_rule_engine", sql_over("flagged", select=RULES_SQL))
def validation_rule_engine(spark, sf):
    return apply_rules(src.raw_sales(spark, sf), rules_frame(spark))


@query("truncate_reload_rules", sql_over("flagged", select=RULES_SQL))
def truncate_reload_rules(spark, sf):
    """Refill the stored rule table, read it back and apply it."""
    path = scratch_path(spark, "rules")
    load_rules(spark, [("OLD", "NULL_CHECK", "FY", "FY IS NOT NULL")], path)
    load_rules(spark, fixed.VALIDATION_RULES, path)
    return apply_rules(src.raw_sales(spark, sf), read_replaced(spark, path))


CONDITIONS = [
    ("FY_LENGTH", "EXPRESSION", None, "length(fy) = 5"),
    ("SALES_RANGE", "EXPRESSION", None, "try_cast(replace(net_sales, ',', '') AS decimal(15,2)) BETWEEN 1000 AND 50000"),
    ("STATE_LIST", "EXPRESSION", None, "trim(sold_state) IN ('FRANCE', 'GERMANY', 'INDIA')"),
    ("MONTH_PATTERN", "EXPRESSION", None, "month LIKE '___-__'"),
    ("GROUP_IS_NO_STATE", "EXPRESSION", None, "material_group <> sold_state"),
    ("FY_NOT_NULL", "NULL_CHECK", "FY", "FY IS NOT NULL"),
    ("NO_SUCH_COLUMN", "EXPRESSION", None, "region = 'x'"),
]
_FAILS = "SELECT '{}' AS rule_name, count(*) FILTER (WHERE NOT coalesce({}, false)) AS failing_rows, false AS has_problem FROM raw_sales"
CONDITIONS_SQL = sql_over(
    "raw_sales",
    select=" UNION ALL ".join(_FAILS.format(name, condition) for name, _, _, condition in CONDITIONS[:-1])
    + " UNION ALL SELECT 'NO_SUCH_COLUMN', NULL, true",
)


@query("rule_conditions", CONDITIONS_SQL)
def rule_conditions(spark, sf):
    """Rules that are conditions of their own; one that cannot be read is reported beside the others' counts."""
    found = check_rules(src.raw_sales(spark, sf), rules_frame(spark, CONDITIONS))
    return found.select("rule_name", "failing_rows", F.col("problem").isNotNull().alias("has_problem"))


@query(
    "rule_net_sales_positive",
    sql_over(
        "raw_sales",
        select="SELECT source_file, net_sales FROM raw_sales WHERE NOT coalesce("
        "TRY_CAST(replace(net_sales, ',', '') AS DECIMAL(15,2)) > 0, false)",
    ),
)
def rule_net_sales_positive(spark, sf):
    raw = src.raw_sales(spark, sf)
    return raw.filter(failing(F.col("net_sales"), "positive")).select("source_file", "net_sales")


@query(
    "quarantine_split",
    sql_over(
        "flagged",
        select="SELECT material_group, material_description, sold_state, supply_location, month, fy, net_sales, "
        "source_file, CASE WHEN bad_net_sales OR bad_month OR bad_fy THEN 'bad' ELSE 'good' END AS side FROM flagged",
    ),
)
def quarantine_split(spark, sf):
    raw = src.raw_sales(spark, sf)
    return quarantine_sides(raw).select(*raw.columns, "side")
