"""Cleaning, monthly totals and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from monthline import schemas
from monthline.operators.features import agg_sales, clean_sales, feature_store, merge_agg
from monthline.parity import inputs as src
from monthline.parity.catalog import query
from monthline.parity.inputs import NOW, sql_over
from monthline.session import scratch_path
from monthline.sources.tables import read_replaced, replace_table

FEATURE_SQL = sql_over(
    "features",
    select="""
    SELECT row_number() OVER (ORDER BY brand NULLS LAST, state NULLS LAST, ds NULLS LAST, period NULLS LAST)
        AS feature_id, brand, state, period, ds, y, year, month, quarter, lag_1, lag_2, lag_3,
      round(rolling_avg_3, 4) AS rolling_avg_3
    FROM features""",
)


def flagship(spark, sf):
    """Raw text rows to numbered model features."""
    store = feature_store(src.agg(spark, sf), now=NOW)
    return store.withColumn("rolling_avg_3", F.round("rolling_avg_3", 4)).drop("created_at")


@query("clean_sales", sql_over("clean_sales", select="SELECT * FROM clean_sales"))
def clean(spark, sf):
    return src.clean(spark, sf)


@query(
    "fiscal_period",
    sql_over("clean_sales", select="SELECT month_num, period, count(*) AS row_count FROM clean_sales GROUP BY ALL"),
)
def periods(spark, sf):
    rows = src.clean(spark, sf)
    return rows.groupBy("month_num", "period").agg(F.count(F.lit(1)).alias("row_count"))


@query("agg_sales", sql_over("agg_sales", select="SELECT * FROM agg_sales"))
def totals(spark, sf):
    return src.agg(spark, sf)


@query("feature_base", sql_over("base", select="SELECT * FROM base"))
def base(spark, sf):
    return src.base(spark, sf)


@query("feature_store", FEATURE_SQL)
def store(spark, sf):
    return flagship(spark, sf)


@query("replace_table", FEATURE_SQL)
def stored(spark, sf):
    """The feature table written, replaced and read back."""
    path = scratch_path(spark, "feature-store")
    replace_table(feature_store(src.agg(spark, sf), now=NOW), path)
    replace_table(feature_store(src.agg(spark, sf), now=NOW), path)
    rows = read_replaced(spark, path, schemas.FEATURE_STORE)
    return rows.withColumn("rolling_avg_3", F.round("rolling_avg_3", 4)).drop("created_at")


@query(
    "feature_refresh_count",
    sql_over("features", select="SELECT count(*) AS feature_count FROM features"),
)
def refresh_count(spark, sf):
    return src.features(spark, sf).agg(F.count(F.lit(1)).alias("feature_count"))


@query("incremental_agg", sql_over("agg_sales", select="SELECT * FROM agg_sales"))
def incremental_agg(spark, sf):
    """Totals of two file lots, with the other two merged in afterwards."""
    raw = src.raw_sales(spark, sf)
    is_late = F.col("source_file").isin("batch_2.csv", "batch_3.csv")
    old = agg_sales(clean_sales(raw.filter(~is_late)))
    return merge_agg(old, clean_sales(raw.filter(is_late)))
