"""Raw sales to clean rows, monthly totals and model features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from monthline import schemas
from monthline.functions import dates
from monthline.functions.numbers import to_amount, to_whole
from monthline.functions.text import part, upper_trim
from monthline.operators.forecast import join_on_keys
from monthline.operators.row_id import with_row_id
from monthline.operators.series import with_history_chunked

SERIES = ["brand", "state"]
MONTHLY = [*SERIES, "period"]
FEATURE_ORDER = [*SERIES, "ds", "period"]


def clean_sales(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalised rows; rows without month, fiscal year or a readable amount are dropped.

    Columns in ``keep`` stay as they are.
    """
    return (
        raw.withColumn("amount", to_amount(F.col("net_sales")))
        .filter(F.col("month").isNotNull() & F.col("fy").isNotNull() & F.col("amount").isNotNull())
        .withColumn("month_num", dates.month_number(part(F.col("month"), 1)))
        .select(
            upper_trim(F.col("material_group")).alias("brand"),
            upper_trim(F.col("material_description")).alias("product"),
            upper_trim(F.col("sold_state")).alias("state"),
            upper_trim(F.col("supply_location")).alias("location"),
            "month_num",
            to_whole(F.concat(F.lit("20"), part(F.col("month"), 2))).alias("year"),
            F.col("amount").alias("net_sales"),
            dates.fiscal_period(F.col("month_num"), F.col("fy")).alias("period"),
            "source_file",
            *keep,
        )
    )


def agg_sales(clean: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals per brand, state and period (and the columns ``by``); NULLs form groups of their own."""
    return clean.groupBy(*by, *MONTHLY).agg(
        F.sum("net_sales").alias("total_sales"), F.count(F.lit(1)).alias("transaction_count")
    )


def combine_agg(parts: DataFrame) -> DataFrame:
    """Sum up partial monthly totals: sums and counts are additive.

    Parts may be negative, where rows have been taken back; a month without rows is no month.
    """
    total_type = schemas.AGG_SALES["total_sales"].dataType
    return (
        parts.groupBy(*MONTHLY)
        .agg(
            F.sum("total_sales").cast(total_type).alias("total_sales"),
            F.sum("transaction_count").alias("transaction_count"),
        )
        .filter("transaction_count > 0")
    )


def merge_agg(old_agg: DataFrame, new_clean: DataFrame) -> DataFrame:
    """Monthly totals of old and new rows without reading the old rows again."""
    return combine_agg(old_agg.unionByName(agg_sales(new_clean)))


def feature_base(agg: DataFrame) -> DataFrame:
    """Date parts and value of each monthly total; unreadable periods get NULL dates."""
    month = F.substring("period", 6, 2).try_cast("int")
    return agg.select(
        *MONTHLY,
        dates.month_start(F.col("period")).alias("ds"),
        F.col("total_sales").cast("double").alias("y"),
        F.substring("period", 1, 4).try_cast("int").alias("year"),
        month.alias("month"),
        dates.quarter_of(month).alias("quarter"),
    )


def feature_history(base: DataFrame, position: str | None = None) -> DataFrame:
    """Lag and rolling columns per series, dated rows first, undated ones by period.

    Series of every length go the same way, in chunks of fixed size.
    """
    return with_history_chunked(base, SERIES, ["ds", "period"], "y", 3, position=position)


def feature_rows(agg: DataFrame, min_lag: int = 3, place: str | None = None) -> DataFrame:
    """Features of all rows with at least ``min_lag`` earlier months; ``place`` names a column for a row's place in its series, from 1."""
    if place is None:
        return feature_history(feature_base(agg)).filter(F.col(f"lag_{min_lag}").isNotNull())
    rows = feature_history(feature_base(agg), place).filter(F.col(f"lag_{min_lag}").isNotNull())
    first = rows.groupBy(*SERIES).agg(F.min(place).alias("_first"))
    return join_on_keys(rows, first, SERIES).withColumn(place, F.col(place) - F.col("_first") + 1).drop("_first")


def feature_store(agg: DataFrame, min_lag: int = 3, now: datetime | None = None) -> DataFrame:
    """``feature_rows`` with a dense id in brand, state, date order and a creation time."""
    numbered = with_row_id(feature_rows(agg, min_lag), FEATURE_ORDER, "feature_id")
    return numbered.withColumn("created_at", dates.moment(now)).select(*schemas.FEATURE_STORE.names)


def series_lengths(features: DataFrame) -> DataFrame:
    """Rows per series, longest first."""
    return (
        features.groupBy(*SERIES)
        .agg(F.count(F.lit(1)).alias("periods"))
        .orderBy(F.desc("periods"), *[F.col(k).asc_nulls_last() for k in SERIES])
    )


def feature_preview(features: DataFrame, n: int = 20) -> DataFrame:
    """The first n feature rows by date."""
    return (
        features.orderBy(*[F.col(c).asc_nulls_last() for c in ("ds", *SERIES, "period")])
        .select(*SERIES, "ds", "y", "lag_1", "lag_2", "lag_3", "rolling_avg_3")
        .limit(n)
    )
