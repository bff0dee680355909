"""Month parsing, month arithmetic and injected time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from monthline.functions import fixed
from monthline.functions.text import part


def moment(now: datetime | None = None) -> Column:
    """``now`` as timestamp without zone; the clock only if nothing was given."""
    if now is None:
        return F.localtimestamp()
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def month_number(token: Column) -> Column:
    """1..12 for a month token in any case, NULL otherwise."""
    return F.nullif(
        F.find_in_set(F.upper(token), F.lit(",".join(fixed.MONTH_TOKENS))), F.lit(0)
    )


def fiscal_period(month_num: Column, fy: Column) -> Column:
    """YYYY-MM: months from April on belong to the first year of ``YY-YY``, the rest to the second."""
    two_digit_year = F.when(
        month_num >= fixed.FISCAL_START_MONTH, part(fy, 1)
    ).otherwise(part(fy, 2))
    return F.concat(
        F.lit(fixed.CENTURY),
        two_digit_year,
        F.lit("-"),
        F.lpad(month_num.cast("string"), 2, "0"),
    )


def month_start(period: Column) -> Column:
    """First day of a YYYY-MM period; NULL if it is no such month."""
    return F.try_to_date(F.concat(period, F.lit("-01")), "yyyy-MM-dd")


def month_index(day: Column) -> Column:
    """Months since year 0: consecutive for consecutive months."""
    return F.year(day) * F.lit(12) + F.month(day)


def quarter_of(month: Column) -> Column:
    return F.ceil(month / F.lit(3.0)).cast("int")


def months_after(last: Column, count: Column) -> Column:
    """Array of the ``count`` month starts after ``last``; empty for count 0."""
    return F.when(
        count > 0,
        F.sequence(F.add_months(last, 1), F.add_months(last, count), F.expr("interval 1 month")),
    ).otherwise(F.array().cast("array<date>"))


def age_days(now: Column, then: Column) -> Column:
    """Whole calendar days between two timestamps."""
    return F.date_diff(now.cast("date"), then.cast("date"))


def version_tag(now: Column) -> Column:
    return F.date_format(now, "'v'yyyyMMdd_HHmmss")
