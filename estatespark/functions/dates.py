"""Calendar expressions on DATE columns (all stay DATE; no timestamp round trips)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col


def month_start(d) -> Column:
    return F.trunc(col(d), "month")


def quarter_start(d) -> Column:
    return F.trunc(col(d), "quarter")


def year_start(d) -> Column:
    return F.trunc(col(d), "year")


def month_end(d) -> Column:
    return F.last_day(col(d))


def quarter_end(d) -> Column:
    return F.last_day(F.add_months(quarter_start(d), 2))


def year_end(d) -> Column:
    return F.make_date(F.year(col(d)), F.lit(12), F.lit(31))


def day_of_week0(d) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col(d)) - F.lit(1)


def is_weekend(d) -> Column:
    return F.dayofweek(col(d)).isin(1, 7)


def month_name(d) -> Column:
    return F.date_format(col(d), "MMMM")


def month_short(d) -> Column:
    return F.date_format(col(d), "MMM")


def day_name(d) -> Column:
    return F.date_format(col(d), "EEEE")


def year_quarter(d) -> Column:
    """'2024-Q3'."""
    return F.concat(F.year(col(d)).cast("string"), F.lit("-Q"), F.quarter(col(d)).cast("string"))


def year_month(d) -> Column:
    """'2024-07'."""
    return F.concat(F.year(col(d)).cast("string"), F.lit("-"),
                    F.lpad(F.month(col(d)).cast("string"), 2, "0"))
