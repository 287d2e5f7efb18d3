"""Date spine generator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (dt.date, str)):
        return F.lit(str(v)).cast("date")
    raise TypeError(f"unsupported date bound {v!r}")


def date_spine(spark: SparkSession, start, end, name: str = "date_day",
               source: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end).

    ``start`` / ``end`` are dates or Columns. With ``source`` the bounds are aggregates over
    it (e.g. ``F.min('sale_date')``): the bounds are one aggregate row and the sequence is
    exploded from it. The spine has one row per calendar day, so its size is bounded by the
    span of the calendar, not by the data.
    """
    seq = F.sequence(_date(start), F.date_sub(_date(end), 1), F.expr("INTERVAL 1 DAY"))
    if source is None:
        base = spark.range(1).select(seq.alias("__days"))
    else:
        base = source.agg(seq.alias("__days"))
    return base.select(F.explode("__days").alias(name))


def days_between(start: dt.date, end: dt.date) -> int:
    return (end - start).days
