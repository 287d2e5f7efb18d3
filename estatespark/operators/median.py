"""Exact medians and price statistics from one table of (keys, value) counts.

``value_counts`` scans the rows once and counts, for every (keys, value), the rows and those for
which each flag holds. A hot group spreads over its values there, and counts combine map-side. All
measures of a group come from these cells in one more aggregation: sums, means, deviations,
conditional counts and the exact median, a percentile weighted by the counts. So a statistic with
a median is two exchanges behind the scan, whatever the size.

What a task holds of a group is one number and count for each of its distinct values (prices in whole
pounds: some hundred thousand), never its rows.

The answer equals ``percentile(value, 0.5)`` over the rows: the middle value, or the mean of the two
middle values for an even count. NULL values are ignored; a group of NULLs has a NULL median.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N = "__n"


def value_counts(rows: DataFrame, keys: Sequence[str], value: str,
                 flags: Mapping[str, Column] | None = None) -> DataFrame:
    """keys, value, ``__n`` and a count for each flag: one row per (keys, value)."""
    counts = [F.count_if(c).alias(name) for name, c in (flags or {}).items()]
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(N), *counts)


def weighted_mean(value: str, weight: str = N) -> Column:
    """Mean of the value over the rows a weight counts; integral values are summed exactly."""
    known = F.when(F.col(value).isNotNull(), F.col(weight))
    total = F.sum(F.col(value) * F.col(weight))
    return total.cast("double") / F.nullif(F.sum(known), F.lit(0)).cast("double")


def weighted_stddev(value: str, weight: str = N) -> Column:
    """Sample standard deviation, from exact sums of the values and of their squares."""
    v = F.col(value).cast("decimal(19,0)")
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    n = F.sum(w).cast("double")
    s1 = F.sum(F.col(value) * F.col(weight)).cast("double")
    # counts in two parts, so that a cell of 10^8 rows or more overflows no product
    square = (v * v).cast("decimal(30,0)")
    low = F.sum(square * (F.col(weight) % F.lit(10**8)).cast("decimal(8,0)"))
    high = F.sum(square * F.expr(f"(`{weight}` div {10**8})").cast("decimal(11,0)"))
    s2 = low.cast("double") + high.cast("double") * F.lit(1e8)
    spread = F.greatest((s2 - s1 * s1 / F.nullif(n, F.lit(0.0))), F.lit(0.0))
    return F.sqrt(F.when(n > F.lit(1.0), spread / F.nullif(n - F.lit(1.0), F.lit(0.0))))


def weighted_median(value: str, weight: str = N) -> Column:
    """Exact median of the value over the rows a weight counts."""
    return F.percentile(F.col(value), F.lit(0.5), F.col(weight))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, alias: str = "median") -> DataFrame:
    """Exact median per group of plain rows; groups without a value have no row."""
    return (value_counts(df, keys, value).groupBy(*keys).agg(weighted_median(value).alias(alias))
            .where(F.col(alias).isNotNull()))


def stats_with_median(cells: DataFrame, keys: Sequence[str], value: str, aggs: Sequence[Column],
                      alias: str, digits: int = 0) -> DataFrame:
    """keys, ``aggs`` (over the cells) and the rounded median, one row per group."""
    return cells.groupBy(*keys).agg(*aggs, F.round(weighted_median(value), digits).alias(alias))
