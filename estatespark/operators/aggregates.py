"""Aggregate operators: price statistics, conditional pivot, frequency tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .median import N, weighted_mean, weighted_stddev


def price_stats(price: str = "sale_price", digits: int = 0,
                which: Sequence[str] = ("transactions", "avg_price")) -> list[Column]:
    """Common measures over a table of price counts (``operators.median``): count, rounded mean,
    min, max, sample stddev, coefficient of variation. Every one is partial-aggregated map-side."""
    p, n = F.col(price), F.col(N)
    exprs = {
        "transactions": F.sum(n).alias("transactions"),
        "avg_price": F.round(weighted_mean(price), digits).alias("avg_price"),
        "min_price": F.min(p).alias("min_price"),
        "max_price": F.max(p).alias("max_price"),
        "price_stddev": F.round(weighted_stddev(price), digits).alias("price_stddev"),
        "price_volatility_ratio":
            F.round(weighted_stddev(price) / weighted_mean(price), 3).alias("price_volatility_ratio"),
        "total_volume": F.sum(p * n).alias("total_volume"),
    }
    return [exprs[w] for w in which]


BITMAP_BITS = 32_768  # numbers in one of Spark's bitmaps


def distinct_numbers(number: str, most: int) -> Column:
    """How many of the dense numbers 1 to ``most`` occur: one bitmap for each 32,768 of them, so the
    state is bounded by ``most`` bits and merges map-side. NULLs are not counted."""
    x = F.col(number).cast("bigint")
    counts = []
    for b in range(1, max(1, -(-most // BITMAP_BITS)) + 1):
        bit = F.when(F.bitmap_bucket_number(x) == F.lit(b), F.bitmap_bit_position(x))
        counts.append(F.bitmap_count(F.bitmap_construct_agg(bit)))
    return reduce(lambda a, b: a + b, counts)


def conditional_pivot(df: DataFrame, keys: Sequence[str], pivot_col: str,
                      categories: Sequence[tuple[object, str]],
                      measures: Sequence[tuple[str, str]]) -> DataFrame:
    """Pivot a (keys, category) -> measures table to one row per key.

    ``categories`` = [(value, prefix)], ``measures`` = [(column, suffix)]; the output column
    is ``prefix + suffix``. A category with no row gives 0 (sum of an empty CASE ... ELSE 0),
    not NULL. The input is already aggregated (few rows per key), so this is a small
    second aggregation.
    """
    aggs = []
    for value, prefix in categories:
        hit = F.col(pivot_col) == F.lit(value)
        for m, suffix in measures:
            aggs.append(F.sum(F.when(hit, F.col(m)).otherwise(F.lit(0))).alias(prefix + suffix))
    return df.groupBy(*keys).agg(*aggs)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency table of one column (NULL is a value of its own)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows by ``order`` (TakeOrderedAndProject: per-partition top-k, then a
    k-row merge; never a global sort). ``order`` must end in a unique tie-break."""
    return df.orderBy(*order).limit(k)
