"""Window operators over aggregated series (one row per group and period)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pct_change


def with_previous(df: DataFrame, partition: Sequence[str], order: Sequence[str | Column],
                  columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Add LAG(col) for each (col, alias) within ``partition`` ordered by ``order``.

    An empty ``partition`` is a single ordered series; use it only on aggregated input
    (a handful of periods), never on detail rows.
    """
    w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
    return df.select("*", *[F.lag(c).over(w).alias(a) for c, a in columns])


def change_columns(pairs: Sequence[tuple[str, str, str, int | None]]) -> list[Column]:
    """(new, old, alias, digits): absolute change when digits is None, else rounded percent."""
    out = []
    for new, old, alias, digits in pairs:
        out.append((F.col(new) - F.col(old) if digits is None
                    else pct_change(new, old, digits)).alias(alias))
    return out


def rank_within(partition: Sequence[str], order: Sequence[Column]) -> Column:
    """RANK with gaps: ties share a rank."""
    return F.rank().over(Window.partitionBy(*partition).orderBy(*order))


def tile_within(n: int, partition: Sequence[str], order: Sequence[Column]) -> Column:
    """NTILE(n); ``order`` should end in a unique tie-break so boundary ties are stable."""
    return F.ntile(n).over(Window.partitionBy(*partition).orderBy(*order))
