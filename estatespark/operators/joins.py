"""Join helpers: broadcast only behind a size check, with the shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_bound(df: DataFrame, max_rows: int) -> int:
    """Rows of ``df`` counted up to ``max_rows + 1`` (a bounded probe, never a full count of
    a large input)."""
    return df.limit(max_rows + 1).count()


def bounded_broadcast(df: DataFrame, max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows.

    ``known_rows`` (e.g. a row count recorded when a dimension was written, or the number of
    days of a calendar) skips the probe. Beyond the bound the frame is returned unhinted and
    the planner keeps a shuffle join; AQE may still convert it at runtime from real sizes.
    """
    n = known_rows if known_rows is not None else row_bound(df, max_rows)
    return F.broadcast(df) if n <= max_rows else df


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | list[str], max_rows: int,
                known_rows: int | None = None) -> DataFrame:
    """LEFT JOIN facts to a lookup table; the lookup is broadcast when provably small."""
    return facts.join(bounded_broadcast(lookup, max_rows, known_rows), on, "left")


def anti_join(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
              max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Non-null child keys with no parent row (orphans)."""
    p = parent.select(F.col(parent_key).alias("__parent_key"))
    return (child.where(F.col(child_key).isNotNull())
            .join(bounded_broadcast(p, max_rows, known_rows),
                  F.col(child_key) == F.col("__parent_key"), "left_anti"))
