"""Data-quality checks as Spark queries.

Each check has a *failing rows* form (for investigation) and a *count* form used by the
suite summary ``(check_name, relation, column_name, failures)``. Counts are aggregates, so a
suite is one Spark job of independent stages; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import anti_join

SUMMARY_COLUMNS = ["check_name", "relation", "column_name", "failures"]


# ------------------------------------------------------------------ failing rows


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-null values occurring more than once, with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                          max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    return anti_join(child, parent, column, parent_column, max_rows, known_rows)


# ------------------------------------------------------------------ counts


def _row(check: str, relation: str, column: str, failures: Column) -> list[Column]:
    return [F.lit(check).alias("check_name"), F.lit(relation).alias("relation"),
            F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures")]


def unique_count(df: DataFrame, relation: str, column: str) -> DataFrame:
    return unique_failures(df, column).agg(*_row("unique", relation, column, F.count(F.lit(1))))


def not_null_counts(df: DataFrame, relation: str, columns: Sequence[str]) -> DataFrame:
    """All not-null checks of one relation in a single pass (one aggregate, then unpivot)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = agg.unpivot([], list(columns), "column_name", "failures")
    return stacked.select(F.lit("not_null").alias("check_name"), F.lit(relation).alias("relation"),
                          "column_name", F.col("failures").cast("bigint").alias("failures"))


def accepted_values_count(df: DataFrame, relation: str, column: str, values: Iterable) -> DataFrame:
    fails = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return fails.agg(*_row("accepted_values", relation, column, F.count_distinct(column)))


def relationship_count(child: DataFrame, relation: str, column: str, parent: DataFrame,
                       parent_column: str, max_rows: int, known_rows: int | None = None) -> DataFrame:
    fails = relationship_failures(child.select(column), column, parent, parent_column, max_rows,
                                  known_rows)
    return fails.agg(*_row("relationships", relation, column, F.count(F.lit(1))))


def relationship_counts(child: DataFrame, relation: str,
                        tests: Sequence[tuple[str, DataFrame, str, int | None]],
                        max_rows: int) -> DataFrame:
    """All relationship checks of one child relation in ONE scan of the child.

    ``tests`` = [(child column, parent frame, parent column, known parent rows)]. Each
    parent's distinct keys are LEFT-joined (broadcast when within ``max_rows``) with a
    presence marker; one aggregate counts non-null child keys whose marker is NULL, then the
    counts are unpivoted to one summary row per check.
    """
    from .joins import bounded_broadcast
    rows = child.select(*[c for c, _, _, _ in tests])
    for i, (c, parent, pc, known) in enumerate(tests):
        keys = (parent.select(F.col(pc).alias(f"__p{i}")).distinct()
                .withColumn(f"__hit{i}", F.lit(True)))
        rows = rows.join(bounded_broadcast(keys, max_rows, known),
                         F.col(c) == F.col(f"__p{i}"), "left")
    counts = rows.agg(*[F.count_if(F.col(c).isNotNull() & F.col(f"__hit{i}").isNull()).alias(c)
                        for i, (c, _, _, _) in enumerate(tests)])
    stacked = counts.unpivot([], [c for c, _, _, _ in tests], "column_name", "failures")
    return stacked.select(F.lit("relationships").alias("check_name"),
                          F.lit(relation).alias("relation"), "column_name",
                          F.col("failures").cast("bigint").alias("failures"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
