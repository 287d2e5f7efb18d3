"""The declared column tests of every layer, run as one summary query per check type,
plus row-count reconciliation between layers and lookup coverage."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.joins import bounded_broadcast, lookup_join
from ..operators.quality import (accepted_values_count, not_null_counts, relationship_counts,
                                 union_all, unique_count)
from . import models as M
from .star import NOT_NULL_COLUMNS, Star

# The declared tests (relation, column) per check, in declaration order.
UNIQUE_TESTS = (
    ("raw", "transaction_id"),
    ("stg", "transaction_id"),
    ("boroughs", "postcode_district"),
    ("enriched", "transaction_id"),
    ("priced", "transaction_id"),
    ("flagged", "transaction_id"),
    ("dim_date", "date_key"),
    ("dim_location", "location_key"),
    ("dim_property", "property_key"),
    ("dim_property", "property_type_code"),
    ("fact", "transaction_key"),
)

NOT_NULL_TESTS = (
    ("raw", ("transaction_id", "price", "sale_date", "postcode", "source_year")),
    ("stg", ("transaction_id", "price", "sale_date", "postcode", "property_type", "tenure",
             "sale_year", "postcode_area", "postcode_district")),
    ("boroughs", ("postcode_district", "borough")),
    ("enriched", ("transaction_id", "price", "borough", "postcode_district")),
    ("priced", ("transaction_id", "price_band", "market_segment")),
    ("flagged", ("transaction_id", "is_central_london", "is_million_plus", "is_flat",
                 "is_leasehold")),
    *NOT_NULL_COLUMNS,
)

ACCEPTED_VALUES_TESTS = (
    ("stg", "property_type", ("Detached", "Semi-Detached", "Terraced", "Flat", "Other", "Unknown")),
    ("stg", "tenure", ("Freehold", "Leasehold", "Unknown")),
    ("priced", "price_band", tuple(l for _, l in C.PRICE_BANDS) + (C.TOP_PRICE_BAND,)),
    ("priced", "market_segment", tuple(l for _, l in C.MARKET_SEGMENTS) + (C.TOP_MARKET_SEGMENT,)),
    ("dim_location", "london_region", tuple(r for _, r in C.REGION_BY_AREA) + (C.OTHER_REGION,)),
    ("dim_property", "property_category",
     (C.PROPERTY_CATEGORY_HOUSE, C.PROPERTY_CATEGORY_FLAT, C.PROPERTY_CATEGORY_OTHER)),
)

RELATIONSHIP_TESTS = (
    ("fact", "date_key", "dim_date", "date_key"),
    ("fact", "location_key", "dim_location", "location_key"),
    ("fact", "property_key", "dim_property", "property_key"),
)

ROW_COUNT_LAYERS = ("raw", "stg", "enriched", "priced", "flagged", "fact")


def relations(spark, sf_dir: str, cfg):
    """All layers by name, and the materialised star."""
    from . import layers as P
    st = P.star(spark, sf_dir, cfg)
    raw = P.raw(spark, sf_dir)
    stg = P.stg(spark, sf_dir)
    boroughs = P.boroughs(spark, sf_dir)
    enr = P.enriched(spark, sf_dir, cfg)
    pr = P.priced(spark, sf_dir, cfg)
    fl = P.flagged(spark, sf_dir, cfg)
    return OrderedDict(raw=raw, stg=stg, boroughs=boroughs, enriched=enr, priced=pr, flagged=fl,
                       dim_date=st.dim_date, dim_location=st.dim_location,
                       dim_property=st.dim_property, fact=st.fact), st


# Layers that are the raw rows with columns added (and rows dropped by staging): one pass
# over raw serves them all.
RAW_LAYERS = ("raw", "stg", "enriched", "priced", "flagged")


def layer_rows(rels, cfg) -> DataFrame:
    """Every raw row with the columns of all its layers, and how often each layer has it.

    ``__raw`` holds the raw columns; ``__w_<layer>`` is the row's weight: 0 or 1 in stg, and
    in the layers behind the lookup as many rows as the lookup finds (at least one).
    """
    raw = rels["raw"]
    once = rels["boroughs"].groupBy("postcode_district").agg(
        F.min("borough").alias("borough"), F.count(F.lit(1)).alias("__matches"))
    wide = M.staged_columns(raw, F.struct(*raw.columns).alias("__raw"), M.is_staged().alias("__staged"))
    joined = lookup_join(wide, once, "postcode_district", cfg.broadcast_max_rows).withColumn(
        "borough", F.coalesce("borough", F.lit(C.UNMATCHED_BOROUGH)))
    staged = F.col("__staged").cast("bigint")
    behind = staged * F.coalesce("__matches", F.lit(1).cast("bigint"))
    weights = {"raw": F.lit(1).cast("bigint"), "stg": staged, "enriched": behind, "priced": behind, "flagged": behind}
    return M.flagged(M.priced(joined, cfg), cfg, rels["stg"]).withColumns(
        {f"__w_{layer}": w for layer, w in weights.items()})


def _of(layer: str, column: str) -> F.Column:
    return F.col("__raw")[column] if layer == "raw" else F.col(column)


def unique_summary(rels, wide) -> DataFrame:
    """The raw rows' layers share one shuffle of the ids."""
    ids = [layer for layer in RAW_LAYERS if (layer, "transaction_id") in UNIQUE_TESTS]
    per_id = (wide.where(F.col("transaction_id").isNotNull()).groupBy("transaction_id")
              .agg(*[F.sum(f"__w_{layer}").alias(layer) for layer in ids]))
    counts = per_id.agg(*[F.count_if(F.col(layer) > 1).alias(layer) for layer in ids])
    stacked = counts.unpivot([], ids, "relation", "failures").select(
        F.lit("unique").alias("check_name"), "relation", F.lit("transaction_id").alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"))
    return union_all([stacked] + [unique_count(rels[r], r, c) for r, c in UNIQUE_TESTS
                                  if not (r in ids and c == "transaction_id")])


def not_null_summary(rels, wide) -> DataFrame:
    """One pass for the raw rows' layers, one for each other relation."""
    tests = [(r, c) for r, cols in NOT_NULL_TESTS if r in RAW_LAYERS for c in cols]
    counts = wide.agg(*[F.coalesce(F.sum(F.when(_of(r, c).isNull(), F.col(f"__w_{r}"))), F.lit(0)).alias(f"{r}.{c}")
                        for r, c in tests])
    stacked = counts.select(F.inline(F.array(*[
        F.struct(F.lit("not_null").alias("check_name"), F.lit(r).alias("relation"), F.lit(c).alias("column_name"),
                 F.col(f"`{r}.{c}`").cast("bigint").alias("failures")) for r, c in tests])))
    return union_all([stacked] + [not_null_counts(rels[r], r, cols) for r, cols in NOT_NULL_TESTS
                                  if r not in RAW_LAYERS])


def accepted_values_summary(rels, wide) -> DataFrame:
    """Distinct unexpected values; only those leave the one pass over the raw rows' layers."""
    tests = [(r, c, v) for r, c, v in ACCEPTED_VALUES_TESTS if r in RAW_LAYERS]
    found = F.array(*[F.when((F.col(f"__w_{r}") > 0) & _of(r, c).isNotNull() & ~_of(r, c).isin(list(v)),
                             F.struct(F.lit(i).alias("test"), _of(r, c).cast("string").alias("value")))
                      for i, (r, c, v) in enumerate(tests)])
    bad = (wide.select(F.inline(F.filter(found, lambda x: x.isNotNull()))).distinct()
           .agg(*[F.count_if(F.col("test") == i).alias(f"t{i}") for i in range(len(tests))]))
    stacked = bad.select(F.inline(F.array(*[
        F.struct(F.lit("accepted_values").alias("check_name"), F.lit(r).alias("relation"),
                 F.lit(c).alias("column_name"), F.col(f"t{i}").cast("bigint").alias("failures"))
        for i, (r, c, _) in enumerate(tests)])))
    return union_all([stacked] + [accepted_values_count(rels[r], r, c, v) for r, c, v in ACCEPTED_VALUES_TESTS
                                  if r not in RAW_LAYERS])


def relationships_summary(rels, star) -> DataFrame:
    known = {"dim_date": star.date_rows, "dim_location": star.location_rows,
             "dim_property": star.property_rows}
    cap = star.cfg.broadcast_max_rows
    by_child: "OrderedDict[str, list]" = OrderedDict()
    for r, c, pr, pc in RELATIONSHIP_TESTS:
        by_child.setdefault(r, []).append((c, rels[pr], pc, known.get(pr)))
    return union_all([relationship_counts(rels[r], r, tests, cap) for r, tests in by_child.items()])


def row_counts(rels, wide) -> DataFrame:
    """Rows per layer and source year: the reconciliation between layers, raw read once."""
    per = wide.groupBy("source_year").agg(*[F.sum(f"__w_{layer}").alias(layer) for layer in RAW_LAYERS])
    stacked = per.unpivot(["source_year"], list(RAW_LAYERS), "layer", "rows").where("rows > 0")
    fact = rels["fact"].groupBy("source_year").agg(F.count(F.lit(1)).alias("rows"))
    return union_all([stacked.select("layer", "source_year", "rows"),
                      fact.select(F.lit("fact").alias("layer"), "source_year", "rows")])


def coverage(enriched: DataFrame) -> DataFrame:
    """Share of sales whose district found no borough in the lookup."""
    by = enriched.groupBy((F.col("borough") == F.lit(C.UNMATCHED_BOROUGH)).alias("is_unmatched")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return by.select("is_unmatched", "rows",
                     F.round(F.col("rows").cast("double") * F.lit(100.0) / total.cast("double"), 2)
                     .alias("share_pct"))


def observed_summary(star: Star) -> DataFrame:
    """Rows and NULLs of the marts' tested columns, as counted while the marts were written: the
    star's own writes are the only pass over the data."""
    spark = star.fact.sparkSession
    rows = [("not_null", r, c, star.observed[r][c], star.observed[r]["__rows"]) for r, cols in NOT_NULL_COLUMNS for c in cols]
    return spark.createDataFrame(rows, "check_name string, relation string, column_name string, failures long, rows long")


KEYS = {"boroughs": "postcode_district", "dim_date": "date_key", "dim_location": "location_key", "dim_property": "property_key",
        "fact": "transaction_key"}


def _failure(check: str, relation: str, column: str, value: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(relation).alias("relation"), F.lit(column).alias("column_name"),
                    value.cast("string").alias("value"))


def _failed(rows: DataFrame, key: Column, tests: list[Column]) -> DataFrame:
    """check_name, relation, column_name, value, key of the tests that fail: ``tests`` are arrays of
    failures, NULL where a row passes. Rows without a failure make no row."""
    found = F.flatten(F.filter(F.array(*tests), lambda x: x.isNotNull()))
    return rows.select(key.cast("string").alias("key"), F.inline(found))


def _row_tests(relation: str, of) -> list[tuple[Column, Column]]:
    """(whether a row fails, the failure) for the not-null and accepted-values tests of a relation."""
    nulls = [(of(c).isNull(), _failure("not_null", r, c, F.lit(None))) for r, cols in NOT_NULL_TESTS if r == relation for c in cols]
    values = [(of(c).isNotNull() & ~of(c).isin(list(v)), _failure("accepted_values", r, c, of(c)))
              for r, c, v in ACCEPTED_VALUES_TESTS if r == relation]
    return nulls + values


def _repeated(df: DataFrame, column: str, name: str) -> DataFrame:
    """The values of a column that occur more than once, and how often."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(f"__{name}_key")).agg(F.count(F.lit(1)).alias(name))
            .where(F.col(name) > 1))


def failing_rows(rels, wide: DataFrame, star: Star) -> DataFrame:
    """Every row that fails one of the declared tests: check_name, relation, column_name, key, value.

    A row gets an array of the tests it fails, which is exploded for failing rows only. Repeated keys
    come from a count of each key (no window) that is joined back; where few are repeated, AQE turns
    that into a broadcast. key is the row's key, value the failing value (NULL for not_null); a row
    that a layer behind the lookup has twice fails there twice.
    """
    ids = [r for r in RAW_LAYERS if (r, "transaction_id") in UNIQUE_TESTS]
    per_id = (wide.where(F.col("transaction_id").isNotNull()).groupBy("transaction_id")
              .agg(*[F.sum(f"__w_{r}").alias(f"__n_{r}") for r in ids])
              .where(" or ".join(f"__n_{r} > 1" for r in ids)))
    raw = wide.join(per_id, "transaction_id", "left")
    tests = []
    for r in RAW_LAYERS:
        checks = _row_tests(r, lambda c, r=r: _of(r, c))
        if r in ids:
            checks.append((F.col(f"__n_{r}") > 1, _failure("unique", r, "transaction_id", F.col("transaction_id"))))
        tests += [F.when(bad & (F.col(f"__w_{r}") > 0), F.array_repeat(what, F.col(f"__w_{r}").cast("int"))) for bad, what in checks]
    parts = [_failed(raw, F.col("transaction_id"), tests)]
    cap = star.cfg.broadcast_max_rows
    known = {"dim_date": star.date_rows, "dim_location": star.location_rows, "dim_property": star.property_rows}
    for r, key in KEYS.items():
        rows, checks = rels[r], _row_tests(r, F.col)
        for i, c in enumerate(c for t, c in UNIQUE_TESTS if t == r):
            rows = rows.join(_repeated(rels[r], c, f"__n{i}"), F.col(c) == F.col(f"____n{i}_key"), "left")
            checks.append((F.col(f"__n{i}") > 1, _failure("unique", r, c, F.col(c))))
        for i, (_, c, parent, pc) in enumerate(t for t in RELATIONSHIP_TESTS if t[0] == r):
            there = rels[parent].select(F.col(pc).alias(f"__p{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
            rows = rows.join(bounded_broadcast(there, cap, known.get(parent)), F.col(c) == F.col(f"__p{i}"), "left")
            checks.append((F.col(c).isNotNull() & F.col(f"__hit{i}").isNull(), _failure("relationships", r, c, F.col(c))))
        parts.append(_failed(rows, F.col(key), [F.when(bad, F.array(what)) for bad, what in checks]))
    return union_all(parts).select("check_name", "relation", "column_name", "key", "value")
