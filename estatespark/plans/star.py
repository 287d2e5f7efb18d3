"""Star schema: one fact, three dimensions with MD5 surrogate keys.

``build_star`` returns lazy frames; ``materialize_star`` writes them once (fact partitioned
by ``sale_year`` so year predicates prune files) and returns frames reading the written
tables together with their row counts, which later joins use as the broadcast size check.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions import code_map, flag_in, surrogate_key
from ..functions import dates as D
from ..operators.joins import bounded_broadcast
from ..operators.spine import date_spine, days_between

DIM_DATE_COLUMNS = [
    "date_key", "full_date", "year", "quarter", "month_number", "month_name", "month_short",
    "day_of_month", "day_of_week_number", "day_of_week_name", "week_of_year",
    "month_start_date", "month_end_date", "quarter_start_date", "quarter_end_date",
    "year_start_date", "year_end_date", "is_weekend", "year_quarter", "year_month",
]

FACT_COLUMNS = [
    "transaction_key", "date_key", "location_key", "property_key", "sale_price",
    "sale_price_million_plus", "transaction_count", "is_new_build", "tenure_is_leasehold",
    "tenure_label", "price_band", "market_segment", "is_central_london", "is_million_plus",
    "is_super_prime", "is_most_recent_year", "sale_date", "sale_year", "sale_quarter",
    "sale_month", "source_year", "loaded_at",
]


def date_attributes(spine: DataFrame, day: str = "date_day") -> DataFrame:
    d = F.col(day)
    return spine.select(
        d.alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month_number"),
        D.month_name(d).alias("month_name"),
        D.month_short(d).alias("month_short"),
        F.dayofmonth(d).alias("day_of_month"),
        D.day_of_week0(d).alias("day_of_week_number"),
        D.day_name(d).alias("day_of_week_name"),
        F.weekofyear(d).alias("week_of_year"),
        D.month_start(d).alias("month_start_date"),
        D.month_end(d).alias("month_end_date"),
        D.quarter_start(d).alias("quarter_start_date"),
        D.quarter_end(d).alias("quarter_end_date"),
        D.year_start(d).alias("year_start_date"),
        D.year_end(d).alias("year_end_date"),
        D.is_weekend(d).alias("is_weekend"),
        D.year_quarter(d).alias("year_quarter"),
        D.year_month(d).alias("year_month"),
    )


def dim_date(spark: SparkSession, cfg: Config) -> DataFrame:
    """Calendar dimension over the configured [start, end) range."""
    return date_attributes(date_spine(spark, cfg.calendar_start, cfg.calendar_end))


def dim_date_for(source: DataFrame, day_col: str = "sale_date") -> DataFrame:
    """Calendar dimension spanning whole years of the days present in ``source``."""
    start = F.trunc(F.min(day_col), "year")
    end = F.add_months(F.trunc(F.max(day_col), "year"), 12)
    return date_attributes(date_spine(source.sparkSession, start, end, source=source))


def dim_location(flagged: DataFrame, cfg: Config) -> DataFrame:
    """One row per (district, area, borough); partial DISTINCT map-side, tiny shuffle."""
    loc = flagged.select("postcode_district", "postcode_area", "borough").distinct()
    return loc.select(
        surrogate_key("postcode_district", "borough").alias("location_key"),
        "postcode_district",
        "postcode_area",
        "borough",
        flag_in("borough", cfg.central_boroughs).alias("is_central_london"),
        code_map("postcode_area", cfg.region_by_area, C.OTHER_REGION).alias("london_region"),
    )


def property_category(type_name) -> F.Column:
    t = F.col(type_name)
    return (F.when(t.isin(*C.HOUSE_TYPES), F.lit(C.PROPERTY_CATEGORY_HOUSE))
            .when(t == F.lit("Flat"), F.lit(C.PROPERTY_CATEGORY_FLAT))
            .otherwise(F.lit(C.PROPERTY_CATEGORY_OTHER)))


def dim_property(flagged: DataFrame) -> DataFrame:
    types = flagged.select("property_type_code", "property_type").distinct()
    return types.select(
        surrogate_key("property_type_code").alias("property_key"),
        "property_type_code",
        F.col("property_type").alias("property_type_name"),
        code_map("property_type", C.PROPERTY_DESCRIPTIONS,
                 C.UNKNOWN_PROPERTY_DESCRIPTION).alias("property_description"),
        property_category("property_type").alias("property_category"),
    )


def fact_transactions(flagged: DataFrame, cfg: Config) -> DataFrame:
    price = F.col("price")
    return flagged.select(
        F.col("transaction_id").alias("transaction_key"),
        F.col("sale_date").alias("date_key"),
        surrogate_key("postcode_district", "borough").alias("location_key"),
        surrogate_key("property_type_code").alias("property_key"),
        price.alias("sale_price"),
        F.when(price >= F.lit(cfg.million_plus), price).otherwise(F.lit(0).cast("bigint"))
        .alias("sale_price_million_plus"),
        F.lit(1).alias("transaction_count"),
        "is_new_build",
        F.col("is_leasehold").alias("tenure_is_leasehold"),
        F.col("tenure").alias("tenure_label"),
        "price_band",
        "market_segment",
        "is_central_london",
        "is_million_plus",
        "is_super_prime",
        "is_most_recent_year",
        "sale_date",
        "sale_year",
        "sale_quarter",
        "sale_month",
        "source_year",
        "loaded_at",
    )


@dataclass
class Star:
    fact: DataFrame
    dim_date: DataFrame
    dim_location: DataFrame
    dim_property: DataFrame
    cfg: Config
    date_rows: int | None = None
    location_rows: int | None = None
    property_rows: int | None = None
    root: str | None = None  # where the tables lie
    observed: dict[str, dict[str, int]] | None = None  # by table: its rows, and NULLs by tested column

    # Dimension sides of the star joins: broadcast behind the recorded size check.
    def locations(self, matched_only: bool = True) -> DataFrame:
        loc = self.dim_location
        if matched_only:
            loc = loc.where(F.col("borough") != F.lit(C.UNMATCHED_BOROUGH))
        return bounded_broadcast(loc, self.cfg.broadcast_max_rows, self.location_rows)

    def location_count(self) -> int:
        """Rows of the location dimension, all of them."""
        return self.dim_location.count() if self.location_rows is None else self.location_rows

    def numbered_locations(self) -> DataFrame:
        """Matched locations with dense numbers (from 1) of their boroughs and districts, for bitmaps.
        The numbers come from windows over the dimension's rows."""
        loc = self.dim_location.where(F.col("borough") != F.lit(C.UNMATCHED_BOROUGH)).withColumns({
            "borough_number": F.dense_rank().over(Window.orderBy("borough")),
            "district_number": F.dense_rank().over(Window.orderBy("postcode_district"))})
        return bounded_broadcast(loc, self.cfg.broadcast_max_rows, self.location_rows)

    def dates(self) -> DataFrame:
        return bounded_broadcast(self.dim_date, self.cfg.broadcast_max_rows, self.date_rows)

    def properties(self) -> DataFrame:
        return bounded_broadcast(self.dim_property, self.cfg.broadcast_max_rows, self.property_rows)

    def calendar_fact(self) -> DataFrame:
        """The fact restricted to the calendar span by predicates on its own columns.

        The inner join to ``dim_date`` drops sales outside the calendar anyway; stating the
        same range on ``date_key`` and ``sale_year`` (equal by construction) lets it reach
        the Parquet scan as pushed filters and partition pruning.
        """
        c = self.cfg
        last_day = c.calendar_end - dt.timedelta(days=1)
        return self.fact.where(
            (F.col("date_key") >= F.lit(str(c.calendar_start)).cast("date"))
            & (F.col("date_key") <= F.lit(str(last_day)).cast("date"))
            & (F.col("sale_year") >= F.lit(c.calendar_start.year))
            & (F.col("sale_year") <= F.lit(last_day.year)))


def build_star(spark: SparkSession, flagged: DataFrame, cfg: Config) -> Star:
    return Star(
        fact=fact_transactions(flagged, cfg),
        dim_date=dim_date(spark, cfg),
        dim_location=dim_location(flagged, cfg),
        dim_property=dim_property(flagged),
        cfg=cfg,
        date_rows=days_between(cfg.calendar_start, cfg.calendar_end),
    )


# The columns of the marts that are declared not null.
NOT_NULL_COLUMNS = (
    ("dim_date", ("date_key", "year", "quarter", "month_number")),
    ("dim_location", ("location_key", "postcode_district", "borough", "london_region")),
    ("dim_property", ("property_key", "property_type_code", "property_category")),
    ("fact", ("transaction_key", "date_key", "location_key", "property_key", "sale_price")),
)


def _write_observed(df: DataFrame, path: str, columns: tuple[str, ...], partition: str | None = None) -> dict[str, int]:
    """Writes a table and returns its rows and the NULLs of ``columns``, counted while writing."""
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return seen.get


def materialize_star(spark: SparkSession, star: Star, root: str) -> Star:
    """Write the marts as tables (drop and rebuild) and return frames over the files, with the
    row and NULL counts observed while they were written."""
    paths = {"fact": f"{root}/fact_transactions", "dim_date": f"{root}/dim_date", "dim_location": f"{root}/dim_location",
             "dim_property": f"{root}/dim_property"}
    frames = {"fact": star.fact, "dim_date": star.dim_date, "dim_location": star.dim_location, "dim_property": star.dim_property}
    tested = dict(NOT_NULL_COLUMNS)
    observed = {n: _write_observed(frames[n], paths[n], tested[n], "sale_year" if n == "fact" else None) for n in paths}
    return Star(
        fact=spark.read.parquet(paths["fact"]).select(*FACT_COLUMNS), dim_date=spark.read.parquet(paths["dim_date"]),
        dim_location=spark.read.parquet(paths["dim_location"]), dim_property=spark.read.parquet(paths["dim_property"]),
        cfg=star.cfg, date_rows=star.date_rows, location_rows=observed["dim_location"]["__rows"],
        property_rows=observed["dim_property"]["__rows"], root=root, observed=observed)
