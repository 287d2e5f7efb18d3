"""The marts by name: SQL functions, catalog views over the written tables, bucketed star tables.

``publish`` creates a database with a table for each mart, staging and KPI views over them and
SQL functions, so that a dashboard reads ``SELECT ... FROM <database>.v_market_health_summary``
with what the optimizer does for any query: year filters prune partitions through the view, and
only the columns asked for are read. A view holds no data and follows the tables it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..operators.joins import bounded_broadcast
from .star import Star


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(column: str, mapping, default: str | None) -> str:
    def lit(v):
        return str(v).upper() if isinstance(v, bool) else _text(v)
    whens = " ".join(f"WHEN {_text(k)} THEN {lit(v)}" for k, v in mapping)
    return f"CASE {column} {whens}" + (f" ELSE {_text(default)}" if default is not None else "") + " END"


def _pct(new: str, old: str, digits: int) -> str:
    return f"round((double({new}) - double({old})) * 100 / nullif(double({old}), 0), {digits})"


MEAN = "round(double(sum(sale_price)) / count(sale_price), 0)"
MEDIAN = "round(percentile(sale_price, 0.5), 0)"
BOROUGH = "borough, is_central_london, london_region"


def _in_calendar(cfg: Config) -> str:
    return (f"f.date_key >= DATE '{cfg.calendar_start}' AND f.date_key < DATE '{cfg.calendar_end}' "
            f"AND f.sale_year BETWEEN {cfg.calendar_start.year} AND {cfg.calendar_end.year - (cfg.calendar_end.month == 1)}")


def view_sql(db: str, cfg: Config) -> dict[str, str]:
    """The views' queries by name, in an order in which each names only earlier ones."""
    postcode = "upper(trim(postcode))"
    staged = f"""
SELECT *, year(sale_date) AS sale_year, month(sale_date) AS sale_month, quarter(sale_date) AS sale_quarter,
       date(trunc(sale_date, 'month')) AS sale_month_start, date(trunc(sale_date, 'quarter')) AS sale_quarter_start,
       regexp_substr(postcode, '^[A-Z]+') AS postcode_area, split_part(postcode, ' ', 1) AS postcode_district
FROM (SELECT transaction_id, price, try_to_date(left(sale_date, 10)) AS sale_date, {postcode} AS postcode,
             property_type AS property_type_code, {_case('property_type', C.PROPERTY_TYPES, C.UNKNOWN_LABEL)} AS property_type,
             new_build AS new_build_flag, {_case('new_build', C.NEW_BUILD, None)} AS is_new_build,
             tenure AS tenure_code, {_case('tenure', C.TENURES, C.UNKNOWN_LABEL)} AS tenure,
             upper(trim(town)) AS town, upper(trim(district)) AS district, upper(trim(county)) AS county,
             ppd_type AS ppd_type_code, {_case('ppd_type', C.PPD_TYPES, C.UNKNOWN_LABEL)} AS ppd_type, source_year, loaded_at
      FROM {db}.raw_sales WHERE price > 0 AND postcode IS NOT NULL AND sale_date IS NOT NULL)"""
    matched = f"""
SELECT f.*, l.borough, l.postcode_district, l.london_region, l.is_central_london AS borough_is_central
FROM {db}.fact_transactions f JOIN {db}.dim_location l ON f.location_key = l.location_key
WHERE l.borough <> {_text(C.UNMATCHED_BOROUGH)}"""
    dated = f"""
SELECT f.*, d.year, d.quarter, d.year_quarter, d.quarter_start_date
FROM {db}.v_matched_sales f JOIN {db}.dim_date d ON f.date_key = d.date_key WHERE {_in_calendar(cfg)}"""
    of_borough = f"(SELECT borough, borough_is_central AS is_central_london, london_region, year, quarter, year_quarter, " \
                 f"quarter_start_date, sale_price FROM {db}.v_dated_sales)"
    yearly = f"SELECT {BOROUGH}, year, count(*) AS transactions, {MEAN} AS avg_price, {MEDIAN} AS median_price " \
             f"FROM {of_borough} GROUP BY {BOROUGH}, year"
    trends = f"""
SELECT {BOROUGH}, year, quarter, year_quarter, quarter_start_date, count(*) AS transactions, {MEAN} AS avg_price,
       {MEDIAN} AS median_price, min(sale_price) AS min_price, max(sale_price) AS max_price,
       round(stddev_samp(sale_price), 0) AS price_stddev, round(stddev_samp(sale_price) / avg(sale_price), 3) AS price_volatility_ratio
FROM {of_borough} GROUP BY {BOROUGH}, year, quarter, year_quarter, quarter_start_date"""
    growth = f"""
SELECT {BOROUGH}, year, transactions, avg_price, median_price, prev_avg_price, prev_median_price,
       avg_price - prev_avg_price AS yoy_avg_change_gbp, median_price - prev_median_price AS yoy_median_change_gbp,
       {_pct('avg_price', 'prev_avg_price', 2)} AS yoy_avg_change_pct,
       {_pct('median_price', 'prev_median_price', 2)} AS yoy_median_change_pct,
       {_pct('transactions', 'prev_transactions', 2)} AS yoy_volume_change_pct
FROM (SELECT *, lag(avg_price) OVER w AS prev_avg_price, lag(median_price) OVER w AS prev_median_price,
             lag(transactions) OVER w AS prev_transactions
      FROM ({yearly}) WINDOW w AS (PARTITION BY borough ORDER BY year, london_region))"""
    velocity = f"""
SELECT {BOROUGH}, year, transactions, round(double(transactions) / 12, 0) AS avg_monthly_transactions,
       rank() OVER (PARTITION BY year ORDER BY transactions DESC) AS volume_rank,
       CASE ntile(4) OVER (PARTITION BY year ORDER BY transactions DESC, borough, london_region)
         {" ".join(f"WHEN {k} THEN {_text(v)}" for k, v in C.LIQUIDITY_TIERS)} END AS liquidity_tier
FROM (SELECT {BOROUGH}, year, count(*) AS transactions FROM {of_borough} GROUP BY {BOROUGH}, year)"""

    def dated_in(year: int) -> str:
        return f"sale_year = {year} AND date_key >= DATE '{cfg.calendar_start}' AND date_key < DATE '{cfg.calendar_end}'"
    first, last = dated_in(cfg.first_year), dated_in(cfg.last_year)
    mean_of = lambda when: f"double(sum(sale_price) FILTER (WHERE {when})) / nullif(count_if({when}), 0)"
    roi = f"""
SELECT borough, property_type_name, property_category, total_transactions, avg_price_overall, median_price_overall,
       round(avg_first, 0) AS avg_price_first_year, round(avg_last, 0) AS avg_price_last_year,
       {_pct('avg_last', 'avg_first', 2)} AS four_year_growth_pct, transactions_first_year, transactions_last_year
FROM (SELECT borough, property_type_name, property_category, count(*) AS total_transactions, {MEAN} AS avg_price_overall,
             {MEDIAN} AS median_price_overall, {mean_of(first)} AS avg_first, {mean_of(last)} AS avg_last,
             nullif(count_if({first}), 0) AS transactions_first_year, nullif(count_if({last}), 0) AS transactions_last_year
      FROM {db}.v_matched_sales f JOIN {db}.dim_property p ON f.property_key = p.property_key
      GROUP BY borough, property_type_name, property_category)
WHERE total_transactions >= {cfg.min_type_sales}"""
    bands = " ".join(f"WHEN postcode_median_price < borough_median_price * {r} THEN {_text(v)}" for r, v in cfg.value_positions)
    undervalued = f"""
SELECT borough, postcode_district, postcode_transactions, postcode_median_price, borough_median_price,
       postcode_median_price - borough_median_price AS price_gap_gbp,
       {_pct('postcode_median_price', 'borough_median_price', 1)} AS price_gap_pct,
       CASE {bands} ELSE {_text(cfg.top_value_position)} END AS value_position
FROM (SELECT *, round(percentile(postcode_median_price, 0.5) OVER (PARTITION BY borough), 0) AS borough_median_price
      FROM (SELECT borough, postcode_district, count(*) AS postcode_transactions, {MEDIAN} AS postcode_median_price
            FROM {db}.v_dated_sales WHERE year >= {cfg.recent_since_year} AND sale_year >= {cfg.recent_since_year}
            GROUP BY borough, postcode_district HAVING count(*) >= {cfg.min_postcode_sales}))"""

    def premium(one: str, other: str, is_one: str, is_other: str, prefix: str) -> str:
        med = lambda when: f"coalesce(round(percentile(sale_price, 0.5) FILTER (WHERE {when}), 0), 0)"
        return f"""
SELECT borough, {one}_txns, {other}_txns, {one}_median, {other}_median, {one}_median - {other}_median AS {prefix}premium_gbp,
       {_pct(f'{one}_median', f'{other}_median', 1)} AS {prefix}premium_pct
FROM (SELECT borough, count_if({is_one}) AS {one}_txns, count_if({is_other}) AS {other}_txns,
             {med(is_one)} AS {one}_median, {med(is_other)} AS {other}_median
      FROM {db}.v_matched_sales GROUP BY borough)
WHERE {one}_txns >= {cfg.min_segment_sales} AND {other}_txns >= {cfg.min_segment_sales}"""
    market = f"""
SELECT *, {_pct('total_transactions', 'prev_year_transactions', 2)} AS volume_yoy_change_pct,
       {_pct('median_price', 'prev_year_median', 2)} AS median_price_yoy_change_pct
FROM (SELECT *, lag(total_transactions) OVER (ORDER BY year) AS prev_year_transactions,
             lag(median_price) OVER (ORDER BY year) AS prev_year_median
      FROM (SELECT year, count(*) AS total_transactions, {MEAN} AS avg_price, {MEDIAN} AS median_price,
                   sum(sale_price) AS total_volume_gbp, count_if(is_million_plus) AS million_plus_transactions,
                   count_if(is_super_prime) AS super_prime_transactions, count_if(is_central_london) AS central_london_transactions,
                   count(DISTINCT borough) AS active_boroughs, count(DISTINCT postcode_district) AS active_postcodes
            FROM {db}.v_dated_sales GROUP BY year))"""
    return {
        "v_stg_transactions": staged, "v_matched_sales": matched, "v_dated_sales": dated, "v_borough_price_trends": trends,
        "v_borough_yoy_growth": growth, "v_borough_transaction_velocity": velocity, "v_property_type_roi_by_borough": roi,
        "v_undervalued_postcodes": undervalued,
        "v_new_build_premium": premium("new_build", "existing", "is_new_build", "NOT is_new_build", ""),
        "v_tenure_premium": premium("freehold", "leasehold", "tenure_label = 'Freehold'", "tenure_label = 'Leasehold'", "freehold_"),
        "v_market_health_summary": market,
    }


def publish(spark: SparkSession, star: Star, raw_path: str, db: str, location: str) -> str:
    """Creates the database with the marts' tables and all views and returns its name.

    ``star`` is a written one (``materialize_star``, ``marts.current``); publishing a newer version
    under the same name re-points tables and views.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    tables = {"raw_sales": raw_path} | {t: f"{star.root}/{t}" for t in ("fact_transactions", "dim_date", "dim_location", "dim_property")}
    for name, path in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS SELECT * FROM parquet.`{path}`")
    for name, sql in view_sql(db, star.cfg).items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {sql}")
    return db


def create_functions(spark: SparkSession) -> None:
    """The macros as SQL functions of the session: a column expression and a relation."""
    null, sep = _text(C.SURROGATE_KEY_NULL), _text(C.SURROGATE_KEY_SEPARATOR)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION surrogate_key(parts ARRAY<STRING>) RETURNS STRING
RETURN md5(array_join(parts, {sep}, {null}))""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION date_spine(first_day DATE, end_day DATE) RETURNS TABLE (date_day DATE)
RETURN SELECT explode(sequence(first_day, date_sub(end_day, 1), INTERVAL 1 DAY))""")


# ---------------------------------------------------------------- bucketed star tables


def bucket_star(spark: SparkSession, star: Star, db: str, location: str, buckets: int) -> list[str]:
    """Writes fact and locations as tables bucketed and sorted by ``location_key``; returns the hot keys.

    One file a bucket and year. Keys with more rows than an even bucket's share are hot; there
    are fewer of them than buckets, and ``bucketed_rows`` keeps them out of the bucketed join.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    counts = star.fact.groupBy("location_key").agg(F.count(F.lit(1)).alias("n"))
    share = star.fact.count() / buckets
    hot = [r.location_key for r in counts.where(F.col("n") > share).select("location_key").collect()]  # fewer than buckets
    for name, df, parts in (("fact_by_location", star.fact, ["sale_year"]), ("locations_by_key", star.dim_location, [])):
        # hot rows are spread here, as one task would write them all otherwise
        salt = F.when(F.col("location_key").isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(buckets))).otherwise(F.lit(0))
        writer = (df.withColumn("__salt", salt).repartition(buckets, "location_key", "__salt").drop("__salt")
                  .write.mode("overwrite").format("parquet").option("path", f"{location}/{name}")
                  .bucketBy(buckets, "location_key").sortBy("location_key"))
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(f"{db}.{name}")
    return hot


def bucketed_rows(spark: SparkSession, db: str, hot: list[str], fact_cols: list[str], loc_cols: list[str],
                  cfg: Config) -> DataFrame:
    """Fact rows with their location, without a shuffle or broadcast of either table.

    Both sides are read by bucket and merged. The hot keys' rows are read apart, split by size, and
    get their few locations by broadcast.
    """
    fact = spark.table(f"{db}.fact_by_location").select("location_key", *fact_cols)
    loc = spark.table(f"{db}.locations_by_key").select("location_key", *loc_cols)
    is_hot = F.col("location_key").isin(hot) if hot else F.lit(False)
    cold = fact.where(~is_hot).join(loc.hint("merge"), "location_key")
    if not hot:
        return cold
    return cold.unionByName(fact.where(is_hot).join(bounded_broadcast(loc.where(is_hot), cfg.broadcast_max_rows, len(hot)),
                                                    "location_key"))


def calendar_slice(star: Star, where: F.Column, borough: str | None = None) -> DataFrame:
    """Fact rows of the calendar days for which ``where`` holds, by borough and quarter.

    The calendar is joined on its year too, so a filter on any of its attributes (quarter, weekend,
    ...) prunes the fact's year partitions at run time; a filter on the borough reaches a large
    fact's scan as a Bloom filter of its location keys.
    """
    d = star.dim_date.where(where).select("date_key", F.col("year").alias("sale_year"), "year_quarter")
    loc = star.dim_location.where(F.col("borough") != F.lit(C.UNMATCHED_BOROUGH))
    loc = loc if borough is None else loc.where(F.col("borough") == F.lit(borough))
    rows = star.fact.select("date_key", "sale_year", "location_key", "sale_price").join(
        bounded_broadcast(d, star.cfg.broadcast_max_rows, star.date_rows), ["date_key", "sale_year"])
    return (rows.join(loc.select("location_key", "borough"), "location_key").groupBy("borough", "year_quarter")
            .agg(F.count(F.lit(1)).alias("transactions"), F.sum("sale_price").alias("value")))
