"""DuckDB oracle text per registered query (see ``oracle.py`` for the shared chain)."""

from __future__ import annotations

from . import config as C
from .config import FIXTURE
from .sources.files import RAW_COLUMNS
from .oracle import _bands, _in, _pct, _q, _skey, date_dim_sql, with_ctes

CFG = FIXTURE


def _liquidity_case(col: str) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN {n} THEN {_q(l)}" for n, l in C.LIQUIDITY_TIERS) + " END"


def oracle_sql() -> dict[str, str]:
    c = CFG
    o: dict[str, str] = {}

    o["q_string_funcs"] = (
        "SELECT transaction_id, postcode, postcode_area, postcode_district, town, district, county FROM stg")
    o["q_try_date"] = (
        "SELECT transaction_id, sale_date AS sale_date_text, "
        "TRY_CAST(left(sale_date, 10) AS DATE) AS sale_date FROM raw")
    o["q_date_funcs"] = (
        "SELECT transaction_id, sale_date, sale_year, sale_month, sale_quarter, sale_month_start, "
        "sale_quarter_start FROM stg")
    o["q_code_mapping"] = (
        "SELECT transaction_id, property_type_code, property_type, new_build_flag, is_new_build, "
        "tenure_code, tenure, ppd_type_code, ppd_type FROM stg")
    o["q_price_bands"] = ("SELECT * FROM priced")
    o["q_flags"] = ("SELECT * FROM flagged")
    o["q_most_recent_year"] = (
        "SELECT sale_year, is_most_recent_year, count(*) AS sales FROM flagged GROUP BY ALL")
    o["q_pct_change"] = (f"""
        SELECT sale_year, sales, prev_sales,
               {_pct('sales', 'prev_sales', 2)} AS sales_change_pct,
               {_pct('value', 'prev_value', 1)} AS value_change_pct,
               {_pct('sales', '0', 2)} AS change_vs_zero_pct
        FROM (SELECT sale_year, sales, value,
                     lag(sales) OVER (ORDER BY sale_year ASC NULLS LAST) AS prev_sales,
                     lag(value) OVER (ORDER BY sale_year ASC NULLS LAST) AS prev_value
              FROM (SELECT sale_year, count(*) AS sales, CAST(sum(price) AS BIGINT) AS value
                    FROM stg GROUP BY sale_year) y) w""")
    o["q_surrogate_key"] = (f"""
        SELECT transaction_id, {_skey('postcode_district', 'borough')} AS location_key,
               {_skey('property_type_code')} AS property_key,
               {_skey('sale_date', 'postcode_district')} AS date_district_key
        FROM enriched""")
    o["q_date_spine"] = ("""
        SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE)
               AS date_day FROM stg""")

    o["q_stg_transactions"] = ("SELECT * FROM stg")
    o["q_enriched"] = ("SELECT * FROM enriched")
    o["q_dim_date"] = (date_dim_sql(
        "SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(sale_date)) AS DATE), "
        "CAST(date_trunc('year', max(sale_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE), "
        "INTERVAL 1 DAY)) AS DATE) AS d FROM stg"))
    o["q_dim_location"] = ("SELECT * FROM dim_location")
    o["q_dim_property"] = ("SELECT * FROM dim_property")
    o["q_fact_transactions"] = ("SELECT * FROM fact")
    o["q_star_join"] = ("""
        SELECT fld.transaction_key, fld.borough, fld.london_region, fld.year, fld.quarter,
               p.property_type_name, p.property_category, fld.sale_price
        FROM fld JOIN dim_property p ON fld.property_key = p.property_key""")

    o["q_group_stats"] = ("""
        SELECT fld.london_region, p.property_type_name, count(*) AS transactions,
               round(avg(sale_price), 0) AS avg_price,
               round(median(sale_price), 0) AS median_price,
               min(sale_price) AS min_price, max(sale_price) AS max_price
        FROM fld JOIN dim_property p ON fld.property_key = p.property_key
        GROUP BY fld.london_region, p.property_type_name""")
    having = f"""
        SELECT borough, postcode_district, count(*) AS postcode_transactions,
               round(median(sale_price), 0) AS postcode_median_price,
               round(avg(sale_price), 0) AS postcode_avg_price
        FROM fld WHERE year >= {c.recent_since_year}
        GROUP BY borough, postcode_district
        HAVING count(*) >= {c.min_postcode_sales}"""
    o["q_having_min_count"] = (having)
    seg_tenure = f"""
        SELECT borough, tenure_label, count(*) AS n, round(median(sale_price), 0) AS med
        FROM fl WHERE tenure_label IN ('Freehold', 'Leasehold') GROUP BY borough, tenure_label"""
    pivot_tenure = f"""
        SELECT borough,
               CAST(sum(n) FILTER (WHERE tenure_label = 'Freehold') AS BIGINT) AS f_n,
               CAST(sum(n) FILTER (WHERE tenure_label = 'Leasehold') AS BIGINT) AS l_n,
               sum(med) FILTER (WHERE tenure_label = 'Freehold') AS f_m,
               sum(med) FILTER (WHERE tenure_label = 'Leasehold') AS l_m
        FROM ({seg_tenure}) s GROUP BY borough"""
    o["q_pivot_segments"] = (f"""
        SELECT borough, coalesce(f_n, 0) AS freehold_txns, coalesce(f_m, 0) AS freehold_median,
               coalesce(l_n, 0) AS leasehold_txns, coalesce(l_m, 0) AS leasehold_median
        FROM ({pivot_tenure}) p""")
    activity = """
        SELECT borough, loc_central AS is_central_london, london_region, year, count(*) AS transactions
        FROM fld GROUP BY borough, loc_central, london_region, year"""
    o["q_rank"] = (f"""
        SELECT *, CAST(rank() OVER (PARTITION BY year ORDER BY transactions DESC) AS INTEGER) AS volume_rank
        FROM ({activity}) a""")
    o["q_ntile"] = (f"""
        SELECT *, CAST(ntile(4) OVER (PARTITION BY year ORDER BY transactions DESC, borough,
                                       london_region) AS INTEGER) AS liquidity_quartile
        FROM ({activity}) a""")

    o["q_borough_price_trends"] = ("""
        SELECT borough, loc_central AS is_central_london, london_region, year, quarter,
               year_quarter, quarter_start_date, count(*) AS transactions,
               round(avg(sale_price), 0) AS avg_price, round(median(sale_price), 0) AS median_price,
               min(sale_price) AS min_price, max(sale_price) AS max_price,
               round(stddev_samp(sale_price), 0) AS price_stddev,
               round(stddev_samp(sale_price) / avg(sale_price), 3) AS price_volatility_ratio
        FROM fld
        GROUP BY borough, loc_central, london_region, year, quarter, year_quarter, quarter_start_date""")

    yearly = """
        SELECT borough, loc_central AS is_central_london, london_region, year,
               count(*) AS transactions, round(avg(sale_price), 0) AS avg_price,
               round(median(sale_price), 0) AS median_price
        FROM fld GROUP BY borough, loc_central, london_region, year"""

    def yoy(partition: str, order: str) -> str:
        return (f"""
        SELECT borough, is_central_london, london_region, year, transactions, avg_price,
               median_price, pa AS prev_avg_price, pm AS prev_median_price,
               avg_price - pa AS yoy_avg_change_gbp, median_price - pm AS yoy_median_change_gbp,
               {_pct('avg_price', 'pa', 2)} AS yoy_avg_change_pct,
               {_pct('median_price', 'pm', 2)} AS yoy_median_change_pct,
               {_pct('transactions', 'pt', 2)} AS yoy_volume_change_pct
        FROM (SELECT y.*,
                     lag(avg_price) OVER w AS pa, lag(median_price) OVER w AS pm,
                     lag(transactions) OVER w AS pt
              FROM ({yearly}) y
              WINDOW w AS (PARTITION BY {partition} ORDER BY {order})) l""")
    o["q_yoy_growth"] = yoy("borough", "year, london_region")
    o["q_yoy_growth_by_region"] = yoy("borough, london_region", "year")

    o["q_transaction_velocity"] = (f"""
        SELECT borough, is_central_london, london_region, year, transactions,
               round(transactions / 12.0, 0) AS avg_monthly_transactions,
               CAST(rank() OVER (PARTITION BY year ORDER BY transactions DESC) AS INTEGER) AS volume_rank,
               {_liquidity_case('ntile(4) OVER (PARTITION BY year ORDER BY transactions DESC, borough, london_region)')} AS liquidity_tier
        FROM ({activity}) a""")

    cal_lo = f"DATE '{c.calendar_start.isoformat()}'"
    cal_hi = f"DATE '{c.calendar_end.isoformat()}'"
    per_year = lambda y, tag: f"""
        SELECT borough, property_type_name, avg(sale_price) AS avg_{tag}, count(*) AS n_{tag}
        FROM fl JOIN dim_property p USING (property_key)
        WHERE date_key >= {cal_lo} AND date_key < {cal_hi} AND year(date_key) = {y}
        GROUP BY borough, property_type_name"""
    o["q_property_type_roi"] = (f"""
        SELECT ov.borough, ov.property_type_name, ov.property_category, ov.total_transactions,
               ov.avg_price_overall, ov.median_price_overall,
               round(a.avg_first, 0) AS avg_price_first_year,
               round(b.avg_last, 0) AS avg_price_last_year,
               {_pct('b.avg_last', 'a.avg_first', 2)} AS four_year_growth_pct,
               a.n_first AS transactions_first_year, b.n_last AS transactions_last_year
        FROM (SELECT borough, property_type_name, property_category, count(*) AS total_transactions,
                     round(avg(sale_price), 0) AS avg_price_overall,
                     round(median(sale_price), 0) AS median_price_overall
              FROM fl JOIN dim_property p USING (property_key)
              GROUP BY borough, property_type_name, property_category) ov
        LEFT JOIN ({per_year(c.first_year, 'first')}) a USING (borough, property_type_name)
        LEFT JOIN ({per_year(c.last_year, 'last')}) b USING (borough, property_type_name)
        WHERE ov.total_transactions >= {c.min_type_sales}""")

    vp = _bands("p.postcode_median_price",
                [(f"b.borough_median_price * {r}", lbl) for r, lbl in C.VALUE_POSITIONS],
                C.TOP_VALUE_POSITION)
    o["q_undervalued_postcodes"] = (f"""
        SELECT p.borough, p.postcode_district, p.postcode_transactions, p.postcode_median_price,
               b.borough_median_price,
               p.postcode_median_price - b.borough_median_price AS price_gap_gbp,
               {_pct('p.postcode_median_price', 'b.borough_median_price', 1)} AS price_gap_pct,
               {vp} AS value_position
        FROM ({having}) p
        JOIN (SELECT borough, round(median(postcode_median_price), 0) AS borough_median_price
              FROM ({having}) h GROUP BY borough) b USING (borough)""")

    seg_nb = """
        SELECT borough, is_new_build, count(*) AS n, round(median(sale_price), 0) AS med
        FROM fl WHERE is_new_build IS NOT NULL GROUP BY borough, is_new_build"""
    o["q_new_build_premium"] = (f"""
        SELECT borough, nb_n AS new_build_txns, ex_n AS existing_txns, nb_m AS new_build_median,
               ex_m AS existing_median, nb_m - ex_m AS premium_gbp,
               {_pct('nb_m', 'ex_m', 1)} AS premium_pct
        FROM (SELECT borough,
                     CAST(coalesce(sum(n) FILTER (WHERE is_new_build), 0) AS BIGINT) AS nb_n,
                     CAST(coalesce(sum(n) FILTER (WHERE NOT is_new_build), 0) AS BIGINT) AS ex_n,
                     coalesce(sum(med) FILTER (WHERE is_new_build), 0) AS nb_m,
                     coalesce(sum(med) FILTER (WHERE NOT is_new_build), 0) AS ex_m
              FROM ({seg_nb}) s GROUP BY borough) p
        WHERE nb_n >= {c.min_segment_sales} AND ex_n >= {c.min_segment_sales}""")
    o["q_tenure_premium"] = (f"""
        SELECT borough, coalesce(f_n, 0) AS freehold_txns, coalesce(l_n, 0) AS leasehold_txns,
               coalesce(f_m, 0) AS freehold_median, coalesce(l_m, 0) AS leasehold_median,
               coalesce(f_m, 0) - coalesce(l_m, 0) AS freehold_premium_gbp,
               {_pct('coalesce(f_m, 0)', 'coalesce(l_m, 0)', 1)} AS freehold_premium_pct
        FROM ({pivot_tenure}) p
        WHERE coalesce(f_n, 0) >= {c.min_segment_sales} AND coalesce(l_n, 0) >= {c.min_segment_sales}""")

    o["q_market_health"] = market_health_sql()
    o.update(more_bodies(o))
    o.update(mart_bodies(o))
    return {k: with_ctes(v) for k, v in o.items()}


def mart_bodies(o: dict[str, str]) -> dict[str, str]:
    """Queries on the marts as a service."""
    from .plans import quality_suite as QS
    from .plans.star import NOT_NULL_COLUMNS
    b: dict[str, str] = {}
    b["q_load_history"] = """
        SELECT source_year, count(*) AS rows, CAST(sum(price) AS BIGINT) AS price_total, count(*) AS ledger_rows,
               CAST(1 AS INTEGER) AS last_load, CAST(0 AS INTEGER) AS loaded_again
        FROM raw_csv GROUP BY source_year"""
    b["q_mart_rebuild"] = """
        SELECT sale_year, count(*) AS transactions, CAST(sum(sale_price) AS BIGINT) AS value, CAST(2 AS BIGINT) AS version
        FROM fact GROUP BY sale_year"""
    b["q_dq_observed"] = "\nUNION ALL\n".join(
        f"SELECT 'not_null' AS check_name, '{r}' AS relation, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failures, count(*) AS rows FROM {r}" for r, cols in NOT_NULL_COLUMNS for c in cols)
    keys = {r: "transaction_id" for r in QS.RAW_LAYERS} | QS.KEYS

    def failing(check: str, r: str, c: str, value: str, where: str) -> str:
        return (f"SELECT '{check}' AS check_name, '{r}' AS relation, '{c}' AS column_name, CAST({keys[r]} AS VARCHAR) AS key, "
                f"{value} AS value FROM {r} ch WHERE {where}")
    b["q_dq_failing_rows"] = "\nUNION ALL\n".join(
        [failing("unique", r, c, f"CAST({c} AS VARCHAR)", f"{c} IN (SELECT {c} FROM {r} GROUP BY {c} HAVING count(*) > 1)")
         for r, c in QS.UNIQUE_TESTS]
        + [failing("not_null", r, c, "CAST(NULL AS VARCHAR)", f"{c} IS NULL") for r, cols in QS.NOT_NULL_TESTS for c in cols]
        + [failing("accepted_values", r, c, f"CAST({c} AS VARCHAR)", f"{c} IS NOT NULL AND {c} NOT IN {_in(v)}")
           for r, c, v in QS.ACCEPTED_VALUES_TESTS]
        + [failing("relationships", r, c, f"CAST({c} AS VARCHAR)",
                   f"{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pr} pa WHERE pa.{pc} = ch.{c})")
           for r, c, pr, pc in QS.RELATIONSHIP_TESTS])
    same = {"q_view_staging": "q_stg_transactions", "q_view_price_trends": "q_borough_price_trends", "q_view_yoy_growth": "q_yoy_growth",
            "q_view_velocity": "q_transaction_velocity", "q_view_type_roi": "q_property_type_roi",
            "q_view_undervalued": "q_undervalued_postcodes", "q_view_new_build": "q_new_build_premium",
            "q_view_tenure": "q_tenure_premium", "q_view_market": "q_market_health",
            "q_sql_surrogate_key": "q_surrogate_key", "q_sql_date_spine": "q_date_spine"}
    b.update({name: o[other] for name, other in same.items()})
    b["q_bucketed_join"] = """
        SELECT l.borough, l.london_region, count(*) AS transactions, CAST(sum(f.sale_price) AS BIGINT) AS value
        FROM fact f JOIN dim_location l ON f.location_key = l.location_key GROUP BY l.borough, l.london_region"""
    b["q_calendar_slice"] = f"""
        SELECT borough, year_quarter, count(*) AS transactions, CAST(sum(sale_price) AS BIGINT) AS value FROM fld
        WHERE year_quarter IN ('{CFG.last_year}-Q1', '{CFG.last_year}-Q2') AND dayofweek(date_key) IN (0, 6)
        GROUP BY borough, year_quarter"""
    extracts = (("v_borough_price_trends", o["q_borough_price_trends"], "borough"), ("v_borough_yoy_growth", o["q_yoy_growth"], "borough"),
                ("v_borough_transaction_velocity", o["q_transaction_velocity"], "borough"),
                ("v_property_type_roi_by_borough", o["q_property_type_roi"], "borough"),
                ("v_undervalued_postcodes", o["q_undervalued_postcodes"], "borough"),
                ("v_new_build_premium", o["q_new_build_premium"], "borough"), ("v_market_health_summary", o["q_market_health"], "year"),
                ("dim_location", "SELECT * FROM dim_location", "location_key"), ("dim_property", "SELECT * FROM dim_property", "property_key"))
    b["q_export_extracts"] = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS extract, count(*) AS rows, count(DISTINCT {first}) AS first_column_values FROM ({sql}) e{i}"
        for i, (name, sql, first) in enumerate(extracts))
    return b


def market_health_sql(upper: bool = False) -> str:
    cols = ["year", "total_transactions", "avg_price", "median_price", "total_volume_gbp",
            "million_plus_transactions", "super_prime_transactions", "central_london_transactions",
            "active_boroughs", "active_postcodes", "prev_year_transactions", "prev_year_median",
            "volume_yoy_change_pct", "median_price_yoy_change_pct"]
    inner = f"""
        SELECT y.*, lag(total_transactions) OVER (ORDER BY year) AS prev_year_transactions,
               lag(median_price) OVER (ORDER BY year) AS prev_year_median
        FROM (SELECT year, count(*) AS total_transactions, round(avg(sale_price), 0) AS avg_price,
                     round(median(sale_price), 0) AS median_price,
                     CAST(sum(sale_price) AS BIGINT) AS total_volume_gbp,
                     count(*) FILTER (WHERE is_million_plus) AS million_plus_transactions,
                     count(*) FILTER (WHERE is_super_prime) AS super_prime_transactions,
                     count(*) FILTER (WHERE is_central_london) AS central_london_transactions,
                     count(DISTINCT borough) AS active_boroughs,
                     count(DISTINCT postcode_district) AS active_postcodes
              FROM fld GROUP BY year) y"""
    sel = []
    for col in cols:
        expr = col
        if col == "volume_yoy_change_pct":
            expr = _pct("total_transactions", "prev_year_transactions", 2)
        elif col == "median_price_yoy_change_pct":
            expr = _pct("median_price", "prev_year_median", 2)
        sel.append(f"{expr} AS {col.upper() if upper else col}")
    return f"SELECT {', '.join(sel)} FROM ({inner}) m"


def _rounded_mean(col: str, digits: int) -> str:
    scale = 10 ** digits
    units = f"CAST(round({col} * {scale}) AS BIGINT)"
    s, n = f"sum({units})", f"count({units})"
    return (f"CAST(sign({s}) * ((abs({s}) * 2 + {n}) // ({n} * 2)) / {float(scale)} AS DOUBLE)")


def _filtered_raw() -> str:
    return (f"SELECT * FROM raw_csv WHERE postcode IS NOT NULL AND "
            f"NULLIF(regexp_extract(postcode, '^[A-Z]+', 0), '') IN {_in(CFG.areas)}")


def more_bodies(o: dict[str, str]) -> dict[str, str]:
    """Quality, ingestion and report queries (may embed earlier bodies as subqueries)."""
    from .plans import quality_suite as QS
    c = CFG
    b: dict[str, str] = {}

    def summary_row(check: str, rel: str, col: str, failures_sql: str, frm: str) -> str:
        return (f"SELECT '{check}' AS check_name, '{rel}' AS relation, '{col}' AS column_name, "
                f"CAST({failures_sql} AS BIGINT) AS failures FROM {frm}")

    b["q_dq_unique"] = "\nUNION ALL\n".join(
        summary_row("unique", r, col, "count(*)",
                    f"(SELECT {col} FROM {r} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) d")
        for r, col in QS.UNIQUE_TESTS)
    b["q_dq_not_null"] = "\nUNION ALL\n".join(
        summary_row("not_null", r, col, f"count(*) FILTER (WHERE {col} IS NULL)", r)
        for r, cols in QS.NOT_NULL_TESTS for col in cols)
    b["q_dq_accepted_values"] = "\nUNION ALL\n".join(
        summary_row("accepted_values", r, col, f"count(DISTINCT {col})",
                    f"{r} WHERE {col} IS NOT NULL AND {col} NOT IN {_in(vals)}")
        for r, col, vals in QS.ACCEPTED_VALUES_TESTS)
    b["q_dq_relationships"] = "\nUNION ALL\n".join(
        summary_row("relationships", r, col, "count(*)",
                    f"{r} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                    f"(SELECT 1 FROM {pr} pa WHERE pa.{pc} = ch.{col})")
        for r, col, pr, pc in QS.RELATIONSHIP_TESTS)
    b["q_dq_orphans"] = """
        SELECT f.transaction_key, f.date_key, f.sale_year FROM fact f
        WHERE f.date_key IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)"""
    b["q_dq_row_counts"] = "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, source_year, count(*) AS rows FROM {layer} GROUP BY source_year"
        for layer in QS.ROW_COUNT_LAYERS)
    b["q_dq_coverage"] = f"""
        SELECT is_unmatched, n AS rows,
               round(CAST(n AS DOUBLE) * 100.0 / CAST(sum(n) OVER () AS DOUBLE), 2) AS share_pct
        FROM (SELECT borough = {_q(C.UNMATCHED_BOROUGH)} AS is_unmatched, count(*) AS n
              FROM enriched GROUP BY 1) g"""

    filt = _filtered_raw()
    b["q_ingest_csv"] = "SELECT * FROM raw_csv"
    b["q_ingest_filter"] = filt
    b["q_ingest_stream"] = filt
    fields = [c for c in RAW_COLUMNS]
    size = " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in fields)
    quoted = " + ".join(f"CASE WHEN contains({c}, chr(34)) OR contains({c}, ',') "
                        f"THEN 2 + len({c}) - len(replace({c}, chr(34), '')) ELSE 0 END"
                        for c in fields if c != "price")
    # fifteen commas and a line end a row, and the quotes that RFC 4180 adds
    per_year = f"SELECT source_year, CAST(sum({size} + {quoted} + 16) AS BIGINT) AS size_bytes FROM raw_csv GROUP BY 1"
    b["q_lake_inventory"] = f"""
        SELECT source_year, is_total, size_bytes, round(size_bytes / 1048576.0::DOUBLE, 3) AS size_mb FROM (
          SELECT source_year, false AS is_total, size_bytes FROM ({per_year}) y
          UNION ALL SELECT NULL, true, CAST(sum(size_bytes) AS BIGINT) FROM ({per_year}) y) t"""
    b["q_malformed_rows"] = '''
        SELECT source_year, count(*) AS rows, count(price) AS priced, CAST(0 AS BIGINT) AS malformed FROM raw_csv GROUP BY source_year'''
    b["q_union_years"] = f"SELECT source_year, count(*) AS rows FROM ({filt}) f GROUP BY source_year"
    b["q_value_counts"] = f"""
        SELECT 'property_type' AS column_name, CAST(property_type AS VARCHAR) AS value, count(*) AS n
        FROM ({filt}) f GROUP BY property_type
        UNION ALL
        SELECT 'source_year', CAST(source_year AS VARCHAR), count(*) FROM ({filt}) f GROUP BY source_year"""
    b["q_top_areas"] = f"""
        SELECT postcode_area, count(*) AS n
        FROM (SELECT NULLIF(regexp_extract(postcode, '^[A-Z]+', 0), '') AS postcode_area FROM ({filt}) f) a
        GROUP BY postcode_area ORDER BY n DESC, postcode_area NULLS LAST LIMIT 10"""
    b["q_profile_summary"] = f"""
        SELECT count(*) AS rows, min(date) AS min_date, max(date) AS max_date,
               min(price) AS min_price, max(price) AS max_price FROM ({filt}) f"""
    text_cols = ", ".join(f"CAST({col} AS VARCHAR) AS {col}" if col == "price" else col
                          for col in ("transaction_id", "price", "date", "postcode", "property_type",
                                      "new_build", "tenure", "paon", "saon", "street", "locality",
                                      "town", "district", "county", "ppd_type", "record_status"))
    b["q_bronze_land"] = f"SELECT {text_cols}, source_year FROM raw_csv"
    b["q_silver_roundtrip"] = f"""
        SELECT * EXCLUDE (date), date AS sale_date, TIMESTAMP '{__import__('estatespark').sources.fixture.FIXTURE_LOADED_AT}' AS loaded_at
        FROM ({filt}) f"""
    b["q_export_csv"] = market_health_sql(upper=True)
    b["q_stg_boroughs"] = "SELECT * FROM boroughs"

    under = o["q_undervalued_postcodes"]
    yoy = o["q_yoy_growth"]
    vel = o["q_transaction_velocity"]
    roi = o["q_property_type_roi"]
    mh = o["q_market_health"]
    b["q_value_position_counts"] = (f"SELECT value_position, count(*) AS postcodes FROM ({under}) u "
                                    f"GROUP BY value_position")
    growth = f"""
        SELECT borough, year, {_rounded_mean('yoy_median_change_pct', 2)} AS yoy_growth_pct,
               round(avg(median_price), 0) AS median_price
        FROM ({yoy}) y WHERE year = (SELECT max(year) FROM ({yoy}) y2)
        GROUP BY borough, year"""
    b["q_borough_growth_ranking"] = f"""
        SELECT *, CAST(rank() OVER (ORDER BY yoy_growth_pct DESC NULLS LAST) AS INTEGER) AS growth_rank
        FROM ({growth}) g"""
    liquidity = f"""
        SELECT borough, CAST(sum(transactions) AS BIGINT) AS transactions
        FROM ({vel}) v WHERE year = (SELECT max(year) FROM ({vel}) v2) GROUP BY borough"""
    b["q_top_liquidity"] = (f"SELECT * FROM ({liquidity}) l ORDER BY transactions DESC, borough "
                            f"LIMIT {c.top_liquidity_k}")
    labels = dict(C.QUADRANT_LABELS)
    b["q_investment_matrix"] = f"""
        SELECT borough, yoy_growth_pct, median_price, transactions,
               CASE WHEN yoy_growth_pct > mg AND transactions > ml THEN {_q(labels['high_growth_high_volume'])}
                    WHEN yoy_growth_pct > mg THEN {_q(labels['high_growth_low_volume'])}
                    WHEN transactions > ml THEN {_q(labels['low_growth_high_volume'])}
                    ELSE {_q(labels['low_growth_low_volume'])} END AS quadrant
        FROM (SELECT g.borough, g.yoy_growth_pct, g.median_price, l.transactions,
                     median(g.yoy_growth_pct) OVER () AS mg, median(l.transactions) OVER () AS ml
              FROM ({growth}) g JOIN ({liquidity}) l USING (borough)) x"""
    b["q_type_consistency"] = f"""
        SELECT property_type_name, count(*) AS boroughs, count(four_year_growth_pct) AS rated,
               count(*) FILTER (WHERE four_year_growth_pct > 0) AS positive,
               min(four_year_growth_pct) AS min_growth_pct, max(four_year_growth_pct) AS max_growth_pct,
               round(CAST(count(*) FILTER (WHERE four_year_growth_pct > 0) AS DOUBLE)
                     / CAST(NULLIF(count(four_year_growth_pct), 0) AS DOUBLE), 3) AS share_positive
        FROM ({roi}) r GROUP BY property_type_name"""
    b["q_growth_spread"] = f"""
        SELECT m.year, g.best AS best_borough_growth_pct,
               m.median_price_yoy_change_pct AS market_growth_pct,
               round(g.best - m.median_price_yoy_change_pct, 2) AS spread_pct
        FROM (SELECT * FROM ({mh}) m1 WHERE year = (SELECT max(year) FROM ({mh}) m2)) m
        JOIN (SELECT year, max(yoy_growth_pct) AS best FROM ({growth}) gg GROUP BY year) g
          USING (year)"""
    return b
