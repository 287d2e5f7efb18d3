"""DuckDB SQL restating each registered query over the test tables.

The driver runs these next to the Spark queries as the correctness gate. The text is built
from the same parameters (``config.FIXTURE`` and the fixture constants) as the Spark code,
so a parameter change moves both sides; the logic is written independently, in SQL.
"""

from __future__ import annotations

import datetime as dt

from . import config as C
from .config import FIXTURE, Config
from .sources import fixture as FX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _case(col: str, mapping, default: str | None) -> str:
    parts = " ".join(f"WHEN {_q(k)} THEN {v if isinstance(v, str) and v in ('TRUE', 'FALSE') else _q(v)}"
                     for k, v in mapping)
    tail = f" ELSE {_q(default)}" if default is not None else ""
    return f"CASE {col} {parts}{tail} END"


def _bands(col: str, bounds, top: str) -> str:
    parts = " ".join(f"WHEN {col} < {b} THEN {_q(lbl)}" for b, lbl in bounds)
    return f"CASE {parts} ELSE {_q(top)} END"


def _pct(new: str, old: str, digits: int) -> str:
    return (f"round((CAST({new} AS DOUBLE) - CAST({old} AS DOUBLE)) * 100.0 "
            f"/ NULLIF(CAST({old} AS DOUBLE), 0), {digits})")


def _skey(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), {_q(C.SURROGATE_KEY_NULL)})"
                               for c in cols)
    return f"md5({parts})"


def _date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def ctes(cfg: Config = FIXTURE) -> dict[str, tuple[list[str], str]]:
    """name -> (dependencies, body)."""
    areas_csv = ",".join(C.LONDON_AREAS)
    n_areas = len(C.LONDON_AREAS)
    per = FX.DISTRICTS_PER_NATION
    seg_case = "CASE c_mktsegment " + " ".join(
        f"WHEN {_q(s)} THEN {_q(code)}" for s, code in FX.SEGMENT_TO_PROPERTY_TYPE) + " END"
    last_day = cfg.calendar_end - dt.timedelta(days=1)
    central = _in(cfg.central_boroughs)
    out: dict[str, tuple[list[str], str]] = {}

    out["fx_sales"] = ([], f"""
        SELECT o.o_orderkey AS okey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
               o.o_orderpriority, c.c_name, c.c_mktsegment, n.n_name, r.r_name,
               split_part('{areas_csv}', ',', CAST(1 + (c.c_nationkey + c.c_custkey % {per}) % {n_areas} AS INTEGER))
                 || CAST(c.c_nationkey * {per} + c.c_custkey % {per} + 1 AS VARCHAR) AS dist
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""")

    out["raw_csv"] = (["fx_sales"], f"""
        SELECT CAST(okey AS VARCHAR) AS transaction_id,
               CASE WHEN okey % {FX.ZERO_PRICE_EVERY} = 0 THEN CAST(0 AS BIGINT)
                    ELSE CAST(floor(o_totalprice * {FX.PRICE_SCALE}) AS BIGINT) END AS price,
               CASE WHEN okey % {FX.NULL_DATE_EVERY} = 0 THEN CAST(NULL AS VARCHAR)
                    WHEN okey % {FX.BAD_DATE_EVERY} = 0 THEN 'not a date'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00' END AS date,
               CASE WHEN okey % {FX.NULL_POSTCODE_EVERY} = 0 THEN CAST(NULL AS VARCHAR)
                    WHEN okey % 10 = 3 THEN ' ' || lower(dist) || ' 1aa '
                    ELSE dist || ' 1AA' END AS postcode,
               CASE WHEN okey % {FX.UNKNOWN_TYPE_EVERY} = 0 THEN 'X' ELSE {seg_case} END AS property_type,
               CASE WHEN okey % {FX.NULL_NEW_BUILD_EVERY} = 0 THEN CAST(NULL AS VARCHAR)
                    WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS new_build,
               CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'F'
                    WHEN left(o_orderpriority, 1) IN ('3', '4') THEN 'L' ELSE 'U' END AS tenure,
               CAST(o_custkey AS VARCHAR) AS paon, CAST(NULL AS VARCHAR) AS saon, CASE WHEN okey % {FX.QUOTED_EVERY} = 0
                    THEN 'FLAT "A", ' || c_name || chr(92) ELSE c_name END AS street,
               CAST(NULL AS VARCHAR) AS locality, ' ' || lower(n_name) || ' ' AS town,
               lower(r_name) AS district, {_q(FX.FIXTURE_COUNTY)} AS county,
               CASE WHEN okey % {FX.ADDITIONAL_PPD_EVERY} = 0 THEN 'B' ELSE 'A' END AS ppd_type,
               'A' AS record_status,
               CAST(year(o_orderdate) AS INTEGER) AS source_year
        FROM fx_sales""")

    out["raw"] = (["raw_csv"], f"""
        SELECT transaction_id, price, date AS sale_date, postcode, property_type, new_build, tenure,
               paon, saon, street, locality, town, district, county, ppd_type, record_status,
               source_year, TIMESTAMP '{FX.FIXTURE_LOADED_AT}' AS loaded_at
        FROM raw_csv""")

    out["fx_seed"] = ([], f"""
        SELECT CASE WHEN j = 2 THEN ' ' || lower(dist) ELSE dist END AS postcode_district,
               CASE WHEN j = 4 THEN n_name || ' ' ELSE n_name END AS borough
        FROM (SELECT n_nationkey, n_name, j,
                     split_part('{areas_csv}', ',', CAST(1 + (n_nationkey + j) % {n_areas} AS INTEGER))
                       || CAST(n_nationkey * {per} + j + 1 AS VARCHAR) AS dist
              FROM (SELECT DISTINCT c.c_nationkey AS n_nationkey, n.n_name, c.c_custkey % {per} AS j
                    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) nj) s
        WHERE (n_nationkey * {per} + j + 1) % {FX.UNMATCHED_DISTRICT_EVERY} <> 0""")

    out["stg"] = (["raw"], f"""
        SELECT d.*,
               CAST(year(sale_date) AS INTEGER) AS sale_year,
               CAST(month(sale_date) AS INTEGER) AS sale_month,
               CAST(quarter(sale_date) AS INTEGER) AS sale_quarter,
               CAST(date_trunc('month', sale_date) AS DATE) AS sale_month_start,
               CAST(date_trunc('quarter', sale_date) AS DATE) AS sale_quarter_start,
               NULLIF(regexp_extract(postcode, '^[A-Z]+', 0), '') AS postcode_area,
               split_part(postcode, ' ', 1) AS postcode_district
        FROM (
          SELECT r.transaction_id, r.price,
                 TRY_CAST(left(r.sale_date, 10) AS DATE) AS sale_date,
                 upper(trim(r.postcode)) AS postcode,
                 r.property_type AS property_type_code,
                 {_case('r.property_type', C.PROPERTY_TYPES, C.UNKNOWN_LABEL)} AS property_type,
                 r.new_build AS new_build_flag,
                 CASE r.new_build WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_new_build,
                 r.tenure AS tenure_code,
                 {_case('r.tenure', C.TENURES, C.UNKNOWN_LABEL)} AS tenure,
                 upper(trim(r.town)) AS town, upper(trim(r.district)) AS district,
                 upper(trim(r.county)) AS county,
                 r.ppd_type AS ppd_type_code,
                 {_case('r.ppd_type', C.PPD_TYPES, C.UNKNOWN_LABEL)} AS ppd_type,
                 r.source_year, r.loaded_at
          FROM (SELECT * FROM raw WHERE price > 0 AND postcode IS NOT NULL AND sale_date IS NOT NULL) r
        ) d""")

    out["boroughs"] = (["fx_seed"], """
        SELECT upper(trim(postcode_district)) AS postcode_district, trim(borough) AS borough
        FROM fx_seed""")

    out["enriched"] = (["stg", "boroughs"], f"""
        SELECT t.transaction_id, t.price, t.sale_date, t.sale_year, t.sale_month, t.sale_quarter,
               t.sale_month_start, t.sale_quarter_start, t.postcode, t.postcode_area,
               t.postcode_district, coalesce(b.borough, {_q(C.UNMATCHED_BOROUGH)}) AS borough,
               t.town, t.district AS source_district, t.county, t.property_type,
               t.property_type_code, t.is_new_build, t.new_build_flag, t.tenure, t.tenure_code,
               t.ppd_type, t.ppd_type_code, t.source_year, t.loaded_at
        FROM stg t LEFT JOIN boroughs b USING (postcode_district)""")

    out["priced"] = (["enriched"], f"""
        SELECT *, {_bands('price', C.PRICE_BANDS, C.TOP_PRICE_BAND)} AS price_band,
                  {_bands('price', C.MARKET_SEGMENTS, C.TOP_MARKET_SEGMENT)} AS market_segment
        FROM enriched""")

    out["flagged"] = (["priced"], f"""
        SELECT *,
               coalesce(borough IN {central}, FALSE) AS is_central_london,
               coalesce(postcode_area IN {_in(cfg.prime_areas)}, FALSE) AS is_prime_postcode_area,
               coalesce(price >= {cfg.million_plus}, FALSE) AS is_million_plus,
               coalesce(price >= {cfg.super_prime}, FALSE) AS is_super_prime,
               coalesce(sale_year = (SELECT max(sale_year) FROM priced), FALSE) AS is_most_recent_year,
               coalesce(property_type = 'Flat', FALSE) AS is_flat,
               coalesce(tenure = 'Leasehold', FALSE) AS is_leasehold
        FROM priced""")

    out["dim_date"] = ([], date_dim_sql(
        f"SELECT CAST(unnest(generate_series({_date(cfg.calendar_start)}, {_date(last_day)}, "
        f"INTERVAL 1 DAY)) AS DATE) AS d"))

    region_case = "CASE postcode_area " + " ".join(
        f"WHEN {_q(a)} THEN {_q(r)}" for a, r in cfg.region_by_area) + f" ELSE {_q(C.OTHER_REGION)} END"
    out["dim_location"] = (["flagged"], f"""
        SELECT {_skey('postcode_district', 'borough')} AS location_key, postcode_district,
               postcode_area, borough, coalesce(borough IN {central}, FALSE) AS is_central_london,
               {region_case} AS london_region
        FROM (SELECT DISTINCT postcode_district, postcode_area, borough FROM flagged) u""")

    desc_case = "CASE property_type " + " ".join(
        f"WHEN {_q(t)} THEN {_q(d)}" for t, d in C.PROPERTY_DESCRIPTIONS) + \
        f" ELSE {_q(C.UNKNOWN_PROPERTY_DESCRIPTION)} END"
    out["dim_property"] = (["flagged"], f"""
        SELECT {_skey('property_type_code')} AS property_key, property_type_code,
               property_type AS property_type_name, {desc_case} AS property_description,
               CASE WHEN property_type IN {_in(C.HOUSE_TYPES)} THEN {_q(C.PROPERTY_CATEGORY_HOUSE)}
                    WHEN property_type = 'Flat' THEN {_q(C.PROPERTY_CATEGORY_FLAT)}
                    ELSE {_q(C.PROPERTY_CATEGORY_OTHER)} END AS property_category
        FROM (SELECT DISTINCT property_type_code, property_type FROM flagged) u""")

    out["fact"] = (["flagged"], f"""
        SELECT transaction_id AS transaction_key, sale_date AS date_key,
               {_skey('postcode_district', 'borough')} AS location_key,
               {_skey('property_type_code')} AS property_key,
               price AS sale_price,
               CASE WHEN price >= {C.MILLION_PLUS} THEN price ELSE CAST(0 AS BIGINT) END AS sale_price_million_plus,
               CAST(1 AS INTEGER) AS transaction_count,
               is_new_build, is_leasehold AS tenure_is_leasehold, tenure AS tenure_label,
               price_band, market_segment, is_central_london, is_million_plus, is_super_prime,
               is_most_recent_year, sale_date, sale_year, sale_quarter, sale_month, source_year,
               loaded_at
        FROM flagged""")

    # fact ⋈ matched locations (the base of every KPI view)
    out["fl"] = (["fact", "dim_location"], f"""
        SELECT f.*, l.borough, l.postcode_district, l.london_region,
               l.is_central_london AS loc_central
        FROM fact f JOIN dim_location l ON f.location_key = l.location_key
        WHERE l.borough <> {_q(C.UNMATCHED_BOROUGH)}""")
    # ... and the calendar
    out["fld"] = (["fl", "dim_date"], """
        SELECT fl.*, d.year, d.quarter, d.year_quarter, d.quarter_start_date
        FROM fl JOIN dim_date d ON fl.date_key = d.date_key""")
    return out


def date_dim_sql(days_sql: str) -> str:
    return f"""
        SELECT d AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month_number,
               strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short,
               CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week_number,
               strftime(d, '%A') AS day_of_week_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year,
               CAST(date_trunc('month', d) AS DATE) AS month_start_date,
               CAST(last_day(d) AS DATE) AS month_end_date,
               CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
               CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
               CAST(date_trunc('year', d) AS DATE) AS year_start_date,
               make_date(CAST(year(d) AS INTEGER), 12, 31) AS year_end_date,
               dayofweek(d) IN (0, 6) AS is_weekend,
               CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
               CAST(year(d) AS VARCHAR) || '-' || lpad(CAST(month(d) AS VARCHAR), 2, '0') AS year_month
        FROM ({days_sql}) days"""


def with_ctes(final: str, extra: dict[str, tuple[list[str], str]] | None = None,
              cfg: Config = FIXTURE) -> str:
    """Prefix ``final`` with every CTE it (transitively) references, in dependency order."""
    defs = ctes(cfg)
    if extra:
        defs.update(extra)
    import re
    order: list[str] = []

    def refs(text: str) -> list[str]:
        return [n for n in defs if re.search(rf"\b{n}\b", text)]

    def visit(n: str, stack: tuple = ()):
        if n in order or n in stack:
            return
        deps, body = defs[n]
        for d in deps + [r for r in refs(body) if r != n]:
            visit(d, stack + (n,))
        order.append(n)

    for n in refs(final):
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({defs[n][1]})" for n in order) + "\n" + final
