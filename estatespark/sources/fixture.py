"""Adapter from the driver's test tables to the raw-sales shape.

The test tables hold no property sales, so a raw sales relation is derived from
``orders ⋈ customer ⋈ nation ⋈ region``: one sale per order. Deterministic rules on the
order key inject the defects the pipeline must handle (zero prices, unparseable and missing
dates, padded lower-case and missing postcodes, unknown codes). With ``k = c_nationkey``,
``j = c_custkey % 6`` and ``num = k*6 + j + 1`` (1..150), the postcode district is
``area || num`` where the area cycles through the eight London areas by ``(k + j) % 8``.
The borough seed has one row per ``num`` that has customers (except multiples of 29, which
stay unmatched), borough = nation name, so every borough spans several areas and regions.

At scale, orders ⋈ customer is the one shuffle join (sort-merge, AQE splits a hot customer);
nation and region have a fixed size (25 and 5 rows) and are broadcast.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LONDON_AREAS
from ..operators.joins import bounded_broadcast
from ..session import app_id, ends_with_app, shared_dir
from .files import RAW_COLUMNS, read_partitioned, to_warehouse

# Fixed values of the fixture (test-data shape, not reference behaviour).
SEGMENT_TO_PROPERTY_TYPE = (
    ("AUTOMOBILE", "D"),
    ("BUILDING", "S"),
    ("FURNITURE", "T"),
    ("HOUSEHOLD", "F"),
    ("MACHINERY", "O"),
)
FIXTURE_LOADED_AT = "2025-01-01 00:00:00"
FIXTURE_COUNTY = "greater london"
NULL_DATE_EVERY = 1013
BAD_DATE_EVERY = 1009
NULL_POSTCODE_EVERY = 997
ZERO_PRICE_EVERY = 499
UNKNOWN_TYPE_EVERY = 701
NULL_NEW_BUILD_EVERY = 353
ADDITIONAL_PPD_EVERY = 20
QUOTED_EVERY = 41  # streets with quotes, a comma and a backslash at the end
UNMATCHED_DISTRICT_EVERY = 29
DISTRICTS_PER_NATION = 6
PRICE_SCALE = 12
REFERENCE_TABLE_MAX_ROWS = 10_000

_lock = threading.RLock()
_materialized: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _area_for(k: Column, j: Column) -> Column:
    areas = F.array(*[F.lit(a) for a in LONDON_AREAS])
    return F.element_at(areas, ((k + j) % F.lit(len(LONDON_AREAS)) + F.lit(1)).cast("int"))


def _district(k: Column, j: Column) -> Column:
    num = k * F.lit(DISTRICTS_PER_NATION) + j + F.lit(1)
    return F.concat(_area_for(k, j), num.cast("string"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yearly-file shape: the 16 file columns plus ``source_year``."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # Reference tables of fixed size (25 nations, 5 regions): broadcast behind the same
    # bounded size probe as every other lookup (runs once: the result is materialised).
    nation = bounded_broadcast(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"),
        REFERENCE_TABLE_MAX_ROWS)
    region = bounded_broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                               REFERENCE_TABLE_MAX_ROWS)

    j = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))

    key = F.col("o_orderkey")
    k = F.col("c_nationkey")
    jj = F.col("c_custkey") % F.lit(DISTRICTS_PER_NATION)
    district = _district(k, jj)

    def every(n: int) -> Column:
        return key % F.lit(n) == F.lit(0)

    price = (F.when(every(ZERO_PRICE_EVERY), F.lit(0).cast("bigint"))
             .otherwise(F.floor(F.col("o_totalprice") * F.lit(PRICE_SCALE)).cast("bigint")))
    date = (F.when(every(NULL_DATE_EVERY), F.lit(None).cast("string"))
            .when(every(BAD_DATE_EVERY), F.lit("not a date"))
            .otherwise(F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(" 00:00"))))
    postcode = (F.when(every(NULL_POSTCODE_EVERY), F.lit(None).cast("string"))
                .when(key % F.lit(10) == F.lit(3),
                      F.concat(F.lit(" "), F.lower(district), F.lit(" 1aa ")))
                .otherwise(F.concat(district, F.lit(" 1AA"))))
    seg = None
    for s, code in SEGMENT_TO_PROPERTY_TYPE:
        cond = F.col("c_mktsegment") == F.lit(s)
        seg = F.when(cond, F.lit(code)) if seg is None else seg.when(cond, F.lit(code))
    property_type = F.when(every(UNKNOWN_TYPE_EVERY), F.lit("X")).otherwise(seg)
    new_build = (F.when(every(NULL_NEW_BUILD_EVERY), F.lit(None).cast("string"))
                 .when(F.col("o_orderstatus") == F.lit("P"), F.lit("Y"))
                 .otherwise(F.lit("N")))
    prio = F.left(F.col("o_orderpriority"), F.lit(1))
    tenure = (F.when(prio.isin("1", "2"), F.lit("F"))
              .when(prio.isin("3", "4"), F.lit("L"))
              .otherwise(F.lit("U")))
    ppd = F.when(every(ADDITIONAL_PPD_EVERY), F.lit("B")).otherwise(F.lit("A"))

    cols = {
        "transaction_id": key.cast("string"),
        "price": price,
        "date": date,
        "postcode": postcode,
        "property_type": property_type,
        "new_build": new_build,
        "tenure": tenure,
        "paon": F.col("o_custkey").cast("string"),
        "saon": F.lit(None).cast("string"),
        "street": (F.when(every(QUOTED_EVERY), F.concat(F.lit('FLAT "A", '), F.col("c_name"), F.lit("\\")))
                   .otherwise(F.col("c_name"))),
        "locality": F.lit(None).cast("string"),
        "town": F.concat(F.lit(" "), F.lower(F.col("n_name")), F.lit(" ")),
        "district": F.lower(F.col("r_name")),
        "county": F.lit(FIXTURE_COUNTY),
        "ppd_type": ppd,
        "record_status": F.lit("A"),
    }
    return j.select(*[cols[c].alias(c) for c in RAW_COLUMNS],
                    F.year(F.col("o_orderdate")).alias("source_year"))


def borough_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed ``postcode_district, borough``: one row per district that has customers (the
    distinct ``(c_nationkey, c_custkey % 6)`` pairs, at most 25 x 6), borough = nation name;
    some rows padded / lower-cased (the staging model normalises them). The distinct runs
    over all customers, partial-aggregated map-side."""
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("n_key"),
        (F.col("c_custkey") % F.lit(DISTRICTS_PER_NATION)).alias("j")).distinct()
    nation = bounded_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
                               REFERENCE_TABLE_MAX_ROWS)
    per = cust.join(nation, F.col("n_key") == F.col("n_nationkey"))
    k = F.col("n_nationkey")
    j = F.col("j")
    num = k * F.lit(DISTRICTS_PER_NATION) + j + F.lit(1)
    district = _district(k, j)
    return (per.where(num % F.lit(UNMATCHED_DISTRICT_EVERY) != F.lit(0))
            .select(F.when(j == F.lit(2), F.concat(F.lit(" "), F.lower(district)))
                    .otherwise(district).alias("postcode_district"),
                    F.when(j == F.lit(4), F.concat(F.col("n_name"), F.lit(" ")))
                    .otherwise(F.col("n_name")).alias("borough")))


def fixture_loaded_at() -> Column:
    return F.lit(FIXTURE_LOADED_AT).cast("timestamp_ntz")


def warehouse_raw_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales in warehouse shape (``sale_date``, ``loaded_at``), not materialised."""
    return to_warehouse(raw_sales(spark, sf_dir), fixture_loaded_at())


WAREHOUSE_COLUMNS = [("sale_date" if c == "date" else c) for c in RAW_COLUMNS] + [
    "source_year", "loaded_at"]


INPUTS = ("orders", "customer", "nation", "region")


def listing(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the input files' names, sizes and times: changed tables are read anew."""
    sc, found = spark.sparkContext, []
    for name in INPUTS:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(path):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(found)).encode()).hexdigest()


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    return (app_id(spark), sf_dir.rstrip("/"), listing(spark, sf_dir), what)


def materialized_path(spark: SparkSession, sf_dir: str, what: str) -> str:
    h = hashlib.sha1(f"{app_id(spark)}|{sf_dir.rstrip('/')}|{listing(spark, sf_dir)}".encode()).hexdigest()[:16]
    return ends_with_app(spark, f"{shared_dir(spark)}/estatespark/tables/{h}/{what}")


def warehouse_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse raw table, loaded once per application and source directory.

    Mirrors the warehouse load: the derived rows are written as a year-partitioned Parquet
    table in the shared folder and every model reads that table, so the join that derives
    them runs once and lineage is cut (a lost executor re-reads files, not the join).
    """
    key = _key(spark, sf_dir, "raw")
    with _lock:
        path = _materialized.get(key)
        if path is None:
            path = materialized_path(spark, sf_dir, "raw_sales")
            # rebalanced by year, so a year has a few files of even size, a hot one more
            (warehouse_raw_lazy(spark, sf_dir).hint("rebalance", "source_year").write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy("source_year").parquet(path))
            _materialized[key] = path
    return read_partitioned(spark, path, WAREHOUSE_COLUMNS)


def remember(spark: SparkSession, sf_dir: str, what: str, build) -> object:
    """Memoise an expensive materialisation per application and source directory."""
    key = _key(spark, sf_dir, what)
    with _lock:
        if key not in _materialized:
            _materialized[key] = build()
        return _materialized[key]
