import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="estatespark-test-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


RAW_DEFAULTS = dict(
    transaction_id=None, price=500000, sale_date="2022-06-15 00:00", postcode="E14 5AB",
    property_type="F", new_build="N", tenure="L", paon=None, saon=None, street=None,
    locality=None, town="london", district="tower hamlets", county="greater london",
    ppd_type="A", record_status="A", source_year=2022, loaded_at=None,
)


def raw_rows(spark, rows):
    """Warehouse-shaped raw rows from partial dicts (defaults fill the rest)."""
    from pyspark.sql import types as T
    from estatespark.sources.fixture import WAREHOUSE_COLUMNS
    schema = T.StructType([
        T.StructField(c, T.LongType() if c == "price" else
                      T.IntegerType() if c == "source_year" else
                      T.TimestampNTZType() if c == "loaded_at" else T.StringType(), True)
        for c in WAREHOUSE_COLUMNS])
    data = []
    for i, r in enumerate(rows):
        d = dict(RAW_DEFAULTS)
        d["transaction_id"] = str(i + 1)
        d.update(r)
        data.append(tuple(d[c] for c in WAREHOUSE_COLUMNS))
    return spark.createDataFrame(data, schema)


def seed_rows(spark, pairs):
    return spark.createDataFrame(pairs, "postcode_district string, borough string")
