"""Marts in versions: a rebuild is written beside the current version and then switched to.

Every version lies in a folder of its own. ``published`` writes one and, when all its tables are
complete, appends a row to the version log; readers take the log's last row. So a reader keeps a
whole version while the next is built, and a rebuild that dies leaves the current one in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from .star import FACT_COLUMNS, Star, materialize_star

LOG = "version long, folder string, date_rows long, location_rows long, property_rows long, built_at timestamp"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The version log, empty before the first version."""
    fs, where = _files(spark, f"{root}/log")
    return spark.read.schema(LOG).parquet(f"{root}/log") if fs.exists(where) else spark.createDataFrame([], LOG)


def _last(spark: SparkSession, root: str, n: int) -> list:
    return versions(spark, root).orderBy(F.col("version").desc()).limit(n).collect()


def published(spark: SparkSession, star: Star, root: str, keep: int = 2) -> Star:
    """Writes ``star`` as the next version below root, switches to it and returns it.

    The last ``keep`` versions stay; older ones are removed after the switch.
    """
    folder = uuid.uuid4().hex
    built = materialize_star(spark, star, f"{root}/{folder}")
    before = _last(spark, root, 1)
    row = (before[0].version + 1 if before else 1, folder, built.date_rows, built.location_rows, built.property_rows)
    (spark.createDataFrame([row], LOG.rsplit(",", 1)[0]).withColumn("built_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(f"{root}/log"))
    kept = {r.folder for r in _last(spark, root, keep)}
    for r in versions(spark, root).filter(~F.col("folder").isin(list(kept))).select("folder").collect():  # one row a rebuild
        fs, where = _files(spark, f"{root}/{r.folder}")
        fs.delete(where, True)
    return built


def current(spark: SparkSession, root: str, cfg: Config, back: int = 0) -> Star:
    """The current version, or the one ``back`` versions before it."""
    found = _last(spark, root, back + 1)
    if len(found) <= back:
        raise ValueError(f"{root} has no such version")
    row = found[back]
    fact, d_date, d_loc, d_prop = (spark.read.parquet(f"{root}/{row.folder}/{n}") for n in
                                   ("fact_transactions", "dim_date", "dim_location", "dim_property"))
    return Star(fact=fact.select(*FACT_COLUMNS), dim_date=d_date, dim_location=d_loc, dim_property=d_prop, cfg=cfg,
                date_rows=row.date_rows, location_rows=row.location_rows, property_rows=row.property_rows,
                root=f"{root}/{row.folder}")
