"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCK = threading.Lock()
_FALLBACK: dict[str, str] = {}  # temp root per application when no checkpoint dir is configured


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "estatespark",
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster session to be.

    AQE on (runtime broadcast conversion, partition coalescing, skew-join split), UTC,
    UI off. On a cluster the same keys belong in the job's submit configuration.
    """
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ESTATESPARK_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root for tables this library writes (lineage cuts, materialised marts, scratch).

    Uses the shared folder the cluster names in ``spark.checkpoint.dir``. Where that is unset
    a local master gets a private temporary folder; any other raises, as its executors would
    not see the driver's files. The caller's checkpoint folder is never set here.
    """
    with _LOCK:
        root = spark.conf.get("spark.checkpoint.dir", None)
        sc = _context(spark)
        if not root and sc is not None:
            root = sc.getCheckpointDir()
        if not root:
            app = app_id(spark)
            root = _FALLBACK.get(app)
            if not root:
                master = spark.conf.get("spark.master", "")
                if not re.match(r"local(\[|$)", master):
                    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
                root = _FALLBACK[app] = tempfile.mkdtemp(prefix="estatespark-")
        return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        return None


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder, removed when the application ends."""
    return ends_with_app(spark, "/".join([shared_dir(spark), "estatespark", *parts, uuid.uuid4().hex]))


def ends_with_app(spark: SparkSession, path: str) -> str:
    """The path, which Spark's driver removes when it ends (any Hadoop file system)."""
    sc = _context(spark)
    if sc is not None:
        jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read back: computed once, lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"
