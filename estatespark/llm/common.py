"""Small helpers the corpus operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BROADCAST_ROWS = 2_000_000  # of one or two numbers each: at most some 50 MB


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: ends its lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most ``bound`` rows; else left to a shuffle join.

    Only for narrow rows of numbers, so that the bound on rows bounds the bytes.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= bound else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Gives the memory that this Python worker has freed back to the system: idle workers wait for
    the next stage beside the JVM. Without glibc, Arrow's pool alone."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):
        pass


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, which gives freed memory back behind a task's last batch."""
    def to_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return to_end


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package's code (what --py-files does), once per application.

    Needless where the package is installed on them, harmless there too.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(to))
    _SHIPPED.add(app)
