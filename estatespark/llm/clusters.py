"""Centroid clustering in whole numbers, over a distance matrix that is kept and brought up to date.

Every vector's row holds its components and its exact dot product with every centroid. A round
sends the tasks only what changed of the centroids: to a dot product is added, for each component
of the centroid that changed, that component of the vector times the change. The squared distance
to a centroid is |vector|^2 - 2 * dot + |centroid|^2, so the nearest one follows without touching
unchanged components. The rows are a written table in every round; a round that has been written
replaces the one before. Only k centroids and k rows of sums pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

LIMIT = 1 << 19  # of a component's size: squared distances then fit a long
STATE = "vec_id long, q array<int>, dots array<long>, cluster int"


@dataclass(frozen=True)
class Params:
    k: int = 40
    dim: int = 64
    rounds: int = 5
    scale: int = 256
    seed: int = 2


def _takes_part(x: Column, p: Params) -> Column:
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(x) == p.dim) & fine, F.lit(False))


def whole_numbers(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """vec_id and q, the components as floor(scale * x), of the vectors that take part.

    Those are the rows of exactly ``dim`` components of which none is null or not finite. A
    component that comes out beyond ``LIMIT`` raises an error.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    scaled = rows.filter(_takes_part(F.col("x"), p)).select(
        "vec_id", F.transform("x", lambda v: F.floor(v * p.scale)).alias("q"))
    far = F.exists("q", lambda v: F.abs(v) > LIMIT)
    return scaled.select("vec_id", F.when(far, F.raise_error(F.lit(f"a component is beyond {LIMIT}")))
                         .otherwise(F.col("q").cast("array<int>")).alias("q"))


def starting_centroids(rows: DataFrame, p: Params = Params()) -> np.ndarray:
    """The k vectors of the least sha256 of ``seed:vec_id``, in that order; fewer if there are fewer.

    Rows of one vec_id go by their components; rows without a vec_id come last.
    """
    mark = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(mark.asc_nulls_last(), "q").limit(p.k).select("q").collect()
    return np.array([r.q for r in first], np.int64).reshape(-1, p.dim)


def _matrix(col: pa.Array, kind: type, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(col), width)


def _lists(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    at = np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(a.ravel(), kind))


def brought_up_to_date(q: np.ndarray, dots: np.ndarray, change: np.ndarray) -> np.ndarray:
    """``dots`` after the centroids changed, from the components that did."""
    for j in np.flatnonzero(change.any(axis=1)):
        at = np.flatnonzero(change[j])
        dots[:, j] += q[:, at] @ change[j, at]
    return dots


def _round(change: np.ndarray, centroids: np.ndarray):
    k, dim = centroids.shape
    norms = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column("q"), np.int64, dim)
            known = b.column("dots")
            dots = _matrix(known, np.int64, k) if len(known.flatten()) else np.zeros((len(q), k), np.int64)
            dots = brought_up_to_date(q, dots, change)
            nearest = (norms - 2 * dots).argmin(axis=1)  # the first of equals
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("q"), _lists(dots, pa.int64()), pa.array(nearest.astype(np.int32))],
                names=["vec_id", "q", "dots", "cluster"])
    return run


class _Rounds:
    """The table of the last round, which replaces that of the round before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, None

    def put(self, rows: DataFrame) -> DataFrame:
        old, self.path = self.path, scratch_path(self.spark, "llm", "distances")
        rows.write.parquet(self.path)
        if old:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        return self.spark.read.schema(STATE).parquet(self.path)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each cluster's vectors; an empty cluster keeps its centroid."""
    dim = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("q")[i].cast("long")).alias(f"s{i}") for i in range(dim)])
    out = centroids.copy()
    for r in sums.collect():  # k rows at most
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dim)]
    return out


def clustered(vectors: DataFrame, p: Params = Params()) -> tuple[DataFrame, np.ndarray]:
    """Each vector's cluster, and the final centroids in whole numbers.

    ``vectors`` has vec_id, embedding and any other columns. Rows that ``whole_numbers`` leaves out
    are not in the result. Columns: vec_id, cluster (the nearest centroid's number, the smaller of
    equals), distance (squared). Repeated rows count as often as they occur; with fewer vectors than
    k each is a starting centroid; with none, or an empty table, the result is empty.
    """
    spark = vectors.sparkSession
    rounds = _Rounds(spark)
    empty = F.array().cast("array<long>")
    state = rounds.put(whole_numbers(vectors, p).select("vec_id", "q", empty.alias("dots"), F.lit(0).alias("cluster")))
    centroids = starting_centroids(state.select("vec_id", "q"), p)
    if not len(centroids):
        return state.select("vec_id", "cluster", F.lit(0).cast("long").alias("distance")), centroids
    change = centroids
    for i in range(p.rounds + 1):
        state = rounds.put(state.mapInArrow(_round(change, centroids), STATE))
        if i < p.rounds:
            last, centroids = centroids, _means(state, centroids)
            change = centroids - last
            if not change.any():  # all further rounds are alike
                break
    norms = F.array(*[F.lit(int(n)) for n in (centroids * centroids).sum(axis=1)])
    own = F.aggregate("q", F.lit(0).cast("long"), lambda t, v: t + v.cast("long") * v)
    at = F.col("cluster")
    distance = own - 2 * F.get("dots", at) + F.get(norms, at).cast("long")
    return state.select("vec_id", "cluster", distance.alias("distance")), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the distances summed over each cluster and over all, and a digest of the
    final centroid's components."""
    spark = assigned.sparkSession
    sums = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(j, int(sums[j]), int(sum(sums.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for j, c in enumerate(centroids.tolist()) if j in sums]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(p: Params = Params()) -> str:
    """DuckDB's SQL of the same clusters, round by round."""
    parts = [f"""v AS (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(embedding, lambda x: CAST(floor({p.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = {p.dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {p.dim})""",
             f"""first AS (SELECT vec_id, q FROM v ORDER BY sha256('{p.seed}:' || vec_id) NULLS LAST, q LIMIT {p.k}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{p.seed}:' || vec_id) NULLS LAST, q) - 1 AS cluster, q AS c FROM first)"""]
    for i in range(p.rounds + 1):
        parts.append(f"""d{i} AS (
  SELECT rid, vec_id, q, min(list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * {p.k} + cluster) AS m
  FROM v, c{i} GROUP BY rid, vec_id, q),
a{i} AS (SELECT rid, vec_id, q, CAST(m % {p.k} AS INTEGER) AS cluster, CAST(m // {p.k} AS BIGINT) AS distance FROM d{i})""")
        if i < p.rounds:
            parts.append(f"""s{i} AS (
  SELECT cluster, i, sum(q[i]) AS s, count(*) AS n FROM a{i}, unnest(range(1, {p.dim + 1})) AS r(i) GROUP BY cluster, i),
m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS (SELECT o.cluster, coalesce(m{i}.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} ON m{i}.cluster = o.cluster)""")
    last = p.rounds
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.cluster = a.cluster"""
