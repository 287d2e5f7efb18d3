"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed hash of its id and text. Words are summed by source and hash bucket; the
running sums give, for each source, the bucket in which its budget ends. Only that boundary
bucket is summed again at a finer grain. Rows below the threshold are taken, without a sort,
and a larger budget takes a superset of the rows that a smaller one does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


@dataclass(frozen=True)
class Params:
    weights: tuple[int, ...] = (5, 2, 1)  # of the sources by code point, null last, repeating
    share: float = 1.5  # of all words, what the mix has
    most: int = 2  # times its size, what a source or a document gives at most
    digits: int = 3  # hex digits of the hash for a histogram: 4096 buckets
    levels: int = 3  # histograms, each inside the boundary bucket of the one before


def sizes(docs: DataFrame, p: Params, *more: Column) -> DataFrame:
    """doc_id, source, size (words; null text: 0) and the row's hash as hex digits."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # each word, with the space around it, becomes one character; a text of space alone none
    size = F.length(F.btrim(F.regexp_replace(text, f"{SPACE}*{WORD}{SPACE}*", "x"), F.lit(" \t\n\x0b\f\r")))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text).cast("binary"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       size.cast("long").alias("size"), F.substring(key, 1, p.levels * p.digits).alias("key"), *more)


def targets(rows: DataFrame, p: Params) -> DataFrame:
    """source, source_size, target: one row per source.

    Filling up to the caps: in order of cap per weight, a source is capped while what is left,
    shared by the weights that are left, would give it more than its cap.
    """
    total = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    cycle = F.array(*[F.lit(w) for w in p.weights])
    named = total.select("source", "source_size", F.element_at(
        cycle, ((F.row_number().over(by_name) - 1) % len(p.weights) + 1).cast("int")).alias("weight"))
    all_ = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = p.most * F.col("source_size")
    left = p.share * F.sum("source_size").over(all_) - p.most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = left / F.sum("weight").over(from_here)
    open_ = named.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") >= cap)
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(all_)
    return open_.select("source", "source_size", F.when(F.col("capped"), cap.cast("double"))
                        .otherwise(final * F.col("weight")).alias("target"))


def _bucket(level: int, p: Params) -> Column:
    """The level's bucket: so many digits of the hash, after those of the levels before."""
    return F.substring("key", 1 + level * p.digits, p.digits)


def _plan(rows: DataFrame, p: Params) -> DataFrame:
    """s (source), source_size, target, times, limit: one row per source.

    Rows of a source are taken ``times`` times, those with a key below ``limit`` once more.
    """
    goal = targets(rows, p)
    whole = F.floor(F.col("target") / F.col("source_size")).cast("int")
    need = cut(goal.withColumn("times", F.when(F.col("source_size") > 0, whole).otherwise(0)), "targets")
    spare = F.greatest(F.col("target") - F.col("times") * F.col("source_size"), F.lit(0.0))
    edge = need.select("source", spare.alias("budget"), F.lit("").alias("threshold"), F.lit(0).cast("long").alias("below"),
                       F.lit(None).cast("long").alias("upto"))
    here = Window.partitionBy("source").orderBy("bucket")  # at most 16 ** digits rows for a source
    for level in range(p.levels):
        at = edge.select(F.col("source").alias("s"), "budget", "threshold", "below")
        inside = rows.join(small(at), F.col("source").eqNullSafe(F.col("s")) & (
            F.substring("key", 1, level * p.digits) == F.col("threshold")))
        sums = (inside.groupBy("source", "threshold", "budget", "below", _bucket(level, p).alias("bucket"))
                .agg(F.sum("size").alias("words"))
                .withColumn("upto", F.col("below") + F.sum("words").over(here)))
        fits = F.col("upto") <= F.col("budget")
        found = sums.groupBy("source", "budget", "threshold", "below").agg(
            F.max(F.when(fits, F.col("upto"))).alias("filled"),
            F.min(F.when(~fits, F.struct("bucket", "upto"))).alias("over"))
        # where no bucket goes over, all of them fit: every digit is below "g"
        found = cut(found.select(
            "source", "budget", F.concat("threshold", F.coalesce(F.col("over.bucket"), F.lit("g"))).alias("threshold"),
            F.coalesce("filled", "below").alias("below"), F.col("over.upto").alias("upto")), "edges")
        # sources without words have no bucket
        kept = edge.join(found.select(F.col("source").alias("f")), F.col("source").eqNullSafe(F.col("f")), "left_anti")
        edge = cut(found.unionByName(kept), "edges")
    # the last boundary bucket is taken if the sum comes nearer with it than without
    nearer = F.coalesce(F.col("upto") - F.col("budget") < F.col("budget") - F.col("below"), F.lit(False))
    limit = edge.select(F.col("source").alias("s"),
                        F.when(nearer, F.concat("threshold", F.lit("g"))).otherwise(F.col("threshold")).alias("limit"))
    return cut(need.join(limit, F.col("source").eqNullSafe(F.col("s")))
               .select("s", "source_size", "target", "times", "limit"), "plan")


def _applied(rows: DataFrame, plan: DataFrame, p: Params) -> DataFrame:
    once = (F.col("key") < F.col("limit")).cast("int")
    copies = F.when(F.col("size") > 0, F.least(F.col("times") + once, F.lit(p.most))).otherwise(0)
    return rows.join(small(plan), F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", copies.cast("int"))


def mix(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies for every row of ``docs``.

    Each row is taken floor(target / source_size) times, and those below the source's
    threshold once more; taken is copies times size. The threshold ends at the finest
    bucket, which is taken whole if that brings the sum nearer to the target. Null text has no
    words; a null source is a source of its own, the last. Rows of no words are never taken.
    Equal rows have one hash and are taken alike. Without words every target is 0; an empty
    table gives an empty result.
    """
    rows = cut(sizes(docs, p), "sizes")
    taken = F.col("copies") * F.col("size")
    return _applied(rows, _plan(rows, p), p).select("doc_id", "source", "size", "source_size", "target",
                                                   taken.alias("taken"), "copies")


def mixed_rows(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it."""
    plan = _plan(cut(sizes(docs, p), "sizes"), p)
    whole = sizes(docs, p, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    often = _applied(whole, plan, p).filter("copies > 0")
    return often.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def oracle_sql(p: Params = Params()) -> str:
    """The mix of documents in DuckDB's SQL: the same buckets, by running sums instead of levels."""
    digits = p.levels * p.digits
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(p.weights))
    return f"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, {digits}) AS key
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
named AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(p.weights)} {weight} END AS weight
  FROM totals),
levels AS (
  SELECT *, ({p.share} * (sum(source_size) OVER ()) - {p.most} * coalesce(sum(source_size) OVER (
              ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM named),
goals AS (
  SELECT source, source_size, (CASE WHEN level * weight >= {p.most} * source_size THEN {p.most} * source_size
         ELSE max(level) FILTER (level * weight < {p.most} * source_size) OVER () * weight END)::DOUBLE AS target
  FROM levels),
need AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM goals),
buckets AS (
  SELECT source, key, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY key) AS upto
  FROM rows GROUP BY source, key),
chosen AS (
  SELECT b.source, b.key,
         upto <= budget OR (upto - words < budget AND upto - budget < budget - (upto - words)) AS once
  FROM buckets b JOIN (SELECT *, greatest(target - times * source_size, 0) AS budget FROM need) n
    ON b.source IS NOT DISTINCT FROM n.source)
SELECT r.doc_id, r.source, r.size, n.source_size, n.target,
       CASE WHEN size > 0 THEN least(times + once::INT, {p.most}) ELSE 0 END::INT AS copies,
       CASE WHEN size > 0 THEN least(times + once::INT, {p.most}) ELSE 0 END * size AS taken
FROM rows r JOIN need n ON r.source IS NOT DISTINCT FROM n.source
JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source AND r.key = c.key"""
