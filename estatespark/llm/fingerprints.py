"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the k least distinct shingle hashes (48 bits) of a text. Sketches of parts
merge into the sketch of the whole, and two sketches give estimates of resemblance,
containment and the number of distinct shingles; below k shingles all of these are exact.
The string form is ``bk1:k:base64``, with six bytes a hash in ascending order.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as T

K = 128
SHINGLE = 5
SPACE = 1 << 48


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of sorted distinct 64-bit shingle hashes."""
    x = hashes[:2 * k] >> np.uint64(16)  # sorted, so their heads are sorted too
    x = x[np.append(True, x[1:] != x[:-1])] if len(x) > 1 else x
    return x[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of what a and b were made from."""
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) * SPACE / float(a[-1] + np.uint64(1))


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    both = merge(a, b, k)
    if not len(both):
        return 0, 0
    top = both[-1]
    in_a, in_b = a[a <= top], b[b <= top]
    return len(np.intersect1d(in_a, in_b, assume_unique=True)), len(both)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated intersection / union; 1 for two empty sketches, 0 for one."""
    common, of = _shared(a, b, k)
    return common / of if of else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 if a is empty."""
    common, of = _shared(a, b, k)
    if not len(a):
        return 1.0
    union = distinct(merge(a, b, k), k)
    return min(1.0, common / of * union / distinct(a, k))


def encode(a: np.ndarray, k: int = K) -> str:
    body = a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return f"bk1:{k}:{base64.b64encode(body).decode()}"


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text.split(":")[2]), np.uint8).reshape(-1, 6)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 2:] = raw
    return full.view(">u8").astype(np.uint64).ravel()


def _sketches(col: pa.Array, shingle: int, k: int) -> list[np.ndarray]:
    return [sketch(s, k) for s in T.shingle_sets(col, shingle)]


def fingerprint(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """doc_id and fingerprint of every row (null text: that of an empty one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [encode(x, k) for x in _sketches(b.column("text"), shingle, k)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(made, pa.string())],
                                             names=["doc_id", "fingerprint"])
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, fingerprint string")


def _with_next(docs: DataFrame) -> DataFrame:
    """Each row with the text that follows it in descending doc_id, the first after the last.

    Rows are dealt into ranges of the id, so no task sorts the whole table; the row after the
    last of a range is the first of the next range, looked up from one row per range. Null
    ids come last, in ranges of a hash of their text; equal ids are ordered by that hash.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    some, none = rows.filter("doc_id is not null"), rows.filter("doc_id is null")
    cuts = sorted({int(c) for c in some.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts)})
    mark = F.xxhash64("text")
    # the number of cuts above an id: descending ids have ascending ranges
    by_id = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c > F.col("doc_id"))) \
        if cuts else F.lit(0)
    by_mark = F.shiftright(mark, 58).cast("int") + F.lit(len(cuts) + 33)
    rows = some.withColumn("part", by_id).unionByName(none.withColumn("part", by_mark)).withColumn("mark", mark)
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark"), F.col("text")]
    near = rows.withColumn("next", F.lead("text").over(Window.partitionBy("part").orderBy(*order)))
    tops = some.groupBy(by_id.alias("part")).agg(F.max("doc_id").alias("doc_id"))  # one row per range
    firsts = some.join(F.broadcast(tops), "doc_id").unionByName(none.withColumn("part", by_mark))
    heads = firsts.groupBy("part").agg(F.min(F.struct(mark.alias("mark"), "text")).alias("head"))
    heads = heads.select("part", F.col("head.text").alias("head"))
    ring = Window.partitionBy().orderBy("part")  # over one row per range
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("part", F.coalesce(F.lead("head").over(ring), F.first("head").over(whole)).alias("after"))
    return (near.join(F.broadcast(after), "part")  # at most parts + 64 rows
            .select("doc_id", "text", F.coalesce("next", "after").alias("next")))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness.

    Edited: the last floor(n_chars / 2) code points are replaced by the first as many (or all)
    of the next document's, in descending doc_id, the first after the last. A single document
    is its own next one. Null texts count as empty; two empty sketches are alike (1), an empty
    and another are not (0). Repeated rows each give a row. An empty table gives none.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, kept_share double, distinct_shingles double")
    names = [c.split()[0] for c in schema.split(", ")]

    def rows_of(b: pa.RecordBatch) -> pa.RecordBatch:
        text, following = b.column("text").to_pylist(), b.column("next").to_pylist()
        edited = [_edited(x, y) for x, y in zip(text, following)]
        own = _sketches(b.column("text"), shingle, k)
        made = _sketches(pa.array(edited, pa.large_string()), shingle, k)
        # most rows' next text is the row below; the others are sketched here
        below = [i + 1 < len(text) and following[i] == text[i + 1] for i in range(len(text))]
        others = iter(_sketches(pa.array([y for y, z in zip(following, below) if not z], pa.large_string()), shingle, k))
        then = [own[i + 1] if z else next(others) for i, z in enumerate(below)]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(x) for x in text], pa.int64()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
             pa.array([encode(x, k) for x in own], pa.string()), pa.array([encode(x, k) for x in made], pa.string()),
             pa.array([resemblance(x, y, k) for x, y in zip(own, made)], pa.float64()),
             pa.array([resemblance(x, y, k) for x, y in zip(own, then)], pa.float64()),
             pa.array([containment(x, y, k) for x, y in zip(own, made)], pa.float64()),
             pa.array([distinct(x, k) for x in own], pa.float64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                yield rows_of(b.slice(i, 1000))
    return _with_next(docs).mapInArrow(run, schema)
