"""Language identification by compression against per-language dictionaries.

A dictionary of raw content is gathered for every language from a bounded sample of its texts.
A text belongs to the language whose dictionary lets zstandard encode it in the fewest bytes;
where the best and the second best are nearly as short, the margin is narrow and the text is
marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import pyarrow as pa
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small

UNKNOWN = "und"
TOGETHER = 512  # texts that meet a dictionary one after the other
_OTHER = regex.compile(r"[^\p{L}]+")


@dataclass(frozen=True)
class Params:
    texts: int = 240  # different labelled texts of a language that it learns from, those with the least hash
    pieces: int = 4  # of each, at places that the hash gives; a text no longer than all of them is taken whole
    chars: int = 250  # of a piece
    level: int = 12
    tie_level: int = 19  # decides between encodings of equal length
    margin: float = 0.01  # of the best size; a narrower lead is rejected
    languages: int = 1_000  # more raise an error


def plain(text: str) -> str:
    """Lower case, and one space for all that is between words."""
    return _OTHER.sub(" ", text.lower()).strip()


def learn(docs: DataFrame, use: Column, p: Params = Params()) -> dict[str, bytes]:
    """A dictionary for every lang among the rows of docs (text, lang) for which ``use`` holds.

    Rows without text or lang teach nothing, and copies of a text teach once. The sample has the
    texts of the least hash of each language, and of a long text pieces from all over it; only hashes
    are shuffled to find them, and partial top lists combine before they meet. The whole sample is
    the dictionary. More languages than ``p.languages`` raise a ValueError.
    """
    text = F.col("text").cast("string")
    rows = (docs.filter(use).filter("text is not null and text <> '' and lang is not null")
            .select(F.col("lang").cast("string").alias("lang"), F.xxhash64(text).alias("mark"), text.alias("text")))
    least = Window.partitionBy("lang").orderBy("mark")
    best = cut(rows.select("lang", "mark").distinct().withColumn("n", F.row_number().over(least))
               .filter(F.col("n") <= p.texts).drop("n"), "sample")
    if best.select("lang").distinct().limit(p.languages + 1).count() > p.languages:
        raise ValueError(f"more than {p.languages} languages")
    length, whole = F.length("text"), p.pieces * p.chars
    at = lambda i: (F.pmod(F.xxhash64("mark", i), length - p.chars + 1) + 1).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(p.pieces - 1)), lambda i: F.substring(F.col("text"), at(i), F.lit(p.chars)))
    taken = F.when(length <= whole, F.array("text")).otherwise(pieces)
    found: dict[str, list[str]] = {}
    picked = cut(rows.join(small(best), ["lang", "mark"], "left_semi").select("lang", "mark", taken.alias("pieces"))
                 .dropDuplicates(["lang", "mark"]), "pieces")
    for r in picked.orderBy("lang", "mark").toLocalIterator():  # p.texts * p.languages rows at most
        found.setdefault(r.lang, []).extend(map(plain, r.pieces))
    return {lang: " ".join(texts).encode() for lang, texts in sorted(found.items())}


Compressors = list[tuple[str, zstandard.ZstdCompressor, zstandard.ZstdCompressor]]


@lru_cache(maxsize=2)
def _compressors(shared: Broadcast, p: Params) -> Compressors:
    return compressors(shared.value, p)


def compressors(dictionaries: dict[str, bytes], p: Params = Params()) -> Compressors:
    def made(raw: bytes, level: int) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False)
    return [(lang, made(raw, p.level), made(raw, p.tie_level)) for lang, raw in dictionaries.items()]


Found = tuple[str, float, bool]


def classify_all(texts: Iterable[str | None], by: Compressors, p: Params = Params()) -> list[Found]:
    """Language, score (the runner-up's share of the two best sizes) and whether the lead is narrow, for each text.

    One dictionary after the other sees TOGETHER texts, so its tables stay in the processor's cache.
    """
    texts, out = iter(texts), []
    while part := [plain(t or "") for t in islice(texts, TOGETHER)]:
        raw = [f" {words} ".encode() for words in part]
        sizes = [[len(c.compress(r)) if words else 0 for words, r in zip(part, raw)] for _, c, _ in by]
        for i, words in enumerate(part):
            out.append(_best(raw[i], [(s[i], lang) for s, (lang, _, _) in zip(sizes, by)], by, p) if words and by
                       else (UNKNOWN, 0.0, True))
    return out


def _best(raw: bytes, sizes: list[tuple[int, str]], by: Compressors, p: Params) -> Found:
    size = sorted(sizes)
    if len(size) == 1:
        return size[0][1], 1.0, False
    if size[0][0] == size[1][0]:
        again = sorted((len(c.compress(raw)), lang) for lang, _, c in by if (size[0][0], lang) in size)
        return again[0][1], 0.5, True
    lead = (size[1][0] - size[0][0]) / size[0][0]
    return size[0][1], size[1][0] / (size[0][0] + size[1][0]), lead < p.margin


def classify(text: str | None, by: Compressors, p: Params = Params()) -> Found:
    """What ``classify_all`` finds for one text."""
    return classify_all([text], by, p)[0]


def predict(docs: DataFrame, dictionaries: dict[str, bytes], p: Params = Params()) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of ``docs`` (doc_id, text, any others).

    lang_pred is the language of the shortest encoding (ties: that of a slower level, then the first by name), and ``und``
    for a null text, one without a letter, or without any dictionary; rejected marks a
    narrow lead and every ``und``. Equal rows have equal
    results; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # p.texts pieced texts a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _compressors(shared, p)
        for b in batches:
            found = classify_all((t.as_py() for t in b.column("text")), by, p)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
