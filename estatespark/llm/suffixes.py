"""Quality rules on repetition, by suffix arrays over words.

For each text the suffix array of its words is built by prefix doubling: suffixes are ranked by
their first 1, 2, 4, ... words, and only those that are not yet told apart are sorted again. The
ranks of every level give the longest common prefix of neighbours in the array. A word's repeat is
the longest sequence from there on that also stands elsewhere in the text, the greater of the
common prefixes with both neighbours. Runs of the array with common prefixes of ``least`` words or
more are the repeated passages; the union of all repeats of that length is the text's covered part.

Texts of a batch go through numpy together, cut between rows into slices of bounded size; a text
that is longer stands alone. Words of different texts never compare equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as T

BLANK = " \t\n\v\f\r"
_SIGN = np.zeros(256, dtype=bool)
_SIGN[list(b"#*$%&|<>")] = True
_PLAIN = np.arange(256, dtype=np.uint8)
COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "covered_words long, longest_repeat long, n_passages long, spans array<struct<start:long,stop:long>>")


@dataclass(frozen=True)
class Params:
    window: int = 3  # words of the base rule's windows
    least: int = 10  # words of a repeat that counts as a passage
    covered: int = 30  # percent of the words that passages may cover
    longest: int = 100  # words that a repeat may have
    min_words: int = 50
    max_repeat: int = 50  # percent of the words in repeated windows


def _levels(keys: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until all differ; suffixes do not
    go on behind ``end``, the end of their text."""
    n = len(keys)
    order = np.lexsort((keys, end))
    new = np.ones(n, bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (end[order][1:] != end[order][:-1])
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels, step = [rank], 1
    size = np.diff(np.append(first, n))
    open_ = order[np.repeat(size > 1, size)]
    while len(open_):
        rank = levels[-1]
        nxt = open_ + step
        behind = np.where(nxt < end[open_], rank[np.minimum(nxt, n - 1)].astype(np.int64) + 1, 0)
        own = rank[open_].astype(np.int64)
        order = np.argsort(own * (n + 1) + behind, kind="stable")
        open_, own, behind = open_[order], own[order], behind[order]
        group = np.ones(len(own), bool)
        group[1:] = own[1:] != own[:-1]
        new = group.copy()
        new[1:] |= behind[1:] != behind[:-1]
        at = np.arange(len(own))
        heads = np.maximum.accumulate(np.where(group, at, 0))
        subs = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[open_] = own + (subs - heads)
        levels.append(rank)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(own)))
        open_ = open_[np.repeat(size > 1, size)]
        step *= 2
    return levels


def common_prefixes(keys: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of all rows' words (``words``: the rows' offsets) and, for each of its
    places but the first, the words in common with the place before."""
    n = len(keys)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end = np.repeat(words[1:], np.diff(words))
    levels = _levels(keys, end)
    array = np.empty(n, np.int64)
    array[levels[-1]] = np.arange(n)
    a, b = array[:-1].copy(), array[1:].copy()
    stop_a, stop_b = end[a], end[b]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < stop_a) & (b < stop_b)
        rank = levels[k]
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        step = same.astype(np.int64) << k
        lcp += step
        a += step
        b += step
    return array, lcp


def repeats(array: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest sequence from it that stands elsewhere too."""
    longest = np.zeros(len(array), np.int64)
    if len(array):
        longest[array[1:]] = lcp
        longest[array[:-1]] = np.maximum(longest[array[:-1]], lcp)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """The words that lie in a repeat of ``least`` words or more."""
    n = len(longest)
    at = np.flatnonzero(longest >= least)
    edge = np.zeros(n + 1, np.int64)
    edge[at] += 1
    np.subtract.at(edge, at + longest[at], 1)
    return np.cumsum(edge[:-1]) > 0


def maximal(array: np.ndarray, lcp: np.ndarray, keys: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """A place in the text for each maximal repeated passage: a run of the array with common
    prefixes of ``least`` words or more, whose members do not all follow one same word."""
    run = np.concatenate([[False], lcp >= least]) if len(array) else np.zeros(0, bool)
    starts = np.flatnonzero(run & ~np.concatenate([[False], run[:-1]])) - 1
    if not len(starts):
        return np.zeros(0, np.int64)
    stops = np.flatnonzero(run & ~np.concatenate([run[1:], [False]])) + 1
    before = keys[np.maximum(array - 1, 0)]
    edges = np.column_stack([starts, np.minimum(stops, len(array) - 1)]).ravel()
    low, high = np.minimum.reduceat(before, edges)[::2], np.maximum.reduceat(before, edges)[::2]
    if stops[-1] == len(array):  # reduceat leaves out the last place of the last run
        low[-1], high[-1] = before[starts[-1]:].min(), before[starts[-1]:].max()
    head = np.zeros(len(array), np.int64)
    head[words[:-1][np.diff(words) > 0]] = 1
    heads = np.concatenate([[0], np.cumsum(head[array])])
    return array[starts[(low != high) | (heads[stops] > heads[starts])]]


def _per_row(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(x)])[words])


def _measure(texts: list[str | None], raw: np.ndarray, off: np.ndarray, p: Params) -> dict[str, object]:
    keys, words = T.word_hashes(raw, off, _PLAIN)
    array, lcp = common_prefixes(keys, words)
    longest = repeats(array, lcp)
    mask = covered(longest, p.least)
    starts, stops = mask.copy(), mask.copy()
    starts[1:] &= ~mask[:-1]
    stops[:-1] &= ~mask[1:]
    row_start = words[:-1][np.diff(words) > 0]
    starts[row_start] = mask[row_start]  # a span ends with its text
    stops[words[1:][np.diff(words) > 0] - 1] = mask[words[1:][np.diff(words) > 0] - 1]
    row = np.repeat(np.arange(len(texts)), np.diff(words))
    begin, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    of = row[begin]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(begin - words[of]), pa.array(end - words[of])], names=["start", "stop"]))
    passages = np.bincount(row[maximal(array, lcp, keys, words, p.least)], minlength=len(texts))
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, row, longest)
    inner = ~T.SPACE[raw]
    letters = np.concatenate([[0], np.cumsum(inner & ((raw & 0xC0) != 0x80))])[off]
    signs = np.concatenate([[0], np.cumsum(_SIGN[raw])])[off]
    dup = []
    for t in texts:
        lines = [x for x in (t or "").split("\n") if x.strip(BLANK)]
        dup.append(len(lines) - len(set(lines)))
    return {"n_words": np.diff(words), "word_chars": np.diff(letters), "n_symbols": np.diff(signs), "n_dup_lines": dup,
            "n_repeat_words": _per_row(covered(longest, p.window), words), "covered_words": _per_row(mask, words),
            "longest_repeat": top, "n_passages": passages, "spans": spans}


def measured(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Counts of every row of ``docs`` (doc_id, text, any others), its repeats included.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines, n_repeat_words (in windows
    that occur twice or more), covered_words, longest_repeat, n_passages and spans (the covered
    part, as word offsets). A null text is empty; an empty one, or one without a word, has zeros
    and no span. Equal rows have equal results; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = T.text_buffers(b.column("text"))
            for i, j in T.slices(off):
                part = off[i:j + 1]
                found = _measure(b.column("text").slice(i, j - i).to_pylist(), raw[part[0]:part[-1]], part - part[0], p)
                cols = [pa.array(v, pa.int64()) if not isinstance(v, pa.Array) else v for v in found.values()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), *cols], names=["doc_id", *found])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, COLUMNS)


def judged(counts: DataFrame, p: Params = Params()) -> DataFrame:
    """``counts`` with base_failed (too short, or too many words in repeated windows) and kept.

    Kept are texts that pass the base rule, whose passages cover ``covered`` percent of the words
    at most and whose longest repeat has ``longest`` words at most.
    """
    n = F.col("n_words")
    base = (n < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat * n)
    repeats_less = (100 * F.col("covered_words") <= p.covered * n) & (F.col("longest_repeat") <= p.longest)
    return counts.withColumn("base_failed", base).withColumn("kept", ~base & repeats_less)


def oracle_sql(p: Params = Params()) -> str:
    """DuckDB's SQL of the same counts: a repeat is a window of so many words that occurs again."""
    def windows(name: str, k: int) -> str:
        return f"""{name}_w AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, hash(w[i:i + {k - 1}])) > 1 AS again
  FROM t, unnest(range(1, len(w) - {k - 2})) AS r(i)),
{name} AS (SELECT rid, count(DISTINCT i + o) AS n FROM {name}_w, unnest(range({k})) AS s(o) WHERE again GROUP BY rid)"""
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
{windows("short", p.window)},
{windows("long", p.least)},
{windows("over", p.longest + 1)},
base AS (
  SELECT t.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         coalesce(short.n, 0) AS n_repeat_words, coalesce(long.n, 0) AS covered_words, over.n IS NOT NULL AS too_long
  FROM t LEFT JOIN short ON short.rid = t.rid LEFT JOIN long ON long.rid = t.rid LEFT JOIN over ON over.rid = t.rid),
judged AS (SELECT *, n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND NOT too_long AND 100 * covered_words <= {p.covered} * n_words AS kept
FROM judged"""
