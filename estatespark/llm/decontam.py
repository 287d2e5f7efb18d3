"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is split into k + 1 pieces: wherever the item
occurs with at most k edits, one piece at least occurs unchanged. The pieces of all items are
looked for at once (Aho-Corasick); every hit names a place, which Myers' bit-parallel edit
distance then verifies against the whole item. Texts are compared in lower case, with every
run of ASCII signs and spaces as one space, and at word boundaries.

The items go to the tasks in blocks of bounded size; documents are neither shuffled nor paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as T
from .common import releasing

SLICE = 2 << 20


@dataclass(frozen=True)
class Params:
    rate: float = 0.06  # edits allowed, as a share of the item's length
    least: int = 24  # bytes; shorter items match without edits only
    block: int = 4_000_000  # bytes of items in a block


HITS = "doc_id long, item_id long, edits int, span_start long, span_end long"


def normalised(col: pa.Array) -> tuple[bytes, np.ndarray]:
    """The rows' bytes, each row between two spaces, and their offsets."""
    raw, off = T.text_buffers(pc.utf8_lower(col.cast(pa.large_string()).fill_null("")))
    n = len(off) - 1
    # a separator on both sides of each row
    at = np.arange(len(raw)) + np.repeat(2 * np.arange(n) + 1, np.diff(off))
    wide = np.full(len(raw) + 2 * n, 32, np.uint8)
    wide[at] = np.where(T.SIGNS[raw], 32, raw)
    bounds = off + 2 * np.arange(n + 1)
    keep = np.ones(len(wide), bool)
    keep[1:] = (wide[1:] != 32) | (wide[:-1] != 32)
    keep[bounds[:-1]] = True  # a row's first space stays, whatever ended the row before
    return wide[keep].tobytes(), np.concatenate([[0], np.cumsum(keep)])[bounds]


def distance(pattern: bytes, text: bytes, peq: dict[int, int] | None = None) -> tuple[int, int]:
    """Myers' search: the least edit distance of pattern to a substring of text, and its end."""
    m = len(pattern)
    peq = peq or pattern_bits(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (mask & ~(xh | plus))
        mh = plus & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        # a match may start anywhere: no carry into the lowest row
        ph, mh = (ph << 1) & mask, (mh << 1) & mask
        plus = mh | (mask & ~(xv | ph))
        minus = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def pattern_bits(pattern: bytes) -> dict[int, int]:
    bits: dict[int, int] = {}
    for i, c in enumerate(pattern):
        bits[c] = bits.get(c, 0) | 1 << i
    return bits


def budget(size: int, p: Params) -> int:
    return int(size * p.rate) if size >= p.least else 0


class Matcher:
    """Finds the items (id, text) of one block in normalised documents."""

    def __init__(self, items: list[tuple[int, str]], p: Params):
        import ahocorasick
        self.items, places = [], {}
        for item, text in items:
            body = normalised(pa.array([text], pa.large_string()))[0]
            if len(body) <= 2:
                continue  # nothing but signs
            k = budget(len(body), p)
            cuts = [len(body) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                places.setdefault(body[a:b], []).append((len(self.items), a))
            self.items.append((item, body, k, pattern_bits(body)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece.decode("latin-1"), (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: bytes, off: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item number, edits, start, end) of each item's best place in each row.

        start and end are offsets in the row's normalised bytes; start is that of the window.
        """
        if not self.items:
            return
        tried: dict[tuple[int, int], list[int]] = {}
        for end, (size, where) in self.automaton.iter(text.decode("latin-1")):
            for item, a in where:
                tried.setdefault((item, end + 1 - size - a), []).append(end)
        if not tried:
            return
        keys = np.array(sorted(tried), np.int64)
        first_end = np.array([tried[i, d][0] for i, d in keys.tolist()])
        rows = np.searchsorted(off, first_end, side="right") - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}  # diagonal verified last
        for (item, diag), row in zip(keys.tolist(), rows.tolist()):
            _, body, k, bits = self.items[item]
            known = best.get((row, item))
            if known and (known[0] == 0 or abs(diag - done[row, item]) <= k):
                continue
            lo, hi = max(int(off[row]), diag - k), min(int(off[row + 1]), diag + len(body) + k)
            edits, stop = distance(body, text[lo:hi], bits)
            if edits <= k and (not known or edits < known[0]):
                best[row, item] = (edits, lo - int(off[row]), lo + stop - int(off[row]))
                done[row, item] = diag
        for (row, item), (edits, a, b) in best.items():
            yield row, item, edits, a, b


@lru_cache(maxsize=2)
def _matcher(block: int, shared: Broadcast, p: Params) -> Matcher:
    return Matcher(shared.value, p)


def _blocks(benchmark: DataFrame, p: Params) -> Iterator[Broadcast]:
    rows, size = [], 0
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for r in items.filter("text is not null").distinct().toLocalIterator():
        if rows and size + len(r.text) > p.block:
            yield sc.broadcast(rows)
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += len(r.text)
    if rows:
        yield sc.broadcast(rows)


def _found(col: pa.Array, m: Matcher) -> Iterator[tuple[int, int, int, int, int]]:
    _, off = T.text_buffers(col)
    for i, j in T.slices(off, SLICE):
        text, at = normalised(col.slice(i, j - i))
        for row, *rest in m.find(text, at):
            yield i + row, *rest


def matches(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, item_id, edits, span_start, span_end: a row for each item in each document's text.

    An item occurs if the text has it with at most rate * length edits; given is its best
    place, as offsets in the normalised text. Null texts and empty items match nothing; equal
    rows each give their rows. Without items or documents there are no rows.
    """
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], HITS)
    for number, shared in enumerate(_blocks(benchmark, p)):
        def run(batches: Iterator[pa.RecordBatch], number: int = number, shared: Broadcast = shared):
            m = _matcher(number, shared, p)
            for b in batches:
                found = list(_found(b.column("text"), m))
                cols = list(zip(*found)) if found else [()] * 5
                rows = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), pa.array([m.items[i][0] for i in cols[1]], pa.int64()),
                     pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    names=["doc_id", "item_id", "edits", "span_start", "span_end"])
        out = out.unionByName(picked.mapInArrow(releasing(run), HITS))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose text no item occurs."""
    for number, shared in enumerate(_blocks(benchmark, p)):
        def run(batches: Iterator[pa.RecordBatch], number: int = number, shared: Broadcast = shared):
            m = _matcher(number, shared, p)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[f[0] for f in _found(b.column("text"), m)]] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(releasing(run), docs.schema)
    return docs
