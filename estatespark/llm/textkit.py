"""Vectorised hashing of words and shingles over Arrow text columns.

Words are the maximal runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased.
Everything works on whole texts; long inputs are cut between rows into slices of bounded
size, so the temporary arrays stay small however long a batch is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SIGNS = np.arange(256) < 128
SIGNS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers that depend on the seed alone."""
    with np.errstate(over="ignore"):
        return mix(np.arange(n, dtype=np.uint64) + _U(seed << 32)) | _U(1)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and the offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _words(raw: np.ndarray, off: np.ndarray, apart: np.ndarray, fold: np.ndarray = _LOWER) -> tuple[np.ndarray, ...]:
    """Hash addends of the bytes inside words, their positions there, the words' first
    addends, their sizes, and the offsets of each row's words."""
    inner = ~apart[raw]
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    heads = off[:-1][off[:-1] < len(raw)]
    first[heads] = inner[heads]
    starts = np.flatnonzero(first)
    words = np.searchsorted(starts, off)
    at = np.flatnonzero(inner)
    head = np.searchsorted(at, starts)
    size = np.diff(np.append(head, len(at)))
    pos = np.arange(len(at)) - np.repeat(head, size)
    keys = stream(1, int(size.max()) if len(size) else 0)
    val = (fold[raw[at]].astype(np.uint64) + _U(1)) * keys[pos]
    return val, pos, head, size, words


def word_hashes(raw: np.ndarray, off: np.ndarray, fold: np.ndarray = _LOWER) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, its bytes mapped by ``fold``, and the offsets of each row's words."""
    val, _, head, size, words = _words(raw, off, SPACE, fold)
    if len(head) == 0:
        return np.zeros(0, np.uint64), words
    return mix(np.add.reduceat(val, head) + size.astype(np.uint64)), words


def stem_hashes(raw: np.ndarray, off: np.ndarray, stems: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words between ASCII signs, and of their heads of so many bytes.

    First come the words; then, for each length, the heads of all words (shorter words
    whole). Offsets are those of the rows' words.
    """
    val, pos, head, size, words = _words(raw, off, SIGNS)
    if len(head) == 0:
        return [np.zeros(0, np.uint64)] * (1 + len(stems)), words
    out = [mix(np.add.reduceat(val, head) + size.astype(np.uint64))]
    for n in stems:
        part = np.add.reduceat(np.where(pos < n, val, _U(0)), head)
        out.append(mix(part + _U(n << 32)))
    return out, words


def shingle_hashes(h: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of k words within a row (repeats kept) and the rows' offsets.

    A row with 1 to k-1 words has its whole sequence as the one shingle; a row without
    words has none.
    """
    n, count = len(h), np.diff(words)
    if n == 0:
        return h, np.zeros(len(words), np.int64)
    end = np.repeat(words[1:], count)
    at = np.arange(n)
    keys = stream(2, k + 1)
    with np.errstate(over="ignore"):
        total = h * keys[0]
        for j in range(1, min(k, n)):
            part = h[j:] * keys[j]
            part[at[j:] >= end[:n - j]] = 0
            total[:n - j] += part
        short = np.repeat(np.minimum(count, k), count).astype(np.uint64)
        total = mix(total + short * keys[k])
    keep = at + k <= end
    keep[words[:-1][(count > 0) & (count < k)]] = True
    per_row = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    return total[keep], np.concatenate([[0], np.cumsum(per_row)])


def shingle_sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes."""
    raw, off = text_buffers(col)
    for i, j in slices(off):
        part = off[i:j + 1]
        h, words = word_hashes(raw[part[0]:part[-1]], part - part[0])
        s, at = shingle_hashes(h, words, k)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            x = np.sort(s[a:b])
            yield x[np.append(True, x[1:] != x[:-1])] if b - a > 1 else x
