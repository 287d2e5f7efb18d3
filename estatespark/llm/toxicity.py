"""Toxicity scores by a counterfactually regularised logistic classifier.

A text's features are the sets of its words and of their heads, hashed. The model is fitted on
a bounded sample of labelled rows. Each sampled sentence that names a group (an identity term)
is paired with its counterfactual, in which the term is swapped for another of its kind; the
loss adds the squared change of the score between the two, so the weights cannot rest on which
group a text mentions. Features of the sampled texts, whole, are extracted in the tasks; fitting
runs on the driver over these alone. Scoring runs in the tasks, over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as T
from .common import cut, releasing

# Identity terms that may stand for one another.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("old", "young"), ("disabled", "deaf", "blind"), ("immigrants", "natives", "refugees"),
    ("mujeres", "hombres"), ("frauen", "männer"), ("femmes", "hommes"),
    ("musulman", "chrétien", "juif"), ("muslime", "christen", "juden"), ("musulmanes", "cristianos", "judíos"),
)
_SWAP = {t: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, t in enumerate(group)}
_TERM = re.compile(r"\b(" + "|".join(sorted(_SWAP, key=lambda t: (-len(t), t))) + r")\b", re.I)


@dataclass(frozen=True)
class Params:
    sample: int = 12_000  # labelled rows fitted on, at most: those with the least hash
    features: int = 1 << 20  # of a hash; a power of two
    stems: tuple[int, ...] = (4, 5, 6, 7, 8)  # bytes
    least_z: float = 4.5  # a feature's share of the toxic rows must differ so many deviations from its share of the others
    ridge: float = 1e-4
    fairness: float = 1.0  # weight of the squared change under a swap
    rounds: int = 300
    rate: float = 0.1


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one a feature
    bias: float


def counterfactual(text: str) -> str:
    """The text with every identity term swapped for the next of its kind."""
    return _TERM.sub(lambda m: _SWAP[m[0].lower()], text)


def features(col: pa.Array, p: Params) -> Iterator[np.ndarray]:
    """Each row's sorted distinct feature numbers (a null or empty text has none)."""
    raw, off = T.text_buffers(col)
    for i, j in T.slices(off):
        part = off[i:j + 1]
        kinds, words = T.stem_hashes(raw[part[0]:part[-1]], part - part[0], p.stems)
        kinds = [(h >> np.uint64(12)).astype(np.uint32).view(np.int32) & (p.features - 1) for h in kinds]
        for a, b in zip(words[:-1].tolist(), words[1:].tolist()):
            x = np.sort(np.concatenate([h[a:b] for h in kinds]))
            yield x[np.append(True, x[1:] != x[:-1])] if len(x) > 1 else x


class _Rows:
    """A sparse 0/1 matrix whose rows are scaled to unit length."""

    def __init__(self, rows: list[np.ndarray]):
        size = np.array([len(r) for r in rows], np.int64)
        self.at = np.concatenate([np.zeros(0, np.int32), *rows])
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), size)
        self.n = len(rows)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n)

    def back(self, e: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.at, e[self.row], size)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[str], labels: list[int], p: Params = Params()) -> Model:
    """A model for the labels 0 and 1; with one kind of label, or none, a constant score."""
    rows = list(features(pa.array(texts, pa.large_string()), p))
    named = [(i, s) for i, s in enumerate(map(counterfactual, texts)) if s != texts[i]]
    swapped = list(features(pa.array([s for _, s in named], pa.large_string()), p))
    return fit_features(rows, [i for i, _ in named], swapped, labels, p)


def fit_features(rows: list[np.ndarray], named: list[int], swapped: list[np.ndarray], labels: list[int],
                 p: Params = Params()) -> Model:
    """The model of rows of features; ``swapped`` has those of the counterfactuals of the rows ``named``."""
    weights = np.zeros(p.features, np.float32)
    y = np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        prior = (y.sum() + 0.5) / (len(y) + 2.0)
        return Model(weights, float(np.log(prior / (1 - prior))))
    count, toxic = np.zeros(p.features, np.int64), np.zeros(p.features, np.int64)
    for r, t in zip(rows, labels):  # a row names each of its features once
        count[r] += 1
        toxic[r] += t
    share = count / len(y)
    spread = np.sqrt(share * (1 - share) * (1 / y.sum() + 1 / (len(y) - y.sum()))) + 1e-12
    gap = toxic / y.sum() - (count - toxic) / (len(y) - y.sum())
    used = np.flatnonzero((np.abs(gap) >= p.least_z * spread) & (count > 0))
    number = np.full(p.features, -1, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    short = lambda r: number[r][number[r] >= 0]
    x = _Rows([short(r) for r in rows])
    pairs = np.array(named, np.int64)
    xs = _Rows([short(r) for r in swapped])
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # both kinds weigh alike
    scale = 1 / np.sqrt(count[used] + 1.0)  # rare features learn as fast as frequent ones
    w, b = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for t in range(1, p.rounds + 1):  # Adam over the whole sample
        z = x.times(w * scale) + b
        error = balance * (_sigmoid(z) - y) / len(y)
        g = x.back(error, len(used))
        if len(pairs):
            s1, s2 = _sigmoid(z[pairs]), _sigmoid(xs.times(w * scale) + b)
            gap = 2 * p.fairness * (s1 - s2) / len(pairs)
            full = np.zeros(x.n)
            full[pairs] = gap * s1 * (1 - s1)
            g += x.back(full, len(used)) - xs.back(gap * s2 * (1 - s2), len(used))
        g = g * scale + p.ridge * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w -= p.rate * (m / fix) / (np.sqrt(v / fix2) + 1e-8)
        b -= p.rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-8)
    weights[used] = w * scale
    return Model(weights, float(b))


def scores(col: pa.Array, model: Model, p: Params) -> np.ndarray:
    return _sigmoid(np.array([model.weights[x].sum(dtype=float) for x in features(col, p)]) + model.bias)


def fit_frame(docs: DataFrame, labels: DataFrame, learn: Column, p: Params = Params()) -> Model:
    """Model of labels.toxic from the rows of docs for which ``learn`` (of doc_id) holds."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("toxic in (0, 1) and doc_id is not null").filter(learn)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mark = [F.xxhash64("doc_id").alias("mark"), F.sha2(F.col("text").cast("binary"), 256).alias("digest")]
    sampled = texts.join(F.broadcast(picked), "doc_id").filter("text is not null").select("doc_id", "toxic", "text", *mark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # one row at a time: texts may be long
                one = b.slice(i, 1)
                text = one.column("text")[0].as_py()
                other = counterfactual(text)
                found = [next(features(pa.array([x], pa.large_string()), p)).astype(np.int32).tobytes() if x is not None else None
                         for x in (text, other if other != text else None)]
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(c) for c in ("mark", "doc_id", "digest", "toxic")),
                     *(pa.array([x], pa.binary()) for x in found)],
                    names=["mark", "doc_id", "digest", "toxic", "own", "swapped"])
    order = ["mark", "doc_id", "digest", "row"]
    rows = cut(sampled.mapInArrow(releasing(run), "mark long, doc_id long, digest string, toxic int, own binary, swapped binary")
               .withColumn("row", F.monotonically_increasing_id()), "features")
    kept = {r.row: i for i, r in enumerate(rows.select(*order).orderBy(*order).limit(p.sample).collect())}
    own: list[np.ndarray] = [np.zeros(0, np.int32)] * len(kept)
    marks, pairs = [0] * len(kept), {}
    for r in rows.select("row", "toxic", "own", "swapped").toLocalIterator():  # a partition at a time
        i = kept.get(r.row)
        if i is not None:
            own[i], marks[i] = np.frombuffer(r.own, np.int32), r.toxic
            if r.swapped is not None:
                pairs[i] = np.frombuffer(r.swapped, np.int32)
    named = sorted(pairs)
    return fit_features(own, named, [pairs[i] for i in named], marks, p)


def score(docs: DataFrame, model: Model, p: Params = Params()) -> DataFrame:
    """doc_id, text, score, predicted for every row; a null or empty text has the bias's score.

    Repeated rows have one score; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # p.features floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = scores(b.column("text"), shared.value, p)
            yield b.append_column("score", pa.array(s, pa.float64())).append_column(
                "predicted", pa.array((s >= 0.5).astype(np.int32), pa.int32()))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(releasing(run), "doc_id long, text string, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(scores(b.column("text"), shared.value, p) < 0.5))
    return docs.mapInArrow(releasing(run), schema)
