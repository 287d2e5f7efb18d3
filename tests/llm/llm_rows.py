"""Awkward rows that every operator has to take, and small tables of other shapes."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns whose names the operators use inside
CLASH = "size long, key string, row string, copies int, node long, band long, score double, part int, n long"


def words(rng: random.Random, n: int, pool: int = 400) -> str:
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def awkward(seed: int = 7) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows, near copies."""
    rng = random.Random(seed)
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, "b", 4), (4, "one", "de", None, 3),
            (5, "one", "de", None, 3), (6, "Two words", "en", "b", 9), (None, "no id here at all", None, None, None),
            (None, "no id here at all", None, None, None), (None, None, None, None, None)]
    base = words(rng, 120).split()
    for i in range(10, 30):
        copy = list(base)
        for _ in range(rng.randrange(0, 14)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy), "en", "a", 0))
    rows += [(i, words(rng, rng.randrange(1, 200)), rng.choice(["en", "de", "fr"]), rng.choice("abc"), 0)
             for i in range(40, 80)]
    rows.append((90, words(rng, 30_000, 10_000), "fr", "c", 0))
    rows.append((91, "ß" * 50_000, "de", "c", 0))  # one very long word
    rows += [(95, "the same row twice, the same row twice", "en", "b", 0)] * 2
    return rows


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        names = [c.split() for c in CLASH.split(", ")]
        df = df.selectExpr("*", *[f"cast(null as {t}) as {n}" for n, t in names])
    return df


def same_rows(a, b) -> bool:
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
