import random
import re

import numpy as np
import pyarrow as pa
import pytest
from estatespark.llm import graph as G
from estatespark.llm import neardup as N
from estatespark.llm import textkit as T
from estatespark.llm.graph import components
from llm_rows import awkward, frame, same_rows, words


def shingles(text, k):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in re.split("[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs; ids are unique or null."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i), d) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_awkward_rows_match_all_pairs(spark, k):
    rows = [r for r in awkward() if r[0] != 95] + [(95, "the same row twice, the same row twice", "en", "b", 0)]
    got = N.near_duplicates(frame(spark, rows, clash=True), N.Params(shingle=k)).collect()
    assert same_rows(got, brute([(r[0], r[1]) for r in rows], k))


def test_repeated_rows_are_one_document(spark):
    rows = [(3, "a b c d e f", None, None, None)] * 3 + [(2, "a b c d e f", None, None, None)]
    got = N.near_duplicates(frame(spark, rows)).collect()
    assert same_rows(got, [(3, 2, 2, False)] * 3 + [(2, 2, 2, True)])


def test_empty_table(spark):
    df = frame(spark, [])
    assert N.near_duplicates(df).collect() == []
    assert N.keep_one(df).collect() == []


def family(rng, n, least=3, most=16, size=150):
    """Copies of one text around the threshold, changed apart; every eighth is a copy of a copy."""
    base = words(rng, size, 10 ** 6).split()
    rows = []
    for i in range(n):
        copy = list(base)
        for j in rng.sample(range(size), rng.randrange(least, most)):
            copy[j] = f"y{rng.randrange(10 ** 6)}"
        if i % 8 == 0 and rows:
            copy = rows[-1][1].split()
            copy[rng.randrange(size)] = "z"
        rows.append((1000 - i, " ".join(copy), None, None, None))
    return rows


def test_large_family_of_copies_changed_apart(spark):
    rows = family(random.Random(3), 160)
    got = N.near_duplicates(frame(spark, rows), N.Params(shingle=2)).collect()
    expected = brute([(r[0], r[1]) for r in rows], 2)
    assert 1 < sum(r[3] for r in expected) < 150
    assert same_rows(got, expected)


def linked(rows, k=2):
    """Pairs of rows that reach the threshold, by comparing all."""
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    return {(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
            if x and y and 100 * len(x & y) >= 80 * len(x | y)}


def test_recall_on_dense_families_around_the_threshold(spark):
    """Of all linked pairs, those that end in one component; edits drawn from few words make
    links that need not pass the hub."""
    rng = random.Random(8)
    rows = []
    for f in range(6):
        base = words(rng, 120, 10 ** 6).split()
        spots = rng.sample(range(120), 24)
        for i in range(60):
            copy = list(base)
            for j in rng.sample(spots, rng.randrange(4, 20)):
                copy[j] = f"{base[j]}x"
            rows.append((f * 100 + i, " ".join(copy), None, None, None))
    pairs = linked(rows)
    of = {r.doc_id: r.component_id for r in N.near_duplicates(frame(spark, rows), N.Params(shingle=2)).collect()}
    recall = sum(of[a] == of[b] for a, b in pairs) / len(pairs)
    assert recall >= 0.95


def test_exact_goes_on_until_no_group_is_open(spark):
    rows = family(random.Random(5), 9, least=6, most=12)
    p = N.Params(shingle=2, levels=1, exact=True)
    assert same_rows(N.near_duplicates(frame(spark, rows), p).collect(), brute([(r[0], r[1]) for r in rows], 2))


def spread(rng, families=6, size=60):
    """Dense families around the threshold, whose links need not pass the hub."""
    rows = []
    for f in range(families):
        base = words(rng, 120, 10 ** 6).split()
        spots = rng.sample(range(120), 24)
        for i in range(size):
            copy = list(base)
            for j in rng.sample(spots, rng.randrange(4, 20)):
                copy[j] = f"{base[j]}x"
            rows.append((f * 100 + i, " ".join(copy), None, None, None))
    return rows


def test_no_link_of_dense_families_is_left_out(spark):
    rows = spread(random.Random(8))
    got = N.near_duplicates(frame(spark, rows), N.Params(shingle=2)).collect()
    assert same_rows(got, brute([(r[0], r[1]) for r in rows], 2))


def test_keep_one_compares_blocks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 1)
    monkeypatch.setattr(N, "BLOCK_CLASSES", 20)
    rows = spread(random.Random(8), 3)
    kept = sorted(r.doc_id for r in N.keep_one(frame(spark, rows), N.Params(shingle=2, levels=1)).collect())
    assert kept == sorted(r[0] for r in brute([(r[0], r[1]) for r in rows], 2) if r[3])


def test_keep_one_finds_links_that_share_no_band(spark, monkeypatch):
    """With one band of ten values nine of ten pairs at the threshold share none."""
    monkeypatch.setattr(N, "SAMPLE", 2)
    rng = random.Random(12)
    rows = []
    for f in range(40):
        base = words(rng, 49, 10 ** 6).split()
        rows.append((f * 10 + 1, " ".join(["all these texts begin as this one does", *base]), None, None, None))
        rows.append((f * 10, " ".join(["all these texts begin as this one does", *base[:-9]]), None, None, None))
    rng.shuffle(rows)
    want = brute([(r[0], r[1]) for r in rows], 5)
    kept = sorted(r.doc_id for r in N.keep_one(frame(spark, rows), N.Params(permutations=5, rows=10, prefixes=True)).collect())
    assert kept == sorted(r[0] for r in want if r[3]) and len(kept) == 40


def test_prefixes_of_sets_at_the_threshold_meet():
    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 5, 9, 10, 50, 99):
        for _ in range(40):
            one = rng.integers(0, 2 ** 63, n).astype(np.uint64)
            two = np.concatenate([one, rng.integers(0, 2 ** 63, n // 4).astype(np.uint64)])  # 4/5 at least
            common = np.sort(rng.choice(two, len(two) // 2, replace=False))
            often = rng.integers(3, 6, len(common))
            assert len(np.intersect1d(*(N._prefix(np.sort(x), common, often, 80) for x in (one, two))))


def test_candidates_grow_with_the_family_not_its_square(spark, monkeypatch):
    rows_of = []
    real = N._confirmed
    monkeypatch.setattr(N, "_confirmed", lambda pairs, sets, p: rows_of.append(pairs.count()) or real(pairs, sets, p))
    counts = []
    for n in (200, 800):
        rows_of.clear()
        N.near_duplicates(frame(spark, [(i, *r[1:]) for i, r in enumerate(family(random.Random(4), n))]), N.Params(shingle=2)).count()
        counts.append(sum(rows_of))
    print("candidates", counts)
    assert counts[1] < 5.5 * counts[0]  # 16 times were the square


def test_rows_that_share_an_id_are_versions_of_one_document(spark):
    rng = random.Random(6)
    a, b = words(rng, 100, 10 ** 6), words(rng, 100, 10 ** 6)
    near = lambda t: " ".join(t.split()[:-2] + ["other", "end"])
    rows = [(10, a, None, None, None), (10, b, None, None, None), (20, near(a), None, None, None), (30, near(b), None, None, None),
            (40, words(rng, 100, 10 ** 6), None, None, None)]
    got = {(r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(10, 10, True), (20, 10, False), (30, 10, False), (40, 40, True)}
    kept = sorted(r.doc_id for r in N.keep_one(frame(spark, rows)).collect())
    assert kept == [10, 40]


def test_keep_one_keeps_columns_and_clean_rows(spark):
    rows = awkward()
    df = frame(spark, rows, clash=True)
    got = N.keep_one(df)
    assert got.columns == df.columns
    kept = {r[0] for r in N.near_duplicates(df).collect() if r[3]}
    assert {r.doc_id for r in got.collect()} == kept


def test_minmax_values_estimate_the_resemblance():
    rng = np.random.default_rng(1)
    p = N.Params(permutations=600)
    pool = rng.integers(0, 2 ** 63, 900).astype(np.uint64)
    a, b = N.signature(pool[:600], p.permutations), N.signature(pool[150:750], p.permutations)  # 450 of 750
    assert abs((a == b).mean() - 0.6) < 0.06
    assert len(N.band_keys(a, N.Params())) == N.Params().bands == 36


def test_sets_do_not_depend_on_slices():
    texts = [r[1] for r in awkward()]
    whole = list(T.shingle_sets(pa.array(texts), 2))
    alone = [next(T.shingle_sets(pa.array([t], pa.string()), 2)) for t in texts]
    assert all(np.array_equal(x, y) for x, y in zip(whole, alone))
    assert [len(x) for x in whole] == [len(shingles(t, 2)) for t in texts]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 3), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(30)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def joined(edges):
    """node: least node reachable, by plain loops."""
    label = {x: x for e in edges for x in e}
    while any(label[a] != label[b] for a, b in edges):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("seed", range(4))
def test_links_found_later_join_known_components(spark, seed):
    rng = random.Random(seed)
    first = [(rng.randrange(90), rng.randrange(90)) for _ in range(50)]
    later = [(rng.randrange(120), rng.randrange(120)) for _ in range(25)] + [(100, 100), first[0], first[0][::-1]]
    known, found = (spark.createDataFrame(e, "a long, b long") for e in (first, later))
    got = list(map(tuple, components(found, components(known)).collect()))
    assert len(got) == len(dict(got)) and dict(got) == joined(first + later)


def test_links_found_before_none_were_known(spark):
    none = components(spark.createDataFrame([], "a long, b long"))
    got = components(spark.createDataFrame([(3, 1), (2, 3)], "a long, b long"), none)
    assert dict(map(tuple, got.collect())) == {1: 1, 2: 1, 3: 1}


def test_stars_and_late_links_take_few_tables(spark, monkeypatch):
    """Every table is a round of tasks on each shuffle partition, however small it is."""
    tables = []
    real = G.cut
    monkeypatch.setattr(G, "cut", lambda df, name: tables.append(name) or real(df, name))
    stars = spark.createDataFrame([(100 * s, 100 * s + i) for s in range(5) for i in range(1, 30)], "a long, b long")
    known = components(stars)
    assert len(tables) <= 3
    tables.clear()
    got = components(spark.createDataFrame([(3, 105), (217, 317)], "a long, b long"), known)
    assert len(tables) <= 5
    assert {r.root for r in got.collect()} == {0, 200, 400}
