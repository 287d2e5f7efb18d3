import hashlib
import random
import re
from collections import defaultdict

from estatespark.llm import mixing as M
from llm_rows import awkward, frame


def brute_targets(total, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, budget = set(), share * sum(total.values())
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(most * total[s] for s in capped)
        over = [s for s in free if left * w[s] / sum(w[x] for x in free) >= most * total[s]]
        if not over:
            return {s: most * total[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in names}
        capped |= set(over)


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    key = [hashlib.md5(f"{'' if r[0] is None else r[0]}\n{r[1] or ''}".encode()).hexdigest()[:9] for r in rows]
    total, by = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r, n, k in zip(rows, size, key):
        total[r[3]] += n
        by[r[3]][k] += n
    goal = brute_targets(total)
    taken = []
    for r, n, k in zip(rows, size, key):
        s = r[3]
        times = int(goal[s] // total[s]) if total[s] else 0
        budget, below = max(0, goal[s] - times * total[s]), 0
        for bucket in sorted(by[s]):
            upto = below + by[s][bucket]
            if bucket == k:
                once = upto <= budget or (below <= budget and upto - budget < budget - below)
                break
            below = upto
        taken.append(0 if not n else min(2, times + once) * n)
    return {(r[0], r[1], r[3]): t for r, t in zip(rows, taken)}, goal


def test_awkward_rows_match_brute_force(spark):
    rows = awkward()
    expected, goal = brute(rows)
    got = M.mix(frame(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.target - goal[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken <= 2 * r["size"]
    texts = defaultdict(list)
    for (doc, _, source), t in expected.items():
        texts[doc, source].append(t)
    assert all(r.taken in texts[r.doc_id, r.source] for r in got)
    rows_again = M.mix(frame(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, rows_again))


def test_sources_come_near_their_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("x" * rng.randrange(1, 60)), None, rng.choice(["a"] * 6 + ["b", "c", "d", None]), 0)
            for i in range(4000)]
    got = M.mix(frame(spark, rows)).toPandas()
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()


def test_mixed_rows_repeat_whole_rows(spark):
    df = frame(spark, awkward(), clash=True)
    got = M.mixed_rows(df)
    assert got.columns == df.columns
    assert got.count() == M.mix(df).agg({"copies": "sum"}).first()[0]


def test_no_rows_and_no_words(spark):
    assert M.mix(frame(spark, [])).collect() == []
    assert M.mixed_rows(frame(spark, [])).collect() == []
    none = M.mix(frame(spark, [(1, None, None, None, None), (2, " ", None, "a", 1)])).collect()
    assert [(r.target, r.taken) for r in none] == [(0.0, 0)] * 2
