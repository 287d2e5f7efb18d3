import hashlib
import math
import random

import numpy as np
import pytest
from estatespark.llm import clusters as C
from llm_rows import same_rows

VEC = "vec_id long, embedding array<float>, label int, cluster string, q string, dots string"


def vectors(n=300, seed=3):
    rng = random.Random(seed)
    hot = [rng.gauss(0, 0.2) for _ in range(64)]
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, 0.01) for x in hot] if i % 3 == 0 else [rng.gauss(0, 0.3) for _ in range(64)]
        rows.append((i, v))
    nan, inf = float("nan"), float("inf")
    rows += [(1000, [0.0] * 63), (1001, [0.1] * 65), (1002, None), (1003, []), (1004, [nan] + [0.0] * 63),
             (1005, [inf] + [0.0] * 63), (1006, [None] + [0.0] * 63), (1007, [0.5] * 64), (1007, [0.5] * 64), (None, [0.25] * 64)]
    return [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def brute(rows, p):
    kept = [(i, [math.floor(p.scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == p.dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(q) for _, q in first[:p.k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(cents))
    for _ in range(p.rounds):
        of = [nearest(q)[1] for _, q in kept]
        for j in range(len(cents)):
            mine = [q for (_, q), o in zip(kept, of) if o == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *nearest(q)[::-1]) for i, q in kept]
    by = {}
    for _, j, d in found:
        by[j] = by.get(j, 0) + d
    return [(i, j, d, by[j], sum(by.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, j, d in found]


@pytest.mark.parametrize("k,rounds", [(40, 5), (7, 0), (400, 2)])
def test_clusters_match_plain_loops(spark, k, rounds):
    p, rows = C.Params(k=k, rounds=rounds), vectors()
    df = spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in rows], VEC)
    assert same_rows(C.with_inertia(*C.clustered(df, p)).collect(), brute(rows, p))


def test_tables_without_vectors(spark):
    for rows in ([], [(1, None, 0, "", "", ""), (2, [1.0], 0, "", "", "")]):
        got = C.with_inertia(*C.clustered(spark.createDataFrame(rows, VEC)))
        assert got.collect() == [] and got.columns[:3] == ["vec_id", "cluster", "distance"]


def test_huge_components_raise(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, 0, "", "", "")], VEC)
    with pytest.raises(Exception, match="beyond"):
        C.clustered(df)


def test_dots_change_by_the_components_that_changed():
    rng = np.random.default_rng(2)
    q, old = rng.integers(-50, 50, (20, 8)), rng.integers(-50, 50, (5, 8))
    new = old.copy()
    new[1, 3] += 4
    new[4] -= 9
    assert np.array_equal(C.brought_up_to_date(q, q @ old.T, new - old), q @ new.T)
