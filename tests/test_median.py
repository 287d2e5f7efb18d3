"""Distributed exact median against a brute-force median, including a hot group."""

import random
import statistics

from pyspark.sql import functions as F

from estatespark.operators.aggregates import distinct_numbers
from estatespark.operators.median import N, exact_median, stats_with_median, value_counts, weighted_mean, weighted_stddev


def brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: float(statistics.median(vs)) for g, vs in groups.items()}


def test_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    # one group holds a third of the rows, with many repeated and distinct values
    rows += [("hot", rnd.choice([rnd.randint(1, 50), rnd.randint(1, 10_000_000)])) for _ in range(6000)]
    for g in range(40):
        size = rnd.randint(1, 300)
        rows += [(f"g{g}", rnd.randint(0, 1000)) for _ in range(size)]
    rows += [("evens", 1), ("evens", 2), ("single", 5), ("nulls", None), (None, 3), (None, 8)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    want = brute(rows)
    assert got == want
    assert got["evens"] == 1.5 and got[None] == 5.5 and "nulls" not in got


def test_equals_builtin_exact_median(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 5), rnd.randint(0, 3), rnd.randint(0, 10**6)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "a int, b int, v bigint")
    mine = {(r.a, r.b): r.m for r in exact_median(df, ["a", "b"], "v", "m").collect()}
    ref = {(r.a, r.b): r.m for r in df.groupBy("a", "b").agg(F.median("v").alias("m")).collect()}
    assert mine == ref


def test_measures_of_cells_with_finer_keys(spark):
    rows = [("a", 1, 5), ("a", 2, 5), ("a", 2, 7), ("b", 1, None), ("a", 1, 9)]
    df = spark.createDataFrame(rows, "g string, h int, v bigint")
    cells = value_counts(df, ["g", "h"], "v", {"two": F.col("h") == 2})
    got = stats_with_median(cells, ["g"], "v", [F.sum(N).alias("n"), F.sum("two").alias("two"),
                                                weighted_mean("v").alias("mean"), weighted_stddev("v").alias("sd")], "m")
    found = {r.g: r for r in got.collect()}
    assert (found["a"].n, found["a"].two, found["a"]["mean"], found["a"].m) == (4, 2, 6.5, 6.0)
    assert abs(found["a"].sd - 1.9148542) < 1e-6
    assert (found["b"].n, found["b"]["mean"], found["b"].sd, found["b"].m) == (1, None, None, None)


def test_bitmaps_count_distinct_numbers(spark):
    rnd = random.Random(5)
    rows = [(g, rnd.choice([None, rnd.randrange(1, 100_000), rnd.randrange(1, 50)])) for g in "abc" for _ in range(4000)]
    rows.append(("none", None))
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r.g: r.n for r in df.groupBy("g").agg(distinct_numbers("v", 99_999).alias("n")).collect()}
    assert got == {g: len({v for h, v in rows if h == g and v is not None}) for g in ("a", "b", "c", "none")}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=60))
def test_exact_median_property(spark, rows):
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    assert got == brute(rows)


def test_deviation_of_cells_beyond_a_hundred_million_rows(spark):
    cells = {"hot": [(100_000, 3 * 10**8 + 7), (450_000, 10**11), (12_000_000, 5)], "edge": [(1, 10**8), (3, 10**8 - 1)],
             "few": [(10, 2), (14, 2), (None, 10**9)], "one": [(9, 1)]}
    rows = [(g, v, n) for g, vs in cells.items() for v, n in vs]
    df = spark.createDataFrame(rows, f"g string, v bigint, {N} bigint")
    got = {r.g: r.sd for r in df.groupBy("g").agg(weighted_stddev("v").alias("sd")).collect()}
    for g, vs in cells.items():
        known = [(v, n) for v, n in vs if v is not None]
        n = sum(c for _, c in known)
        s1, s2 = sum(v * c for v, c in known), sum(v * v * c for v, c in known)
        want = ((s2 * n - s1 * s1) / (n * (n - 1))) ** 0.5 if n > 1 else None
        assert got[g] is None if want is None else abs(got[g] - want) <= 1e-6 * want
