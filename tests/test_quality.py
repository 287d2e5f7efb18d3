from pyspark.sql import functions as F

from estatespark.operators import quality as Q


def test_checks_count_failures(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "zz")], "k int, v string")
    assert Q.unique_failures(df, "k").collect()[0]["n_records"] == 2
    assert Q.unique_count(df, "t", "k").first().failures == 1
    nn = {r.column_name: r.failures for r in Q.not_null_counts(df, "t", ["k", "v"]).collect()}
    assert nn == {"k": 1, "v": 1}
    assert Q.accepted_values_count(df, "t", "v", ["a", "b"]).first().failures == 1


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (3,)], "k int")
    assert Q.relationship_count(child, "c", "k", parent, "k", 100).first().failures == 1
    # beyond the broadcast bound the same check runs as a shuffle anti-join
    assert Q.relationship_count(child, "c", "k", parent, "k", 1).first().failures == 1


def test_fused_relationships_one_scan(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (None, "b"), (3, None), (3, "a")],
                                  "k int, s string")
    p1 = spark.createDataFrame([(1,), (3,), (3,)], "k int")  # duplicate parent keys are fine
    p2 = spark.createDataFrame([("a",), ("b",)], "s string")
    got = {r.column_name: r.failures for r in Q.relationship_counts(
        child, "c", [("k", p1, "k", None), ("s", p2, "s", 2)], 100).collect()}
    assert got == {"k": 1, "s": 1}
