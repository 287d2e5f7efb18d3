import random

import pyarrow as pa
from estatespark.llm import decontam as D
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import awkward, frame, words


def table(pattern: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=70), st.binary(max_size=120))
def test_bit_parallel_distance_is_the_table_s(pattern, text):
    pattern, text = bytes(c % 4 for c in pattern), bytes(c % 4 for c in text)
    assert D.distance(pattern, text)[0] == table(pattern, text)


def norm(text):
    return D.normalised(pa.array([text], pa.large_string()))[0]


def test_rows_are_normalised_alone():
    body, off = D.normalised(pa.array(["A-b!", None, "", "  C\tDÉ", "x"]))
    assert [body[a:b] for a, b in zip(off[:-1], off[1:])] == [b" a b ", b" ", b" ", " c dé ".encode(), b" x "]


def brute(docs, items, p=D.Params()):
    out = set()
    for d, text, *_ in docs:
        for i, item in items:
            if item is None or len(norm(item)) <= 2 or text is None:
                continue
            n = table(norm(item), norm(text))
            if n <= D.budget(len(norm(item)), p):
                out.add((d, i, n))
    return out


def test_matches_are_those_of_the_full_table(spark):
    rng = random.Random(4)
    items = [(i, words(rng, 14, 10 ** 6)) for i in range(6)] + [(7, None), (8, "  "), (9, "Short one."), (10, "w1")]
    rows = [r for r in awkward() if len(r[1] or "") < 900][:20]
    for i in range(30):
        item = items[i % 6][1]
        letters = list(item.upper() if i % 2 else item)
        for _ in range(rng.randrange(0, 9)):
            at = rng.randrange(len(letters))
            letters[at] = rng.choice(["", "q", letters[at] + "z"])
        rows.append((200 + i, words(rng, 10) + " " + "".join(letters) + "\n" + words(rng, 5), None, None, None))
    rows += [(300, "a short\tONE!", None, None, None), (301, "ashort one", None, None, None)]
    bench = spark.createDataFrame([(*x, None) for x in items], "item_id long, text string, doc_id long")
    df = frame(spark, rows, clash=True)
    got = D.matches(df, bench).collect()
    expected = brute(rows, items)
    assert {(r.doc_id, r.item_id) for r in got} == {x[:2] for x in expected}
    assert {(r.doc_id, r.item_id, r.edits) for r in got if r.edits == 0} == {x for x in expected if x[2] == 0}
    assert 10 < len(got) < 60
    blocks = D.matches(df, bench, D.Params(block=200)).collect()
    assert sorted(map(str, got)) == sorted(map(str, blocks))
    clean = D.keep_clean(df, bench, D.Params(block=200))
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(r[0]) for r in rows if r[0] not in {x[0] for x in expected})


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    df = frame(spark, awkward())
    assert D.matches(df, none).collect() == [] and D.keep_clean(df, none).count() == df.count()
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert D.matches(frame(spark, []), some).collect() == []
    assert {r.doc_id for r in D.matches(df, some).collect()} == {4, 5}
