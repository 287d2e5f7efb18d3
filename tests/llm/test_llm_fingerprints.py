import hashlib

import numpy as np
import pyarrow as pa
from estatespark.llm import fingerprints as P
from estatespark.llm import textkit as T
from llm_rows import awkward, frame


def of(text, k=P.K):
    return P.sketch(next(T.shingle_sets(pa.array([text], pa.string()), P.SHINGLE)), k)


def test_edited_texts_and_likeness_match_brute_force(spark):
    rows = [r for r in awkward() if r[0] is not None and r[0] != 95]
    got = {r.doc_id: r for r in P.edited_fingerprints(frame(spark, rows, clash=True)).collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), reverse=True)
    assert len(got) == len(order)
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == P.encode(of(text)) and r.edited_fingerprint == P.encode(of(edited))
        assert r.near_edited == P.resemblance(of(text), of(edited))
        assert r.near_next == P.resemblance(of(text), of(following))


def test_null_ids_ties_and_small_tables(spark):
    assert P.edited_fingerprints(frame(spark, [])).collect() == []
    one = P.edited_fingerprints(frame(spark, [(5, "abcd", None, None, None)])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    rows = awkward()
    got = P.edited_fingerprints(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    null = [r for r in got if r.doc_id is None]
    assert len(null) == 3 and len({r.fingerprint for r in null if r.n_chars}) == 1


def test_empty_texts_are_alike_and_unlike_others():
    assert P.resemblance(of(""), of(" \n")) == 1.0
    assert P.resemblance(of(""), of("a b c d e f")) == 0.0
    assert P.containment(of(""), of("a")) == 1.0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 2 ** 63, 40_000).astype(np.uint64) * np.uint64(2))
    rng.shuffle(pool)
    a, b = np.sort(pool[:20_000]), np.sort(pool[5_000:30_000])
    k = 512
    whole = P.sketch(np.union1d(a, b), k)
    assert np.array_equal(P.merge(P.sketch(a, k), P.sketch(b, k), k), whole)
    assert abs(P.resemblance(P.sketch(a, k), P.sketch(b, k), k) - 0.5) < 0.1
    assert abs(P.containment(P.sketch(a, k), P.sketch(b, k), k) - 0.75) < 0.15
    assert abs(P.distinct(whole, k) / 30_000 - 1) < 0.15
    assert np.array_equal(P.decode(P.encode(whole, k)), whole)


def test_plain_fingerprints(spark):
    got = P.fingerprint(frame(spark, awkward())).collect()
    assert {r.fingerprint for r in got if r.doc_id in (1, 2, 3)} == {P.encode(of(""))}
    assert len({r.fingerprint for r in got if r.doc_id in (4, 5)}) == 1
