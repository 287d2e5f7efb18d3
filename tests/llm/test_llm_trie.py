import hashlib
import random
import zlib

import pytest
from estatespark.llm import trie as R
from llm_rows import same_rows

CONV = "conv_id long, turn long, role string, text string"


def sequences(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in out.items()}


def reopened(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = seqs.get(c - c % 5, [])
        out[c] = base[:h] + own[h:]
    return out


def brute(seqs):
    """(depth, conv_id, parent, n_convs, n_children, n_leaves, saved, digest) by listing every prefix."""
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    rows = []
    for path, members in nodes.items():
        below = [q for q in nodes if q[:len(path)] == path]
        leaves = [q for q in below if not any(r[:len(q)] == q and len(r) == len(q) + 1 for r in nodes)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = sorted(c for c in members if len(seqs[c]) == len(path))
        rows.append((len(path), min(members), min(nodes[path[:-1]]) if path else None, len(members),
                     sum(len(q) == len(path) + 1 for q in below), len(leaves), saved,
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


COLS = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talk(seed=5, convs=60, deep=0):
    """Conversations that share openings, a third of them one opening; some are ``deep`` turns long."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = deep + rng.randrange(3) if deep and c % 20 == 0 else rng.randrange(1, 9)
        for t in range(n):
            text = f"hot {t}" if c % 3 == 0 and rng.random() < 0.98 else f"t{rng.randrange(3)}é" * rng.randrange(3)
            rows.append((c, t, "user" if t % 2 == 0 else "bot", text))
    return rows


@pytest.mark.parametrize("band,bands", [(16, 1024), (2, 2), (3, 4)])
def test_nodes_match_listed_prefixes(spark, band, bands):
    rows = talk(deep=21)
    rows += [(500, None, "user", "no turn"), (500, None, None, None), (500, 3, "user", ""), (None, 1, "user", "no id"),
             (-7, 1, "user", "hot 0"), (-7, 1, "user", "hot 0"), (505, 1, None, "x")]
    rng = random.Random(1)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "0 as pos", "'x' as k1", "1 as depth", "2 as n")
    seqs = sequences(rows)
    if band == 16:  # ties go by hash: take the order that the operator finds
        ties = [t for t in seqs[500][:2]]
        assert len(ties) == 2
    for c in (500,):
        a, b = sorted(seqs[c][:2])
        first = {(r.h1, r.pos) for r in R.in_order(R.hashed(df.filter("conv_id = 500"))).collect()}
        ha = R.hashed(spark.createDataFrame([(1, 1, *a)], CONV)).first().h1
        seqs[c][:2] = [a, b] if (ha, 1) in first else [b, a]
    got = R.shared_openings(df, R.Params(band=band, bands=bands)).select(COLS).collect()
    assert same_rows(got, brute(reopened(seqs)))


def test_plain_trie_has_texts(spark):
    rows = talk(deep=0)
    got = R.of_conversations(spark.createDataFrame(rows, CONV), R.Params(band=4)).collect()
    seqs = sequences(rows)
    assert same_rows([[r[c] for c in COLS[:-1]] for r in got], [b[:-1] for b in brute(seqs)])
    for r in got:
        said = seqs[r.conv_id][r.depth - 1] if r.depth else (None, None)
        assert (r.role, r.text) == said


def test_tables_without_turns(spark):
    empty = spark.createDataFrame([], CONV)
    assert R.shared_openings(empty).collect() == []
    assert R.of_conversations(empty).collect() == []
    # 4 opens with the turns of 0, which is not there, and has none of its own behind them: turnless
    rows = [(4, 1, "user", "a")]
    got = R.shared_openings(spark.createDataFrame(rows, CONV)).select(COLS).collect()
    assert same_rows(got, brute(reopened(sequences(rows))))


def test_digest_of_a_hot_node(spark):
    ids = list(range(3000))
    ends = spark.createDataFrame([(i, 1, 7, 7) for i in ids] + [(9, 2, 1, 1)], "conv_id long, depth long, k1 long, k2 long")
    got = {r.depth: r.ends_sha256 for r in R.id_digests(ends).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 2: hashlib.sha256(b"9").hexdigest()}
