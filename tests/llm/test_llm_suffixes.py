import random
import re

import numpy as np
from estatespark.llm import suffixes as S
from llm_rows import awkward, frame, same_rows, words

GAP = "[^\x20\x09-\x0D]+"


def repeat_lengths(w):
    """Longest sequence from each word that occurs elsewhere, by comparing all pairs."""
    out = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            n = 0
            while i != j and max(i, j) + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            out[i] = max(out[i], n)
    return out


def in_windows(w, k):
    seen = {}
    for i in range(len(w) - k + 1):
        seen.setdefault(tuple(w[i:i + k]), []).append(i)
    return {i + o for at in seen.values() if len(at) > 1 for i in at for o in range(k)}


def brute(doc_id, text, p):
    t = text or ""
    w = re.findall(GAP, t)
    lines = [x for x in t.split("\n") if re.search(GAP, x)]
    rep, cov = in_windows(w, p.window), in_windows(w, p.least)
    longest = 0
    while longest < len(w) and in_windows(w, longest + 1):
        longest += 1
    edges = sorted(cov)
    spans = [i for i in edges if i - 1 not in cov], [i + 1 for i in edges if i + 1 not in cov]
    base = len(w) < p.min_words or 100 * len(rep) > p.max_repeat * len(w)
    return (doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
            len(cov), longest, list(zip(*spans)), base,
            not base and 100 * len(cov) <= p.covered * len(w) and longest <= p.longest)


def maximal_repeats(w, least):
    """Windows of ``least`` words that occur again and do not all follow one same word."""
    seen = {}
    for i in range(len(w) - least + 1):
        seen.setdefault(tuple(w[i:i + least]), []).append(w[i - 1] if i else None)
    return sum(len(before) > 1 and (None in before or len(set(before)) > 1) for before in seen.values())


def texts():
    rng = random.Random(11)
    long = words(rng, 120, 10 ** 6)
    return [words(rng, 80, 6), "a " * 70, "x y z " * 40, f"{long} middle {long}", f"{words(rng, 900, 10 ** 6)} {long} {long}",
            "Same line here\nsame line here\nSame line here\n \n \n\n", "a|b <c> #d $5 50% & *\r\n" * 3, "größe ß 你好 " * 30,
            "A a A a A a b", words(rng, 300, 10 ** 6) + " " + " ".join(long.split()[:60]) + " - " + " ".join(long.split()[:60])]


def test_counts_match_plain_loops(spark):
    p = S.Params()
    rows = [r for r in awkward() if r[0] not in (90, 91)] + [(200 + i, t, "en", "a", 0) for i, t in enumerate(texts())]
    got = S.judged(S.measured(frame(spark, rows, clash=True), p), p).collect()
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    for r, g in zip(rows, got):
        want = brute(r[0], r[1], p)
        mine = (*[g[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words",
                                 "longest_repeat")], [tuple(s) for s in g.spans], g.base_failed, g.kept)
        assert g.n_passages == maximal_repeats(re.findall(GAP, r[1] or ""), p.least)
        assert mine == want, r[0]
    by = {g.doc_id: g for g in got}
    assert by[203].base_failed and not by[204].base_failed and not by[204].kept and by[209].kept


def test_very_long_texts(spark):
    rows = [r for r in awkward() if r[0] in (90, 91)]
    rows.append((92, "the same words again " * 60_000, "en", "a", 0))
    got = {r.doc_id: r for r in S.measured(frame(spark, rows)).collect()}
    assert got[90].n_words == 30_000 and got[91].n_words == 1
    assert got[92].n_repeat_words == 240_000 and got[92].longest_repeat == 239_996 and got[92].n_passages == 1


def test_empty_table(spark):
    assert S.judged(S.measured(frame(spark, []))).collect() == []


def test_suffix_array_of_random_rows():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = rng.integers(0, 25, 6)
        offs = np.concatenate([[0], np.cumsum(sizes)])
        keys = rng.integers(0, 3, offs[-1]).astype(np.uint64)
        array, lcp = S.common_prefixes(keys, offs)
        want = [n for a, b in zip(offs[:-1], offs[1:]) for n in repeat_lengths(list(keys[a:b]))]
        assert list(S.repeats(array, lcp)) == want
        row = np.repeat(np.arange(6), sizes)
        suffix = [(offs[row[i] + 1], tuple(keys[i:offs[row[i] + 1]])) for i in array]
        assert suffix == sorted(suffix)


def test_results_do_not_depend_on_slices(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts())]
    whole = S.measured(frame(spark, rows).coalesce(1)).collect()
    alone = S.measured(frame(spark, rows).repartition(len(rows))).collect()
    assert same_rows([r[:-1] for r in whole], [r[:-1] for r in alone])
