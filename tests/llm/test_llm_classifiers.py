import random

import pyarrow as pa
import pytest
import zstandard
from estatespark.llm import langid as L
from estatespark.llm import toxicity as X
from llm_rows import awkward, frame, words
from pyspark.sql import functions as F


def test_swaps_of_identity_terms():
    assert X.counterfactual("Women and MEN, womenfolk") == "men and women, womenfolk"
    assert X.counterfactual("nothing here") == "nothing here"


def labelled(seed, n, bias=0.9):
    """Toxic rows hold an insult; they name one group far more often than the others do."""
    rng, texts, marks = random.Random(seed), [], []
    for _ in range(n):
        toxic = rng.random() < 0.3
        w = words(rng, 25).split()
        if toxic:
            w[rng.randrange(25)] = rng.choice(["idiot", "moron", "scum"])
        if rng.random() < (bias if toxic else 1 - bias):
            w[rng.randrange(25)] = "muslim"
        texts.append(" ".join(w))
        marks.append(int(toxic))
    return texts, marks


def test_regularised_scores_ignore_the_group_named():
    texts, marks = labelled(1, 1500)
    plain, fair = X.fit(texts, marks, X.Params(fairness=0)), X.fit(texts, marks, X.Params(fairness=20.0))
    neutral = [words(random.Random(i), 25) + " muslim" for i in range(200)]
    swapped = [X.counterfactual(t) for t in neutral]

    def gap(m):
        a, b = (X.scores(pa.array(t), m, X.Params()) for t in (neutral, swapped))
        return abs(a - b).mean()
    assert gap(fair) < 0.6 * gap(plain)
    test, truth = labelled(2, 600)
    found = X.scores(pa.array(test), fair, X.Params()) >= 0.5
    assert (found == (pd_array(truth) == 1)).mean() > 0.95


def pd_array(x):
    import numpy as np
    return np.array(x)


def test_one_kind_of_label_gives_a_constant():
    for marks in ([], [0, 0], [1, 1]):
        m = X.fit(["a b", "c"][:len(marks)], marks)
        s = X.scores(pa.array(["", None, "idiot"]), m, X.Params())
        assert len(set(s)) == 1 and 0 < s[0] < 1


def test_frames_with_awkward_rows(spark):
    texts, marks = labelled(3, 400)
    docs = frame(spark, [(1000 + i, t, None, None, None) for i, t in enumerate(texts)] + awkward(), clash=True)
    labels = spark.createDataFrame([(1000 + i, 0, m) for i, m in enumerate(marks)] + [(1, 0, None), (None, 0, 1), (2, 1, 7)],
                                   "doc_id long, quality int, toxic int")
    model = X.fit_frame(docs, labels, F.col("doc_id") % 5 != 0)
    got = X.score(docs, model).collect()
    assert len(got) == len(texts) + len(awkward())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    held = [(r.predicted, marks[r.doc_id - 1000]) for r in got if r.doc_id and r.doc_id >= 1000 and r.doc_id % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    clean = X.keep_clean(docs, model)
    assert clean.columns == docs.columns
    assert clean.count() == sum(r.predicted == 0 for r in got)
    assert X.score(frame(spark, []), model).collect() == []
    nothing = X.fit_frame(frame(spark, []), labels, F.lit(True))
    assert X.keep_clean(frame(spark, awkward()), nothing).count() == len(awkward())


def test_a_very_long_labelled_text_does_not_end_the_sample(spark):
    texts, marks = labelled(5, 400)
    ids = spark.range(2000, 2400).orderBy(F.xxhash64("id")).limit(1).first().id  # the first of the sample
    rows = [(2000 + i, t) for i, t in enumerate(texts) if 2000 + i != ids]
    long = spark.range(1).select(F.lit(ids).cast("long").alias("doc_id"), F.repeat(F.lit("plain old words "), 1_300_000).alias("text"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(long)
    labels = spark.createDataFrame([(2000 + i, 0, 0 if 2000 + i == ids else m) for i, m in enumerate(marks)],
                                   "doc_id long, quality int, toxic int")
    model = X.fit_frame(docs, labels, F.lit(True))
    found = X.scores(pa.array(["a word idiot moron scum", "a plain word"]), model, X.Params())
    assert found[0] >= 0.5 > found[1]
    kept = [t for i, t in enumerate(texts) if 2000 + i != ids]
    same = X.fit(kept + ["plain old words"], [m for i, m in enumerate(marks) if 2000 + i != ids] + [0])
    assert abs(X.scores(pa.array(kept), model, X.Params()) - X.scores(pa.array(kept), same, X.Params())).max() < 1e-3


def test_held_out_toxicity_of_the_test_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = X.score(docs, X.fit_frame(docs, labels, ~out)).join(labels, "doc_id").filter(out).select("predicted", "toxic").collect()
    assert len(got) > 500 and sum(r.predicted == r.toxic for r in got) / len(got) > 0.97


def test_held_out_languages_of_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = L.predict(docs, L.learn(docs, ~out)).join(docs.select("doc_id", "lang"), "doc_id").filter(out).collect()
    assert len(found) > 100 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_of_awkward_rows(spark):
    docs = frame(spark, awkward(), clash=True)
    known = L.learn(docs, F.lit(True))
    assert set(known) == {"en", "de", "fr"}
    got = L.predict(docs, known).collect()
    assert len(got) == len(awkward())
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3) or r.doc_id is None and r.lang_pred == "und")
    assert sum(r.lang_pred == "und" for r in got) == 4
    assert {r.lang_pred for r in L.predict(docs, {}).collect()} == {"und"}
    assert L.learn(frame(spark, []), F.lit(True)) == {} and L.predict(frame(spark, []), known).collect() == []


def test_predictions_match_plain_loops(spark):
    """The shortest of the encodings with each dictionary, one text and dictionary at a time."""
    rows = [r for r in awkward() if r[0] not in (90, 91)]
    docs, p = frame(spark, rows), L.Params()
    known = L.learn(docs, F.lit(True), p)

    def size(text, raw, level):
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False).compress(text))
    for r, got in zip(rows, L.predict(docs, known, p).collect()):
        words = " ".join("".join(c if c.isalpha() else " " for c in (r[1] or "").lower()).split())
        if not words:
            assert (got.lang_pred, got.score, got.rejected) == ("und", 0.0, True)
            continue
        raw = f" {words} ".encode()
        by = sorted((size(raw, d, p.level), lang) for lang, d in known.items())
        tied = [lang for n, lang in by if n == by[0][0]]
        best = min((size(raw, known[lang], p.tie_level), lang) for lang in tied)[1]
        assert got.lang_pred == best and abs(got.score - by[1][0] / (by[0][0] + by[1][0])) < 1e-12
        assert got.rejected == (by[1][0] - by[0][0] < p.margin * by[0][0])


def test_learning_sees_whole_texts_and_copies_once(spark):
    rng = random.Random(4)
    lists = {k: ["".join(rng.choice(k) for _ in range(8)) for _ in range(60)] for k in ("abcdefghijkl", "mnopqrstuvwz")}
    word = lambda letters: rng.choice(lists[letters])
    head = "the same english heading again and again " * 60
    rows = [(i, head + " ".join(word("abcdefghijkl") for _ in range(3000)), "xx", None, None) for i in range(30)]
    rows += [(100 + i, head + " ".join(word("mnopqrstuvwz") for _ in range(3000)), "yy", None, None) for i in range(30)]
    rows += [(200 + i, head, "xx", None, None) for i in range(500)]  # copies
    known = L.learn(frame(spark, rows), F.lit(True))
    assert known["xx"].count(head.strip().encode()[:200]) <= 60 and known["xx"].count(b"a") > 2000 and known["yy"].count(b"z") > 2000
    tests = [(1, " ".join(word("abcdefghijkl") for _ in range(80)), None, None, None), (2, " ".join(word("mnopqrstuvwz") for _ in range(80)), None, None, None)]
    assert [r.lang_pred for r in L.predict(frame(spark, tests), known).collect()] == ["xx", "yy"]
    with pytest.raises(ValueError, match="more than 1 languages"):
        L.learn(frame(spark, rows), F.lit(True), L.Params(languages=1))


def test_narrow_margins_are_rejected():
    by = L.compressors({"xx": b"abc def ghi jkl " * 20, "yy": b"abc def ghi jkl " * 20, "zz": b"stu vwx yz" * 20})
    assert L.classify("abc def ghi", by)[2] and L.classify("abc def ghi", by)[0] in ("xx", "yy")
    assert not L.classify("stu vwx yz stu vwx", by)[2]
    assert L.classify("12 ,.", by) == ("und", 0.0, True)


def test_a_dictionary_meets_many_texts_one_after_the_other(monkeypatch):
    monkeypatch.setattr(L, "TOGETHER", 3)
    met = []

    class Counted:
        def __init__(self, name, by):
            self.name, self.by = name, by

        def compress(self, raw):
            met.append(self.name)
            return self.by.compress(raw)

    by = L.compressors({"xx": b"abc def ghi jkl " * 20, "yy": b"stu vwx yz " * 20})
    texts = ["abc def", None, "vwx stu yz", "12", "ghi jkl ghi", ""]
    counted = [(lang, Counted(lang, fast), slow) for lang, fast, slow in by]
    assert L.classify_all(texts, counted) == [L.classify(t, by) for t in texts]
    assert met == ["xx", "xx", "yy", "yy", "xx", "yy"] and L.classify_all(texts, []) == [("und", 0.0, True)] * 6
