import os
import random
import re
from collections import Counter

import corpus_pipeline as P
import public_tokenizers
from estatespark.llm import common, decontam, mixing, neardup
from estatespark.llm import queries as QS
from llm_rows import DOCS, awkward, words
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def tables(spark, tmp_path, rows, benchmark, labels=()):
    d = str(tmp_path / "tables")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def shingles(text, k=5):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_workers_give_memory_back_behind_the_last_batch(monkeypatch):
    said = []
    monkeypatch.setattr(common, "release", lambda: said.append("released"))

    def run(batches):
        try:
            yield from batches
        finally:
            said.append("ended")
    assert list(common.releasing(run)(iter([1, 2]))) == [1, 2] and said == ["ended", "released"]


def one_of_each(rows):
    """Ids that stay where the smallest of each component of linked texts does, by comparing all pairs."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d for d in sets if find(d) == d}


def test_stages_against_plain_loops(spark, tmp_path):
    """Planted toxic texts with and without labels, near copies and benchmark passages: the ids that each
    stage keeps of its own input, and what it returns."""
    rng = random.Random(9)
    item = words(rng, 15, 10 ** 6)
    insults = "idiot moron scum vermin filth".split()
    rows, labels, toxic = [], [], set()
    for i in range(300):
        text = words(rng, 40).split()
        if i % 4 == 0:
            toxic.add(1000 + i)
            for j in range(0, 40, 5):
                text[j] = rng.choice(insults)
        rows.append((1000 + i, " ".join(text), "en", "ab"[i % 2], 0))
        if i % 3:
            labels.append((1000 + i, 1, int(i % 4 == 0)))
    for i in range(20):  # near copies of clean texts
        text = rows[4 * i + 1][1].split()
        text[-1] = f"copy{i}"
        rows.append((2000 + i, " ".join(text), "en", "b", 0))
    leaks = {3000 + i for i in range(5)}
    rows += [(d, f"{words(rng, 12)} {item} {words(rng, 12)}", "en", "a", 0) for d in sorted(leaks)]
    rows += [(4000, None, "en", "a", None), (4001, "", None, None, 0)]
    d = tables(spark, tmp_path, rows, [(1, item), (2, None)], labels)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, d)
        before = docs.collect()
        if i == len(P.STAGES) - 1:
            break
        assert out.columns == docs.columns, name
        out.write.parquet(to := str(tmp_path / name))
        docs = spark.read.parquet(to)
        ids, kept = {r.doc_id for r in before}, {r.doc_id for r in docs.collect()}
        if name == "toxicity":
            assert kept == ids - toxic
        elif name == "near_duplicates":
            assert kept == one_of_each(before) and not kept & set(range(2000, 2020)) and docs.count() == len(kept)
        elif name == "decontamination":
            assert kept == ids - leaks
        elif name == "mixing":
            size = {s: sum(len((r.text or "").split()) for r in before if r.source == s) for s in {r.source for r in before}}
            taken = {s: sum(len((r.text or "").split()) for r in docs.collect() if r.source == s) for s in size}
            weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
            target, left, open_ = {}, 1.5 * sum(size.values()), set(size)
            while open_:  # the excess over twice a source's size is shared anew
                share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
                full = {s for s in open_ if share[s] > 2 * size[s]}
                target |= {s: 2 * size[s] for s in full} if full else share
                left -= sum(2 * size[s] for s in full)
                open_ = open_ - full if full else set()
            assert all(abs(taken[s] - target[s]) <= 45 for s in size), (taken, target)
            per = Counter(r.doc_id for r in docs.collect())
            assert max(per.values()) <= 2 and set(per) <= ids
    got = sorted(out.collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in before)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]


def test_stages_take_awkward_rows(spark, tmp_path):
    rows = awkward()
    d = tables(spark, tmp_path, rows, [(1, "an item that is nowhere in the documents"), (2, None)])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, d)
        if i == len(P.STAGES) - 1:
            break
        assert out.columns == docs.columns, name
        before, after = docs.count(), out.count()
        if name == "near_duplicates":
            kept = {r.doc_id for r in neardup.near_duplicates(docs).collect() if r.kept}
            assert after == len(kept) + 1  # without id: one of the two equal texts, and the null text
        elif name in ("toxicity", "decontamination"):
            assert after == before
        elif name == "mixing":
            assert after == mixing.mix(docs).agg({"copies": "sum"}).first()[0]
        out.write.parquet(to := str(tmp_path / name))
        docs = spark.read.parquet(to)
    assert out.count() == docs.count()


def test_run_on_the_test_tables(spark):
    got = P.run(spark, SF).collect()
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    bench, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "documents"))
    leaked = {r.doc_id for r in decontam.matches(docs, bench).collect()}
    assert leaked and not leaked & {r.doc_id for r in got}


def test_empty_documents(spark, tmp_path):
    assert P.run(spark, tables(spark, tmp_path, [], [])).collect() == []


def test_every_operator_has_a_query(spark):
    names = QS.queries()
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(QS.oracle_sql()) <= set(names)


def test_oracles_agree(spark):
    duckdb = __import__("duckdb")
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    for name, sql in QS.oracle_sql().items():
        got = QS.queries()[name](spark, SF)
        rel = con.sql(sql)
        expected = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
        show = lambda r: str(sorted((k, round(v, 6) if isinstance(v, float) else v) for k, v in r.items()))
        assert sorted(show(r.asDict()) for r in got.collect()) == sorted(map(show, expected)), name
