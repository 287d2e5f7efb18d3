import hashlib
import random
import re
from pathlib import Path

import pytest
from estatespark.llm import known_licenses as KL
from estatespark.llm import licenses as C
from estatespark.llm import quotes as Q
from estatespark.llm import warc as W
from estatespark.session import scratch_path
from llm_rows import awkward, frame
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, payload binary, first long"


def pages():
    rng = random.Random(2)
    long = ["<p>" + "z" * rng.randrange(97, 400) for _ in range(8)] + ["é" * 50, "y" * 100, "y" * 99]
    rows = [(i, f"http://x/{i}", rng.choice(long), None, None) for i in range(60)]
    rows += [(70, "a\r\nb%", None, None, None), (71, None, "", None, None), (72, "u", "", None, None),
             (None, "v", long[0], None, None), (1, "http://x/1", "again " * 30, None, None)]
    rows.append((80, "w", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5, None, None))
    return rows


def test_archives_round_trip(spark):
    rows = pages()
    got = W.archived(spark.createDataFrame(rows, PAGES).repartition(4)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= W.LEAST and i is not None:
            first[body] = min(i, first.get(body, i))
    expected = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        again = body in first and first[body] != i
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                         first[body] if again else None, None if again else True))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def inner_archive() -> str:
    """Three whole records, as a page may hold them."""
    row = {"record_type": "response", "record_id": "urn:page:9", "target_uri": "x", "page_id": 9, "refers_to": None,
           "payload_digest": "0", "payload_bytes": 4, "payload": b"body"}
    return (W.record(row) * 3).decode()


def test_ranges_filters_and_projection(spark):
    to = scratch_path(spark, "test-warc")
    rows = pages() + [(90 + i, "inner", f"{'a' * i}{inner_archive()}", None, None) for i in range(3)]
    W.write(spark.createDataFrame(rows, PAGES).coalesce(1), to, step=100)
    whole = W.read(spark, to)
    assert sorted(r.target_uri or "" for r in whole.collect()) == sorted(r[1] or "" for r in rows)
    for split in (150, 1000, 2000, 5000):
        cut = W.read(spark, to, split=split)
        assert cut.rdd.getNumPartitions() > 1
        assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    for on in ("true", "false"):
        before = spark.conf.get(W.PUSHDOWN)
        spark.conf.set(W.PUSHDOWN, on)
        try:
            some = W.read(spark, to, "page_id long, record_type string").filter("record_type = 'response' and page_id >= 70")
            assert sorted(r.page_id for r in some.collect()) == [70, 71, 72, 80, 90, 91, 92]
        finally:
            spark.conf.set(W.PUSHDOWN, before)
    reader = W._FilteringReader(to, W.SPLIT, ["page_id"])
    list(reader.pushFilters([W.EqualTo(("page_id",), 71)]))
    assert [r for p in reader.partitions() for r in reader.read(p)] == [(71,)]
    assert list(reader.pushFilters([W.EqualTo(("payload",), b"")])) != []


def test_no_pages(spark):
    assert W.archived(spark.createDataFrame([], PAGES)).collect() == []


def variant(text):
    text = text.replace("\n", "  \n * ").upper().replace("LICENSE", "LICENCE").replace(",", " ;")
    return "// Copyright (c) 2020 Someone Else\n/* © 2021 another */\n" + text


def test_known_licences_in_other_dress(spark):
    rows = [(i, t, None, None, None) for i, (_, t) in enumerate(KL.KNOWN)]
    rows += [(100 + i, variant(t), None, None, None) for i, (_, t) in enumerate(KL.KNOWN)]
    got = {r.doc_id: r.license_id for r in C.scan(frame(spark, rows, clash=True)).collect()}
    for i, (name, _) in enumerate(KL.KNOWN):
        assert got[i] == name and got[100 + i] == name
    changed = C.scan(frame(spark, [(1, KL.MIT.replace("sell", "rent"), None, None, None)])).first()
    assert changed.license_id is None and changed.digest


def test_notices_and_awkward_rows(spark):
    rows = awkward() + [(500, "text\nreleased under the MIT licence\nLicensed under CC BY-NC 4.0\n# released under the MIT "
                              "License.\nRELEASED under the MIT License\nno license here", None, None, None)]
    got = C.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert [r.notices for r in got if r.doc_id == 500] == ["CC-BY-NC-4.0,MIT"]
    assert all(r.digest is None for r in got if r.doc_id in (1, 2, 3))
    assert len({r.digest for r in got if r.doc_id in (4, 5)}) == 1
    assert C.scan(frame(spark, [])).collect() == []


CONV = "conv_id long, turn long, role string, text string, key string, depth int"


def brute_links(rows):
    """What linked() returns, by plain loops."""
    norm = lambda t: re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", t.lower()).strip(" ")
    parts, said, quotes = {}, {}, {}
    for n, (c, t, _, text, *_) in enumerate(rows):
        lines = []
        for line in re.sub("\r\n?", "\n", text or "").split("\n"):
            m = re.match(r"(?:[ \t]*>)+", line)
            lines.append((m[0].count(">") if m else 0, line[m.end():] if m else line))
        runs = []
        for level, content in lines:
            if runs and runs[-1][0] == level:
                runs[-1][1].append(content)
            else:
                runs.append((level, [content]))
        own = "\n".join(x for level, x in lines if level == 0).strip(" \t\n")
        q = [(level, norm(" ".join(x))) for level, x in runs if level and norm(" ".join(x))]
        parts[n] = (own, q)
        if c is not None and t is not None:
            quotes.setdefault((c, t), []).extend(q)
            for k in {own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")}:
                if norm(k):
                    said.setdefault((c, norm(k)), []).append(t)
    parent, count = {}, {}
    for (c, t), qs in quotes.items():
        hits = [(level, -min(said[c, k])) for level, k in qs if (c, k) in said and min(said[c, k]) < t]
        if hits:
            parent[c, t], count[c, t] = -min(hits)[1], len(hits)
    out = []
    for n, (c, t, role, *_) in enumerate(rows):
        at, depth = t, 0
        while (c, at) in parent:
            at, depth = parent[c, at], depth + 1
        own, q = parts[n]
        out.append((c, t, role, parent.get((c, t)), at, depth, len(q), count.get((c, t), 0), own,
                    f"<|{role or ''}|>\n{own}"))
    return out


def conversations():
    rng = random.Random(6)
    rows = []
    for c in range(6):
        said = []
        for t in range(25):
            own = [" ".join(f"w{rng.randrange(300)}" for _ in range(6)) for _ in range(rng.randrange(1, 4))]
            text = []
            for _ in range(rng.randrange(0, 3)):
                if said:
                    q = rng.choice(said)
                    mark = rng.choice(["> ", ">", "> > ", " >> "])
                    text += [mark + x.upper() for x in rng.choice([q, q[:1]])] + rng.choice([[], ["> nobody said"]])
            sep = rng.choice([[], [""]])
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["\n", "\r\n"]).join(text + sep + own), None, None))
            said.append(own)
    rows += [(0, 90, None, None, None, None), (0, 91, "user", "", None, None), (None, 3, "user", "> x\ny", None, None),
             (2, None, "user", "> w1\nalone", None, None), (3, 95, "user", ">\n> >\n>>> !!", None, None),
             (4, 96, "user", "same", None, None), (4, 96, "user", "same", None, None), (4, 97, "user", "> same", None, None),
             (5, 98, "user", "x " * 40_000, None, None), (5, 99, "user", ">> " + "x " * 40_000 + "\n> w1", None, None)]
    return rows


def test_quotes_are_linked_as_by_loops(spark):
    rows = conversations()
    got = Q.in_reply_order(Q.linked(spark.createDataFrame(rows, CONV).repartition(5))).collect()
    expected = brute_links(rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert sum(r[3] is not None for r in expected) > 50 and max(r[5] for r in expected) > 2
    order = [(r.conv_id, r.root_turn, r.depth, r.turn) for r in got if r.conv_id is not None and r.turn is not None]
    assert order == sorted(order)


def brute_partial(rows):
    """(conv_id, turn) -> (parent_turn, linked) with partial quotes, by plain loops over whole words."""
    words = lambda t: tuple(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t.lower()))

    def blocks(lines):
        out = [[]]
        for x in lines:
            out[-1].append(x) if x.strip(" \t") else out.append([])
        return [words(" ".join(b)) for b in out]

    said, runs = {}, {}
    for c, t, _, text, *_ in rows:
        if c is None or t is None:
            continue
        own, found = [], []
        for line in (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n"):
            mark = re.match(r"(?:[ \t]*>)*", line)[0]
            level = mark.count(">")
            if not level:
                own.append(line)
            if level and found and found[-1][0] == level:
                found[-1][1].append(line[len(mark):])
            else:
                found.append((level, [line[len(mark):]]))
        runs.setdefault((c, t), []).extend(f for f in found if f[0])
        for part in {words(" ".join(own)), *blocks(own), *map(words, own)}:
            said[c, part] = min(t, said.get((c, part), t))
    out = {}
    for (c, t), found in runs.items():
        hits, linked = [], 0
        for level, lines in found:
            pieces = [(0, words(" ".join(lines))), *((1, b) for b in blocks(lines)), *((1, words(x)) for x in lines)]
            mine = [(level, rank, -said[c, w]) for rank, w in pieces if w and said.get((c, w), t) < t]
            hits, linked = hits + mine, linked + bool(mine)
        if hits:
            out[c, t] = (-min(hits)[2], linked)
    return out


THREAD = [
    (0, "Hello all,\n\nthe first line is here\nthe second one follows\nand a third ends it\n\nSecond paragraph\nof two lines\n\nThird one"),
    (1, "Hello all,\n\nanother message with\nits own hard wrapped\nlines in a paragraph"),
    (2, "> the second one follows\n> and a third ends it\n\npartial multi-line"),
    (3, "> Second paragraph\n> of two lines\n>\n> Third one\n\ntwo of three paragraphs"),
    (4, "> Third one\n> its own hard wrapped\n\nneighbouring quotes"),
    (5, "> another message with\n> its own hard wrapped\n> lines in a paragraph\n> [snip]\n\nan extra line"),
    (6, "> Hello all,\n>\n> its own hard wrapped\n\ngreeting of 0, line of 1"),
    (7, "> partial multi line\n> [snip]\n> > the second one follows\n> > and a third ends it\n\nouter partial, inner whole"),
    (8, "> Third one\n\nx\n\n> neighbouring quotes\n> [snip]\n\nwhole first"),
    (9, "> never said\n\nnone"),
    (10, "> its own hard\n\nno whole line"),
]


def test_partial_quotes_are_linked(spark):
    rows = [(7, t, "user", text, None, None) for t, text in THREAD]
    got = {r.turn: r for r in Q.linked(spark.createDataFrame(rows, CONV), partial=True).collect()}
    parents = {0: None, 1: None, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 2, 8: 0, 9: None, 10: None}
    assert {t: r.parent_turn for t, r in got.items()} == parents
    assert got[7].root_turn == 0 and got[7].depth == 2 and got[7].linked == 2 and got[4].linked == got[4].quotes == 1


def test_partial_quotes_as_by_loops(spark):
    rng = random.Random(8)
    rows = conversations() + [(8, t, "user", text, None, None) for t, text in THREAD]
    for c in range(20, 24):
        said = []
        for t in range(30):
            own = [" ".join(f"w{rng.randrange(60)}" for _ in range(2)) for _ in range(6)]
            own.insert(rng.randrange(1, 6), "")
            text = []
            for _ in range(rng.randrange(3) if said else 0):
                q, a = rng.choice(said), rng.randrange(6)
                text += [rng.choice(["> ", "> > ", ">"]) * 1 + x for x in q[a:a + rng.randrange(1, 5)]] + rng.choice([[], ["> more"], [""]])
            rows.append((c, t, "user", "\n".join([*text, "", *own]), None, None))
            said.append(own)
    got = Q.linked(spark.createDataFrame(rows, CONV).repartition(5), partial=True).collect()
    assert len(got) == len(rows)
    expected = brute_partial(rows)
    seen = {(r.conv_id, r.turn): (r.parent_turn, r.linked) for r in got if r.parent_turn is not None}
    assert seen == expected and len(expected) > 100
    whole = {(r[0], r[1]) for r in brute_links(rows) if r[3] is not None}
    assert whole < set(seen)


def test_no_messages(spark):
    assert Q.linked(spark.createDataFrame([], CONV)).collect() == []


@pytest.mark.parametrize("text,levels", [("> > a\n> b\nc\n>d", [2, 1, 1]), ("a > b", []), ("", [])])
def test_levels(spark, text, levels):
    row = Q.parsed(spark.createDataFrame([(1, 1, "user", text, None, None)], CONV)).select(F.col("quotes.level")).first()
    assert row[0] == levels


def test_sql_of_the_links_agrees():
    duckdb = pytest.importorskip("duckdb")
    con, rows = duckdb.connect(), conversations()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    assert sorted(map(str, con.execute(Q.oracle_sql()).fetchall())) == sorted(map(str, brute_links(rows)))


def test_whole_texts_and_notices_of_common_licences(spark):
    names = ["GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Artistic-1.0-Perl",
             "Apache-2.0"]
    folder = Path(KL.__file__).parent / "license_texts"
    texts = [(folder / f"{x}.txt").read_text() for x in names]
    gpl = texts[1]
    short = gpl[:gpl.index("END OF TERMS AND")].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
                                                        "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")
    lines = {"# SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0-only", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
             "Released under CC-BY-ND 4.0": "CC-BY-ND-4.0", "distributed under the MPL 2.0": "MPL-2.0",
             "This program is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "under no terms": ""}
    rows = [(i, t, None, None, None) for i, t in enumerate([*texts, short, *(f"a\n{x}\nb" for x in lines)])]
    got = sorted(C.scan(frame(spark, rows)).collect())
    assert [r.license_id for r in got[:len(names) + 1]] == [*names, "GPL-2.0"]
    assert [r.notices for r in got[len(names) + 1:]] == list(lines.values())


def test_a_table_of_wordings(spark):
    entries = [("House-1", "Ask  the owner\nfirst."), ("House-2", "Nothing may be copied."), ("House-0", "NOTHING may be copied"),
               ("Other", "Organisation use only"), (None, None), ("Empty", "..")]
    own = spark.createDataFrame(entries, "license_id string, text string")
    rows = awkward() + [(500, "ask the owner first", None, None, None), (501, "Nothing may be copied", None, None, None),
                        (502, "x\n* nothing may be copied!\norganization use only\nReleased under the MIT License.", None, None, None)]
    got = C.scan(frame(spark, rows), own).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: (r.license_id, r.notices) for r in got}
    assert by_id[500] == ("House-1", "") and by_id[501] == ("House-0", "House-0") and by_id[502] == (None, "House-0,Other")
    none = C.scan(frame(spark, rows), own.limit(0)).collect()
    assert len(none) == len(rows) and {(r.license_id, r.notices) for r in none} == {(None, "")}
