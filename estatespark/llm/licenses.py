"""License scans by canonical digests, in DataFrame functions only.

A text's canonical form ignores case, punctuation, bullets, copyright lines and equivalent
spellings. Its SHA-256 is hash-joined to the digests of a table of wordings, so a whole text is a
known licence or none. Lines that are notices on their own are looked up in the same way, each
line being an entire text. The SQL looks up the fixed lists KNOWN and NOTICES only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small
from .known_licenses import KNOWN, NOTICES, wordings

WORDINGS = 200_000  # rows of two short strings in a broadcast: at most some 30 MB
MARKS = 16  # sets of letters that lines are searched for

# Pattern and replacement, in this order; written so that Java's and RE2's syntax agree.
LINES = (
    (r"(?m)^[ \t*#/;-]*(copyright[ \t]*(\(c\)|©|[0-9]|<|\[|by )|\(c\)|©)[^\n]*$", ""),
    (r"(?m)^[ \t*#/;-]*all rights reserved[.]?[ \t]*$", ""),
    (r"(?m)^[ \t*#/;•-]*(([0-9]+[.)]|[(]?[a-z][.)])[ \t]+)?", ""),
)
SIGNS = r"[^a-z0-9]+"
SPELLINGS = (
    (r"licenc", "licens"),
    (r"\b(organ|author|recogn|util|initial|custom)is", r"\1iz"),
    (r"\b(fav|hon|lab|behavi|col)our", r"\1or"),
    (r"\b(sub|non) (licens|commercial|infring)", r"\1\2"),
    (r"\backnowledgement", "acknowledgment"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bhttps?\b", "https"),
)


def canonical(text: Column) -> Column:
    out = F.lower(text)
    for pattern, to in LINES:
        out = F.regexp_replace(out, pattern, to)
    out = F.regexp_replace(out, SIGNS, " ")
    for pattern, to in SPELLINGS:
        out = F.regexp_replace(out, pattern, to.replace("\\", "$"))
    return F.trim(out)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null for a null text or one without letters and digits."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def default_wordings(like: DataFrame) -> DataFrame:
    """license_id, text of the wordings that this package ships."""
    return like.sparkSession.createDataFrame(wordings(), "license_id string, text string")


def _mark(form: Column) -> Column:
    """Letters that a raw line has in lower case if its canonical form is ``form``; else empty."""
    kept = F.filter(F.split(form, " "), lambda w: ~w.rlike("licens|iz|or|sub|non|ment|https"))
    longest = F.array_max(F.transform(kept, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return F.when(F.contains(form, F.lit("licen")), F.lit("licen")).otherwise(F.coalesce(longest, F.lit("")))


def _lookup(line: Column, listed: DataFrame) -> Column:
    """Whether a line may be a wording of one line: a test of letters that spares the others' digests."""
    marks = [r.mark for r in listed.filter("one_line").select(_mark(F.col("form")).alias("mark")).distinct()
             .limit(MARKS + 1).collect()]
    if len(marks) > MARKS or "" in marks:
        return F.lit(True)
    found = F.lit(False)
    for mark in sorted({*marks, "licen"}):
        found = found | F.contains(F.lower(line), F.lit(mark))
    return found


def known(wordings: DataFrame) -> DataFrame:
    """license_id, form, known_digest, one_line of a table of wordings (license_id, text)."""
    text = F.col("text").cast("string")
    return (wordings.select(F.col("license_id").cast("string").alias("license_id"), canonical(text).alias("form"),
                            (~F.contains(F.trim(text, F.lit(" \t\r\n")), F.lit("\n"))).alias("one_line"))
            .filter("form != ''").withColumn("known_digest", F.sha2(F.col("form").cast("binary"), 256)))


def scan(docs: DataFrame, wordings: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license_id, notices for every row of ``docs`` (doc_id, text, any others).

    wordings: (license_id, text), of any number; by default those that this package ships. A
    wording of one line is a notice. license_id: the licence that the whole text is, else null.
    notices: the licences that lines of the text announce, each once, in order of name (empty:
    none). A null text, and one without letters or digits, has a null digest and no licence.
    Equal rows have equal results; an empty table gives an empty result.
    """
    wordings = default_wordings(docs) if wordings is None else wordings
    forms = cut(known(wordings), "wordings")
    listed = small(cut(forms.groupBy("known_digest").agg(F.min("license_id").alias("license_id")), "listed"), bound=WORDINGS)
    text = F.col("text").cast("string")
    lines = F.filter(F.coalesce(F.split(text, "\n"), F.array().cast("array<string>")), lambda x: _lookup(x, forms))
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(text).alias("digest"),
                           F.array_distinct(F.transform(lines, digest)).alias("lines"),
                           F.monotonically_increasing_id().alias("row")), "scanned")
    told = cut(rows.select("row", F.explode("lines").alias("known_digest")).join(listed, "known_digest")
               .groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices")), "told")
    return (rows.join(listed, F.col("digest") == F.col("known_digest"), "left").join(small(told, bound=WORDINGS), "row", "left")
            .select("doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices")))


def oracle_sql() -> str:
    """The scan of documents in DuckDB's SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def form(x: str) -> str:
        out = f"lower({x})"
        for pattern, to in LINES:
            out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(to)}, 'g')"
        out = f"regexp_replace({out}, {quoted(SIGNS)}, ' ', 'g')"
        for pattern, to in SPELLINGS:
            out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(to)}, 'g')"
        return f"trim({out})"

    values = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in KNOWN + NOTICES)
    return f"""
WITH known AS (
  SELECT d AS known_digest, min(i) AS license_id
  FROM (SELECT i, sha256({form('t')}) AS d FROM (VALUES {values}) v(i, t)) GROUP BY d),
docs AS (
  SELECT doc_id, row_number() OVER () AS r, text,
         CASE WHEN {form('text')} <> '' THEN sha256({form('text')}) END AS digest FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
told AS (
  SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM lines JOIN known ON known_digest = sha256({form('line')})
  WHERE contains(lower(line), 'licen') GROUP BY r)
SELECT doc_id, digest, license_id, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known ON digest = known_digest LEFT JOIN told USING (r)"""
