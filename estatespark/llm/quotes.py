"""Quotation linking of conversations, in DataFrame functions only.

Each message is parsed into lines with a quote level (the number of leading ``>``). Runs of
lines of one level are passages. Quoted passages, and on request their paragraphs and lines, are
hashed in normalised form and joined to the message of the same conversation that said them first,
as a whole, as a paragraph or as a line. A message answers the latest message that its outermost
linked quotes come from. Roots and depths follow by pointer jumping, and (root_turn, depth, turn)
is the reply order. The SQL links whole passages only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

PREFIX = r"^((?:[ \t]*>)+)"


def normal(text: Column) -> Column:
    """Lower case, and one space for all that is no letter or digit; ASCII signs only count."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " "))


def _key(text: Column) -> Column:
    return F.md5(normal(text).cast("binary"))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own (the text without quoted lines), quotes, said.

    quotes: (level, key, parts) of each quoted passage, parts being the keys of its paragraphs and
    lines; said: keys of the own text, its paragraphs and its lines. Passages and parts without
    letters or digits have no key.
    """
    prefix = lambda x: F.regexp_extract(x, PREFIX, 1)
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), "\r\n?", "\n")
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(prefix(x), r"[^>]", "")).alias("level"),
        F.substring(x, F.length(prefix(x)) + 1, F.length(x)).alias("content")))
    level = lambda i: F.get("lines", i)["level"]
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: (i == 0) | (level(i) != level(i - 1)))
    stop = lambda k: F.coalesce(F.get("starts", k + 1), F.size("lines"))
    passages = F.transform("starts", lambda s, k: F.struct(
        level(s).alias("level"),
        F.array_join(F.transform(F.slice("lines", s + 1, stop(k) - s), lambda x: x["content"]), "\n").alias("text")))
    parts = lambda x: F.array_distinct(F.concat(F.split(x, r"\n[ \t]*\n"), F.split(x, "\n")))
    keys = lambda x: F.transform(F.filter(x, lambda y: normal(y) != ""), _key)
    quoted = F.filter(passages, lambda q: (q["level"] > 0) & (normal(q["text"]) != ""))
    own_lines = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["content"])
    said = F.array_distinct(F.concat(F.array("own"), F.split("own", r"\n[ \t]*\n"), F.split("own", "\n")))
    rows = (messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                            F.col("role").cast("string").alias("role"), lines.alias("lines"))
            .withColumn("starts", starts))
    return (rows.withColumn("own", F.trim(F.array_join(own_lines, "\n"), F.lit(" \t\n")))
            .withColumn("quotes", F.transform(quoted, lambda q: F.struct(
                q["level"].alias("level"), _key(q["text"]).alias("key"), keys(parts(q["text"])).alias("parts"))))
            .withColumn("said", keys(said))
            .select("conv_id", "turn", "role", "own", "quotes", "said"))


def _roots(links: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn, depth of every message that answers another."""
    state = links.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth"))
    while True:
        up = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"),
                          F.col("depth").alias("more"))
        step = cut(state.join(up, ["conv_id", "root_turn"], "left").select(
            "conv_id", "turn", F.coalesce("up", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("up").isNotNull().alias("moved")), "roots")
        moved = step.filter("moved").limit(1).count()
        state = step.drop("moved")
        if not moved:
            return state


def linked(messages: DataFrame, partial: bool = False) -> DataFrame:
    """conv_id, turn, role, parent_turn, root_turn, depth, quotes, linked, text, formatted.

    One row for every row of ``messages`` (conv_id, turn, role, text, any others). quotes is the
    number of its quoted passages, linked of those whose words an earlier turn of the
    conversation has as its own text, a paragraph or a line (the earliest turn that does).
    parent_turn: the latest of these turns at the outermost linked level, else null. With
    ``partial``, a passage is also linked by any of its paragraphs and lines that an earlier turn
    has; at the outermost linked level these count where no whole passage is linked.
    root_turn: the end of that chain, the turn itself without a parent; depth: its length. text
    is the message without quoted lines. Null texts count as empty. Rows with a null conv_id or
    turn stay alone. Rows of one (conv_id, turn) are one message's parts and share its links.
    An empty table gives an empty result.
    """
    rows = cut(parsed(messages).withColumn("row", F.monotonically_increasing_id()), "parsed")
    pieces = F.array(F.struct(F.lit(0).alias("rank"), F.col("q.key").alias("key")))
    if partial:
        pieces = F.concat(pieces, F.transform("q.parts", lambda x: F.struct(F.lit(1).alias("rank"), x.alias("key"))))
    quoted = cut(rows.filter("conv_id is not null and turn is not null")
                 .select("conv_id", "turn", "row", F.posexplode("quotes").alias("at", "q"))
                 .select("conv_id", "turn", "row", "at", F.col("q.level").alias("level"), F.explode(pieces).alias("p"))
                 .select("conv_id", "turn", "row", "at", "level", "p.rank", "p.key"), "quoted")
    wanted = cut(quoted.select("conv_id", "key").distinct(), "wanted")
    first = cut(rows.select("conv_id", "turn", F.explode("said").alias("key")).filter("turn is not null")
                .join(small(wanted, bound=500_000), ["conv_id", "key"], "left_semi")
                .groupBy("conv_id", "key").agg(F.min("turn").alias("source")), "first")
    hits = quoted.join(first, ["conv_id", "key"]).filter("source < turn")
    links = cut(hits.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", "rank", (-F.col("source")).alias("source"))).alias("best"),
        F.count_distinct("row", "at").alias("linked"))
        .select("conv_id", "turn", (-F.col("best.source")).alias("parent_turn"), "linked"), "links")
    placed = cut(links.join(_roots(links), ["conv_id", "turn"]), "placed")
    out = rows.join(small(placed, bound=500_000), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"), F.size("quotes").alias("quotes"),
        F.coalesce("linked", F.lit(0)).cast("int").alias("linked"), F.col("own").alias("text"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "own").alias("formatted"))


def in_reply_order(rows: DataFrame) -> DataFrame:
    """Linked rows dealt into ranges and sorted: each conversation in reply order, roots by turn.

    Ranges cut through long conversations, so none has to fit in a task.
    """
    order = ["conv_id", "root_turn", "depth", "turn"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def oracle_sql() -> str:
    """The linked rows of conversations in DuckDB's SQL, with a recursive walk up the replies."""
    def norm(x: str) -> str:
        return rf"trim(regexp_replace(lower({x}), '[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+', ' ', 'g'))"

    return rf"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role,
         string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS lines
  FROM conversations),
split AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM messages),
marked AS (SELECT r, pos, line, regexp_extract(line, '{PREFIX}', 1) AS prefix FROM split),
leveled AS (
  SELECT r, pos, len(regexp_replace(prefix, '[^>]', '', 'g')) AS level, substr(line, len(prefix) + 1) AS content
  FROM marked),
changed AS (
  SELECT *, (level IS DISTINCT FROM lag(level) OVER (PARTITION BY r ORDER BY pos))::INT AS new FROM leveled),
runs AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY pos) AS run FROM changed),
quotes AS (
  SELECT r, level, {norm("string_agg(content, ' ' ORDER BY pos)")} AS key
  FROM runs WHERE level > 0 GROUP BY r, run, level),
told AS (SELECT * FROM quotes WHERE key <> ''),
owns AS (
  SELECT r, trim(string_agg(content, chr(10) ORDER BY pos), ' ' || chr(9) || chr(10)) AS own
  FROM leveled WHERE level = 0 GROUP BY r),
parts AS (
  SELECT r, own AS part FROM owns
  UNION SELECT r, unnest(regexp_split_to_array(own, '\n[ \t]*\n')) FROM owns
  UNION SELECT r, unnest(string_split(own, chr(10))) FROM owns),
firsts AS (
  SELECT conv_id, {norm('part')} AS key, min(turn) AS source
  FROM parts JOIN messages USING (r) WHERE {norm('part')} <> '' GROUP BY 1, 2),
links AS (
  SELECT m.conv_id, m.turn, (array_agg(f.source ORDER BY t.level, f.source DESC))[1] AS parent_turn,
         count(*)::INT AS linked
  FROM told t JOIN messages m USING (r) JOIN firsts f ON f.conv_id = m.conv_id AND f.key = t.key
  WHERE f.source < m.turn GROUP BY m.conv_id, m.turn),
walk AS (
  SELECT conv_id, turn, parent_turn AS root_turn, 1 AS depth FROM links
  UNION ALL
  SELECT w.conv_id, w.turn, l.parent_turn, w.depth + 1
  FROM walk w JOIN links l ON l.conv_id = w.conv_id AND l.turn = w.root_turn),
roots AS (SELECT conv_id, turn, max(depth) AS depth, arg_max(root_turn, depth) AS root_turn FROM walk GROUP BY 1, 2)
SELECT m.conv_id, m.turn, m.role, l.parent_turn, coalesce(w.root_turn, m.turn) AS root_turn,
       coalesce(w.depth, 0)::INT AS depth, coalesce(n.n, 0)::INT AS quotes, coalesce(l.linked, 0)::INT AS linked,
       coalesce(o.own, '') AS text, '<|' || coalesce(m.role, '') || '|>' || chr(10) || coalesce(o.own, '') AS formatted
FROM messages m LEFT JOIN owns o USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM told GROUP BY r) n USING (r)
LEFT JOIN links l ON l.conv_id = m.conv_id AND l.turn = m.turn
LEFT JOIN roots w ON w.conv_id = m.conv_id AND w.turn = m.turn"""
