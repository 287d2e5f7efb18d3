"""Prefix trie of conversations, rolled up in bands of depths.

A node is a distinct sequence of the first d turns (role, text); its members are the conversations
that start with it. Texts are hashed once and never shuffled: a turn is worth the hash of its role,
text and place, and a prefix the exclusive or of its turns' hashes (128 bits), so running keys are
window sums that combine over pieces of a conversation of any length.

Totals over subtrees are summed in bands of ``band`` depths. Every node explodes only to the nodes
above it within its band (at most ``band`` rows). The nodes at the bands' borders then hold their
bands' sums; these are completed across bands by doubling steps (each adds the sums of the borders
1, 2, 4, ... bands below), and a completed border explodes once to the nodes above it within its
band. So rounds grow with the logarithm of the deepest conversation's number of bands, and no row
explodes by more than the height of a band. All sums combine before they are shuffled, so a prefix
that a third of all conversations share costs one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, small

KEY = ["depth", "k1", "k2"]
PIECE = 256  # ids of a node that are joined before they are hashed


@dataclass(frozen=True)
class Params:
    band: int = 16  # depths
    bands: int = 1024  # of a conversation whose keys are summed together


def hashed(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, h1, h2 (hashes of role and text) and bytes (UTF-8 bytes of the text).

    A null role or text is empty. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.octet_length(text).cast("long").alias("bytes"))


def in_order(turns: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, ... by turn, null first), h1, h2, bytes.

    Turns of one number are ordered by their hashes; equal turns count as often as they occur.
    Conversations lie over ranges of (conv_id, turn), so a long one has many tasks; a range
    continues one conversation of the range before at most, which bounds the starts.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("spread")]
    ranged = cut(turns.withColumn("spread", F.monotonically_increasing_id())  # deals out equal rows
                 .repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    counts = cut(ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n")), "counts")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .filter("before > 0").drop("n"))
    at = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return (ranged.withColumn("at", at).join(small(starts), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "h1", "h2", "bytes"))


def lengths(turns: DataFrame) -> DataFrame:
    """conv_id and n, the number of its turns."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("n"))


def reopened(turns: DataFrame, sizes: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first turns of their group's first one.

    Conversation c gets the first h turns of c - c % group (all if there are fewer, none if there
    is no such one), then its own turns after its first h; h = crc32(c in decimal) % most.
    Returns turns and lengths in the form of ``in_order`` (with n) and ``lengths``.
    """
    c = F.col("conv_id")
    plan = sizes.select("conv_id", "n", (F.crc32(c.cast("string").cast("binary")) % most).alias("h"),
                        (c - c % group).alias("base"))
    bases = sizes.filter(c % group == 0).select(c.alias("base"), F.col("n").alias("base_n"))
    given = F.least("h", F.coalesce("base_n", F.lit(0)))
    plan = cut(plan.join(bases, "base", "left").select(
        "conv_id", "base", "h", given.alias("given"), (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + given).alias("n")), "plan")
    own = (turns.join(plan.select("conv_id", "h", "given", "n"), "conv_id").filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "h1", "h2", "bytes", "n"))
    heads = turns.filter((c % group == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    taken = (heads.join(plan.select("conv_id", "base", "h", "n"), "base").filter("pos <= h")
             .select("conv_id", "pos", "h1", "h2", "bytes", "n"))
    return own.unionByName(taken), plan.select("conv_id", "n")


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _starts(totals: DataFrame, deepest: int, width: int) -> DataFrame:
    """conv_id, band, s1, s2: the exclusive or of a conversation's earlier bands.

    ``width`` bands are summed together, and groups of so many bands by the same rule.
    """
    earlier = (Window.partitionBy("conv_id", "group").orderBy("band")
               .rowsBetween(Window.unboundedPreceding, -1))
    rows = totals.withColumn("group", F.floor(F.col("band") / width)).withColumns(
        {s: F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)) for s, x in (("s1", "x1"), ("s2", "x2"))})
    if deepest < width:
        return rows.select("conv_id", "band", "s1", "s2")
    groups = totals.groupBy("conv_id", F.floor(F.col("band") / width).alias("band")).agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    above = _starts(groups, deepest // width, width).select(
        "conv_id", F.col("band").alias("group"), F.col("s1").alias("g1"), F.col("s2").alias("g2"))
    return rows.join(above, ["conv_id", "group"]).select(
        "conv_id", "band", _xor("s1", "g1").alias("s1"), _xor("s2", "g2").alias("s2"))


def prefixes(turns: DataFrame, deepest: int, p: Params = Params()) -> DataFrame:
    """Each turn as the prefix it ends: conv_id, depth, k1, k2, n, bytes, h1, h2 and above.

    above: the keys of the prefixes of its band's first depth less one up to depth - 1.
    """
    rows = turns.select("conv_id", "pos", "n", "bytes", "h1", "h2",
                        F.xxhash64("h1", "pos").alias("x1"), F.xxhash64("h2", "pos").alias("x2"),
                        F.floor((F.col("pos") - 1) / p.band).alias("band"))
    w = Window.partitionBy("conv_id", "band").orderBy("pos")
    upto, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    local = (rows.withColumns({"k1": F.bit_xor("x1").over(upto), "k2": F.bit_xor("x2").over(upto)})
             .withColumn("above", F.collect_list(F.struct("k1", "k2")).over(earlier)))
    zero = F.lit(0).cast("long")
    above = F.concat(F.array(F.struct(zero.alias("k1"), zero.alias("k2"))), "above")
    if deepest > p.band:
        totals = cut(rows.groupBy("conv_id", "band").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")), "bands")
        later = cut(_starts(totals, deepest // p.band, p.bands).filter("band > 0"), "starts")
        local = local.join(small(later, bound=BROADCAST_ROWS // 4), ["conv_id", "band"], "left").withColumns(
            {s: F.coalesce(s, zero) for s in ("s1", "s2")})
        above = F.transform(above, lambda e: F.struct(e.k1.bitwiseXOR(F.col("s1")).alias("k1"),
                                                      e.k2.bitwiseXOR(F.col("s2")).alias("k2")))
        local = local.withColumns({"above": above, "k1": _xor("k1", "s1"), "k2": _xor("k2", "s2")})
    else:
        local = local.withColumn("above", above)
    return local.select("conv_id", F.col("pos").alias("depth"), "k1", "k2", "n", "bytes", "h1", "h2", "above")


def _explode(nodes: DataFrame, p: Params) -> DataFrame:
    """A row for each node above within the band: at_depth, its key and the node's columns."""
    rows = nodes.select("*", F.posexplode("above").alias("i", "up"))
    return rows.withColumn("at_depth", F.floor((F.col("depth") - 1) / p.band) * p.band + F.col("i"))


def _completed(borders: DataFrame, p: Params) -> DataFrame:
    """Sums of the bands' borders (KEY, n_leaves, saved_tokens, t1, t2: the border above) over all below.

    After a step a border holds the sums of the borders less than 2, 4, 8, ... bands below it, and
    points as many bands up.
    """
    step, state = p.band, cut(borders, "borders")
    while state.filter(F.col("depth") >= step).limit(1).count():
        given = (state.filter(F.col("depth") >= step)
                 .groupBy((F.col("depth") - step).alias("depth"), F.col("t1").alias("k1"), F.col("t2").alias("k2"))
                 .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")))
        target = state.select((F.col("depth") + step).alias("depth"), F.col("k1").alias("t1"), F.col("k2").alias("t2"),
                              F.col("t1").alias("next1"), F.col("t2").alias("next2"))
        zero = F.lit(0)
        state = cut(state.join(given, KEY, "left").join(target, ["depth", "t1", "t2"], "left").select(
            *KEY, (F.col("n_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
            F.col("next1").alias("t1"), F.col("next2").alias("t2")), "borders")
        step *= 2
    return state.select(*KEY, "n_leaves", "saved_tokens")


_KEPT = ["conv_id", "n_convs", "n_ends", "h1", "h2", "p1", "p2"]


def _summed(rows: DataFrame) -> DataFrame:
    """One row a node: what its own row says, and the sums of all rows for it."""
    return rows.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in _KEPT],
                                  *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


def _for(rows: DataFrame, children: Column) -> DataFrame:
    """What exploded rows give the nodes above them."""
    none = F.lit(None).cast("long")
    return rows.select(F.col("at_depth").alias("depth"), F.col("up.k1").alias("k1"), F.col("up.k2").alias("k2"),
                       *[none.alias(c) for c in _KEPT], children.cast("long").alias("n_children"), "n_leaves", "saved_tokens")


def rolled_up(found: DataFrame, sizes: DataFrame, deepest: int, p: Params = Params()) -> DataFrame:
    """The trie's nodes with their totals, from ``prefixes`` and the lengths of all conversations."""
    nodes = (found.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("depth") == F.col("n")).alias("n_ends"),
        *[F.first(c).alias(c) for c in ("bytes", "h1", "h2", "above")]))  # the same for all members
    nodes = cut(nodes.withColumn("n_leaves", (F.col("n_ends") == F.col("n_convs")).cast("long"))
                .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes"))
                .withColumn("p1", F.element_at("above", -1).k1).withColumn("p2", F.element_at("above", -1).k2), "nodes")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = (sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("n") == 0).alias("n_ends"))
            .filter("n_convs > 0").select(
                zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", "n_ends",
                *[none.alias(c) for c in ("h1", "h2", "p1", "p2")], zero.alias("n_children"),
                (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"), zero.alias("saved_tokens")))
    own = nodes.withColumn("n_children", zero).select(*KEY, *_KEPT, "n_children", "n_leaves", "saved_tokens").unionByName(root)
    inner = F.col("depth") % p.band != 0  # a border's sums go up when they are complete
    up = _explode(nodes, p).withColumns({c: F.when(inner, F.col(c)).otherwise(zero) for c in ("n_leaves", "saved_tokens")})
    sums = _summed(own.unionByName(_for(up, F.col("at_depth") == F.col("depth") - 1)))
    if deepest < p.band:
        return sums
    sums = cut(sums, "sums")
    tops = cut(nodes.filter(~inner).select(*KEY, "above"), "tops")
    borders = sums.filter(~inner).join(tops, KEY, "left").select(
        *KEY, "n_leaves", "saved_tokens", F.col("above")[0].k1.alias("t1"), F.col("above")[0].k2.alias("t2"))
    full = cut(_completed(borders, p), "completed")
    down = _explode(full.join(tops, KEY), p).filter("i > 0")
    whole = sums.filter(~inner).drop("n_leaves", "saved_tokens").join(full, KEY)
    return _summed(sums.filter(inner).unionByName(whole).unionByName(_for(down, zero)))


def prefix_trie(turns: DataFrame, sizes: DataFrame, p: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """The nodes, and the prefixes (conv_id, depth, k1, k2) with which conversations end.

    ``turns`` as of ``in_order`` with n, ``sizes`` as of ``lengths``, with 0 for conversations
    without a turn. Columns of the nodes: depth, k1, k2, conv_id (smallest member), parent_conv_id
    (the parent's conv_id; null for the root), n_convs, n_ends, n_children, n_leaves (childless
    nodes of the subtree), saved_tokens (over the subtree, (n_convs - 1) times the bytes of each
    node's last text) and h1, h2 of the last turn (for ``with_texts``). The root has depth 0.
    Without any conversation there is no node, not even the root.
    """
    deepest = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    found = cut(prefixes(turns, deepest, p), "prefixes")
    nodes = cut(rolled_up(found, sizes, deepest, p), "trie")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2")
    zero = F.lit(0).cast("long")
    ends = (found.filter("depth = n").select("conv_id", *KEY)
            .unionByName(sizes.filter("n = 0").select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"))))
    return whole, ends


def of_conversations(conversations: DataFrame, p: Params = Params()) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text, any others) as they are.

    Turns are ordered by turn, null first, then by a hash of role and text; null role or text is
    empty; repeated rows are turns of their own; rows without a conv_id are left out; an empty
    table has no node. Columns as of ``prefix_trie``, with role and text of the last turn.
    """
    turns = cut(in_order(hashed(conversations)), "ordered")
    sizes = cut(lengths(turns), "lengths")
    return with_texts(prefix_trie(turns.join(sizes, "conv_id"), sizes, p)[0], conversations)


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with role and text of their last turns (null for the root) in place of h1, h2."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = (conversations.select(F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
                                 role.alias("role"), text.alias("text")).dropDuplicates(["h1", "h2"]))
    return nodes.join(said, ["h1", "h2"], "left").drop("h1", "h2")


def id_digests(ends: DataFrame) -> DataFrame:
    """KEY and sha256 of the comma-joined, ascending conv_ids of every node's rows in ``ends``.

    A digest is sequential, so one task hashes all ids of a node; it holds a batch of joined
    pieces at a time, never a node's ids.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in KEY]))
            ids, out, i = b.column("conv_id").to_pylist(), [], 0
            while i < len(keys):
                j = i + 1
                while j < min(len(keys), i + PIECE) and keys[j] == keys[i]:
                    j += 1
                out.append((*keys[i], part, seq, ",".join(map(str, ids[i:j]))))
                seq, i = seq + 1, j
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)

    names = [*KEY, "part", "seq", "ids"]
    schema = pa.schema([(c, pa.int64()) for c in names[:5]] + [("ids", pa.string())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            done = []
            for key, ids in zip(zip(*[b.column(c).to_pylist() for c in KEY]), b.column("ids").to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((*now, h.hexdigest()))
                    now, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(sha.names, r)) for r in done], sha)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(sha.names, (*now, h.hexdigest())))], sha)

    sha = pa.schema([(c, pa.int64()) for c in KEY] + [("ends_sha256", pa.string())])
    pieces = (ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
              .mapInArrow(joined, "depth long, k1 long, k2 long, part long, seq long, ids string"))
    return (cut(pieces, "pieces").repartition(*KEY).sortWithinPartitions(*KEY, "part", "seq")
            .mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string"))


def shared_openings(conversations: DataFrame, p: Params = Params()) -> DataFrame:
    """The trie of the reopened conversations, with the digest of the ids that end at each node.

    Null, repeated and missing rows are taken as in ``of_conversations``.
    """
    turns = cut(in_order(hashed(conversations)), "ordered")
    again, sizes = reopened(turns, cut(lengths(turns), "lengths"))
    nodes, ends = prefix_trie(again, cut(sizes, "lengths"), p)
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(id_digests(ends), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def oracle_sql() -> str:
    """DuckDB's SQL of ``shared_openings``: sequences as lists, prefixes as their heads."""
    return """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list(said ORDER BY pos) AS turns,
         list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS inverse
  FROM t GROUP BY conv_id),
h AS (SELECT conv_id, turns, (4294967295 - inverse) % 9 AS h FROM convs),
again AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
  FROM h a LEFT JOIN h b ON b.conv_id = a.conv_id - a.conv_id % 5),
heads AS (SELECT conv_id, d AS depth, len(turns) = d AS ends, turns[1:d] AS path
          FROM again, unnest(range(len(turns) + 1)) AS r(d)),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
                 (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(path[depth].text)) END AS saved
          FROM heads GROUP BY depth, path),
kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
marked AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.depth = k.depth AND n.path = k.path),
up AS (SELECT path[1:d] AS path, d AS depth, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
       FROM marked, unnest(range(depth + 1)) AS r(d) GROUP BY ALL)
SELECT m.conv_id, m.depth, parent.conv_id AS parent_conv_id, m.n_convs, m.n_children, up.n_leaves,
       CAST(up.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM marked m JOIN up ON up.depth = m.depth AND up.path = m.path
LEFT JOIN marked parent ON parent.depth = m.depth - 1 AND parent.path = m.path[1:m.depth - 1]
"""
