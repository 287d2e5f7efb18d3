"""Near-duplicate documents by min-max hashing, banding and exact confirmation.

One pass over the texts keeps, under each of ``permutations`` random orders, both the least
and the greatest shingle hash: two signature values for one evaluation. Agreement of either
value estimates the resemblance without bias, with a lower variance than as many separate
minima give. ``rows`` consecutive values make a band.
Texts with equal shingle sets form one class before anything is compared. Classes that share
a band are a group, and the pairs of a group are never listed:

1. every class is compared with the hubs of its groups, the classes whose groups are the fullest, so
   the original of a family rather than one of its copies: first with the fullest of them, then
   with the others that are not in one component with it by then;
2. a group of more than two classes that are still in different components is open. Its classes
   get ``more`` further values for that band, under fresh permutations, and the longer band deals
   them into smaller groups with hubs of their own; and so on for ``levels`` levels, as long as
   groups are open. A level has one row for each class and open band, however large the groups are.

Every link is confirmed on the full shingle sets. What the hubs of no level reached is then
compared all the same (``exact``), where it is in different components still: the pairs of groups of
at most SMALL classes are listed; the classes of larger groups are dealt into clusters (groups that
share classes) and blocks of bounded size, and one task compares all of two blocks, so that no pair
becomes a row. With the defaults a pair at the threshold of 0.8 shares no band with a probability of
some 1e-6 (5e-6 for five shingles), and is left out. ``prefixes`` finds those too: every class
is then grouped by its prefix, the rarest shingles that are more than the threshold lets it lack: two sets that
reach the threshold share the first of their common shingles in any order of all shingles, and it is in the
prefixes of both. What these groups hold in different components is compared in the same way, so no link is left out.
Groups of prefixes chain far more classes together than bands do, and all classes of such a cluster are compared:
for tables of some ten thousand classes, not for large ones, and off unless asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as T
from .common import cut, release, small
from .graph import components


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    percent: int = 80  # least 100 * intersection / union
    permutations: int = 90
    rows: int = 5
    more: int = 5  # values that a band grows by on each further level
    levels: int = 3
    exact: bool = True  # compare what the levels leave in different components
    prefixes: bool = False  # and what shares no band; quadratic in large tables

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows


SMALL = 16  # classes of a group whose pairs are listed
BLOCK_CLASSES, BLOCK_SHINGLES = 4096, 1 << 19  # of a block on average
SAMPLE, SEEN, COMMON = 16, 3, 200_000  # one class of so many shows the common shingles; any choice of them gives the same links
SLOTS = "node long, n long, slot int, band long"
SKETCH = "rid long, doc_id long, k1 long, k2 long, n_shingles long, bands array<long>"


def signature(s: np.ndarray, permutations: int, level: int = 1) -> np.ndarray:
    """Least and greatest value of a non-empty shingle set under each permutation of a level."""
    mul, add = T.stream(16 * level + 3, permutations), T.stream(16 * level + 4, permutations)
    low = np.full(permutations, ~np.uint64(0))
    high = np.zeros(permutations, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 8192):
            x = (s[i:i + 8192, None] ^ add) * mul
            np.minimum(low, x.min(axis=0), out=low)
            np.maximum(high, x.max(axis=0), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_keys(sig: np.ndarray, p: Params) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` signature values."""
    values = sig[:p.bands * p.rows].reshape(p.bands, p.rows)
    with np.errstate(over="ignore"):
        return T.mix((values * T.stream(5, p.rows)).sum(axis=1) + T.stream(6, p.bands)).view(np.int64)


def longer_keys(s: np.ndarray, at: np.ndarray, keys: np.ndarray, level: int, p: Params) -> np.ndarray:
    """The keys of bands ``at``, so far ``keys``, with the further values of a level."""
    sig = signature(s, -(-p.bands * p.more // 2), level)[:p.bands * p.more].reshape(p.bands, p.more)
    with np.errstate(over="ignore"):
        return T.mix((sig[at] * T.stream(5, p.more)).sum(axis=1) + keys.view(np.uint64)).view(np.int64)


def _longer(level: int, p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, n, slot, band = [], [], [], []
            rows = zip(*(b.column(c).to_pylist() for c in ("node", "n")), *(b.column(c) for c in ("shingles", "open")))
            for k, size, shingles, open_ in rows:
                s = shingles.values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = open_.values.field("slot").to_numpy(zero_copy_only=False)
                keys = open_.values.field("band").to_numpy(zero_copy_only=False)
                node += [k] * len(at)
                n += [size] * len(at)
                slot.append(at)
                band.append(longer_keys(s, at, keys, level, p))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(np.concatenate([*slot, np.zeros(0, np.int32)]), pa.int32()),
                 pa.array(np.concatenate([*band, np.zeros(0, np.int64)]), pa.int64())], names=["node", "n", "slot", "band"])
    return run


def _sets(p: Params, with_sets: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2, n, out = [], [], [], []
            for s in T.shingle_sets(b.column("text"), p.shingle):
                with np.errstate(over="ignore"):
                    k1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                    k2.append(int((T.mix(s)).sum(dtype=np.uint64).view(np.int64)))
                n.append(len(s))
                if with_sets:
                    out.append(s.view(np.int64))
                else:
                    out.append(band_keys(signature(s, p.permutations), p) if len(s) else np.zeros(0, np.int64))
            at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            flat = np.concatenate([*out, np.zeros(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(n, pa.int64()), lists], names=["rid", "doc_id", "k1", "k2", "n_shingles", "bands"])
            del k1, k2, n, out, at, flat, lists
            release()
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """rid: the doc_id, or a number made from the text where that is null."""
    rid = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))))
    return docs.select(rid.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _confirmed(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * common >= p.percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _alike(x: str, y: str, p: Params) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return 100 * F.least(x, y) >= p.percent * F.greatest(x, y)


def _grouped(slots: DataFrame) -> DataFrame:
    """The slots (node, n, slot, band) whose band more than one class has, with that number."""
    shared = slots.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    return slots.join(shared, "band")


def _hubs(members: DataFrame, rank: Column) -> DataFrame:
    """band, hub, hub_n: the class of the greatest rank in each group."""
    best = F.max(F.struct(rank.alias("rank"), (-F.col("node")).alias("least"), "n")).alias("hub")
    return (members.groupBy("band").agg(best)
            .select("band", (-F.col("hub.least")).alias("hub"), F.col("hub.n").alias("hub_n"), "hub.rank"))


def _near(members: DataFrame, hubs: DataFrame, p: Params) -> DataFrame:
    """(node, hub, rank) for classes and the hubs of their groups that can reach the threshold."""
    near = members.join(hubs, "band").filter("node <> hub").filter(_alike("n", "hub_n", p))
    return near.select("node", "hub", "rank").distinct()


def _apart(near: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``near`` whose classes are not in one component yet."""
    of_hub = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    return (near.join(roots, "node", "left").join(of_hub, "hub", "left")
            .filter(F.coalesce("root", "node") != F.coalesce("hub_root", "hub")))


def _hub_links(near: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The confirmed links (a, b) among classes and hubs."""
    pairs = near.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    return cut(_confirmed(pairs, sets, p), "links")


def _open(members: DataFrame, roots: DataFrame, size: int) -> DataFrame:
    """The members of groups of at least ``size`` classes that lie in different components."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = (placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
             .filter((F.col("low") != F.col("high")) & (F.col("size") >= size)).select("band"))
    return cut(members.join(open_, "band"), "members")


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """The components after more links were found: only those links and the components they touch are gone through."""
    return components(found, roots) if found.limit(1).count() else roots


def _apart_groups(members: DataFrame, roots: DataFrame) -> DataFrame:
    """band, size, node, n, root: the members of groups that lie in different components."""
    placed = members.select("band", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = (placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
             .filter("low <> high").select("band", "size"))
    return cut(placed.join(open_, "band").select("band", "size", "node", "n", "root"), "rest")


def _listed(groups: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The confirmed links (a, b) among all pairs of each group that are not in one component."""
    one, two = (groups.select("band", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("root").alias(f"root{x}"))
                for x in "ab")
    pairs = one.join(two, "band").filter("a < b and roota <> rootb").filter(_alike("na", "nb", p)).select("a", "b").distinct()
    return cut(_confirmed(cut(pairs, "pairs"), sets, p), "links")


def _joining(percent: int):
    def run(block: pa.Table) -> pa.Table:
        """Links (a, b) that join the components of two blocks' classes as all their links would."""
        block = block.combine_chunks()
        node, label, side = (block.column(c).to_numpy().copy() for c in ("node", "root", "side"))
        names, label = np.unique(label, return_inverse=True)
        lists = block.column("shingles").chunk(0)
        size = lists.value_lengths().to_numpy().astype(np.int64)
        starts = np.cumsum(size) - size
        _, flat = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        has = np.zeros(int(flat.max()) + 1, bool)
        a, b = [], []
        for x in np.flatnonzero(label != np.bincount(label).argmax()):
            own = flat[starts[x]:starts[x] + size[x]]
            has[own] = True
            common = np.add.reduceat(has[flat], starts, dtype=np.int64)
            has[own] = False
            hit = (100 * common >= percent * (size + size[x] - common)) & (label != label[x])
            if side.min() < side.max():
                hit &= side != side[x]
            if hit.any():
                met, first = np.unique(label[hit], return_index=True)
                a += [int(node[x])] * len(met)
                b += node[np.flatnonzero(hit)[first]].tolist()
                label[np.isin(label, met)] = label[x]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _compared(groups: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) that join the components of ``groups`` as all their links would."""
    if not groups.limit(1).count():
        return groups.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    first = groups.groupBy("band").agg(F.min("node").alias("b"))
    clusters = components(cut(groups.join(first, "band").select(F.col("node").alias("a"), "b").distinct(), "chains"))
    nodes = cut(groups.select("node", "root", "n").distinct().join(clusters.withColumnRenamed("root", "cluster"), "node"), "nodes")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    dealt = (nodes.join(small(nodes.groupBy("cluster").agg(blocks.alias("blocks"))), "cluster")
             .withColumn("side", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cluster", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
                     "side", "node", "root"))
    return cut(dealt.join(sets, "node").groupBy("cluster", "low", "high").applyInArrow(_joining(p.percent), "a long, b long"), "links")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of docs that hold a text of each of these classes."""
    return _keyed(docs).join(small(nodes.select(F.col("least_rid").alias("rid")).distinct()), "rid", "left_semi")


def _sets_of(docs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """node, shingles of the classes ``nodes`` (node, k1, k2, least_rid)."""
    return cut(_texts(docs, nodes).mapInArrow(_sets(p, True), SKETCH).join(nodes.select("node", "k1", "k2"), ["k1", "k2"])
               .groupBy("node").agg(F.first("bands").alias("shingles")), "sets")


def _prefix(s: np.ndarray, common: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, rare ones before common ones, one more than it may lack."""
    k = len(s) + (-percent * len(s) // 100) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        rank = np.where(common[at] == s, often[at], 0)
        s = s[np.lexsort((s, rank))]
    return s[:k]


def _prefixes(p: Params, shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _sets(p, True)(batches):
            lists = b.column("bands")
            flat, at = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            out = [_prefix(flat[i:j], *shared.value, p.percent).view(np.int64) for i, j in zip(at[:-1], at[1:])]
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*out, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), found], names=["k1", "k2", "bands"])
            del lists, flat, out, found
            release()
    return run


def _by_prefix(docs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """node, band, members, n: the classes of groups that share a shingle of their prefixes."""
    some = classes.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0).select("node", "k1", "k2", "least_rid")
    seen = (_sets_of(docs, some, p).select(F.explode("shingles").alias("s")).groupBy("s").count()
            .filter(F.col("count") >= SEEN).orderBy(F.col("count").desc(), "s").limit(COMMON).toPandas())
    common, often = seen["s"].to_numpy(np.int64).view(np.uint64), seen["count"].to_numpy(np.int64)
    order = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order], often[order]))  # COMMON pairs of numbers at most
    found = (_texts(docs, classes).mapInArrow(_prefixes(p, shared), "k1 long, k2 long, bands array<long>")
             .join(classes.select("node", "k1", "k2"), ["k1", "k2"]).select("node", F.explode("bands").alias("band")))
    # one shuffle of all prefixes: nearly all of their shingles stand in one class alone
    shared_by = found.withColumn("members", F.count("*").over(Window.partitionBy("band"))).filter("members > 1")
    return cut(shared_by.join(classes.select("node", "n"), "node"), "members")


def _compare(groups: DataFrame, roots: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The components after what the groups hold in different components was compared."""
    rest = _apart_groups(groups, roots)
    roots = _merged(roots, _listed(rest.filter(F.col("size") <= SMALL), sets, p))
    rest = _apart_groups(rest.filter(F.col("size") > SMALL), roots)
    return _merged(roots, _compared(rest, sets, p))


def _linked(classes: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """The components (node, root) of the confirmed links between classes."""
    members = cut(_grouped(classes.select("node", "n", F.posexplode("bands").alias("slot", "band"))), "members")
    fullness = members.groupBy("node").agg(F.sum("members").alias("fullness"))
    hubs = cut(_hubs(members.join(fullness, "node"), F.col("fullness")), "hubs")
    nodes = cut(members.select("node").distinct().join(classes.select("node", "k1", "k2", "least_rid"), "node"), "nodes")
    sets = _sets_of(docs, nodes, p)

    near = cut(_near(members, hubs, p), "near")
    first = F.max(F.struct("rank", (-F.col("hub")).alias("least")))  # the fullest of a class's hubs
    best = near.groupBy("node").agg(first.alias("best")).select("node", (-F.col("best.least")).alias("hub"))
    roots = components(_hub_links(best, sets, p))
    roots = _merged(roots, _hub_links(_apart(near, roots), sets, p))
    rest = members.join(hubs.select("band", "hub"), "band").filter("node <> hub").drop("hub")
    for level in range(2, p.levels + 1):
        members = _open(members, roots, 3)
        if not members.limit(1).count():
            break
        bands = members.groupBy("node", "n").agg(F.collect_list(F.struct("slot", "band")).alias("open"))  # p.bands at most
        members = cut(_grouped(cut(bands.join(sets, "node").mapInArrow(_longer(level, p), SLOTS), "slots")), "members")
        near = _near(members, _hubs(members, F.xxhash64("node", F.lit(level))), p)
        roots = _merged(roots, _hub_links(_apart(near, roots), sets, p))
    if p.exact:
        roots = _compare(rest, roots, sets, p)
    if p.prefixes:
        rest = _apart_groups(_by_prefix(docs, classes, p), roots)
        nodes = cut(rest.select("node").distinct().join(classes.select("node", "k1", "k2", "least_rid"), "node"), "nodes")
        roots = _compare(rest, roots, _sets_of(docs, nodes, p), p)
    return roots


def _versions(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) for classes that share a doc_id: they are versions of one document."""
    texts = rows.filter("n_shingles > 0 and doc_id is not null")
    more = cut(texts.groupBy("doc_id").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).filter("low <> high")
               .select("doc_id"), "versions")
    if not more.limit(1).count():
        return classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    of = cut(texts.join(more, "doc_id").select("doc_id", "k1", "k2").distinct().join(classes.select("node", "k1", "k2"), ["k1", "k2"]),
             "versions")
    first = of.groupBy("doc_id").agg(F.min("node").alias("a"))
    return of.join(first, "doc_id").filter("a <> node").select("a", F.col("node").alias("b"))


def _resolved(docs: DataFrame, p: Params) -> DataFrame:
    """rid, doc_id, n_shingles, component_id and keeper (the rid that stays) of every row."""
    rows = cut(_keyed(docs).mapInArrow(_sets(p, False), SKETCH), "sketch")
    classes = cut(
        rows.filter("n_shingles > 0").groupBy("k1", "k2")
        .agg(F.min("rid").alias("least_rid"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies"),
             F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))  # equal sets have equal bands
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    roots = _merged(_linked(classes, docs, p), cut(_versions(rows, classes), "versions"))
    ids = (roots.join(classes.select("node", "least_id", "least_rid"), "node").groupBy("root")
           .agg(F.min("least_id").alias("component_id"), F.min("least_rid").alias("root_rid")))
    named = cut(roots.join(ids, "root").select("node", "component_id", "root_rid"), "named")
    groups = cut(classes.join(named, "node", "left").filter("copies > 1 or root_rid is not null").select(
        "k1", "k2", F.coalesce("component_id", "least_id").alias("component_id"),
        F.coalesce("component_id", "least_id", "root_rid", "least_rid").alias("keeper")), "groups")
    whole = rows.select("rid", "doc_id", "n_shingles", "k1", "k2").join(groups, ["k1", "k2"], "left")
    some = F.col("n_shingles") > 0
    return whole.select("rid", "doc_id", "n_shingles",
                        F.when(some, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                        F.when(some, F.coalesce("keeper", "rid")).otherwise(F.col("rid")).alias("keeper"))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text, any others).

    component_id is the smallest doc_id reachable over confirmed links, the row's own
    included; kept marks the row whose id that is. Null and empty texts, and those without a
    word, have no shingles, link with nothing and are kept. Rows with a null doc_id keep it;
    they take part by their text, and are kept where nothing of their component has an id.
    Rows that share a doc_id are versions of one document and share its component.
    An empty table gives an empty result.
    """
    return _resolved(docs, p).select("doc_id", "n_shingles", "component_id",
                                     F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one stays for each component.

    That is the row of the smallest doc_id, or of the least text hash where no row has an id. Of
    rows that share that id the one of the least text hash stays. Texts without a word all stay.
    """
    found = cut(_resolved(docs, p), "resolved")
    gone = cut(found.filter("rid <> keeper").select("rid").distinct(), "gone")
    again = cut(found.filter("n_shingles > 0 and rid = keeper").groupBy("rid").count().filter("count > 1")
                .select("rid"), "again")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(text)).alias("rid"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(text).alias("mark"))
    kept = rows.join(small(gone), "rid", "left_anti")
    few = small(again)
    repeated = cut(kept.join(few, "rid", "left_semi").dropDuplicates(["rid", "mark"]), "repeated")
    least = repeated.groupBy("rid").agg(F.min("mark").alias("mark"))
    return (kept.join(few, "rid", "left_anti")
            .unionByName(repeated.join(least, ["rid", "mark"], "left_semi")).select("row.*"))
