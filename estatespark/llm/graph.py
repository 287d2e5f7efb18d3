"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _renamed(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges, with the labels of their ends."""
    of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return (edges.join(of_a, "a", "left").join(of_b, "b", "left")
            .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))


def _hooked(edges: DataFrame) -> DataFrame:
    """(node, root): every node under the least of itself and its neighbours, followed to the end."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                 .select("node", F.least("node", "least").alias("root")), "labels")
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = cut(labels.join(up, "root").select("node", F.col("up").alias("root"), F.col("root").alias("was")), "labels")
        moved = labels.filter("root < was").limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels


def _merged(roots: DataFrame, step: DataFrame) -> DataFrame:
    """The labels after a further step over the labels."""
    to = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null; a written table); root: the least node.

    ``known``, components of earlier edges as this function returns them, are merged with what ``edges``
    link. Each round puts every node under its least neighbour, follows these labels to their
    ends (pointer jumping: log of the depth) and goes on with the edges between different labels
    alone. Two rounds leave at most half of the nodes that have edges, and stars and dense groups
    end after one or two. Minima per node combine before the shuffle; a hub's edges sit on the
    probe side of plain sort-merge joins, which AQE splits. Every step is a written table. Empty edges: no rows.
    """
    steps = []
    left = edges if known is None else cut(_renamed(edges, known), "edges")
    while not steps or left.limit(1).count():
        steps.append(_hooked(left))
        left = cut(_renamed(left, steps[-1]).filter("a <> b"), "edges")
    roots = steps[0]
    for step in steps[1:]:
        roots = _merged(roots, step)
    if known is not None:
        new = roots.join(known, "node", "left_anti")
        roots = _merged(known, roots).union(new)
    return roots if known is None and len(steps) == 1 else cut(roots, "roots")

