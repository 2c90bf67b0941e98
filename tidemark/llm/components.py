"""Connected components of a large edge list, by hooking and contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import splittable_groups
from tidemark.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is one node of its component.

    Each round every node hooks to its smallest neighbour, and edges are carried over
    to the nodes hooked to.  A component loses at least half of its nodes per round,
    so rounds grow with the logarithm of its size.  Each round's edges and labels are
    written to the shared scratch folder: lineage stays short and lost executors cost a
    reread.  Edges with a null end and loops take no part; repeats do no harm; an
    empty list gives no rows.
    """
    links = stored(_links(edges.select("a", "b")), "links")
    labels = stored(links.select(F.col("a").alias("node"), F.col("b").alias("root"))
                    .groupBy("node").agg(F.min("root").alias("root"))
                    .select("node", F.least("node", "root").alias("root")), "labels")
    first = True
    while not links.isEmpty():
        hooks = splittable_groups(links, "a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        hooks = stored(hooks, "hooks")
        if not first:
            moved = labels.join(hooks, labels.root == hooks.a, "left")
            labels = stored(moved.select("node", F.coalesce("low", "root").alias("root")), "labels")
        first = False
        left = hooks.select("a", F.col("low").alias("new_a"))
        right = hooks.select(F.col("a").alias("b"), F.col("low").alias("new_b"))
        contracted = links.filter("a < b").join(left, "a").join(right, "b")
        links = stored(_links(contracted.select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))), "links")
    return labels


def _links(edges: DataFrame) -> DataFrame:
    """Each edge once per direction."""
    once = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return once.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                       .alias("e")).select("e.a", "e.b")
