"""Connected components by hooking and pointer jumping (distributed union-find).

Every node hooks onto its smallest neighbour if that is smaller, which gives a
forest; pointers jump to their pointer's pointer until they reach the roots;
links between two trees go on as links between their roots. At least half of
the nodes with links hook in every turn.

A turn is minima per node (added up in each task before the shuffle) and joins,
so a node with very many links is split like any skewed join key; no task ever
gathers a node's links. Steps are written to the shared scratch folder, which
also cuts the plan's lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged


def _above(parent: DataFrame, child: DataFrame) -> DataFrame:
    """Rows (node, up, moved) of ``child`` with ``up`` moved to its own ``up``."""
    step = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
    return child.join(step, "up", "left").select(
        "node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved"))


def _roots(parent: DataFrame) -> DataFrame:
    """(node, up) with every ``up`` moved to the root of its tree; a step jumps
    twice, so pointers get three times as long."""
    while True:
        jumped = staged(_above(parent, _above(parent, parent).drop("moved")), "parents")
        done = jumped.filter("moved").isEmpty()
        parent = jumped.select("node", "up")
        if done:
            return parent


def relabelled(labels: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (node, root) of ``labels`` with roots replaced as ``roots`` (node, up) has them."""
    return labels.join(roots.select(F.col("node").alias("root"), "up"), "root", "left") \
        .select("node", F.coalesce("up", "root").alias("root"))


def _between(links: DataFrame, roots: DataFrame) -> DataFrame:
    a, b = (roots.select(F.col("node").alias(x), F.col("up").alias(f"up_{x}")) for x in "ab")
    moved = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("up_a", "a").alias("a"), F.coalesce("up_b", "b").alias("b"))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for the end points of ``edges`` (a, b): the
    smallest node of the component. Repeated edges and loops are allowed (a
    node with nothing but loops has no row); no edges give no rows."""
    links, labels = edges.select("a", "b").filter("a <> b"), None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("least", "a").alias("up")), "least")
        if labels is not None and least.isEmpty():
            return labels
        roots = _roots(least.filter("up < node"))
        if labels is None:      # nodes that did not hook are roots
            labels = least.select("node", F.col("node").alias("root"))
        labels = staged(relabelled(labels, roots), "labels")
        links = staged(_between(links, roots), "links")
