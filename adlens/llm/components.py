"""Connected components of a link table, by contraction on the executors.

Each round every node hooks to its smallest neighbour if that is smaller, the forest is flattened by
pointer jumping, and the links are rewritten between the roots. At least half of the nodes of a
component that isn't done yet vanish each round. Nothing but row counts reaches the driver; each round's
tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import released, stash


def _flatten(parent: DataFrame) -> DataFrame:
    """Point every node at its root: parent(node, root) with root <= node."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        moved = stash(parent.join(up, "root", "left")
                      .select("node", F.coalesce("higher", "root").alias("root"),
                              (F.col("higher") < F.col("root")).alias("moved")))
        parent = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            return parent


def _roots(nodes: DataFrame, parent: DataFrame) -> DataFrame:
    """nodes(node, root) with every root replaced by its own root, where it has one."""
    up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
    return nodes.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: root is the smallest node it is connected with."""
    with released(links.sparkSession):
        return stash(_contracted(links, a, b), hold=True)


def extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the links that gave ``roots`` and of these ones (a, b): only the roots that they join are
    worked on, however many nodes there are."""
    with released(links.sparkSession):
        at = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
        moved = components(links.join(at("a"), "a", "left").join(at("b"), "b", "left")
                           .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
        new = moved.join(roots.select("node"), "node", "left_anti")
        return stash(_roots(roots, moved).union(new.select("node", "root")), hold=True)


def _contracted(links: DataFrame, a: str, b: str) -> DataFrame:
    links = stash(links.select(F.col(a).alias("a"), F.col(b).alias("b"))
                  .where("a is not null and b is not null and a <> b")
                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = None
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("near")).union(links.select("b", "a"))
        hooked = stash(both.groupBy("node").agg(F.min("near").alias("near"))
                       .select("node", F.least("node", "near").alias("root")))
        parent = _flatten(hooked)
        found = parent if found is None else stash(_roots(found, parent))
        roots = lambda side: parent.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        links = stash(links.join(roots("a"), "a").join(roots("b"), "b").where("a_root <> b_root")
                      .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct())
        if links.isEmpty():
            return found
