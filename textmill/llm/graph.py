"""Connected components of an edge table, by contraction, round by round in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) of every node of edges (a, b longs): label is its component's smallest node.

    In a round every node takes its smallest neighbour's own smallest neighbour for
    a name; edges are renamed, and those within one name are gone. So a star is
    done in one round, and what is joined shrinks with the components that are
    left. A hub's edges are summed before they are shuffled, and the joins that
    rename them can be split. No edges give no rows.
    """
    left = scratch.write(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    )
    now = None
    while now is None or not left.isEmpty():
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        least = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("name"))
        up = least.select(F.col("node").alias("name"), F.col("name").alias("up"))
        name = scratch.write(least.join(up.hint("merge"), "name").select("node", F.col("up").alias("name")))
        of_a, of_b = (scratch.reread(name).select(F.col("node").alias(c), F.col("name").alias(f"{c}_name")) for c in ("a", "b"))
        renamed = left.join(of_a.hint("merge"), "a").join(of_b.hint("merge"), "b").where("a_name <> b_name")
        fewer = scratch.write(
            renamed.select(F.least("a_name", "b_name").alias("a"), F.greatest("a_name", "b_name").alias("b")).distinct()
        )
        scratch.drop(left)
        if now is None:
            now = name
        else:
            again = name.select(F.col("node").alias("name"), F.col("name").alias("new"))
            new = scratch.write(now.join(again.hint("merge"), "name", "left").select("node", F.coalesce("new", "name").alias("name")))
            scratch.drop(name, now)
            now = new
        left = fewer
    return now.select("node", F.col("name").alias("label"))


def merged(comps: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """comps (node, label) after its components are joined by edges (a, b) between their labels, or between nodes it lacks."""
    new = components(edges, scratch)
    again = new.select(F.col("node").alias("label"), F.col("label").alias("new"))
    old = comps.join(again.hint("merge"), "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return scratch.write(old.union(new).distinct())
