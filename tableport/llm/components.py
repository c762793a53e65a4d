"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link in (a, b): the least node of its component.

    Rounds of hooking and shortening: every node takes the least root among its neighbours', then the root's root.
    Each round's table is written, so lineage stays short; the frontier of a chain halves in every round. A node
    with very many links is pre-aggregated (a minimum) before the shuffle.
    """
    links = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    roots = links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    roots = materialize(roots, "roots")
    while True:
        known = roots.select(F.col("node").alias("b"), F.col("root").alias("near"))
        seen = links.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hooked = roots.join(seen, "node").select("node", "root", F.least("root", "near").alias("low"))
        # the old root learns of the lower one as well, which joins whole trees in one step
        told = hooked.select(F.col("root").alias("node"), "low").union(hooked.select("node", "low"))
        # written, so that the join below is between two plain shuffles: AQE can then split a large component
        lowest = materialize(told.groupBy("node").agg(F.min("low").alias("low")), "lowest")
        jump = lowest.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        moved = (lowest.join(jump, "low", "left").select("node", F.least("low", F.coalesce("lower", "low")).alias("root")))
        moved = materialize(moved, "roots")
        if moved.join(roots, ["node", "root"], "left_anti").isEmpty():
            return moved
        roots = moved
