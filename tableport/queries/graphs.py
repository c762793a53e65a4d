"""Dependency order over a graph derived from orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import graph
from .common import load


def _graph(spark, root):
    """Orders are nodes; order k depends on k/2 and k/3 (order 0 on itself), on its customer (not a
    node), twice on k/2 when urgent, and the dearest orders' halves depend back on them: cycles."""
    orders = load(spark, root, "orders")
    k = F.col("o_orderkey")
    nodes = orders.select(k.alias("node"), k.alias("ordinal"))

    def edges(rows, child, parent, slot):
        return rows.select(child.cast("bigint").alias("child"), parent.cast("bigint").alias("parent"),
                           (k * 8 + slot).alias("ordinal"))

    half, third = F.floor(k / 2), F.floor(k / 3)
    parts = [
        edges(orders, k, half, 0), edges(orders, k, third, 1), edges(orders, k, -1 - F.col("o_custkey"), 2),
        edges(orders.filter("o_orderpriority = '1-URGENT'"), k, half, 3),
        edges(orders.filter("o_totalprice > 499500"), half, k, 4),
    ]
    return nodes, reduce(lambda a, b: a.unionByName(b), parts)


def q44_topo_levels(spark, root):
    found = graph.dependency_levels(*_graph(spark, root), ordered=False)
    return found.found.select("node", "level").unionByName(
        found.cyclic.select("node", F.lit(None).cast("int").alias("level")))


def q44b_topo_order(spark, root):
    return graph.topological_order(*_graph(spark, root))


def q44c_cycles(spark, root):
    return graph.cycles(*_graph(spark, root))


QUERIES = {f.__name__: f for f in (q44_topo_levels, q44b_topo_order, q44c_cycles)}

_GRAPH = """WITH RECURSIVE
    n AS (SELECT o_orderkey AS node FROM orders),
    raw AS (SELECT o_orderkey AS child, o_orderkey // 2 AS parent, o_orderkey * 8 AS ordinal FROM orders
        UNION ALL SELECT o_orderkey, o_orderkey // 3, o_orderkey * 8 + 1 FROM orders
        UNION ALL SELECT o_orderkey, -1 - o_custkey, o_orderkey * 8 + 2 FROM orders
        UNION ALL SELECT o_orderkey, o_orderkey // 2, o_orderkey * 8 + 3 FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT o_orderkey // 2, o_orderkey, o_orderkey * 8 + 4 FROM orders WHERE o_totalprice > 499500),
    e AS (SELECT child, parent, max(ordinal) AS ordinal FROM raw WHERE child <> parent
        AND child IN (SELECT node FROM n) AND parent IN (SELECT node FROM n) GROUP BY ALL),
    late AS (SELECT a.child AS node FROM e a JOIN e b ON a.child = b.parent AND a.parent = b.child
        UNION SELECT e.child FROM late JOIN e ON e.parent = late.node),
    depth AS (SELECT node, 0 AS d FROM n WHERE node NOT IN (SELECT node FROM late)
            AND node NOT IN (SELECT child FROM e)
        UNION SELECT e.child, d + 1 FROM depth JOIN e ON e.parent = depth.node
            WHERE e.child NOT IN (SELECT node FROM late)),
    lvl AS (SELECT node, max(d) AS level FROM depth GROUP BY node)"""

ORACLES = {
    "q44_topo_levels": f"""{_GRAPH} SELECT node, CAST(level AS INTEGER) AS level FROM n LEFT JOIN lvl USING (node)""",
    "q44b_topo_order": f"""{_GRAPH},
        ord AS (SELECT node, 0 AS level, [node] AS path FROM lvl WHERE level = 0
            UNION ALL SELECT e.child, any_value(ord.level) + 1,
                list_append(arg_max(path, (path, e.ordinal)), arg_max(e.ordinal, (path, e.ordinal)))
            FROM ord JOIN e ON e.parent = ord.node JOIN lvl ON lvl.node = e.child AND lvl.level = ord.level + 1 GROUP BY e.child)
        SELECT node, CAST(level AS INTEGER) AS level, row_number() OVER (ORDER BY level IS NULL, level, path, node) AS position
        FROM n LEFT JOIN ord USING (node)""",
    "q44c_cycles": f"""{_GRAPH},
        inner_edges AS (SELECT child, parent FROM e WHERE child IN (FROM late) AND parent IN (FROM late)),
        reach AS (SELECT child AS a, parent AS b FROM inner_edges
            UNION SELECT reach.a, x.parent FROM reach JOIN inner_edges x ON x.child = reach.b),
        mutual AS (SELECT r.a, min(r.b) AS component FROM reach r JOIN reach s ON s.a = r.b AND s.b = r.a GROUP BY r.a)
        SELECT late.node, component FROM late LEFT JOIN mutual ON mutual.a = late.node""",
}
