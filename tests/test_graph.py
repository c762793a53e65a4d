import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from tableport.operators import graph
from tableport.operators.graph import cycles, dependency_levels, topological_order
from tableport.session import small_frame


def first_in_first_out(nodes, edges):
    """Brute force: placement by a queue; whatever never becomes free follows in input order."""
    links = [(c, p) for c, p in edges if c != p and c in nodes and p in nodes]
    open_parents = {n: sum(c == n for c, _ in links) for n in nodes}
    queue, out = deque(n for n in nodes if not open_parents[n]), []
    while queue:
        node = queue.popleft()
        out.append(node)
        for child, parent in links:
            if parent == node:
                open_parents[child] -= 1
                if not open_parents[child]:
                    queue.append(child)
    return out + [n for n in nodes if n not in out]


def ordered(spark, nodes, edges):
    n = small_frame(spark, list(zip(nodes, range(len(nodes)))), "node string, ordinal bigint")
    e = small_frame(spark, [(c, p, i) for i, (c, p) in enumerate(edges)], "child string, parent string, ordinal bigint")
    return [r["node"] for r in topological_order(n, e).orderBy("position").collect()]


@pytest.mark.parametrize("nodes, edges", [
    ("abc", []),
    ("ab", [("a", "b")]),
    ("abc", [("a", "b"), ("b", "c")]),
    ("abcd", [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")]),
    ("ab", [("a", "a"), ("a", "b")]),
    ("ab", [("a", "z"), ("z", "b")]),
    ("abcd", [("a", "b"), ("b", "a"), ("c", "a")]),
    ("abc", [("a", "b"), ("a", "b"), ("a", "c"), ("c", "b")]),
])
def test_known_graphs(spark, nodes, edges):
    assert ordered(spark, list(nodes), edges) == first_in_first_out(list(nodes), edges)


def test_random_graphs(spark):
    rng = random.Random(5)
    for _ in range(6):
        nodes = [f"n{i}" for i in range(rng.randint(2, 9))]
        edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(rng.randint(1, 12))]
        edges += [edges[0]]
        assert ordered(spark, nodes, edges) == first_in_first_out(nodes, edges)


def test_levels_and_cycle_report(spark):
    nodes = small_frame(spark, [(n, i) for i, n in enumerate("abcd")], "node string, ordinal bigint")
    edges = small_frame(spark, [("a", "b", 0), ("b", "a", 1), ("c", "a", 2)], "child string, parent string, ordinal bigint")
    found = dependency_levels(nodes, edges)
    assert [tuple(r) for r in found.placed.select("node", "level").collect()] == [("d", 0)]
    assert sorted(r["node"] for r in found.cyclic.collect()) == ["a", "b", "c"]
    fork = small_frame(spark, [("a", "b", 0), ("b", "c", 1), ("d", "b", 2)], "child string, parent string, ordinal bigint")
    assert dependency_levels(nodes, fork, max_rounds=2).placed.count() == 4
    with pytest.raises(ValueError, match="longer than 1"):
        dependency_levels(nodes, fork, max_rounds=1)


def test_long_chain_takes_few_rounds(spark):
    """A chain of 2000 levels, a second one of 700 beside it, a branch off the middle, and a ring that never starts."""
    n = 2000
    edges = [(i + 1, i) for i in range(n - 1)] + [(3000 + i + 1, 3000 + i) for i in range(699)] + [(5000, 1000)]
    edges += [(6000 + (i + 1) % 50, 6000 + i) for i in range(50)] + [(7000, 6000)]
    names = [*range(n), *range(3000, 3700), 5000, *range(6000, 6050), 7000]
    nodes = spark.createDataFrame([(v, i) for i, v in enumerate(names)], "node long, ordinal long")
    links = spark.createDataFrame([(c, p, i) for i, (c, p) in enumerate(edges)], "child long, parent long, ordinal long")
    rows = topological_order(nodes, links).orderBy("position").collect()
    level = {v: v for v in range(n)} | {3000 + i: i for i in range(700)} | {5000: 1001}
    assert {r["node"]: r["level"] for r in rows} == level | {v: None for v in names if v >= 6000}
    assert [r["node"] for r in rows] == first_in_first_out(names, edges)
    dependency_levels(nodes, links, max_rounds=2)


def mutual(nodes, edges):
    """{node: least node that it leads to and that leads back, or None} of the nodes on or behind a cycle."""
    links = {(c, p) for c, p in edges if c != p and c in nodes and p in nodes}
    reach = {n: set() for n in nodes}
    for n in nodes:
        todo = [n]
        while todo:
            at = todo.pop()
            new = {p for c, p in links if c == at} - reach[n]
            reach[n] |= new
            todo += new
    stuck = [n for n in nodes if n in reach[n] or any(m in reach[m] for m in reach[n])]
    return {n: min((m for m in reach[n] if n in reach[m]), default=None) for n in stuck}


def found_cycles(spark, nodes, edges):
    n = spark.createDataFrame([(v, v) for v in nodes], "node long, ordinal long")
    e = spark.createDataFrame([(c, p, i) for i, (c, p) in enumerate(edges)], "child long, parent long, ordinal long")
    return {r["node"]: r["component"] for r in cycles(n, e).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cycles_against_mutual_reach(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(30 + 10 * seed))
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(len(nodes) + 6)]
    assert found_cycles(spark, nodes, edges) == mutual(nodes, edges)


def test_long_cycles_and_what_hangs_between(spark):
    ring = [(100 + (i + 1) % 40, 100 + i) for i in range(40)]                  # a ring by itself
    loop = [(200 + (i + 1) % 30, 200 + i) for i in range(30)]                  # with a tail in front and one behind
    other = [(300, 301), (301, 300)]
    edges = ring + loop + other + [(250, 205), (251, 250), (300, 251), (210, 260), (1, 1), (400, 300)]
    nodes = [1, *range(100, 140), *range(200, 230), 250, 251, 260, 300, 301, 400]
    got = found_cycles(spark, nodes, edges)
    assert got == {n: 100 for n in range(100, 140)} | {n: 200 for n in range(200, 230)} | {300: 300, 301: 300, 250: None, 251: None, 400: None}
    assert found_cycles(spark, [1, 2], [(1, 2)]) == {}


def test_layers_from_behind_against_the_front(spark):
    """Edges taken off in layers from behind give the levels and the order that peeling from the front gives."""
    rng = random.Random(11)
    names = list(range(30))
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in names] + [(v, v // 2) for v in names]
    edges = list(dict.fromkeys([*[(max(e), min(e)) for e in edges], (3, 7), (20, 21)]))
    nodes = spark.createDataFrame([(v, i) for i, v in enumerate(names)], "node long, ordinal long")
    links = spark.createDataFrame([(c, p, i) for i, (c, p) in enumerate(edges)], "child long, parent long, ordinal long")
    plain, layered = (dependency_levels(nodes, links, max_rounds=m, small=0) for m in (100, None))
    rows = lambda f: sorted((r["node"], r["level"], *r["sort_key"]) for r in f.placed.collect())
    assert rows(layered) == rows(plain)
    assert sorted(layered.cyclic.collect()) == sorted(plain.cyclic.collect())
    unordered = dependency_levels(nodes, links, ordered=False, small=0)
    assert "sort_key" not in unordered.placed.columns
    assert sorted(tuple(r) for r in unordered.placed.select("node", "level").collect()) == [r[:2] for r in rows(plain)]


def test_layers_move_few_edges_and_few_rounds_are_left(spark):
    """In a tree half of what is left leaves with each layer: few edges are left for the rounds from the front."""
    jumps = spark.range(1, 4096).select(F.col("id").alias("node"), F.floor(F.col("id") / 2).alias("from")).where("id > 1")
    layers, rest = graph._layers(jumps, 64)
    assert [layer.count() for layer in layers] == [2048, 1024, 512, 256, 128, 64] and rest.count() == 62
    chain = spark.range(1, 100).select(F.col("id").alias("node"), (F.col("id") - 1).alias("from"))
    layers, rest = graph._layers(chain, 0)               # a layer of one edge is not worth a round
    assert len(layers) == 1 and rest.count() == 98


def test_cycles_behind_each_other_take_few_rounds(spark, monkeypatch):
    """20 cycles, each hanging on all later ones: one repetition for each of them before."""
    made = []
    real = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name: made.append(name) or real(df, name))
    nodes = list(range(40))
    edges = [e for i in range(0, 40, 2) for e in ((i, i + 1), (i + 1, i))] + [(j, i) for i in range(0, 40, 2) for j in range(i + 2, 40, 2)]
    n = spark.createDataFrame([(v,) for v in nodes], "id long")
    e = spark.createDataFrame(edges, "child long, parent long")
    parts = {r["id"]: (r["component"], r["size"]) for r in graph._components(n, e).collect()}
    assert parts == {v: (v - v % 2, 2) for v in nodes}
    assert made.count("rest-links") < 12


def test_small_rings_take_few_rounds(spark, monkeypatch):
    """300 rings of two: rounds grow with the longest ring and chain, not with how many there are."""
    made = []
    real = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name: made.append(name) or real(df, name))
    edges = [e for i in range(0, 600, 2) for e in ((i, i + 1), (i + 1, i))]
    assert found_cycles(spark, list(range(600)), edges) == {v: v - v % 2 for v in range(600)}
    assert made.count("rings") <= 3


def test_order_keys_are_not_written_again_for_all_nodes(spark, monkeypatch):
    """Keys stay where the rounds wrote them: only those of chains are joined, none are joined with all nodes."""
    kept, real = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name: kept.append(df.columns) or real(df, name))
    nodes = spark.createDataFrame([(i, 100 + i) for i in range(9)], "node long, ordinal long")
    # 0 -> 1 -> 2 (a chain), 2 -> 3 and 4, 5 alone; 6 and 7 on a cycle, 8 behind it
    links = [(1, 0), (2, 1), (3, 2), (4, 2), (6, 7), (7, 6), (8, 6)]
    edges = spark.createDataFrame([(c, p, 10 - i) for i, (c, p) in enumerate(links)], "child long, parent long, ordinal long")
    got = {r["node"]: (r["level"], r["position"]) for r in topological_order(nodes, edges).collect()}
    assert got == {0: (0, 1), 5: (0, 2), 1: (1, 3), 2: (2, 4), 4: (3, 5), 3: (3, 6), 6: (None, 7), 7: (None, 8), 8: (None, 9)}
    assert not any("sort_key" in columns for columns in kept)
    found = dependency_levels(nodes, edges)
    assert {r["node"]: r["ordinal"] for r in found.placed.collect()} == {i: 100 + i for i in range(6)}
    assert {tuple(r) for r in found.cyclic.collect()} == {(6, 106), (7, 107), (8, 108)}
