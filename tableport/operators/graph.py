"""Dependency order of tables (or of anything with parent edges): chains are contracted, then peeled from behind and from the front with joins."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from ..session import materialize, path_exists, scratch_path
from .ranking import global_row_number


@dataclass(frozen=True)
class Levels:
    """``found`` (node, level and, if ordered, sort_key), ``cyclic`` (node, ordinal): on or behind a cycle; ``placed`` is
    ``found`` with ordinals, which cost a join of all nodes."""

    found: DataFrame
    cyclic: DataFrame
    numbered: DataFrame

    @property
    def placed(self) -> DataFrame:
        return self.found.join(self.numbered, "node").select("node", "ordinal", *self.found.columns[1:])


def usable_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One edge per (child, parent) with the ordinal of the last; self and unknown ends dropped."""
    known = nodes.select("node")
    return (
        edges.filter("child <> parent")
        .join(known.withColumnRenamed("node", "parent"), "parent", "left_semi")
        .join(known.withColumnRenamed("node", "child"), "child", "left_semi")
        .groupBy("child", "parent").agg(F.max("ordinal").alias("ordinal"))
    )


def _chains(links: DataFrame) -> DataFrame:
    """(node, head, dist) of every node behind the head of its chain.

    An edge is a chain link if its parent has no other child and its child no other parent. Every round doubles the
    pointers, so a chain of L nodes takes log L rounds, over chain nodes only. Rings of chain links have no head
    and are left out: no pointer of theirs ever ends. As long as another pointer is open, some end in each round.
    """
    lone_child = links.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.any_value("parent").alias("parent")).where("n = 1")
    lone_parent = links.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("parent")
    steps = lone_child.join(lone_parent, "parent").select(
        F.col("child").alias("node"), F.col("parent").alias("head"), F.lit(1).cast("bigint").alias("dist"))
    steps = materialize(steps, "chains")
    before = steps.count()
    while True:
        ahead = steps.select(F.col("node").alias("head"), F.col("head").alias("further"), F.col("dist").alias("more"))
        seen = Observation()
        doubled = steps.join(ahead, "head", "left").observe(seen, F.count("further").alias("open")).select(
            "node", F.coalesce("further", "head").alias("head"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"))
        steps = materialize(doubled, "chains")
        still = seen.get["open"]
        if not still:
            return steps
        if still == before:                              # only rings are still open
            return materialize(steps.join(ahead.select("head"), "head", "left_anti").select("node", "head", "dist"), "chains")
        before = still


def _layers(jumps: DataFrame, small: int) -> tuple[list[DataFrame], DataFrame]:
    """Edges by layers from behind, and the rest: a layer is what leads to nodes that nothing left depends on.

    Goes on while more than ``small`` edges are left and a round takes a quarter of them, so all rounds together move
    a few times the edges. All edges of a node are in one layer, and its parents in later layers or in the rest.
    """
    spark, layers, left = jumps.sparkSession, [], jumps.count()
    while left > small:
        seen, path = Observation(), scratch_path(spark, "layer")
        inner = jumps.select(F.col("from").alias("node")).distinct().withColumn("inner", F.lit(True))
        (jumps.join(inner, "node", "left").withColumn("inner", F.col("inner").isNotNull())
         .observe(seen, F.count_if("inner").alias("left")).write.partitionBy("inner").parquet(path))
        here, before, left = spark.read.schema(jumps.schema), left, seen.get["left"]
        if left < before:
            layers.append(here.parquet(f"{path}/inner=false"))
            jumps = here.parquet(f"{path}/inner=true") if left else spark.createDataFrame([], jumps.schema)
        if left > before * 3 // 4:
            break
    return layers, jumps


def dependency_levels(nodes: DataFrame, edges: DataFrame, max_rounds: int | None = None, ordered: bool = True,
                      small: int = 200_000) -> Levels:
    """Levels of nodes by their parents: layers taken off from behind, the rest peeled from the front.

    ``nodes``: node, ordinal (unique, the input order). ``edges``: child, parent, ordinal (unique).
    Chains are contracted first, so a round places whole chains, and as many rounds are needed as a path has chains.
    A round from the front joins the nodes placed last with all edges that are left, so it is kept for the rest: as long
    as a good part of the nodes has no child, these leave with their edges (``_layers``), down to ``small`` edges. Once
    the rest is placed the layers follow, the last one first, and each edge is joined once more.
    A round from the front writes the nodes that some placed parent has reached, ready or not; how many parents a node
    needs stands on its edges. Lineage stays one round long, and a lost executor costs one
    round. ``sort_key`` makes (level, sort_key) the order a first-in-first-out placement gives: the key of the parent
    placed last, then its edge's ordinal. Nodes of one chain have one key: at any level, two nodes differ by the edges
    where their paths part, and those lead to heads. ``ordered=False`` leaves the keys out, which grow with the levels.
    ``max_rounds`` bounds the chains of a path; with it all is peeled from the front.
    """
    spark = nodes.sparkSession
    links = materialize(usable_edges(nodes, edges), "edges")
    chains = _chains(links)
    root = scratch_path(spark, "levels")
    node_type, long = nodes.schema["node"].dataType, T.LongType()

    # edges between chains, from the last node of one to the head of another
    ends = links.join(chains.select(F.col("node").alias("child")), "child", "left_anti")
    lengths = materialize(chains.groupBy("head").agg(F.max("dist").alias("length")), "lengths")
    of_parent = chains.select(F.col("node").alias("parent"), F.col("head").alias("from"))
    edge = [F.col("ordinal").cast("bigint").alias("edge")] if ordered else []
    jumps = materialize(ends.join(of_parent, "parent", "left").select(
        F.col("child").alias("node"), F.coalesce("from", "parent").alias("from"), *edge), "jumps")
    numbered = nodes.select("node", F.col("ordinal").cast("bigint"))

    def with_length(rows: DataFrame) -> DataFrame:
        return rows.join(lengths.withColumnRenamed("head", "node"), "node", "left").withColumn(
            "length", F.coalesce("length", F.lit(0)).cast("bigint"))

    starts = with_length(numbered.join(jumps.select("node"), "node", "left_anti").join(chains.select("node"), "node", "left_anti"))
    if ordered:
        first = F.struct(F.lit(-1).cast("bigint").alias("level"), F.array().cast("array<bigint>").alias("sort_key"), F.col("ordinal").alias("edge"))
        last_type = T.StructType([T.StructField("level", long), T.StructField("sort_key", T.ArrayType(long)), T.StructField("edge", long)])
        level, last = F.col("last.level"), F.struct("above", "sort_key", "edge")
        key = [F.array_append("last.sort_key", F.col("last.edge")).alias("sort_key")]
    else:
        first, last_type, level, last, key = F.lit(-1).cast("bigint"), long, F.col("last"), F.col("above"), []
    schema = T.StructType([T.StructField("node", node_type), *[T.StructField(c, long) for c in ("need", "met", "length")],
                           T.StructField("last", last_type)])
    state = starts.select("node", F.lit(0).cast("bigint").alias("need"), F.lit(0).cast("bigint").alias("met"), "length", first.alias("last"))

    def reached(rows: DataFrame, placed: DataFrame, how: str = "inner") -> DataFrame:
        """Edges with the level of their parent chain's last node, and its key."""
        return rows.join(placed.select(F.col("node").alias("from"), (level + 1 + F.col("length")).alias("above"), *key), "from", how)

    layers, rest = _layers(jumps, small) if max_rounds is None else ([], jumps)
    rest = materialize(with_length(rest.join(rest.groupBy("node").agg(F.count(F.lit(1)).alias("need")), "node")), "rest")
    done = 0
    while True:
        seen = Observation()
        ready = F.col("met") == F.col("need")
        (state.withColumn("ready", ready).observe(seen, F.count_if(ready).alias("placed"))
         .write.partitionBy("ready").parquet(f"{root}/round={done}"))
        if not seen.get["placed"]:
            break
        if max_rounds is not None and done >= max_rounds:
            raise ValueError(f"dependency path longer than {max_rounds} chains")
        here = spark.read.schema(schema)
        hits = reached(rest, here.parquet(f"{root}/round={done}/ready=true")).select(
            "node", "need", F.lit(1).cast("bigint").alias("met"), "length", last.cast(last_type).alias("last"))
        waiting = f"{root}/round={done}/ready=false"
        if path_exists(spark, waiting):
            hits = hits.unionByName(here.parquet(waiting))
        state = hits.groupBy("node").agg(
            F.max("need").alias("need"), F.sum("met").alias("met"), F.max("length").alias("length"), F.max("last").alias("last"))
        done += 1

    placed = [f"{root}/round={i}/ready=true" for i in range(done)]
    for i, layer in enumerate(reversed(layers) if done else []):
        hits = reached(layer, spark.read.schema(schema).parquet(*placed), "left")
        found = hits.groupBy("node").agg(
            F.count(F.lit(1)).alias("need"), F.count("above").alias("met"), F.max(last.cast(last_type)).alias("last")).where("met = need")
        with_length(found).select(schema.names).write.parquet(f"{root}/layer={i}")
        placed.append(f"{root}/layer={i}")
    heads = spark.read.schema(schema).parquet(*placed) if placed else spark.createDataFrame([], schema)
    # only keys of heads with a chain behind them move once more
    columns = ["node", (F.col("start") + F.col("dist")).cast("int").alias("level"), *(["sort_key"] if ordered else [])]
    heads = heads.select("node", "length", (level + 1).alias("start"), *key, F.lit(0).cast("bigint").alias("dist"))
    behind = chains.join(heads.where("length > 0").drop("dist").withColumnRenamed("node", "head"), "head")
    found = heads.select(*columns).unionByName(behind.select(*columns))
    return Levels(found, materialize(numbered.join(found.select("node"), "node", "left_anti"), "cyclic"), numbered)


def _rings(links: DataFrame) -> DataFrame:
    """(id, component) of rings, whose nodes all have one parent and one child: pointers are doubled, the least id kept.
    Once a round lowers none, every stretch holds the least id of the next one, and so all around."""
    steps = materialize(links.select(F.col("child").alias("id"), F.col("parent").alias("far"), F.col("child").alias("component")), "rings")
    while True:
        seen = Observation()
        ahead = steps.select(F.col("id").alias("far"), F.col("far").alias("further"), F.col("component").alias("other"))
        steps = materialize(steps.join(ahead, "far").observe(seen, F.count_if(F.col("other") < F.col("component")).alias("changed")).select(
            "id", F.col("further").alias("far"), F.least("component", "other").alias("component")), "rings")
        if not seen.get["changed"]:
            return steps.select("id", "component")


def _components(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component, size) of the strongly connected parts of (child, parent) links, by colouring to both sides.

    Every node takes the greatest colour that leads to it and the greatest it leads to. Where both are one, the node
    belongs to the part of the node that gave the colour. Parts never lie across nodes with other colours, so links
    between these go and the rest starts again. Colours are hashes of the ids, which differ as ids do: a hash of one
    bigint can be undone. So the nodes that win are spread over the graph whatever its numbering, and
    a few repetitions do.
    """
    spark, found = ids.sparkSession, []
    own = F.xxhash64(F.col("id").cast("bigint"))
    sides = ("ahead", "behind")
    while not ids.isEmpty():
        colours = ids.select("id", own.alias("ahead"), own.alias("behind"))
        while True:
            seen = Observation()
            none = F.lit(None).cast("bigint")
            to_parent = links.join(colours, F.col("child") == F.col("id")).select(F.col("parent").alias("id"), "ahead", none.alias("behind"))
            to_child = links.join(colours, F.col("parent") == F.col("id")).select(F.col("child").alias("id"), none.alias("ahead"), "behind")
            sent = to_parent.unionByName(to_child).withColumns({f"own_{s}": none for s in sides})
            after = colours.withColumns({f"own_{s}": F.col(s) for s in sides}).unionByName(sent).groupBy("id").agg(
                *[F.max(c).alias(c) for c in (*sides, "own_ahead", "own_behind")])
            colours = materialize(after.observe(seen, F.count_if(F.expr("ahead > own_ahead OR behind > own_behind")).alias("changed"))
                                  .select("id", *sides), "colours")
            if not seen.get["changed"]:
                break
        found.append(colours.where("ahead = behind").select("id", F.col("ahead").alias("colour")))
        open_ones = colours.where("ahead <> behind")
        ids = open_ones.select("id")
        links = materialize(links.join(open_ones.withColumnsRenamed({"id": "child"}), "child").join(
            open_ones.withColumnsRenamed({"id": "parent"}), ["parent", *sides]).select("child", "parent"), "rest-links")
    if not found:
        return spark.createDataFrame([], "id bigint, component bigint, size bigint")
    whole = reduce(DataFrame.unionByName, found)
    sizes = whole.groupBy("colour").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("size"))
    return whole.join(sizes, "colour").select("id", "component", "size")


def cycles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) of every node that cannot be placed: ``component`` is the least ordinal among the nodes of its
    cycle (nodes that depend on each other), and NULL for a node that only hangs behind a cycle or between two.

    What no cycle follows is peeled off from behind, again by chains and frontiers. Chains of the rest are contracted,
    since a chain lies on a cycle as a whole or not at all; rings are found by pointer doubling and the
    remaining core by colouring, whose rounds grow with the number of chains of its longest path.
    """
    left = materialize(dependency_levels(nodes, edges, ordered=False).cyclic, "cyclic")
    links = materialize(usable_edges(left, edges), "cyclic-edges")
    core = materialize(dependency_levels(
        left, links.select(F.col("parent").alias("child"), F.col("child").alias("parent"), "ordinal"), ordered=False).cyclic, "core")
    numbered = {end: core.select(F.col("node").alias(end), F.col("ordinal").alias(f"{end}_id")) for end in ("child", "parent")}
    links = materialize(links.join(numbered["child"], "child").join(numbered["parent"], "parent").select(
        F.col("child_id").cast("bigint").alias("child"), F.col("parent_id").cast("bigint").alias("parent")), "core-links")
    chains = _chains(links)
    alone = links.join(links.groupBy("child").count().where("count = 1").select("child"), "child", "left_semi").join(
        links.groupBy("parent").count().where("count = 1").select("parent"), "parent", "left_semi")
    rings = _rings(alone.join(chains.select(F.col("node").alias("child")), "child", "left_anti"))
    rings = materialize(rings, "ring-parts")
    of_parent = chains.select(F.col("node").alias("parent"), "head")
    ends = materialize(
        links.join(chains.select(F.col("node").alias("child")), "child", "left_anti")
        .join(rings.select(F.col("id").alias("child")), "child", "left_anti").join(of_parent, "parent", "left")
        .select("child", F.coalesce("head", "parent").alias("parent")).distinct(), "core-ends")
    heads = core.select(F.col("ordinal").cast("bigint").alias("id")).join(chains.select(F.col("node").alias("id")), "id", "left_anti")
    heads = materialize(heads.join(rings, "id", "left_anti"), "core-heads")
    loops = ends.where("child = parent").select(F.col("child").alias("id"), F.lit(True).alias("loop"))
    parts = _components(heads, ends.where("child <> parent")).join(loops, "id", "left").where("size > 1 OR loop").select("id", "component")
    # a chain belongs to the component of its head, whose least ordinal may be one of the chain
    members = parts.unionByName(chains.join(parts, F.col("head") == F.col("id")).select(F.col("node").alias("id"), "component"))
    least = members.groupBy("component").agg(F.min("id").alias("least"))
    members = members.join(least, "component").select("id", F.col("least").alias("component")).unionByName(rings)
    return left.join(members, F.col("ordinal") == F.col("id"), "left").select("node", "component")


def topological_order(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, level, position): parents first, first in first out; nodes on or behind a cycle last,
    in input order and without a level."""
    found = dependency_levels(nodes, edges)
    late = found.cyclic.select(
        "node", F.lit(None).cast("int").alias("level"), F.lit(None).cast("array<bigint>").alias("sort_key"), "ordinal")
    # no two placed nodes of a level have one key, so their ordinals are not needed
    both = found.found.withColumn("ordinal", F.lit(None).cast("bigint")).unionByName(late).withColumn("late", F.col("level").isNull())
    return global_row_number(both, ["late", "level", "sort_key", "ordinal"]).select("node", "level", "position")
