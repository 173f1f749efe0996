"""Biconnected components and cut vertices by spanning forest, preorder and low values, as joins and aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.operators.graph import components
from vitrine.sources.shared import bucketed_table, write_table

#: Levels of the spanning forest after which ``spanning_forest`` raises.
MOST_LEVELS = 1000
#: Edges whose arcs one bucket holds.
BUCKET_ROWS = 1_000_000


def _buckets(spark: SparkSession, rows: int) -> int:
    # fewer than the session's partitions, and a join would deal the arcs anew
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // BUCKET_ROWS + 1)


def _roots(arcs: DataFrame) -> DataFrame:
    """(node): the smallest node of every component. The first round of ``components`` needs no shuffle of the arcs here."""
    least = write_table(arcs.groupBy("node").agg(F.min("other").alias("to")).withColumn("to", F.least("node", "to")), "forest-rings")
    hop = least.select(F.col("node").alias("to"), F.col("to").alias("name"))
    names = write_table(least.join(hop, "to").select("node", "name"), "forest-rings")
    half = arcs.where("node < other").join(names.hint("shuffle_hash"), "node").select(F.col("name").alias("a"), F.col("other").alias("node"))
    between = half.join(names.hint("shuffle_hash"), "node").select("a", F.col("name").alias("b")).where("a <> b").distinct()
    rings = components(write_table(between, "forest-rings"), "forest-rings").withColumnRenamed("node", "name")
    return names.select("name").distinct().join(rings, "name", "left").select(F.coalesce("component", "name").alias("node")).distinct()


def spanning_forest(arcs: DataFrame, most_levels: int = MOST_LEVELS) -> list[DataFrame]:
    """Breadth-first trees of ``arcs`` (node, other; both directions, in buckets by node): for each level a written table
    (node, parent), roots (parent null) first.

    Every component is rooted at its smallest node; of several possible parents the smallest is taken. A level joins the
    last one with the arcs, which stay in their buckets: each arc is sent once, by the level that its node is on. The
    number of joins is the greatest distance from a root.
    """
    roots = _roots(arcs)
    levels = [write_table(roots.withColumn("parent", F.lit(None).cast(roots.schema["node"].dataType)), "forest-level")]
    while True:
        if len(levels) > most_levels:
            raise RuntimeError(f"spanning_forest: nodes are left after {most_levels} levels")
        step = arcs.join(levels[-1].select("node").hint("shuffle_hash"), "node").groupBy(F.col("other").alias("new")).agg(F.min("node").alias("parent"))
        step = step.withColumnRenamed("new", "node")
        # a neighbour of this level is on it, on the one before, or new
        for seen in levels[-2:]:
            step = step.join(seen.select("node"), "node", "left_anti")
        step = write_table(step, "forest-level")
        if step.isEmpty():
            return levels
        levels.append(step)


def _up(levels: list[DataFrame], start: list[DataFrame], total: dict, join) -> list[DataFrame]:
    """From the deepest level to the roots: each level's rows joined with what its children add up to."""
    done = [start[-1]]
    for level, own in zip(reversed(levels[1:]), reversed(start[:-1]), strict=True):
        below = done[0].join(level, "node").groupBy(F.col("parent").alias("node")).agg(*[f.alias(f"below_{c}") for c, f in total.items()])
        done.insert(0, write_table(join(own.join(below, "node", "left")), "forest-up"))
    return done


def numbered_forest(levels: list[DataFrame]) -> list[DataFrame]:
    """(node, parent, pre, size, above) per level: preorder number, nodes of the subtree, the parent's number.

    Sizes go up the levels. A child's number is its parent's, plus one, plus the sizes of its earlier
    siblings; that sum is a difference of prefix sums over one range sort by (parent, node), so the children of a hub are
    spread over tasks. Numbers go down the levels.
    """
    one = [level.select("node", F.lit(1).cast("long").alias("size")) for level in levels]
    add = lambda df: df.select("node", (F.col("size") + F.coalesce("below_size", F.lit(0))).alias("size"))
    sizes = _up(levels, one, {"size": F.sum("size")}, add)
    both = [level.join(size, "node").withColumn("depth", F.lit(d)) for d, (level, size) in enumerate(zip(levels, sizes, strict=True))]
    everything = reduce(DataFrame.unionByName, both)
    n = int(everything.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("parent").asc_nulls_first(), F.col("node")]
    placed = write_table(everything.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "forest-placed")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    base = placed.groupBy("part").agg(F.sum("size").alias("all")).select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    local = F.sum("size").over(Window.partitionBy("part").orderBy(*order)) - F.col("size")
    placed = placed.withColumn("local", local).join(base, "part").select("node", "parent", "size", "depth", (F.col("base") + F.col("local")).alias("sum"))
    first = placed.groupBy("parent").agg(F.min("sum").alias("first"))
    placed = placed.join(first, placed["parent"].eqNullSafe(first["parent"])).drop(first["parent"])
    placed = write_table(placed.withColumn("offset", F.col("sum") - F.col("first")), "forest-offsets")
    done = [write_table(placed.where("depth = 0").select("node", "parent", F.col("offset").alias("pre"), "size", F.lit(None).cast("long").alias("above")), "forest-numbers")]
    for d in range(1, len(levels)):
        above = done[-1].select(F.col("node").alias("parent"), F.col("pre").alias("above"))
        down = placed.where(F.col("depth") == d).join(above, "parent")
        done.append(write_table(down.select("node", "parent", (F.col("above") + 1 + F.col("offset")).alias("pre"), "size", "above"), "forest-numbers"))
    return done


def _blocks(arcs: DataFrame, most_levels: int) -> DataFrame:
    """``biconnected`` of ``arcs`` (node, other; both directions, in buckets by node, repeated ones allowed)."""
    levels = spanning_forest(arcs, most_levels)
    numbers = numbered_forest(levels)
    tree = reduce(DataFrame.unionByName, numbers)
    # levels are breadth first, so an edge outside the tree never joins a node with one above it
    up = tree.select("node", "parent", F.col("pre").alias("to")).hint("shuffle_hash")
    sent = arcs.join(up, "node").where("parent IS NULL OR other <> parent").select(F.col("other").alias("node"), "to")
    met = sent.join(tree.select("node", "above").hint("shuffle_hash"), "node").where("above IS NULL OR above <> to")
    ends = write_table(met.groupBy("node").agg(F.min("to").alias("least"), F.max("to").alias("most")), "blocks-ends")
    reach = [
        n.join(ends, "node", "left").select("node", F.least("pre", "least").alias("low"), F.greatest("pre", "most").alias("high")) for n in numbers
    ]
    least = lambda df: df.select("node", F.least("low", "below_low").alias("low"), F.greatest("high", "below_high").alias("high"))
    reach = _up(levels, reach, {"low": F.min("low"), "high": F.max("high")}, least)
    # the edge above a node with the edge above its parent, which must have one
    above = tree.where("parent IS NOT NULL").select(F.col("node").alias("parent"), "pre", "size")
    leaving = reduce(DataFrame.unionByName, reach).join(tree.select("node", "parent"), "node").join(above, "parent")
    leaving = leaving.where("low < pre OR high >= pre + size").select(F.col("node").alias("a"), F.col("parent").alias("b"))
    # first along the tree, so that the edges outside it join few names
    along = components(leaving, "blocks-along").withColumnRenamed("component", "name")
    named = tree.select("node", "parent").join(along, "node", "left").withColumn("name", F.coalesce("name", "node"))
    named = write_table(named, "blocks-along")
    half = arcs.where("node < other").join(named.hint("shuffle_hash"), "node").where("parent IS NULL OR other <> parent")
    half = half.select(F.col("other").alias("node"), F.col("node").alias("from"), F.col("name").alias("a"))
    across = half.join(named.hint("shuffle_hash"), "node").where("parent IS NULL OR parent <> from").select("a", F.col("name").alias("b"))
    across = write_table(across.where("a <> b").distinct(), "blocks-across")
    blocks = components(across, "blocks").select(F.col("node").alias("name"), F.col("component").alias("block"))
    named = named.where("parent IS NOT NULL").join(blocks, "name", "left")
    return write_table(named.select("node", "parent", F.coalesce("block", "name").alias("block")), "blocks")


def biconnected(edges: DataFrame, most_levels: int = MOST_LEVELS) -> DataFrame:
    """(node, parent, block) of every node but the roots: the biconnected component of the tree edge above it.

    Two tree edges belong together if an edge outside the tree joins their unrelated lower ends, or, one below the
    other, if the lower one's subtree has an edge that leaves the subtree of their common node (Tarjan and Vishkin); the components of
    that relation are the blocks, each named by its smallest lower end. No component of the graph is one task's
    work; rounds grow with the depth of the forest.
    """
    edges = write_table(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "blocks-edges")
    arcs = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(edges.select("b", "a"))
    return _blocks(bucketed_table(arcs, "blocks-arcs", _buckets(edges.sparkSession, edges.count()), "node"), most_levels)


def _counted(block: DataFrame) -> DataFrame:
    """(node, blocks): in how many blocks each node is."""
    return block.select("node", "block").unionAll(block.select("parent", "block")).distinct().groupBy("node").agg(F.count("*").alias("blocks"))


def cut_vertices(edges: DataFrame, most_levels: int = MOST_LEVELS) -> DataFrame:
    """(node, blocks) of the nodes whose loss splits their component: those in two biconnected components or more."""
    return _counted(biconnected(edges, most_levels)).where("blocks >= 2")


def cut_members(pairs: DataFrame, most_levels: int = MOST_LEVELS) -> DataFrame:
    """(member, blocks, degree) of the members of ``pairs`` (member, group) whose loss splits their component of that
    bipartite graph; blocks as in ``cut_vertices`` of it, degree the number of groups.

    A group of three members or more stands for a ring through them and one of two for an edge: whichever member is lost, the others
    stay joined, as by their group. A group of one member is cut off with it, one block each. So groups are no nodes and the
    forest has half the depth. The rows of one group are sorted in one task, and so are a member's arcs.
    """
    n = _buckets(pairs.sparkSession, pairs.count())
    dealt = pairs.select("member", "group").dropna().repartition(n, "group").distinct()
    line = Window.partitionBy("group").orderBy("member")
    after, at = F.lead("member").over(line), F.row_number().over(line)
    ring = dealt.select("member", after.alias("after"), at.alias("at"), F.first("member").over(line).alias("first"))
    ring = ring.select("member", F.coalesce("after", F.when(F.col("at") >= 3, F.col("first"))).alias("to"), (F.col("after").isNull() & (F.col("at") == 1)).alias("lone"))
    own = F.struct(F.col("member").alias("node"), F.col("to").alias("other"), F.when(F.col("lone"), 2).otherwise(1).cast("byte").alias("kind"))
    back = F.struct(F.col("to").alias("node"), F.col("member").alias("other"), F.lit(0).cast("byte").alias("kind"))
    both = ring.select(F.inline(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, back))))
    arcs = bucketed_table(both, "members-arcs", n, "node")
    of = arcs.groupBy("node").agg(F.count_if(F.col("kind") > 0).alias("degree"), F.count_if(F.col("kind") == 2).alias("lone"))
    blocks = _counted(_blocks(arcs.where("other IS NOT NULL").select("node", "other"), most_levels))
    found = of.join(blocks.hint("shuffle_hash"), "node", "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)) + F.col("lone"))
    return found.where("blocks >= 2").select(F.col("node").alias("member"), "blocks", "degree")
