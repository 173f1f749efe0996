"""Graph operators over edge tables: components, reach, projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.sources.shared import write_table


#: Rounds after which ``components`` raises; 3/4 of the nodes or fewer are expected to be left by a round.
MOST_ROUNDS = 400


def components(edges: DataFrame, tag: str, rounds: int = MOST_ROUNDS) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component = smallest node).

    Each round lets every node choose its first neighbour (a partial aggregate, so a hub costs no
    task more than its share), contracts the edges and drops loops; the chosen labels of all rounds
    are then followed from the last to the first, and the smallest node of each label names it. First
    is the smallest in the first round, which ends stars around their smallest node, and the least
    by a hash that is another in each later round, so that no order of the nodes makes long ways:
    rounds grow with the logarithm of the number of nodes. Every round is written to the shared
    folder. Edges that are left after ``rounds`` raise. Nodes without an edge have no row.
    """
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    live = write_table(edges.select(least, most).where("a <> b").distinct(), tag)
    maps: list[DataFrame] = []
    while not live.isEmpty():
        if len(maps) == rounds:
            raise RuntimeError(f"components ({tag}): edges are left after {rounds} rounds")
        turn = len(maps)
        rank = lambda c, turn=turn: F.xxhash64(F.lit(turn), c) if turn else F.col(c)
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        chosen = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", rank("b")).alias("m"))
        # only ever from a later to an earlier rank, so choices make no circle
        chosen = write_table(chosen.select("node", F.when(rank("m") < rank("node"), F.col("m")).otherwise(F.col("node")).alias("to")), tag)
        # a node may choose one that itself chooses an earlier: follow that once more
        hop = chosen.select(F.col("node").alias("to"), F.col("to").alias("to2"))
        chosen = write_table(chosen.join(hop, "to", "left").select("node", F.coalesce("to2", "to").alias("to")), tag)
        maps.append(chosen)
        left = chosen.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = chosen.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        moved = live.join(left, "a").join(right, "b").where("a2 <> b2")
        live = write_table(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), tag)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    last = maps[-1].select("node", F.col("to").alias("component"))
    for chosen in reversed(maps[:-1]):
        then = last.select(F.col("node").alias("to"), "component")
        last = chosen.join(then, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    if len(maps) == 1:  # by the smallest neighbour, and what a node chose is the smallest of all
        return last
    last = write_table(last, tag)
    names = last.groupBy("component").agg(F.min("node").alias("name"))
    return last.join(names, "component").select("node", F.col("name").alias("component"))


def reach(edges: DataFrame, roots: DataFrame, depth: int, tag: str = "reach") -> DataFrame:
    """(node, depth) of what can be reached from ``roots`` (node) along src -> dst, least depth first.

    Each level joins the frontier with the edges and leaves out what was seen; ``depth`` bounds the
    number of levels, so cycles end."""
    found = write_table(roots.select("node").distinct().withColumn("depth", F.lit(0)), tag)
    frontier = found
    for level in range(1, depth + 1):
        step = edges.join(frontier.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        frontier = write_table(step.join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(level)), tag)
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def shared_member_pairs(pairs: DataFrame, group: str, member: str, least: int, most: int) -> DataFrame:
    """(a, b, shared): groups that share members; members of fewer than ``least`` or more than
    ``most`` groups tie nothing, which also bounds the pairs a member can make."""
    degree = pairs.groupBy(member).agg(F.count("*").alias("deg")).where(F.col("deg").between(least, most)).select(member)
    kept = pairs.join(degree, member)
    a, b = kept.select(member, F.col(group).alias("a")), kept.select(member, F.col(group).alias("b"))
    return a.join(b, member).where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def degrees(edges: DataFrame) -> DataFrame:
    """Number of edges at every node of (a, b)."""
    ends = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node")))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))
