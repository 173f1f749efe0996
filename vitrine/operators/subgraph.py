"""A bounded part of a two-sided graph: conditional expansion from seeds, whole components up to a cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.graph import components
from vitrine.sources.shared import write_table


def expand(edges: DataFrame, persons: DataFrame, companies: DataFrame, rich: DataFrame, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Two hops over ``edges`` (person, company): kept persons (person, hop) and companies (company, hop).

    Hop 1 takes the companies of the seed persons and every person of those and of the seed companies. Hop 2 takes
    the companies of those persons that join ``least`` of them or more, or that are ``rich`` (company), and
    their persons. Neighbours are counted as distinct persons kept by hop 1, so the order of visits means nothing.
    """
    persons, companies = persons.select("person").distinct(), companies.select("company").distinct()
    zero = F.lit(0)
    own = edges.join(persons, "person", "left_semi").select("company").distinct()
    first = own.withColumn("hop", F.lit(1)).unionByName(companies.withColumn("hop", zero)).groupBy("company").agg(F.min("hop").alias("hop"))
    first = write_table(first, "hop1-companies")
    met = edges.join(first, "company", "left_semi").select("person").distinct()
    kept = met.withColumn("hop", F.lit(1)).unionByName(persons.withColumn("hop", zero)).groupBy("person").agg(F.min("hop").alias("hop"))
    kept = write_table(kept, "hop1-persons")
    # edges are distinct, so a count of rows counts persons, with a partial aggregate for hubs
    near = edges.join(kept, "person", "left_semi").groupBy("company").agg(F.count("*").alias("n"))
    near = near.join(rich.select("company").distinct().withColumn("rich", F.lit(True)), "company", "left")
    near = near.where((F.col("n") >= least) | F.col("rich")).select("company").join(first, "company", "left_anti")
    second = write_table(near.withColumn("hop", F.lit(2)), "hop2-companies")
    met = edges.join(second, "company", "left_semi").select("person").distinct().join(kept, "person", "left_anti")
    return kept.unionByName(met.withColumn("hop", F.lit(2))), first.unionByName(second)


def bounded_subgraph(
    edges: DataFrame, persons: DataFrame, companies: DataFrame, rich: DataFrame, cap: int, least: int = 2, unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The expansion of the seeds, at most ``cap`` nodes of it: nodes (node, kind, id, hop, degree, cluster), edges (a, b).

    ``unique`` says that ``edges`` is a written table without repeated rows.

    Nodes are 2 * person and 2 * company + 1. Nodes without a kept edge go. Whole components are taken, largest first,
    until the next does not fit (only the first cap / 2 can matter, as none has fewer than two nodes); if the largest
    alone is above the cap, its ``cap`` nodes of highest degree stay. Clusters are the components of what is
    left, numbered from 0 by size, then by smallest node.
    """
    if not unique:  # once, not for every join
        edges = write_table(edges.select("person", "company").distinct(), "subgraph-given")
    kept, firms = expand(edges, persons, companies, rich, least)
    inside = edges.join(kept, "person", "left_semi").join(firms, "company", "left_semi")
    inside = write_table(inside.select((F.col("person") * 2).alias("a"), (F.col("company") * 2 + 1).alias("b")), "subgraph")
    ends = inside.select(F.col("a").alias("node")).unionAll(inside.select(F.col("b").alias("node")))
    members = components(inside, "subgraph-rings").join(ends.groupBy("node").agg(F.count("*").alias("degree")), "node")
    members = write_table(members, "subgraph-members")
    sizes = members.groupBy("component").agg(F.count("*").alias("size")).orderBy(F.col("size").desc(), "component").limit(cap // 2 + 1)
    order = Window.orderBy(F.col("size").desc(), "component")  # cap / 2 + 1 rows at most
    sizes = sizes.withColumn("upto", F.sum("size").over(order)).withColumn("turn", F.row_number().over(order))
    whole = members.join(sizes.where(F.col("upto") <= cap), "component", "left_semi")
    above = members.join(sizes.where((F.col("turn") == 1) & (F.col("size") > cap)), "component", "left_semi")
    above = above.orderBy(F.col("degree").desc(), "node").limit(cap)
    chosen = write_table(whole.select("node").unionAll(above.select("node")), "subgraph-chosen")
    left = inside.join(chosen.select(F.col("node").alias("a")), "a", "left_semi").join(chosen.select(F.col("node").alias("b")), "b", "left_semi")
    left = write_table(left.select("a", "b"), "subgraph-edges")
    ends = left.select(F.col("a").alias("node")).unionAll(left.select(F.col("b").alias("node")))
    rings = components(left, "subgraph-clusters")  # of at most ``cap`` nodes
    number = F.row_number().over(Window.orderBy(F.col("size").desc(), "component")) - 1
    number = rings.groupBy("component").agg(F.count("*").alias("size")).select("component", number.alias("cluster"))
    hops = kept.select((F.col("person") * 2).alias("node"), "hop").unionAll(firms.select(F.col("company") * 2 + 1, "hop"))
    nodes = ends.groupBy("node").agg(F.count("*").alias("degree")).join(rings.join(number, "component"), "node").join(hops, "node")
    kind = F.when(F.col("node") % 2 == 0, "person").otherwise("company")
    return nodes.select("node", kind.alias("kind"), F.floor(F.col("node") / 2).alias("id"), "hop", "degree", "cluster"), left
