"""Typed edges with properties, the whole graph as published files, neighbours and inverted indexes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.graph import degrees
from vitrine.sources.shared import shared_dir


def typed(rows: DataFrame, kind: str, src: Column, dst: Column, **properties: Column) -> DataFrame:
    """Edges (src, dst, type, props) of one kind; props is a JSON object without its null values, edges without an end are left out."""
    props = F.to_json(F.struct(*[c.alias(k) for k, c in properties.items()])) if properties else F.lit("{}")
    edges = rows.select(src.cast("string").alias("src"), dst.cast("string").alias("dst"), F.lit(kind).alias("type"), props.alias("props"))
    return edges.where("src IS NOT NULL AND dst IS NOT NULL")


def one_each(edges: list[DataFrame]) -> DataFrame:
    """The edges of all kinds, one for each (src, dst, type); of several the least properties stay, so that reruns agree."""
    return reduce(DataFrame.unionByName, edges).groupBy("src", "dst", "type").agg(F.min("props").alias("props"))


def controls(firms: DataFrame, organisations: DataFrame, state: str) -> DataFrame:
    """CONTROLS edges to ``firms`` (firm, authority, made: the id made of the authority's name): from the organisation (name, org) of that name, else
    from an id made of the name, else from the state itself where no authority is named."""
    known = organisations.groupBy(F.col("name").alias("authority")).agg(F.min("org").alias("org"))
    found = firms.join(known, "authority", "left")
    source = F.coalesce("org", F.when(F.col("authority").isNotNull(), F.col("made")), F.lit(state))
    return typed(found, "CONTROLS", source, F.col("firm"), authority=F.col("authority"))


def neighbours(edges: DataFrame, nodes: DataFrame, hidden: tuple[str, ...] = ()) -> DataFrame:
    """(node, neighbour, type): what stands next to each of ``nodes`` (node), on either side, but for edges of a ``hidden`` type."""
    shown = edges.where(~F.col("type").isin(*hidden)) if hidden else edges
    both = shown.select(F.col("src").alias("node"), F.col("dst").alias("neighbour"), "type").unionAll(shown.select("dst", "src", "type"))
    return both.join(nodes.select("node").distinct(), "node", "left_semi").distinct()


def inverted(rows: DataFrame, key: str, item: str, most: int = 50) -> DataFrame:
    """(key, n, items): for each key the number of its distinct items and the first ``most`` of them; ranked before they are gathered."""
    pairs = rows.select(key, item).where(F.col(key).isNotNull() & F.col(item).isNotNull()).distinct()
    first = F.row_number().over(Window.partitionBy(key).orderBy(item))
    top = pairs.withColumn("rn", first).where(F.col("rn") <= most).groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return pairs.groupBy(key).agg(F.count("*").alias("n")).join(top, key)


def publish(nodes: DataFrame, edges: DataFrame, tag: str = "graph") -> str:
    """The whole graph as JSON lines: ``nodes`` (id, label, kind, ...) with their degree, ``links`` whose ends are both nodes, and a ``summary`` of
    one document. Returns the folder; every part is written by its tasks, so the graph never stands in one document."""
    ids = nodes.select("id").distinct()
    kept = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    degree = degrees(kept.select(F.col("src").alias("a"), F.col("dst").alias("b"))).withColumnRenamed("node", "id")
    shown = nodes.join(degree, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0).cast("long")))
    folder = shared_dir(nodes.sparkSession, tag)
    shown.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{folder}/nodes")
    kept.select(F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), "type")).alias("value")).write.text(f"{folder}/links")
    kinds = shown.groupBy("kind").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("kinds"))
    counted = kinds.crossJoin(kept.agg(F.count("*").alias("n_links")))  # one row each
    counted.select(F.to_json(F.struct("n_links", "kinds")).alias("value")).write.text(f"{folder}/summary")
    return folder
