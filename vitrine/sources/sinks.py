"""Sinks: envelopes, entity streams, feeds, staging tables, snapshots and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.sources.shared import shared_dir


def envelope(items: DataFrame, most: int, order: list[Column], **meta: str) -> DataFrame:
    """One JSON document: ``meta``, ``total`` and the first ``most`` items in ``order``.

    The document is one row, so ``most`` bounds it; the total counts all items."""
    first = items.orderBy(*order).limit(most)
    place = Window.orderBy(*order)
    numbered = first.select(F.struct(F.row_number().over(place).alias("n"), F.struct("*").alias("item")).alias("x"))
    data = numbered.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["item"]).alias("data"))
    total = items.agg(F.count("*").alias("total"))
    head = F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in meta.items()), "total", "data"))
    return total.join(F.broadcast(data)).select(head.alias("value"))  # one row each


def write_lines(df: DataFrame, tag: str) -> str:
    """Write a single string column as text to a new shared folder; its path."""
    path = shared_dir(df.sparkSession, tag)
    df.write.text(path)
    return path


def entity(identifier: Column, schema: str, **properties: Column) -> Column:
    """A JSON entity: id, schema and properties, each a list; empty ones are left out."""
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in properties.items()))
    full = F.filter(pairs, lambda p: p["value"].isNotNull() & (p["value"] != ""))
    values = F.map_from_entries(F.transform(full, lambda p: F.struct(p["key"], F.array(p["value"]))))
    return F.to_json(F.struct(identifier.alias("id"), F.lit(schema).alias("schema"), values.alias("properties")))


def valid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (src, dst, ...) whose ends are both among ``nodes`` (id)."""
    ids = nodes.select("id").distinct()
    kept = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
    return kept.join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def xml_escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def atom_entry(identifier: Column, title: Column, summary: Column) -> Column:
    """One Atom entry, escaped."""
    return F.concat(
        F.lit("<entry><id>"), xml_escaped(identifier), F.lit("</id><title>"), xml_escaped(title),
        F.lit("</title><summary>"), xml_escaped(summary), F.lit("</summary></entry>"),
    )


def atom_document(items: DataFrame, most: int, order: list[Column], identifier: str, title: str, updated: str) -> DataFrame:
    """One Atom 1.0 document (column ``value``, one row) of the first ``most`` of ``items`` (id, title, summary) in ``order``.

    The document is one row, so ``most`` bounds it; without items it has none but is still a feed."""
    first = items.orderBy(*order).limit(most)
    numbered = first.select(F.struct(F.row_number().over(Window.orderBy(*order)).alias("n"), atom_entry(F.col("id"), F.col("title"), F.col("summary")).alias("e")).alias("x"))
    body = numbered.agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"]), "").alias("body"))
    head = F.lit('<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><id>')
    part = lambda text: xml_escaped(F.lit(text))
    return body.select(F.concat(head, part(identifier), F.lit("</id><title>"), part(title), F.lit("</title><updated>"), part(updated), F.lit("</updated>"), "body", F.lit("</feed>")).alias("value"))


def json_feed(items: DataFrame, most: int, order: list[Column], title: str, home: str) -> DataFrame:
    """One JSON Feed 1.1 document of the first ``most`` of ``items``, whose columns are the fields of an item."""
    return envelope(items, most, order, version="https://jsonfeed.org/version/1.1", title=title, home_page_url=home)


def stage(df: DataFrame, path: str) -> int:
    """Append rows to a staging table and count what was appended."""
    before = _count(df.sparkSession, path, df.schema)
    df.write.mode("append").parquet(path)
    return _count(df.sparkSession, path, df.schema) - before


def _count(spark: SparkSession, path: str, schema) -> int:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(path).count() if there else 0


def merged_snapshot(old: DataFrame, new: DataFrame, key: str, turn: str) -> DataFrame:
    """A registry flushed and loaded again: of every key the values of the latest ``turn``, a null
    value filled from the turn before it."""
    both = old.unionByName(new)
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(turn))).alias(c) for c in both.columns if c not in (key, turn)]
    return both.groupBy(key).agg(*latest, F.max(turn).alias(turn))


def finished_log(log: DataFrame, key: str, turn: str) -> DataFrame:
    """The last entry of each key of an append-only log."""
    rest = [c for c in log.columns if c != key]
    last = log.groupBy(key).agg(F.max(F.struct(turn, *(c for c in rest if c != turn))).alias("x"))
    return last.select(key, *(F.col(f"x.{c}").alias(c) for c in rest))
