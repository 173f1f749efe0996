"""Queries that write the tables in the formats of the sources, read them back, and publish them."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.plans.registry import query
from vitrine.sources import files, sinks
from vitrine.sources.shared import shared_dir, write_table
from vitrine.streaming.lines import read_lines_stream


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, (SELECT count(*) FROM part WHERE p_partkey % 10 = 0) AS malformed FROM part")
def separated_text(t):
    """Text with a byte order mark, a separator to be found and rows of too many fields (SRC-04, SRC-05, SRC-06)."""
    part = t("part")
    path = _separated(part, "^", "\ufeff")
    rows = files.read_separated(part.sparkSession, path)
    bad = rows.where(F.col(files.BAD).isNotNull()).select("p_partkey", files.BAD).agg(F.count("p_partkey").alias("malformed"))
    return files.well_formed(rows).join(F.broadcast(bad))  # one row


def _separated(part, sep, mark="", path=None):
    """The parts as text files, each with a header line, every tenth row again with too many fields; added to ``path``, if given."""
    line = F.concat_ws(sep, "p_partkey", "p_name", "p_brand")
    tail = F.array(F.lit(""), F.when(F.col("p_partkey") % 10 == 0, F.lit(f"{sep}x{sep}y")))
    header = mark + sep.join(("p_partkey", "p_name", "p_brand"))
    lines = part.select(line.alias("line"), F.explode(F.array_compact(tail)).alias("tail")).select(F.concat("line", "tail").alias(header))
    path = path or shared_dir(part.sparkSession, "separated")
    # one column whose name is the header, neither quoted nor escaped
    lines.write.options(header="true", sep="\x01", quote="", escape="", emptyValue="").mode("append").csv(path)
    return path


@query("""SELECT count(*) FILTER (WHERE p_partkey % 3 <> 0) + 0 AS first_run, count(*) + 0 AS rows, count(*) FILTER (WHERE p_partkey % 10 = 0) AS malformed, sum(p_partkey)::BIGINT AS keys FROM part""")
def resumed_lines(t):
    """Separated text read as a stream that stops and goes on by byte offsets, malformed rows counted (SRC-07, ST-A)."""
    part = t("part")
    spark = part.sparkSession
    source, out, checkpoint = (shared_dir(spark, f"lines-{x}") for x in ("source", "rows", "checkpoint"))

    def run(rows) -> None:
        _separated(rows, "|", path=source)  # straight into the folder: read as text again, large files would be cut and small ones joined
        stream = read_lines_stream(spark, source)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()

    run(part.where("p_partkey % 3 <> 0"))
    first = spark.read.parquet(out).agg(F.count("p_partkey").alias("first_run")).first()[0]  # one number
    run(part.where("p_partkey % 3 = 0"))
    rows = spark.read.parquet(out)
    return rows.agg(
        F.lit(first).cast("long").alias("first_run"), F.count("p_partkey").alias("rows"), F.count(files.BAD).alias("malformed"), F.sum(F.col("p_partkey").cast("long")).alias("keys")
    )


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def ndjson_load(t):
    """A table as JSON lines and back (SRC-03, SNK-04)."""
    customer = t("customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = shared_dir(customer.sparkSession, "ndjson")
    customer.write.json(path)
    return files.read_lines(customer.sparkSession, path, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double")


def _documents(t):
    """One JSON document for each nation: its suppliers as a list, or keyed by name where the number is odd."""
    item = F.struct(F.col("s_suppkey").cast("string").alias("k"), F.col("s_name").alias("name"))
    found = t("supplier").groupBy("s_nationkey").agg(F.collect_list(item).alias("items"))
    keyed = F.to_json(F.map_from_entries(F.transform("items", lambda x: F.struct(x["name"], x))))
    return found.select("s_nationkey", F.when(F.col("s_nationkey") % 2 == 0, F.to_json("items")).otherwise(keyed).alias("doc"))


@query("SELECT s_nationkey, s_suppkey AS k, s_name AS name FROM supplier")
def list_or_object_rows(t):
    """Rows of JSON documents that are lists or objects (SRC-01, SRC-02, SRC-14)."""
    rows = _documents(t).select("s_nationkey", F.explode(files.list_or_values(F.col("doc"), "struct<k: string, name: string>")).alias("x"))
    return rows.select("s_nationkey", F.col("x.k").cast("long").alias("k"), "x.name")


@query("SELECT 0::BIGINT AS n")
def missing_document(t):
    """A JSON document that is not there has no rows (SRC-01)."""
    spark = t("nation").sparkSession
    return files.read_documents(spark, shared_dir(spark, "missing"), "a long").agg(F.count("*").alias("n"))


@query("SELECT n_regionkey, n_nationkey, n_name FROM nation")
def pivot_rows(t):
    """Rows of a response of parallel arrays (SRC-17)."""
    cols = t("nation").groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("x"))
    doc = cols.select("n_regionkey", F.to_json(F.struct(F.col("x.n_nationkey").alias("k"), F.col("x.n_name").alias("v"))).alias("doc"))
    read = doc.select("n_regionkey", F.from_json("doc", "k array<int>, v array<string>").alias("d")).select("n_regionkey", "d.k", "d.v")
    return read.select("n_regionkey", F.explode(files.zipped("k", "v")).alias("r")).select("n_regionkey", F.col("r.k").alias("n_nationkey"), F.col("r.v").alias("n_name"))


@query("""SELECT n_nationkey, substr(upper(n_name), 1, 3) AS currency, (n_nationkey + 0.5) / (CASE WHEN n_nationkey % 3 = 0 THEN 100.0 ELSE 1.0 END) AS rate
    FROM nation WHERE regexp_matches(substr(upper(n_name), 1, 3), '^[A-Z]{3}$')""")
def xml_rates(t):
    """Rates of an XML list with multipliers (SRC-12, NM-12)."""
    code = F.substring(F.upper("n_name"), 1, 3)
    times = F.when(F.col("n_nationkey") % 3 == 0, F.lit(' multiplier="100"')).otherwise(F.lit(""))
    xml = F.concat(F.lit('<Rate currency="'), code, F.lit('"'), times, F.lit(">"), (F.col("n_nationkey") + F.lit(0.5)).cast("string"), F.lit("</Rate>"))
    return t("nation").select("n_nationkey", F.inline(files.xml_rates(xml)))


@query("SELECT p_partkey, p_name || 'ăș' AS a, p_name || 'ă' AS b FROM part")
def mixed_encodings(t):
    """Bytes in UTF-8 or Latin-2 as text (SRC-23)."""
    utf = F.encode(F.concat("p_name", F.lit("ăș")), "UTF-8")
    latin = F.encode(F.concat("p_name", F.lit("ã")), "ISO-8859-1")  # the byte of ă in Latin-2
    return t("part").select("p_partkey", files.decoded(utf).alias("a"), files.decoded(latin).alias("b"))


@query("SELECT l_returnflag, 'flag=' || l_returnflag AS origin, count(*) AS n FROM lineitem GROUP BY 1, 2")
def files_by_folder(t):
    """Several globs as one table, with where each row comes from (SRC-31)."""
    items = t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_returnflag").alias("flag"))
    path = shared_dir(items.sparkSession, "globs")
    items.write.partitionBy("flag").json(path)
    read = files.read_globs(items.sparkSession, [f"{path}/flag=[AN]/*.json", f"{path}/flag=[!AN]/*.json"], "l_orderkey long, l_returnflag string")
    return read.groupBy("l_returnflag", "origin").agg(F.count("*").alias("n"))


@query("""SELECT count(DISTINCT text) AS blobs, count(DISTINCT doc_id || '|' || text) AS urls,
    count(DISTINCT doc_id || '|' || text) - count(DISTINCT text) AS saved FROM documents""")
def content_cache(t):
    """A cache that keeps each content once (SRC-30, SO-10)."""
    fetched = t("documents").where("text is not null").select(F.col("doc_id").cast("string").alias("url"), F.col("text").alias("content"))
    blobs, urls = files.content_cache(fetched)
    one = blobs.agg(F.count("*").alias("blobs")).join(F.broadcast(urls.agg(F.count("*").alias("urls"))))
    return one.select("blobs", "urls", (F.col("urls") - F.col("blobs")).alias("saved"))


@query("""SELECT 'contracts' AS source, (SELECT count(*) FROM orders) AS total, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n, o_orderkey
    FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 60""")
def envelope_export(t):
    """The first 60 of a table in a JSON envelope, written and read back (SNK-01, SNK-02, API-22)."""
    orders = t("orders").select("o_orderkey", "o_totalprice")
    path = sinks.write_lines(sinks.envelope(orders, 60, [F.desc("o_totalprice"), F.asc("o_orderkey")], source="contracts"), "envelope")
    back = files.read_documents(orders.sparkSession, path, "source string, total long, data array<struct<o_orderkey: long, o_totalprice: double>>")
    rows = back.select("source", "total", F.posexplode("data").alias("n", "x"))
    return rows.select("source", "total", (F.col("n") + 1).cast("long").alias("n"), "x.o_orderkey")


@query("""SELECT 'c' || c_custkey AS id, 'Company' AS schema, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 2 END AS n FROM customer
    UNION ALL SELECT 'e' || o_orderkey, 'Directorship', 2 FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 5 <> 0""")
def entity_stream(t):
    """Entities and valid edges as JSON lines, read back by schema (SNK-07, SRC-27, JN-27)."""
    customer = t("customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("id"), "c_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("sector"))
    nodes = customer.select("id").unionByName(t("region").select(F.lit("r0").alias("id")).limit(1))
    edges = t("orders").select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("src"), F.when(F.col("o_orderkey") % 5 != 0, F.lit("r0")).otherwise(F.lit("gone")).alias("dst"), "o_orderkey"
    )
    lines = customer.select(sinks.entity(F.col("id"), "Company", name=F.col("c_name"), sector=F.col("sector")).alias("value"))
    kept = sinks.valid_edges(edges, nodes)
    lines = lines.unionByName(kept.select(sinks.entity(F.concat(F.lit("e"), F.col("o_orderkey")), "Directorship", director=F.col("src"), organization=F.col("dst")).alias("value")))
    path = sinks.write_lines(lines, "entities")
    back = files.read_lines(customer.sparkSession, path, "id string, schema string, properties map<string, array<string>>")
    return back.select("id", "schema", F.size("properties").alias("n"))


@query("""SELECT '<entry><id>' || o_orderkey || '</id><title>A &amp; B &lt;' || o_orderpriority || '&gt;</title><summary>&quot;' || o_orderstatus || '&quot;</summary></entry>' AS entry
    FROM orders ORDER BY o_orderkey DESC LIMIT 60""")
def atom_feed(t):
    """Escaped feed entries of the latest 60 (SNK-08, SNK-09)."""
    latest = t("orders").orderBy(F.desc("o_orderkey")).limit(60)
    title = F.concat(F.lit("A & B <"), "o_orderpriority", F.lit(">"))
    return latest.select(sinks.atom_entry(F.col("o_orderkey").cast("string"), title, F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))).alias("entry"))


_ENTRY = """'<entry><id>' || o_orderkey || '</id><title>A &amp; B &lt;' || o_orderpriority || '&gt;</title><summary>&quot;' || o_orderstatus || '&quot;</summary></entry>'"""


@query(f"""SELECT '<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><id>urn:orders</id><title>Orders &amp; more</title><updated>2024-01-01T00:00:00Z</updated>'
    || string_agg({_ENTRY}, '' ORDER BY o_orderkey DESC) || '</feed>' AS value FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 60)""")
def atom_document(t):
    """The Atom document of the latest 60, written as a file and read back (SNK-09)."""
    orders = t("orders")
    items = orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("A & B <"), "o_orderpriority", F.lit(">")).alias("title"), F.concat(F.lit('"'), "o_orderstatus", F.lit('"')).alias("summary"))
    feed = sinks.atom_document(items, 60, [F.desc("o_orderkey")], "urn:orders", "Orders & more", "2024-01-01T00:00:00Z")
    return orders.sparkSession.read.option("wholetext", "true").text(sinks.write_lines(feed, "atom")).select(F.rtrim("value", F.lit("\n")).alias("value"))


@query("""SELECT 'https://jsonfeed.org/version/1.1' AS version, (SELECT count(*) FROM orders) AS total, row_number() OVER (ORDER BY o_orderkey DESC) AS n, o_orderkey::VARCHAR AS id, o_orderpriority AS title
    FROM orders ORDER BY o_orderkey DESC LIMIT 60""")
def feed_document(t):
    """The JSON Feed of the latest 60, written as a file and read back (SNK-08)."""
    orders = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"))
    feed = sinks.json_feed(orders, 60, [F.col("id").cast("long").desc()], "Orders", "https://example.org")
    back = files.read_documents(orders.sparkSession, sinks.write_lines(feed, "feed"), "version string, total long, data array<struct<id: string, title: string>>")
    return back.select("version", "total", F.posexplode("data").alias("n", "x")).select("version", "total", (F.col("n") + 1).cast("long").alias("n"), "x.id", "x.title")


@query("SELECT count(*) AS rows, 2 * count(*) AS staged FROM nation")
def staging_counts(t):
    """A staging table that is appended to twice (SNK-03)."""
    nation = t("nation")
    path = shared_dir(nation.sparkSession, "staging")
    first, second = sinks.stage(nation, path), sinks.stage(nation, path)
    return nation.agg(F.count("*").alias("rows")).select("rows", F.lit(first + second).cast("long").alias("staged"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new ' || c_name ELSE c_name END AS name, c_acctbal AS balance,
    CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS turn FROM customer""")
def registry_snapshot(t):
    """A registry flushed, loaded and merged with a later load (SNK-05, SNK-06, ER-03, ER-04)."""
    customer = t("customer")
    old = write_table(customer.select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit(1).alias("turn")), "registry")
    later = customer.where("c_custkey % 3 = 0")
    new = later.select("c_custkey", F.concat(F.lit("new "), "c_name").alias("name"), F.lit(None).cast("double").alias("balance"), F.lit(2).alias("turn"))
    return sinks.merged_snapshot(old, new, "c_custkey", "turn")


@query("SELECT event_type, count(*) AS n FROM (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1) GROUP BY 1")
def finished_log(t):
    """Counts by the last status of each key of a log (SNK-12)."""
    log = t("events").select("user_id", "event_id", "event_type")
    return sinks.finished_log(log, "user_id", "event_id").groupBy("event_type").agg(F.count("*").alias("n"))
