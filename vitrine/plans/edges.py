"""The graph of regions, counties, suppliers and customers with all kinds of edges, published and asked."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.names import make_id
from vitrine.operators import edges as op
from vitrine.operators.gold import contracts, money
from vitrine.plans.registry import query
from vitrine.sources import files
from vitrine.sources.shared import write_table

_MADE = "'o:' || substr(sha256(n_name), 1, 16)"
_ALL = f"""sub AS (SELECT 'n' || n_nationkey AS src, 'r' || n_regionkey AS dst, 'SUBORDINATE_OF' AS type, '{{}}' AS props FROM nation),
    ctl AS (SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'state' WHEN n_nationkey % 2 = 0 THEN 'n' || n_nationkey ELSE {_MADE} END AS src, 's' || s_suppkey AS dst, 'CONTROLS' AS type,
      CASE WHEN s_suppkey % 7 = 0 THEN '{{}}' ELSE '{{"authority":"' || n_name || '"}}' END AS props FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    awd AS (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, 'AWARDED_CONTRACT' AS type, '{{"lines":' || count(*) || ',"total":' || sum(CAST(l_extendedprice AS DECIMAL(18,2))) || '}}' AS props
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
    pos AS (SELECT DISTINCT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst, 'HOLDS_POSITION' AS type, '{{"role":"' || c_mktsegment || '"}}' AS props FROM customer),
    rep AS (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, 'LEGAL_REP' AS type, min('{{"since":' || year(o_orderdate) || '}}') AS props FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
    edge AS (SELECT * FROM sub UNION ALL SELECT * FROM ctl UNION ALL SELECT * FROM awd UNION ALL SELECT * FROM pos UNION ALL SELECT * FROM rep)"""


def _key(prefix, column):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _edges(t):
    nation, rows = t("nation"), contracts(t)
    firms = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    authority = F.when(F.col("s_suppkey") % 7 != 0, F.col("n_name"))
    firms = firms.select(_key("s", "s_suppkey").alias("firm"), authority.alias("authority"), make_id("o", "n_name").alias("made"))
    organisations = nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), _key("n", "n_nationkey").alias("org"))
    awarded = rows.groupBy("authority", "supplier").agg(F.count("*").alias("lines"), F.sum("amount").alias("total"))
    lines = t("lineitem").join(t("orders").where("o_orderpriority = '1-URGENT'"), F.col("l_orderkey") == F.col("o_orderkey"))
    return op.one_each([
        op.typed(nation, "SUBORDINATE_OF", _key("n", "n_nationkey"), _key("r", "n_regionkey")),
        op.controls(firms, organisations, "state"),
        op.typed(awarded, "AWARDED_CONTRACT", _key("c", "authority"), _key("s", "supplier"), lines=F.col("lines"), total=F.col("total")),
        op.typed(t("customer"), "HOLDS_POSITION", _key("c", "c_custkey"), _key("n", "c_nationkey"), role=F.col("c_mktsegment")),
        op.typed(lines, "LEGAL_REP", _key("c", "o_custkey"), _key("s", "l_suppkey"), since=F.year("o_orderdate")),
    ])


@query(f"WITH {_ALL} SELECT * FROM edge")
def typed_edges(t):
    """All edges of five kinds with their properties (GR-12, ER-05, SNK-05)."""
    return _edges(t)


@query(f"""WITH {_ALL}, top AS (SELECT 's' || s_suppkey AS node FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20), shown AS (SELECT * FROM edge WHERE type <> 'AWARDED_CONTRACT')
    SELECT DISTINCT src AS node, dst AS neighbour, type FROM shown WHERE src IN (SELECT node FROM top) UNION SELECT dst, src, type FROM shown WHERE dst IN (SELECT node FROM top)""")
def shown_neighbours(t):
    """What stands next to the 20 suppliers of highest balance, contracts hidden (GR-13)."""
    top = t("supplier").orderBy(F.col("s_acctbal").desc(), "s_suppkey").limit(20).select(_key("s", "s_suppkey").alias("node"))
    return op.neighbours(_edges(t), top, ("AWARDED_CONTRACT",))


@query(f"""WITH {_ALL}, n AS (SELECT 'c' || c_custkey AS id, c_name AS label, 'person' AS kind FROM customer UNION ALL SELECT 's' || s_suppkey, s_name, 'company' FROM supplier),
    k AS (SELECT * FROM edge WHERE src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n)), d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM k UNION ALL SELECT dst FROM k) GROUP BY 1)
    SELECT id, label, kind, coalesce(degree, 0) AS degree, (SELECT count(*) FROM k) AS n_links, (SELECT count(*) FROM n) AS n_nodes FROM n LEFT JOIN d USING (id)""")
def published_graph(t):
    """The whole graph of persons and companies as JSON lines, read back with its summary (SNK-11, GR-11)."""
    nodes = t("customer").select(_key("c", "c_custkey").alias("id"), F.col("c_name").alias("label"), F.lit("person").alias("kind"))
    nodes = nodes.unionAll(t("supplier").select(_key("s", "s_suppkey"), "s_name", F.lit("company")))
    spark = nodes.sparkSession
    folder = op.publish(nodes, write_table(_edges(t), "edges"))
    links = files.read_lines(spark, f"{folder}/links", "source string, target string, type string").agg(F.count("target").alias("n_links"))
    summary = files.read_lines(spark, f"{folder}/summary", "n_links long, kinds map<string, long>")
    total = F.aggregate(F.map_values("kinds"), F.lit(0).cast("long"), lambda a, x: a + x)
    facts = summary.join(links, "n_links").select("n_links", total.alias("n_nodes"))  # one row
    return files.read_lines(spark, f"{folder}/nodes", "id string, label string, kind string, degree long").join(F.broadcast(facts))


@query("""WITH p AS (SELECT DISTINCT o_custkey AS member, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    r AS (SELECT *, row_number() OVER (PARTITION BY member ORDER BY item) AS rn FROM p)
    SELECT member, count(*) AS n, list(item ORDER BY item) FILTER (WHERE rn <= 50) AS items FROM r GROUP BY 1""")
def member_index(t):
    """For each customer the parts ordered, 50 shown at most (AG-32)."""
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("member"), F.col("l_partkey").alias("item"))
    return op.inverted(rows, "member", "item")


@query("""SELECT n_name AS authority, count(*) AS bids, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def totals_by_authority(t):
    """Contracts and their sum by authority, from the county of the buyer (AG-11)."""
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_name").alias("authority")).agg(F.count("*").alias("bids"), F.sum(money("o_totalprice")).cast("double").alias("total"))
