"""Bounded views of the graph of customers and parts: conditional expansion, whole components, a cap."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators.gold import money, spread, tasks_of
from vitrine.operators.subgraph import bounded_subgraph as bounded
from vitrine.operators.subgraph import expand
from vitrine.plans.registry import query
from vitrine.sources.shared import write_table

#: Nodes of the view, persons with the most contracts, companies with the most persons.
CAP, RICHEST, HUBS = 3000, 120, 50

_GRAPH = f"""edge AS (SELECT DISTINCT o_custkey AS person, l_partkey AS company FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    rich AS (SELECT DISTINCT l_partkey AS company FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity = 50),
    seed_person AS (SELECT c_custkey AS person FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0 UNION
      (SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
       ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, 1 LIMIT {RICHEST})),
    seed_company AS (SELECT company FROM (SELECT company, count(*) AS n FROM edge GROUP BY 1) LEFT JOIN (SELECT company, true AS r FROM rich) USING (company)
       WHERE n >= 2 ORDER BY n * CASE WHEN r THEN 2 ELSE 1 END DESC, company LIMIT {HUBS}),
    f1 AS (SELECT company, min(hop) AS hop FROM (SELECT company, 0 AS hop FROM seed_company UNION ALL SELECT company, 1 FROM edge JOIN seed_person USING (person)) GROUP BY 1),
    p1 AS (SELECT person, min(hop) AS hop FROM (SELECT person, 0 AS hop FROM seed_person UNION ALL SELECT person, 1 FROM edge JOIN f1 USING (company)) GROUP BY 1),
    f2 AS (SELECT company, 2 AS hop FROM edge JOIN p1 USING (person) WHERE company NOT IN (SELECT company FROM f1)
       GROUP BY 1 HAVING count(*) >= 2 OR company IN (SELECT company FROM rich)),
    p2 AS (SELECT DISTINCT person, 2 AS hop FROM edge JOIN f2 USING (company) WHERE person NOT IN (SELECT person FROM p1)),
    person_kept AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2), company_kept AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2)"""


def _graph(t):
    n = tasks_of(t("lineitem"))
    orders = spread(t("orders"), n, "o_orderkey")
    lines = spread(t("lineitem").select("l_orderkey", "l_partkey"), n, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    edges = spread(lines.select(F.col("o_custkey").alias("person"), F.col("l_partkey").alias("company")), n, "person").distinct()
    edges = write_table(edges, "view-edges")
    rich = t("lineitem").where("l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity = 50").select(F.col("l_partkey").alias("company")).distinct()
    paid = t("lineitem").groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("paid"))  # most lines of an order lie together
    total = paid.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("person")).agg(F.sum("paid").alias("total"))
    richest = total.orderBy(F.col("total").desc(), "person").limit(RICHEST).select("person")
    chosen = t("customer").where("c_mktsegment = 'BUILDING' AND c_acctbal < 0").select(F.col("c_custkey").alias("person"))
    hubs = edges.groupBy("company").agg(F.count("*").alias("n")).where("n >= 2").join(rich.withColumn("r", F.lit(2)), "company", "left")
    hubs = hubs.orderBy((F.col("n") * F.coalesce("r", F.lit(1))).desc(), "company").limit(HUBS).select("company")
    return edges, chosen.union(richest).distinct(), hubs, rich


@query(f"WITH {_GRAPH} SELECT 'person' AS kind, person AS id, hop FROM person_kept UNION ALL SELECT 'company', company, hop FROM company_kept")
def neighbour_expansion(t):
    """Persons and companies within two hops of the seeds; the second hop has a condition (JN-29)."""
    persons, companies = expand(*_graph(t))
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), F.col(name).alias("id"), "hop")
    return kind(persons, "person").unionAll(kind(companies, "company"))


@query(f"""WITH RECURSIVE {_GRAPH}, e AS (SELECT person * 2 AS a, company * 2 + 1 AS b FROM edge SEMI JOIN person_kept USING (person) SEMI JOIN company_kept USING (company)),
    s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    comp(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM s UNION
      (SELECT s.b, min(c.component) FROM comp c JOIN s ON s.a = c.node JOIN recurring.comp k ON k.node = s.b WHERE c.component < k.component GROUP BY s.b)),
    d AS (SELECT a AS node, count(*) AS degree FROM s GROUP BY 1), m AS (SELECT node, component, degree FROM comp JOIN d USING (node)),
    z AS (SELECT component, count(*) AS size FROM m GROUP BY 1),
    r AS (SELECT *, sum(size) OVER o AS upto, row_number() OVER o AS turn FROM z WINDOW o AS (ORDER BY size DESC, component)),
    chosen AS (SELECT node FROM m JOIN r USING (component) WHERE upto <= {CAP} UNION ALL
      (SELECT node FROM m JOIN r USING (component) WHERE turn = 1 AND size > {CAP} ORDER BY degree DESC, node LIMIT {CAP})),
    e2 AS (SELECT a, b FROM e WHERE a IN (SELECT node FROM chosen) AND b IN (SELECT node FROM chosen)),
    s2 AS (SELECT a, b FROM e2 UNION ALL SELECT b, a FROM e2),
    comp2(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM s2 UNION
      (SELECT s2.b, min(c.component) FROM comp2 c JOIN s2 ON s2.a = c.node JOIN recurring.comp2 k ON k.node = s2.b WHERE c.component < k.component GROUP BY s2.b)),
    n AS (SELECT component, row_number() OVER (ORDER BY count(*) DESC, component) - 1 AS cluster FROM comp2 GROUP BY 1)
    SELECT node, CASE WHEN node % 2 = 0 THEN 'person' ELSE 'company' END AS kind, node // 2 AS id, coalesce(p.hop, c.hop) AS hop, degree, cluster
    FROM comp2 JOIN n USING (component) JOIN (SELECT a AS node, count(*) AS degree FROM s2 GROUP BY 1) USING (node)
    LEFT JOIN person_kept p ON node = p.person * 2 LEFT JOIN company_kept c ON node = c.company * 2 + 1""")
def bounded_subgraph(t):
    """The bounded view: expansion, isolated nodes gone, whole components by size up to the cap (GR-09, TK-11)."""
    return bounded(*_graph(t), CAP, unique=True)[0]
