"""Graph queries: chains of control, conflicts of interest, rings and their hubs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.operators.biconnected import cut_members
from vitrine.operators.gold import CONTRACT, LINK, as_double, companies, contracts, links, money, spread, tasks_of, tied
from vitrine.operators.graph import components, degrees, reach, shared_member_pairs
from vitrine.plans.registry import query
from vitrine.sources.shared import write_table

_EDGES = """edge AS (SELECT 'r' || r_regionkey AS src, 'n' || n_nationkey AS dst FROM region JOIN nation ON n_regionkey = r_regionkey
    UNION ALL SELECT 'n' || n_nationkey, 's' || s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey
    UNION ALL SELECT 's' || s_suppkey, 'n' || (s_nationkey + 1) % 25 FROM supplier)"""


def _ownership(t):
    """Owner -> owned, with cycles from companies back to counties."""
    nation, supplier = t("nation"), t("supplier")
    key = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    return (
        nation.select(key("r", F.col("n_regionkey")).alias("src"), key("n", F.col("n_nationkey")).alias("dst"))
        .unionAll(supplier.select(key("n", F.col("s_nationkey")), key("s", F.col("s_suppkey"))))
        .unionAll(supplier.select(key("s", F.col("s_suppkey")), key("n", (F.col("s_nationkey") + 1) % 25)))
    )


@query(f"""WITH RECURSIVE {_EDGES}, chain(node, depth) AS (SELECT 'r0', 0 UNION
    SELECT dst, depth + 1 FROM chain JOIN edge ON src = node WHERE depth < 6)
    SELECT node, CAST(min(depth) AS INT) AS depth FROM chain WHERE depth > 0 AND node <> 'r0' GROUP BY node""")
def control_chain(t):
    """Everything a root controls, at most six steps down, with the least depth (JN-07, GR-01, AG-10)."""
    edges = _ownership(t)
    root = edges.sparkSession.createDataFrame([("r0",)], "node string")
    return reach(edges, root, 6).where("depth > 0").select("node", "depth")


@query(f"""WITH RECURSIVE {LINK}, top AS (SELECT l_suppkey AS cui FROM lineitem GROUP BY 1 ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, 1 LIMIT 1),
    hop1 AS (SELECT DISTINCT b.cui FROM top JOIN link a ON a.cui = top.cui JOIN link b ON a.id = b.id),
    hop2 AS (SELECT DISTINCT b.cui FROM hop1 JOIN link a ON a.cui = hop1.cui JOIN link b ON a.id = b.id)
    SELECT cui FROM hop1 UNION SELECT cui FROM hop2 UNION SELECT cui FROM top""")
def k_hop_network(t):
    """Companies within two steps over shared persons from the largest supplier (JN-08, GR-04, SO-02, GR-14)."""
    n = tasks_of(t("lineitem"))
    top = write_table(companies(t).orderBy(F.col("contracte_ron").desc(), "cui").limit(1).select("cui"), "top-firm")
    # both directions of a step ask for one end only, so links are joined once, written as they come and never sent around twice
    pairs = write_table(tied(t), "links")
    found = top
    for _ in range(2):
        met = write_table(spread(pairs, n, "cui").join(found, "cui", "left_semi").select("id").distinct(), "hop-persons")
        found = write_table(spread(pairs, n, "id").join(met, "id", "left_semi").select("cui").distinct(), "hop-firms")
    return found.union(top).distinct()


_TYPED = f"""{LINK}, {CONTRACT}, typed AS (SELECT id AS src, cui AS dst, 'MEMBER_OF_BOARD' AS type FROM link
    UNION ALL SELECT DISTINCT o_custkey, o_custkey % 7, 'HOLDS_POSITION' FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT DISTINCT authority, supplier, 'AWARDED_CONTRACT' FROM contract WHERE flag = 'R')"""


def _typed(t):
    office = t("orders").where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct()
    awarded = contracts(t).where("flag = 'R'").select("authority", "supplier").distinct()
    return (
        links(t).select(F.col("id").alias("src"), F.col("cui").alias("dst"), F.lit("MEMBER_OF_BOARD").alias("type"))
        .unionAll(office.select("o_custkey", F.col("o_custkey") % 7, F.lit("HOLDS_POSITION")))
        .unionAll(awarded.select("authority", "supplier", F.lit("AWARDED_CONTRACT")))
    )


@query(f"""WITH {_TYPED} SELECT DISTINCT a.src AS person, a.dst AS company FROM typed a JOIN typed b ON a.src = b.src
    WHERE a.type IN ('MEMBER_OF_BOARD') AND b.type = 'HOLDS_POSITION'""")
def board_and_office(t):
    """Board members who hold public office (JN-05, GR-02, FLT-02, SO-01)."""
    edges = _typed(t)
    board = edges.where(F.col("type").isin("MEMBER_OF_BOARD")).select(F.col("src").alias("person"), F.col("dst").alias("company"))
    office = edges.where("type = 'HOLDS_POSITION'").select(F.col("src").alias("person"))
    return spread(board, tasks_of(t("lineitem")), "person").join(office, "person", "left_semi").distinct()


@query(f"""WITH {_TYPED} SELECT DISTINCT c.dst AS supplier, b.src AS person FROM typed c JOIN typed b ON c.dst = b.dst AND b.type = 'MEMBER_OF_BOARD'
    JOIN typed o ON o.src = b.src AND o.type = 'HOLDS_POSITION' WHERE c.type = 'AWARDED_CONTRACT'""")
def conflicted_suppliers(t):
    """Suppliers with contracts whose board member holds office (JN-06, GR-03)."""
    edges = _typed(t)
    awarded = edges.where("type = 'AWARDED_CONTRACT'").select(F.col("dst").alias("supplier")).distinct()
    board = edges.where("type = 'MEMBER_OF_BOARD'").select(F.col("dst").alias("supplier"), F.col("src").alias("person"))
    office = edges.where("type = 'HOLDS_POSITION'").select(F.col("src").alias("person")).distinct()
    n = tasks_of(t("lineitem"))
    held = spread(board, n, "person").join(office, "person", "left_semi")
    return spread(held, n, "supplier").join(awarded, "supplier", "left_semi").distinct()


@query(f"""WITH {LINK}, d AS (SELECT id FROM link GROUP BY 1 HAVING count(*) BETWEEN 2 AND 25), k AS (SELECT link.* FROM link JOIN d USING (id))
    SELECT x.cui AS a, y.cui AS b, count(*) AS shared FROM k x JOIN k y ON x.id = y.id AND x.cui < y.cui GROUP BY 1, 2""")
def shared_admin_edges(t):
    """Companies tied by shared persons of bounded degree (JN-23, GR-05)."""
    return shared_member_pairs(links(t), "cui", "id", 2, 25)


_BIPARTITE = """e AS (SELECT DISTINCT l_partkey * 2 AS a, l_orderkey * 2 + 1 AS b FROM lineitem),
    s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    comp(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM s UNION
      (SELECT s.b, min(c.component) FROM comp c JOIN s ON s.a = c.node JOIN recurring.comp k ON k.node = s.b WHERE c.component < k.component GROUP BY s.b))"""


def _bipartite(t):
    return t("lineitem").select((F.col("l_partkey") * 2).alias("a"), (F.col("l_orderkey") * 2 + 1).alias("b")).distinct()


@query(f"WITH RECURSIVE {_BIPARTITE} SELECT node, component FROM comp")
def connected_components(t):
    """Components of the part-order graph (ER-07, GR-06)."""
    return components(_bipartite(t), "rings").select("node", "component")


@query(f"""WITH RECURSIVE {_BIPARTITE} SELECT component, count(*) FILTER (WHERE node % 2 = 0) AS firms, count(*) FILTER (WHERE node % 2 = 1) AS admins
    FROM comp GROUP BY 1 HAVING count(*) >= 4""")
def ring_summary(t):
    """Rings of four members or more (AG-24, GR-15)."""
    labels = components(_bipartite(t), "rings")
    per = labels.groupBy("component").agg(F.count_if(F.col("node") % 2 == 0).alias("firms"), F.count_if(F.col("node") % 2 == 1).alias("admins"))
    return per.where("firms + admins >= 4")


@query(f"""WITH RECURSIVE {_BIPARTITE}, z AS (SELECT component, count(*) AS size FROM comp GROUP BY 1)
    SELECT component, size, CAST(row_number() OVER (ORDER BY size DESC, component) AS INT) AS number FROM z ORDER BY number LIMIT 100""")
def component_numbering(t):
    """The hundred largest components numbered by size (WN-10)."""
    size = components(_bipartite(t), "rings").groupBy("component").agg(F.count("*").alias("size"))
    top = size.orderBy(F.col("size").desc(), "component").limit(100)
    return top.withColumn("number", F.row_number().over(Window.orderBy(F.col("size").desc(), "component")))


@query(f"""WITH {LINK}, f AS (SELECT l_suppkey AS cui, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1)
    SELECT id, count(*) AS firms, CAST(sum(total) AS DOUBLE) AS money FROM link JOIN f USING (cui) GROUP BY 1 HAVING count(*) >= 3 ORDER BY firms DESC, money DESC, id LIMIT 200""")
def hubs(t):
    """Persons at three companies or more (AG-25, GR-07)."""
    firms = companies(t).select("cui", "contracte_ron")
    per = links(t).join(firms, "cui").groupBy("id").agg(F.count("*").alias("firms"), as_double(F.sum("contracte_ron")).alias("money"))
    return per.where("firms >= 3").orderBy(F.col("firms").desc(), F.col("money").desc(), "id").limit(200)


@query(f"WITH {LINK}, n AS (SELECT 'p' || id AS node FROM link UNION ALL SELECT 'c' || cui FROM link) SELECT node, count(*) AS degree FROM n GROUP BY 1")
def node_degrees(t):
    """Degree of every person and company (AG-26, GR-11)."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return degrees(links(t).select(key("p", "id").alias("a"), key("c", "cui").alias("b")))


@query()
def bridge_firms(t):
    """Firms of the part-order graph whose loss splits their ring, with degree and money (GR-08).

    Of the cut vertices those that are parts stay, if they have money or two orders or more."""
    lines = t("lineitem")
    cut = cut_members(lines.select(F.col("l_partkey").alias("member"), F.col("l_orderkey").alias("group"))).withColumnRenamed("member", "firm")
    total = lines.groupBy(F.col("l_partkey").alias("firm")).agg(F.sum(money("l_extendedprice")).alias("total"))
    found = cut.join(total, "firm").where("total > 0 OR degree >= 2")
    return found.select("firm", "blocks", "degree", as_double(F.col("total")).alias("money"))
