"""The second surface of questions, asked over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators.answers import any_holds, committee, grants, members_by_party, search, share_of
from vitrine.operators.gold import COMPANY, LINK, PERSON, as_double, companies, links, money, persons
from vitrine.plans.registry import query

_PER_PERSON = f"""{LINK}, {COMPANY}, {PERSON}, per AS (SELECT id, count(*) AS companies, sum(contracte_ron) AS total FROM link JOIN company USING (cui) GROUP BY 1)"""


@query(f"""WITH {_PER_PERSON} SELECT id, nume, camera, coalesce(companies, 0) AS companies, CAST(coalesce(total, 0) AS DOUBLE) AS total FROM person LEFT JOIN per USING (id)
    WHERE contains(lower(nume), '#00000001') ORDER BY id LIMIT 15""")
def answer_persons(t):
    """Persons by a part of the name, with their companies and the contracts of those (API-12, TK-10)."""
    # the few that are found first, so that only their links are added up
    found = search(persons(t), ["id"], 15, {"nume": "#00000001"})
    held = links(t).join(found.select("id"), "id").join(companies(t).select("cui", "contracte_ron"), "cui")
    per = held.groupBy("id").agg(F.count("*").alias("companies"), F.sum("contracte_ron").alias("total"))
    zero = F.lit(0)
    return found.join(per, "id", "left").select("id", "nume", "camera", F.coalesce("companies", zero).alias("companies"), as_double(F.coalesce("total", zero)).alias("total"))


@query(f"""WITH {COMPANY} SELECT cui, nume, sector, judet, bal, CAST(contracte_ron AS DOUBLE) AS contracts, contracte_nr AS n FROM company
    WHERE contains(lower(nume), 'supplier#') AND contains(lower(sector), 'a') AND bal > 5000 ORDER BY cui LIMIT 20""")
def answer_companies(t):
    """Companies by parts of name, sector and county, listed ones only, with what they have in contracts (API-14, JN-10)."""
    found = search(companies(t), ["cui"], 20, {"nume": "SUPPLIER#", "sector": "ă", "judet": ""}, F.col("bal") > 5000)
    return found.select("cui", "nume", "sector", "judet", "bal", as_double(F.col("contracte_ron")).alias("contracts"), F.col("contracte_nr").alias("n"))


@query(r"""WITH d AS (SELECT doc_id, doc_id % 20 + 2005 AS year, regexp_split_to_array(coalesce(text, ''), '[.\n]+')[1] AS title,
      regexp_split_to_array(trim(regexp_replace(coalesce(text, ''), '[ \t\r\n\f\v]+', ' ', 'g')), ' ')[1:6] AS words FROM documents)
    SELECT doc_id, year, substr(title, 1, 150) AS title FROM d WHERE year = 2010 AND (contains(strip_accents(lower(title)), 'ar')
      OR len(list_filter(words, lambda w: contains(strip_accents(lower(w)), 'ar'))) > 0) ORDER BY doc_id LIMIT 15""")
def answer_releases(t):
    """Releases of a year by a part of their title or of the names in them (API-19, FLT-10)."""
    text = F.coalesce("text", F.lit(""))
    words = F.slice(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), 1, 6)
    d = t("documents").select("doc_id", (F.col("doc_id") % 20 + 2005).alias("year"), F.get(F.split(text, r"[.\n]+"), F.lit(0)).alias("title"), F.transform(words, lambda w: F.struct(w.alias("name"))).alias("named"))
    hit = any_holds(F.array(F.struct(F.col("title").alias("name"))), "AR", "name") | any_holds(F.col("named"), "AR", "name")
    return search(d, ["doc_id"], 15, where=(F.col("year") == 2010) & hit).select("doc_id", "year", F.substring("title", 1, 150).alias("title"))


@query("""WITH paid AS (SELECT c_mktsegment AS party, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS paid FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 1000 GROUP BY 1),
    members AS (SELECT c_mktsegment AS party, count(*) FILTER (WHERE c_custkey % 3 = 0) AS deputies, count(*) FILTER (WHERE c_custkey % 3 = 1) AS senators FROM customer GROUP BY 1),
    reports AS (SELECT p_type AS party, count(*) AS reports FROM part GROUP BY 1)
    SELECT party, coalesce(paid, 0) AS paid, coalesce(deputies, 0) AS deputies, coalesce(senators, 0) AS senators, coalesce(reports, 0) AS reports
    FROM paid FULL JOIN members USING (party) FULL JOIN reports USING (party)""")
def answer_grants(t):
    """What parties were paid, their members in both chambers and their reports (API-18, API-07, AG-20)."""
    customer = t("customer").withColumn("party", F.col("c_mktsegment"))
    spent = t("orders").where("o_totalprice > 1000").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spent"))
    paid = spent.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("party").agg(as_double(F.sum("spent")).alias("paid"))
    sits = customer.withColumn("chamber", F.when(F.col("c_custkey") % 3 == 0, "d").when(F.col("c_custkey") % 3 == 1, "s"))
    members = members_by_party(sits, "party", "chamber", {"deputies": "d", "senators": "s"})
    reports = t("part").groupBy(F.col("p_type").alias("party")).agg(F.count("*").alias("reports"))
    return grants(paid, members, reports)


@query("""SELECT l_suppkey AS cui, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')), 0) AS DOUBLE) AS share
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def state_share(t):
    """What holders whose names match a pattern hold of every company (AG-29)."""
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    held = lines.select(F.col("l_suppkey").alias("cui"), F.col("c_mktsegment").alias("holder"), money("l_quantity").alias("part"))
    return share_of(held, "cui", "holder", "part", "machin|furnit").withColumn("share", as_double(F.col("share")))


@query("""WITH c AS (SELECT p_brand AS name, count(*) AS n FROM part GROUP BY 1), f AS (SELECT * FROM c WHERE contains(lower(name), 'brand#1') ORDER BY name LIMIT 1)
    SELECT name, n AS n_members, p_partkey AS member, p_type AS role FROM f JOIN part ON p_brand = name""")
def answer_committee(t):
    """The members of the first committee that a text names (API-20)."""
    found = committee(t("part").withColumnRenamed("p_brand", "name"), "BRAND#1")
    return found.select("name", "n_members", F.col("p_partkey").alias("member"), F.col("p_type").alias("role"))
