"""Joins, aggregates, top-k and window queries over the relational star."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.functions.names import fold
from vitrine.operators.gold import (
    COMPANY, CONTRACT, LINK, PERSON, as_double, companies, contracts, links, money, persons, spread, tasks_of,
)
from vitrine.plans.registry import query
from vitrine.sources.shared import write_table


@query(f"""WITH {COMPANY} SELECT sector, count(*) AS companies, CAST(sum(contracte_ron) AS DOUBLE) AS contracts,
    CAST(sum(CAST(bal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM company GROUP BY sector""")
def summary_by_sector(t):
    """Companies and their contract totals by sector (AG-01)."""
    return companies(t).groupBy("sector").agg(
        F.count("*").alias("companies"),
        as_double(F.sum("contracte_ron")).alias("contracts"),
        as_double(F.sum(money("bal"))).alias("balance"),
    )


@query(f"""WITH {PERSON} SELECT p.judet, count(*) AS persons, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM person p JOIN customer ON id = c_custkey GROUP BY p.judet""")
def summary_by_county(t):
    """Persons by county (AG-02)."""
    return persons(t).join(t("customer"), F.col("id") == F.col("c_custkey")).groupBy("judet").agg(
        F.count("*").alias("persons"), as_double(F.sum(money("c_acctbal"))).alias("balance")
    )


@query(f"""WITH {COMPANY} SELECT judet AS authority, count(*) AS companies, CAST(sum(contracte_ron) AS DOUBLE) AS total
    FROM company GROUP BY judet ORDER BY companies DESC, authority LIMIT 60""")
def companies_per_authority(t):
    """Companies per tutelary authority, the 60 largest (AG-03)."""
    per = companies(t).groupBy(F.col("judet").alias("authority")).agg(
        F.count("*").alias("companies"), as_double(F.sum("contracte_ron")).alias("total")
    )
    return per.orderBy(F.col("companies").desc(), "authority").limit(60)


@query("""SELECT s_suppkey AS simbol, s_name AS nume, s_acctbal AS procent FROM supplier WHERE s_acctbal > 0""")
def state_holdings(t):
    """Holdings above zero (API-08, FLT-01)."""
    return t("supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("simbol"), F.col("s_name").alias("nume"), F.col("s_acctbal").alias("procent")
    )


@query(f"""WITH {COMPANY}, {PERSON}, {LINK} SELECT p.id, p.nume, count(DISTINCT c.cui) AS firme, CAST(sum(contracte_ron) AS DOUBLE) AS total
    FROM person p JOIN link l ON p.id = l.id JOIN company c ON l.cui = c.cui AND contracte_ron > 0
    GROUP BY p.id, p.nume ORDER BY total DESC, p.id LIMIT 100""")
def officials_contracts(t):
    """Persons at companies with contracts (JN-01, AG-04)."""
    n = tasks_of(t("lineitem"))
    # a row for each company and for each person, so that links, which are distinct, need no distinct count
    firms = companies(t).where("contracte_ron > 0").groupBy("cui").agg(F.sum("contracte_ron").alias("c"))
    known = persons(t).groupBy("id", "nume").agg(F.count("*").alias("times"))
    per = spread(spread(links(t), n, "cui").join(firms, "cui"), n, "id").groupBy("id").agg(F.count("*").alias("firme"), F.sum("c").alias("c"))
    per = per.join(known, "id").select("id", "nume", "firme", as_double(F.col("c") * F.col("times")).alias("total"))
    return per.orderBy(F.col("total").desc(), "id").limit(100)


@query(f"""WITH {COMPANY}, {PERSON}, {LINK} SELECT p.id, count(*) FILTER (WHERE contracte_nr > 500) AS mari, CAST(sum(contracte_ron) AS DOUBLE) AS total
    FROM person p JOIN link l ON p.id = l.id JOIN company c ON l.cui = c.cui
    GROUP BY p.id HAVING sum(contracte_ron) >= 50000000 ORDER BY total DESC, p.id LIMIT 200""")
def persons_min_contracts(t):
    """Persons whose companies' contracts reach a least total (JN-02, AG-06, AG-07, API-06)."""
    per = links(t).join(companies(t), "cui").join(persons(t).select("id"), "id").groupBy("id").agg(
        F.count_if(F.col("contracte_nr") > 500).alias("mari"), F.sum("contracte_ron").alias("sum")
    )
    per = per.where("sum >= 50000000").select("id", "mari", as_double(F.col("sum")).alias("total"))
    return per.orderBy(F.col("total").desc(), "id").limit(200)


@query(f"""WITH {LINK}, {PERSON}, multi AS (SELECT cui FROM link GROUP BY cui HAVING count(*) >= 2)
    SELECT l.cui, count(DISTINCT p.id) AS administratori,
           array_to_string(list_sort(list(DISTINCT p.nume))[1:6], ', ') AS nume
    FROM multi m JOIN link l ON m.cui = l.cui JOIN person p ON l.id = p.id GROUP BY l.cui""")
def co_administration(t):
    """Companies of two persons or more, with their first six names (JN-09, AG-05)."""
    pairs = links(t).join(persons(t).select("id", "nume"), "id")
    per = pairs.groupBy("cui").agg(F.count("*").alias("administratori")).where("administratori >= 2")
    # the rank is cut to six before the shuffle, so no company's names are gathered
    first = F.row_number().over(Window.partitionBy("cui").orderBy("nume"))
    names = pairs.select("cui", "nume").distinct().withColumn("rn", first).where("rn <= 6").groupBy("cui").agg(F.sort_array(F.collect_list("nume")).alias("n"))
    return per.join(names, "cui").select("cui", "administratori", F.array_join("n", ", ").alias("nume"))


@query(f"""WITH {COMPANY}, {LINK} SELECT l.id, l.cui, c.nume, coalesce(c.bal, 0) AS bal
    FROM link l LEFT JOIN (SELECT * FROM company WHERE bal > 5000) c ON l.cui = c.cui""")
def person_companies_left(t):
    """Companies of every person, unknown ones kept (JN-04, FLT-12, API-02)."""
    known = companies(t).where("bal > 5000").select("cui", "nume", "bal")
    return links(t).join(known, "cui", "left").select("id", "cui", "nume", F.coalesce("bal", F.lit(0.0)).alias("bal"))


@query("""SELECT p_brand AS comisie, p_type AS rol, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY n DESC, comisie, rol""")
def role_distribution(t):
    """Members by committee and role (AG-08, API-09)."""
    return t("part").groupBy(F.col("p_brand").alias("comisie"), F.col("p_type").alias("rol")).agg(F.count("*").alias("n"))


@query("""SELECT (SELECT count(*) FROM customer) AS persons, (SELECT count(*) FROM supplier) AS companies,
    (SELECT count(*) FROM orders) AS notices, (SELECT count(*) FROM lineitem) AS contracts,
    (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS suppliers, (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem) AS total,
    (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM pages) AS pages, (SELECT count(*) FROM events) AS events,
    (SELECT count(*) FROM part) AS parts, (SELECT count(DISTINCT o_custkey) FROM orders) AS authorities,
    (SELECT max(s_acctbal) FROM supplier) AS top_balance, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS parties""")
def global_stats(t):
    """Thirteen figures over all tables in one row (AG-09, API-10, SNK-14)."""
    parts = [
        t("customer").agg(F.count("*").alias("persons"), F.countDistinct("c_mktsegment").alias("parties")),
        t("supplier").agg(F.count("*").alias("companies"), F.max("s_acctbal").alias("top_balance")),
        t("orders").agg(F.count("*").alias("notices"), F.countDistinct("o_custkey").alias("authorities")),
        t("lineitem").agg(
            F.count("*").alias("contracts"),
            F.countDistinct("l_suppkey").alias("suppliers"),
            as_double(F.sum(money("l_extendedprice"))).alias("total"),
        ),
        *(t(n).agg(F.count("*").alias(a)) for n, a in (("documents", "documents"), ("pages", "pages"), ("events", "events"), ("part", "parts"))),
    ]
    out = parts[0].withColumn("one", F.lit(1))
    for part in parts[1:]:  # one-row tables on a constant key
        out = out.join(part.withColumn("one", F.lit(1)), "one")
    return out.drop("one")


@query("""SELECT c_custkey AS id, c_name AS nume FROM customer WHERE contains(strip_accents(lower(c_name)), '0001')
    ORDER BY c_custkey LIMIT 15""")
def search_person(t):
    """Accent-insensitive substring search with a clamped limit (FLT-03, TK-01, TK-02, API-01)."""
    hit = t("customer").where(F.contains(fold("c_name"), F.lit("0001")))
    return hit.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nume")).orderBy("id").limit(max(1, min(15, 100)))


@query(f"""WITH {COMPANY} SELECT cui, nume, judet, CAST(contracte_ron AS DOUBLE) AS contracte_ron FROM company
    WHERE contains(strip_accents(lower(nume)), 'supplier') AND sector = 'EUROPE' AND bal > 0
    ORDER BY contracte_ron DESC NULLS LAST, cui LIMIT 50""")
def search_company(t):
    """Company search with optional conditions chained (FLT-04, API-03)."""
    wanted = {"nume": "supplier", "sector": "EUROPE"}
    found = companies(t)
    if wanted.get("nume"):
        found = found.where(F.contains(fold("nume"), F.lit(wanted["nume"])))
    if wanted.get("sector"):
        found = found.where(F.col("sector") == wanted["sector"])
    found = found.where("bal > 0").select("cui", "nume", "judet", as_double(F.col("contracte_ron")).alias("contracte_ron"))
    return found.orderBy(F.col("contracte_ron").desc_nulls_last(), "cui").limit(50)


@query(f"""WITH {COMPANY} SELECT cui, nume, sector, CAST(contracte_ron AS DOUBLE) AS contracte_ron, contracte_nr FROM company
    WHERE contracte_ron > 0 ORDER BY contracte_ron DESC, cui LIMIT 20""")
def top_companies(t):
    """The companies with the largest contracts (API-04, TK-03, TK-08)."""
    top = companies(t).where("contracte_ron > 0").orderBy(F.col("contracte_ron").desc(), "cui").limit(20)
    return top.select("cui", "nume", "sector", as_double(F.col("contracte_ron")).alias("contracte_ron"), "contracte_nr")


@query("""WITH w AS (SELECT * FROM (VALUES (1,'lemon'),(2,'a'),(3,'e')) v(ord, word)), hit AS (
      SELECT p_partkey, p_name, word, row_number() OVER (PARTITION BY p_partkey ORDER BY ord) AS rn FROM part JOIN w ON contains(lower(p_name), word))
    SELECT p_partkey, p_name, word FROM hit WHERE rn = 1""")
def listed_name_match(t):
    """First listed word contained in a name (JN-11); the list is a fixed three-row table."""
    part = t("part").select("p_partkey", "p_name")
    words = part.sparkSession.createDataFrame([(1, "lemon"), (2, "a"), (3, "e")], "ord int, word string")
    hits = part.join(F.broadcast(words), F.contains(F.lower("p_name"), F.col("word")))
    first = Window.partitionBy("p_partkey").orderBy("ord")
    return hits.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("p_partkey", "p_name", "word")


@query("""WITH q AS (SELECT n_nationkey, lower(n_name) AS k FROM nation UNION ALL SELECT 100 + r_regionkey, lower(r_name) FROM region
      UNION ALL SELECT 200 + n_nationkey, lower(n_name) || ' state' FROM nation), o AS (SELECT n_nationkey AS ord, lower(n_name) AS name FROM nation),
    hit AS (SELECT q.n_nationkey AS qid, o.ord, row_number() OVER (PARTITION BY q.n_nationkey ORDER BY (q.k <> o.name), o.ord) AS rn
      FROM q JOIN o ON q.k = o.name OR contains(q.k, o.name) OR contains(o.name, q.k))
    SELECT qid, ord AS org FROM hit WHERE rn = 1""")
def org_name_resolve(t):
    """An organisation by its exact name, else by containment, the first in order (JN-12, SRC-32).

    Both sides are the 25 nations and 5 regions, so the containment join is bounded."""
    nation, region = t("nation"), t("region")
    asked = (
        nation.select(F.col("n_nationkey").alias("qid"), F.lower("n_name").alias("k"))
        .unionByName(region.select((F.col("r_regionkey") + 100).alias("qid"), F.lower("r_name").alias("k")))
        .unionByName(nation.select((F.col("n_nationkey") + 200).alias("qid"), F.concat(F.lower("n_name"), F.lit(" state")).alias("k")))
    )
    orgs = nation.select(F.col("n_nationkey").alias("ord"), F.lower("n_name").alias("name"))
    hit = asked.join(F.broadcast(orgs), F.contains(F.col("k"), F.col("name")) | F.contains(F.col("name"), F.col("k")))
    first = Window.partitionBy("qid").orderBy(F.col("k") != F.col("name"), "ord")
    return hit.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("qid", F.col("ord").alias("org"))


@query("""WITH b AS (SELECT o_custkey % 500 AS numar, CAST(year(o_orderdate) AS INT) AS an, max(o_orderkey) AS bill FROM orders GROUP BY 1, 2)
    SELECT p_partkey, numar, an, bill FROM part JOIN b ON p_partkey % 500 = numar AND 1992 + p_size % 7 = an""")
def composite_key_link(t):
    """Laws and bills on (number, year), the last bill of a key (JN-13)."""
    bills = t("orders").groupBy(
        (F.col("o_custkey") % 500).alias("numar"), F.year("o_orderdate").alias("an")
    ).agg(F.max("o_orderkey").alias("bill"))
    laws = t("part").select("p_partkey", (F.col("p_partkey") % 500).alias("numar"), (F.col("p_size") % 7 + 1992).alias("an"))
    return laws.join(bills, ["numar", "an"]).select("p_partkey", "numar", "an", "bill")


@query("""WITH v AS (SELECT c_nationkey AS k, CAST(year(o_orderdate) AS INT) AS an, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS venituri FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 20 GROUP BY 1, 2),
    c AS (SELECT s_nationkey AS k, CAST(year(l_shipdate) AS INT) AS an, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS cheltuieli FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey > 4 GROUP BY 1, 2)
    SELECT coalesce(v.k, c.k) AS cif, coalesce(v.an, c.an) AS an, CAST(venituri AS DOUBLE) AS venituri, CAST(cheltuieli AS DOUBLE) AS cheltuieli
    FROM v FULL JOIN c ON v.k = c.k AND v.an = c.an""")
def budget_full_outer(t):
    """Revenue against spending by key and year, either may be missing (JN-14, SO-04)."""
    revenue = (
        t("orders").join(t("customer").where("c_nationkey < 20"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("cif"), F.year("o_orderdate").alias("an")).agg(F.sum(money("o_totalprice")).alias("v"))
    )
    spending = (
        t("lineitem").join(t("supplier").where("s_nationkey > 4"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("cif"), F.year("l_shipdate").alias("an")).agg(F.sum(money("l_extendedprice")).alias("c"))
    )
    both = revenue.join(spending, ["cif", "an"], "full")
    return both.select("cif", "an", as_double(F.col("v")).alias("venituri"), as_double(F.col("c")).alias("cheltuieli"))


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1996-01-01')""")
def target_semi(t):
    """Persons with recent notices (JN-15)."""
    recent = t("orders").where(F.col("o_orderdate") >= "1996-01-01")
    return t("customer").join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1998-01-01')""")
def remaining_anti(t):
    """Work that remains: persons without a notice since a date (JN-17, SO-07)."""
    done = t("orders").where(F.col("o_orderdate") >= "1998-01-01")
    return t("customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""SELECT o_orderkey, c_custkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def code_translation(t):
    """Registration code to company to county (JN-16, JN-28, JN-31)."""
    people = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return t("orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "n_name")


@query(f"""WITH {CONTRACT}, pair AS (SELECT supplier, authority, sum(amount) AS total, count(*) AS nr FROM contract GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY total DESC, authority) AS rn FROM pair)
    SELECT supplier, authority, CAST(total AS DOUBLE) AS total, nr, CAST(rn AS INT) AS place FROM r WHERE rn <= 3""")
def supplier_top3_authorities(t):
    """The three best-paying authorities of every supplier (AG-12, WN-03)."""
    pair = contracts(t).groupBy("supplier", "authority").agg(F.sum("amount").alias("total"), F.count("*").alias("nr"))
    order = Window.partitionBy("supplier").orderBy(F.col("total").desc(), "authority")
    top = pair.withColumn("place", F.row_number().over(order)).where("place <= 3")
    return top.select("supplier", "authority", as_double(F.col("total")).alias("total"), "nr", "place")


@query(f"""WITH {CONTRACT}, last AS (SELECT notice, lot % 2 AS p, arg_max(amount, (lot, amount)) AS amount FROM contract GROUP BY 1, 2)
    SELECT CAST((SELECT sum(amount) FROM contract) AS DOUBLE) AS gross, CAST((SELECT sum(amount) FROM last) AS DOUBLE) AS real""")
def gross_vs_real_total(t):
    """Sum of all bidder lines against the last value per announcement and lot (AG-13)."""
    rows = contracts(t)
    last = rows.groupBy("notice", F.col("lot") % 2).agg(F.max_by("amount", F.struct("lot", "amount")).alias("last"), F.sum("amount").alias("all"))
    return last.agg(as_double(F.sum("all")).alias("gross"), as_double(F.sum("last")).alias("real"))


@query(f"""WITH {CONTRACT}, ok AS (SELECT * FROM contract WHERE amount > 0 AND amount <= 90000)
    SELECT supplier, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS nr,
      array_to_string(list_transform(list_sort(list(DISTINCT year(day))), lambda y: CAST(y AS VARCHAR)), ',') AS ani
    FROM ok GROUP BY supplier ORDER BY total DESC, supplier LIMIT 50000""")
def direct_purchase_rollup(t):
    """Direct purchases per supplier; amounts outside the bounds do not count at all (AG-14, FLT-06)."""
    ok = contracts(t).where("amount > 0 and amount <= 90000")
    years = F.array_join(F.transform(F.sort_array(F.collect_set(F.year("day"))), lambda y: y.cast("string")), ",")
    per = ok.groupBy("supplier").agg(F.sum("amount").alias("s"), F.count("*").alias("nr"), years.alias("ani"))
    return per.orderBy(F.col("s").desc(), "supplier").limit(50000).select("supplier", as_double(F.col("s")).alias("total"), "nr", "ani")


@query("""SELECT n_name AS judet, count(*) AS n, min(c_acctbal) AS minim, median(c_acctbal) AS median, max(c_acctbal) AS maxim
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def salary_stats(t):
    """Least, median and largest by county (AG-17)."""
    return t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("judet")).agg(
        F.count("*").alias("n"),
        F.min("c_acctbal").alias("minim"),
        F.median("c_acctbal").alias("median"),
        F.max("c_acctbal").alias("maxim"),
    )


@query("""SELECT cod, string_agg(an || ':' || suma, ',' ORDER BY an) AS pe_an, CAST(sum(s) AS DOUBLE) AS total FROM (
      SELECT c_mktsegment AS cod, CAST(year(o_orderdate) AS INT) AS an, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS suma
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) GROUP BY cod""")
def party_year_map(t):
    """Subsidies per party as a year map, shown as text (AG-19, AG-21, AG-35)."""
    per = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_mktsegment").alias("cod"), F.year("o_orderdate").alias("an")
    ).agg(F.sum(money("o_totalprice")).alias("s"))
    entry = F.struct("an", F.concat_ws(":", F.col("an").cast("string"), F.col("s").cast("string")).alias("x"))
    listed = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["x"])
    return per.groupBy("cod").agg(F.array_join(listed, ",").alias("pe_an"), as_double(F.sum("s")).alias("total"))


@query(f"""WITH {CONTRACT}, {LINK}, firm AS (SELECT supplier, sum(amount) AS total FROM contract GROUP BY 1)
    SELECT l.id, count(DISTINCT l.cui) AS firme, CAST(sum(total) AS DOUBLE) AS contracte,
      (SELECT CAST(sum(amount) AS DOUBLE) FROM contract c WHERE c.authority = l.id) AS directe
    FROM link l JOIN firm ON l.cui = supplier GROUP BY l.id""")
def person_rollup(t):
    """Totals per person: contracts once per company, direct purchases as they come (AG-22, AG-23)."""
    n = tasks_of(t("lineitem"))
    rows = contracts(t).select(F.col("authority").alias("id"), F.col("supplier").alias("cui"), "amount")
    pairs = write_table(spread(rows, n, "id").groupBy("id", "cui").agg(F.sum("amount").alias("d")), "person-firms")
    firms = pairs.groupBy("cui").agg(F.sum("d").alias("total"))
    direct = pairs.groupBy("id").agg(F.sum("d").alias("d"))
    met = spread(pairs.select("id", "cui"), n, "cui").join(firms, "cui")
    per = spread(met, n, "id").groupBy("id").agg(F.count("*").alias("firme"), F.sum("total").alias("c"))
    return per.join(direct, "id", "left").select("id", "firme", as_double(F.col("c")).alias("contracte"), as_double(F.col("d")).alias("directe"))


@query("""WITH src AS (SELECT s_suppkey AS cui, 1 AS seq, CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS nume, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS bal, false AS soe FROM supplier
      UNION ALL SELECT s_suppkey, 2, upper(s_name), NULL, s_nationkey % 5 = 0 FROM supplier WHERE s_suppkey % 4 <> 0
      UNION ALL SELECT s_suppkey, 3, 'x' || s_name, -s_acctbal, false FROM supplier)
    SELECT cui, arg_min(nume, seq) FILTER (WHERE nume IS NOT NULL) AS nume, arg_min(bal, seq) FILTER (WHERE bal IS NOT NULL) AS bal, bool_or(soe) AS soe FROM src GROUP BY cui""")
def company_upsert(t):
    """First non-null field per company over three partial sources in order (AG-34, SNK-05)."""
    s = t("supplier")
    none = F.lit(None).cast("double")
    parts = [
        s.select("s_suppkey", F.lit(1), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")), F.lit(False)),
        s.where("s_suppkey % 4 <> 0").select("s_suppkey", F.lit(2), F.upper("s_name"), none, F.col("s_nationkey") % 5 == 0),
        s.select("s_suppkey", F.lit(3), F.concat(F.lit("x"), "s_name"), -F.col("s_acctbal"), F.lit(False)),
    ]
    names = ["cui", "seq", "nume", "bal", "soe"]
    rows = parts[0].toDF(*names).unionByName(parts[1].toDF(*names)).unionByName(parts[2].toDF(*names))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
    return rows.groupBy("cui").agg(first("nume"), first("bal"), F.bool_or("soe").alias("soe"))


@query("""SELECT o_custkey AS id, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS notice, CAST(max(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1""")
def latest_declaration(t):
    """Latest notice per person, the smaller key on ties (WN-01, WN-05)."""
    order = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), "o_orderkey")
    last = t("orders").withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return last.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("notice"), F.col("o_orderdate").cast("date").alias("day"))


@query("""SELECT o_custkey AS id, count(*) AS n, CAST(arg_max(CAST(o_totalprice AS DECIMAL(18,2)), (o_orderdate, o_orderkey)) - arg_min(CAST(o_totalprice AS DECIMAL(18,2)), (o_orderdate, o_orderkey)) AS DOUBLE) AS delta
    FROM orders GROUP BY 1 HAVING count(*) >= 2""")
def wealth_delta(t):
    """Last minus first value of a person's declarations in time (WN-02, RL-18)."""
    when = F.struct("o_orderdate", "o_orderkey")
    worth = money("o_totalprice")
    per = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").alias("n"), as_double(F.max_by(worth, when) - F.min_by(worth, when)).alias("delta")
    )
    return per.where("n >= 2")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header
    FROM conversations""")
def carry_forward_header(t):
    """The last header row above each row (WN-07, SRC-10, SRC-20)."""
    head = F.when(F.col("role") == "user", F.md5("text"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return t("conversations").select("conv_id", "turn", F.last(head, ignorenulls=True).over(before).alias("header"))


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1""")
def json_props(t):
    """Values out of JSON properties (TX-17, SRC-01, SRC-03)."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k"))


@query("""WITH a AS (SELECT o_custkey % 50 AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1),
    b AS (SELECT o_custkey % 50 AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v, count(*) AS n FROM orders GROUP BY 1),
    j AS (SELECT coalesce(a.k, b.k) AS id, a.v AS v0, b.v AS v1, a.n AS n0, b.n AS n1 FROM a FULL JOIN b ON a.k = b.k)
    SELECT id, field, before, after, after - before AS delta FROM (
      SELECT id, 'valoare' AS field, CAST(v0 AS DOUBLE) AS before, CAST(v1 AS DOUBLE) AS after, v0 IS DISTINCT FROM v1 AS c FROM j
      UNION ALL SELECT id, 'numar', CAST(n0 AS DOUBLE), CAST(n1 AS DOUBLE), n0 IS DISTINCT FROM n1 FROM j) WHERE c""")
def changelog_diff(t):
    """Changed values between two snapshots, unpivoted (WN-11, RL-15, ST-F)."""

    def snapshot(df, suffix):
        return df.groupBy((F.col("o_custkey") % 50).alias("id")).agg(
            as_double(F.sum(money("o_totalprice"))).alias(f"v{suffix}"), F.count("*").cast("double").alias(f"n{suffix}")
        )

    orders = t("orders")
    both = snapshot(orders.where(F.col("o_orderdate") < "1997-01-01"), 0).join(snapshot(orders, 1), "id", "full")
    rows = both.selectExpr("id", "stack(2, 'valoare', v0, v1, 'numar', n0, n1) as (field, before, after)")
    return rows.where("not (before <=> after)").withColumn("delta", F.col("after") - F.col("before"))


@query("""SELECT CAST(n_nationkey * 10 + s AS BIGINT) AS id, n_name || '/' || service AS name FROM nation, (VALUES (0,'police'),(1,'health'),(2,'school')) v(s, service)""")
def template_cross(t):
    """Organisations from a template: services by counties, both fixed lists (SRC-25, JN-32)."""
    nation = t("nation")
    services = nation.sparkSession.createDataFrame([(0, "police"), (1, "health"), (2, "school")], "s int, service string")
    made = nation.crossJoin(F.broadcast(services))
    return made.select((F.col("n_nationkey") * 10 + F.col("s")).cast("long").alias("id"), F.concat_ws("/", "n_name", "service").alias("name"))


@query("""SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,4)))::DOUBLE AS total FROM events GROUP BY 1, 2""")
def hourly_events(t):
    """Tumbling one-hour windows over the event feed (an extension; the batch form of the stream)."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return t("events").groupBy(hour.alias("hour"), "event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total")
    )
