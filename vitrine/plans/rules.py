"""Alerts, red flags, anomalies and coverage reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.anomaly import ecod
from vitrine.operators.gold import COMPANY, CONTRACT, LINK, PERSON, as_double, companies, contracts, money, persons
from vitrine.plans.registry import query
from vitrine.sources.shared import write_table

# Severities and their scores.
SEVERITY = {"mare": 3, "medie": 2, "mica": 1}


def _alert(df: DataFrame, kind: str, severity: str, subject: str, value) -> DataFrame:
    return df.select(
        F.lit(kind).alias("tip"),
        F.lit(severity).alias("severitate"),
        F.lit(SEVERITY[severity]).alias("scor"),
        F.col(subject).cast("string").alias("entitate"),
        as_double(value).alias("valoare"),
    )


_ALERTS = f"""{COMPANY}, {PERSON}, {LINK}, {CONTRACT}, a AS (
    SELECT 'conflict_confirmat' AS tip, 'mare' AS severitate, 3 AS scor, CAST(l.id AS VARCHAR) AS entitate, CAST(sum(c.amount) AS DOUBLE) AS valoare
      FROM link l JOIN contract c ON c.authority = l.id AND c.supplier = l.cui GROUP BY l.id
    UNION ALL SELECT 'parlamentar_conduce_soe', 'medie', 2, CAST(p.id AS VARCHAR), CAST(max(k.contracte_ron) AS DOUBLE) FROM person p JOIN link l ON p.id = l.id JOIN company k ON k.cui = l.cui
      WHERE camera = 'BUILDING' AND k.judet < 'C' GROUP BY p.id
    UNION ALL SELECT 'soe_pierdere_contracte_mari', 'medie', 2, CAST(cui AS VARCHAR), CAST(contracte_ron AS DOUBLE) FROM company WHERE bal < 0 AND contracte_ron >= 5000000
    UNION ALL SELECT 'outlier_valoare_contract', 'mica', 1, CAST(cui AS VARCHAR), CAST(contracte_ron AS DOUBLE) FROM company WHERE contracte_nr > 0 AND contracte_ron >= 1000000 AND contracte_ron >= 38500 * contracte_nr
    UNION ALL SELECT 'concentrare_persoana', 'mica', 1, CAST(id AS VARCHAR), CAST(count(DISTINCT cui) AS DOUBLE) FROM link GROUP BY id HAVING count(DISTINCT cui) > 3
    UNION ALL SELECT 'partid_subventie_fara_parlamentari', 'medie', 2, cod, CAST(s AS DOUBLE) FROM (SELECT n_name AS cod, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS s, count(*) FILTER (WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000) AS d FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) WHERE s > 10000 AND d = 0
    UNION ALL SELECT 'firma_noua_bani_stat', 'medie', 2, CAST(supplier AS VARCHAR), CAST(sum(amount) AS DOUBLE) FROM contract GROUP BY supplier HAVING min(day) >= DATE '1992-01-10'
    UNION ALL SELECT 'firma_mama_straina', 'mica', 1, CAST(cui AS VARCHAR), CAST(contracte_ron AS DOUBLE) FROM company WHERE sector = 'EUROPE' AND contracte_ron > 0)"""


def _alerts(t) -> DataFrame:
    """All rules from one table of authority and supplier, written once."""
    rows = contracts(t).groupBy("authority", "supplier").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"), F.min("day").alias("day"))
    rows = write_table(rows, "alerts-star")
    total = rows.groupBy("supplier").agg(F.sum("amount").alias("contracte_ron"), F.sum("n").alias("contracte_nr"), F.min("day").alias("since"))
    total = write_table(total, "alerts-firms")
    known = (
        t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("cui"), F.col("s_acctbal").alias("bal"), F.col("n_name").alias("judet"), F.col("r_name").alias("sector"))
    )
    none = F.lit(0)
    firm = known.join(total.withColumnRenamed("supplier", "cui"), "cui", "left")
    firm = firm.withColumn("contracte_ron", F.coalesce("contracte_ron", none)).withColumn("contracte_nr", F.coalesce("contracte_nr", none))
    people, pairs = persons(t), rows.select(F.col("authority").alias("id"), F.col("supplier").alias("cui"))
    own = rows.groupBy(F.col("authority").alias("id")).agg(F.sum("amount").alias("v"))
    leads = (
        people.where("camera = 'BUILDING'").join(pairs, "id").join(firm.where("judet < 'C'").select("cui", "contracte_ron"), "cui")
        .groupBy("id").agg(F.max("contracte_ron").alias("v"))
    )
    loss = firm.where("bal < 0 and contracte_ron >= 5000000")
    outlier = firm.where("contracte_nr > 0 and contracte_ron >= 1000000 and contracte_ron >= 38500 * contracte_nr")
    many = pairs.groupBy("id").agg(F.count("*").alias("v")).where("v > 3")
    party = (
        t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name")
        .agg(F.sum(money("c_acctbal")).alias("s"), F.count_if((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000)).alias("d"))
        .where("s > 10000 and d = 0")
    )
    new = total.where(F.col("since") >= "1992-01-10").withColumnRenamed("contracte_ron", "v")
    foreign = firm.where("sector = 'EUROPE' and contracte_ron > 0")
    value = F.col("v")
    return reduce(
        DataFrame.unionByName,
        [
            _alert(own, "conflict_confirmat", "mare", "id", value),
            _alert(leads, "parlamentar_conduce_soe", "medie", "id", value),
            _alert(loss, "soe_pierdere_contracte_mari", "medie", "cui", F.col("contracte_ron")),
            _alert(outlier, "outlier_valoare_contract", "mica", "cui", F.col("contracte_ron")),
            _alert(many, "concentrare_persoana", "mica", "id", value),
            _alert(party, "partid_subventie_fara_parlamentari", "medie", "n_name", F.col("s")),
            _alert(new, "firma_noua_bani_stat", "medie", "supplier", value),
            _alert(foreign, "firma_mama_straina", "mica", "cui", F.col("contracte_ron")),
        ],
    )


@query(f"WITH {_ALERTS} SELECT tip, severitate, scor, entitate, valoare FROM a")
def alerts(t):
    """Eight deterministic rules in one list (RL-01 to RL-08, SO-03)."""
    return _alerts(t)


@query(f"WITH {_ALERTS} SELECT tip, severitate, count(*) AS n, max(valoare) AS top FROM a GROUP BY 1, 2")
def alert_counts(t):
    """Alerts by rule and severity (RL-09, AG-27, TK-09)."""
    return _alerts(t).groupBy("tip", "severitate").agg(F.count("*").alias("n"), F.max("valoare").alias("top"))


@query(f"WITH {CONTRACT} SELECT notice, lot, supplier, CAST(amount AS DOUBLE) AS amount FROM contract WHERE lot = 1 AND amount >= 80000")
def red_flags_single_bid(t):
    """Large contracts with a single bid (RL-10)."""
    return contracts(t).where("lot = 1 and amount >= 80000").select("notice", "lot", "supplier", as_double(F.col("amount")).alias("amount"))


@query(f"""WITH {CONTRACT} SELECT notice, lot, supplier, CAST(amount AS DOUBLE) AS amount FROM contract
    WHERE regexp_matches(lower(procedure), 'urgent|not specified') AND amount >= 50000 AND NOT (lot = 1 AND amount >= 80000)""")
def red_flags_noncompetitive(t):
    """Large contracts by a risky procedure that have no single bid (RL-11, TX-16, FLT-09)."""
    risky = contracts(t).where(F.lower("procedure").rlike("urgent|not specified") & (F.col("amount") >= 50000))
    return risky.where("not (lot = 1 and amount >= 80000)").select("notice", "lot", "supplier", as_double(F.col("amount")).alias("amount"))


@query(f"""WITH {CONTRACT} SELECT authority, supplier, count(*) AS nr, CAST(sum(amount) AS DOUBLE) AS total, count(DISTINCT year(day)) AS ani
    FROM contract GROUP BY 1, 2 HAVING count(*) >= 3 AND sum(amount) >= 100000""")
def fragmentation_pairs(t):
    """Authorities that buy from one supplier again and again (AG-15, RL-12)."""
    pair = contracts(t).groupBy("authority", "supplier").agg(
        F.count("*").alias("nr"), F.sum("amount").alias("s"), F.countDistinct(F.year("day")).alias("ani")
    )
    return pair.where("nr >= 3 and s >= 100000").select("authority", "supplier", "nr", as_double(F.col("s")).alias("total"), "ani")


@query(f"""WITH {CONTRACT}, {COMPANY}, f AS (SELECT supplier, min(day) AS since, sum(amount) AS total FROM contract GROUP BY 1)
    SELECT cui, concat_ws('+', CASE WHEN since >= DATE '1992-01-10' THEN 'nou' END, CASE WHEN cui % 10 = 0 THEN 'persoana fizica' END, CASE WHEN sector = 'EUROPE' THEN 'mama straina' END) AS flaguri
    FROM company JOIN f ON cui = supplier""")
def firm_flags(t):
    """Flags of a firm joined as text (RL-13, DT-11)."""
    since = contracts(t).groupBy(F.col("supplier").alias("cui")).agg(F.min("day").alias("since"))
    flags = F.concat_ws(
        "+",
        F.when(F.col("since") >= "1992-01-10", "nou"),
        F.when(F.col("cui") % 10 == 0, "persoana fizica"),
        F.when(F.col("sector") == "EUROPE", "mama straina"),
    )
    return companies(t).join(since, "cui").select("cui", flags.alias("flaguri"))


@query("""WITH d AS (SELECT DISTINCT x AS w FROM benchmark, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) u(x)),
    k AS (SELECT doc_id, lang, list_distinct(regexp_extract_all(lower(text), '[a-z]{4,}')) AS ws FROM documents),
    h AS (SELECT k.doc_id, count(*) AS hit FROM k, unnest(ws) u(x) JOIN d ON x = w GROUP BY 1)
    SELECT lang, count(*) AS docs, count(*) FILTER (WHERE len(ws) > 0 AND coalesce(hit, 0) >= greatest(1, len(ws) // 2)) AS covered FROM k LEFT JOIN h USING (doc_id) GROUP BY 1""")
def coverage_report(t):
    """Documents half of whose words a dictionary covers, by language (JN-22, RL-16, AG-28)."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), F.lit(0)))
    known = t("benchmark").select(F.explode(words("text")).alias("w")).distinct()
    docs = t("documents").select("doc_id", "lang", words("text").alias("ws"))
    hits = docs.select("doc_id", F.explode("ws").alias("w")).join(known, "w").groupBy("doc_id").agg(F.count("*").alias("hit"))
    rows = docs.select("doc_id", "lang", F.size("ws").alias("n")).join(hits, "doc_id", "left")
    covered = (F.col("n") > 0) & (F.coalesce("hit", F.lit(0)) >= F.greatest(F.lit(1), F.floor(F.col("n") / 2)))
    return rows.groupBy("lang").agg(F.count("*").alias("docs"), F.count_if(covered).alias("covered"))


@query("""WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS last FROM orders)
    SELECT o_orderpriority AS comisie, CAST(o_orderdate AS DATE) AS zi, count(*) AS n, array_to_string(list_transform(list_sort(list(DISTINCT o_custkey)), lambda x: CAST(x AS VARCHAR)), ',') AS plx
    FROM orders, m WHERE CAST(o_orderdate AS DATE) BETWEEN last - 60 AND last GROUP BY 1, 2""")
def recent_activity(t):
    """Sessions of the last sixty days, those of one committee and day merged (RL-17, FLT-07, AG-30, DT-10)."""
    orders = t("orders").withColumn("zi", F.col("o_orderdate").cast("date"))
    last = orders.agg(F.max("zi").alias("last")).withColumn("one", F.lit(1))
    recent = orders.withColumn("one", F.lit(1)).join(last, "one").where(F.col("zi").between(F.date_sub("last", 60), F.col("last")))
    bills = F.array_join(F.transform(F.sort_array(F.collect_set("o_custkey")), lambda x: x.cast("string")), ",")
    return recent.groupBy(F.col("o_orderpriority").alias("comisie"), "zi").agg(F.count("*").alias("n"), bills.alias("plx"))


@query("""WITH f AS (SELECT o_custkey AS id, CAST(count(*) AS DOUBLE) AS a, max(o_totalprice) AS b, min(o_totalprice) AS c FROM orders GROUP BY 1),
    s AS (SELECT (SELECT skewness(a) FROM f) AS sa, (SELECT skewness(b) FROM f) AS sb, (SELECT skewness(c) FROM f) AS sc),
    p AS (SELECT id, -ln(cume_dist() OVER (ORDER BY a)) AS la, -ln(cume_dist() OVER (ORDER BY a DESC)) AS ra, -ln(cume_dist() OVER (ORDER BY b)) AS lb, -ln(cume_dist() OVER (ORDER BY b DESC)) AS rb,
      -ln(cume_dist() OVER (ORDER BY c)) AS lc, -ln(cume_dist() OVER (ORDER BY c DESC)) AS rc FROM f)
    SELECT id, round(greatest(la, ra) + greatest(lb, rb) + greatest(lc, rc), 4) AS score FROM p""")
def wealth_anomaly(t):
    """ECOD outlier score of every person's declarations (RL-14, WN-08)."""
    per = t("orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").cast("double").alias("a"), F.max("o_totalprice").alias("b"), F.min("o_totalprice").alias("c")
    )
    return ecod(per, "id", ["a", "b", "c"]).select("id", F.round("score", 4).alias("score"))
