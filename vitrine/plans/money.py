"""Follow the money: persons whose companies have public contracts, and those who declared the company themselves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrine.functions.names import org_tokens
from vitrine.operators.gold import LINK, as_double, contract_totals, links
from vitrine.plans.registry import query
from vitrine.sources.shared import write_table

LEADS, CONFIRMED, SHOWN = 200, 100, 5
_LETTERS = ("0123456789", "aeioumnrst")
#: Every person declares some of the companies by name, between words that tell nothing.
_MONEY = f"""{LINK}, firm AS (SELECT l_suppkey AS cui, 'Societatea ' || translate(lpad(l_suppkey::VARCHAR, 6, '0'), '{_LETTERS[0]}', '{_LETTERS[1]}') || ' SRL' AS name,
      sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    held AS (SELECT id, cui, name, total, (id + cui) % 17 = 0 AS declared FROM link LEFT JOIN firm USING (cui)),
    per AS (SELECT id, count(*) AS companies, count(total) AS with_contracts, coalesce(sum(total), 0) AS total, count(total) FILTER (WHERE declared) AS confirmed,
      coalesce(sum(total) FILTER (WHERE declared), 0) AS confirmed_total FROM held GROUP BY 1)"""


def _firms(t):
    name = lambda c: F.concat(F.lit("Societatea "), F.translate(F.lpad(F.col(c).cast("string"), 6, "0"), *_LETTERS), F.lit(" SRL"))
    total = contract_totals(lambda n: t(n).where("l_returnflag = 'R'")).select(F.col("l_suppkey").alias("cui"), "total")
    return total.withColumn("name", name("cui")), name


def _held(t):
    """(id, cui, total, confirmed) of every person's companies: confirmed if the company has contracts and a telling word of its name is
    in the person's own declaration (ER-09)."""
    firms, name = _firms(t)
    pairs = write_table(links(t), "money-links")
    # words of the companies that a person names, one row a word: nothing is gathered per person
    declared = pairs.where((F.col("id") + F.col("cui")) % 17 == 0).withColumn("text", F.concat(F.lit("asociat la "), name("cui")))
    words = declared.select("id", F.explode(org_tokens("text")).alias("word")).distinct()
    own = firms.select("cui", F.explode(org_tokens("name")).alias("word"))
    hit = pairs.join(own, "cui").join(words, ["id", "word"]).select("id", "cui").distinct().withColumn("confirmed", F.lit(True))
    held = pairs.join(firms.select("cui", "total"), "cui", "left").join(hit, ["id", "cui"], "left")
    return held.withColumn("confirmed", F.coalesce("confirmed", F.lit(False)))


def _per_person(t):
    zero = F.lit(0).cast("decimal(28,2)")
    sure = F.when(F.col("confirmed"), F.col("total"))
    return _held(t).groupBy("id").agg(
        F.count("*").alias("companies"), F.count("total").alias("with_contracts"), F.coalesce(F.sum("total"), zero).alias("total"),
        F.count(sure).alias("confirmed"), F.coalesce(F.sum(sure), zero).alias("confirmed_total"),
    )


@query(f"WITH {_MONEY} SELECT id, companies, with_contracts, CAST(total AS DOUBLE) AS total FROM per WHERE with_contracts > 0 ORDER BY per.total DESC, id LIMIT {LEADS}")
def money_leads(t):
    """The 200 persons whose companies have most in contracts; leads, not findings (ER-10, API-05)."""
    found = _per_person(t).where("with_contracts > 0").orderBy(F.col("total").desc(), "id").limit(LEADS)
    return found.select("id", "companies", "with_contracts", as_double(F.col("total")).alias("total"))


@query(f"WITH {_MONEY} SELECT id, confirmed, CAST(confirmed_total AS DOUBLE) AS total FROM per WHERE confirmed > 0 ORDER BY per.confirmed_total DESC, id LIMIT {CONFIRMED}")
def money_confirmed(t):
    """The 100 persons with most in contracts of companies that they declared themselves (ER-09, ER-10, API-05)."""
    found = _per_person(t).where("confirmed > 0").orderBy(F.col("confirmed_total").desc(), "id").limit(CONFIRMED)
    return found.select("id", "confirmed", as_double(F.col("confirmed_total")).alias("total"))


@query(f"""WITH {_MONEY}, r AS (SELECT id, cui, coalesce(total, 0) AS total, row_number() OVER (PARTITION BY id ORDER BY coalesce(total, 0) DESC, cui) AS rn FROM held),
    top AS (SELECT id, list(cui || ':' || total ORDER BY rn) AS firms FROM r WHERE rn <= {SHOWN} GROUP BY 1)
    SELECT c_custkey AS id, c_name AS name, n_name AS county, coalesce(companies, 0) AS companies, CAST(coalesce(per.total, 0) AS DOUBLE) AS total, coalesce(firms, []) AS firms,
      CASE WHEN coalesce(confirmed, 0) > 0 THEN 'confirmed' WHEN coalesce(with_contracts, 0) > 0 THEN 'lead' ELSE 'none' END AS money
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN per ON per.id = c_custkey LEFT JOIN top ON top.id = c_custkey""")
def person_records(t):
    """The nested record of every person: place, companies with most contracts, what the money says (API-02, JN-31, ER-08)."""
    held = _held(t).withColumn("total", F.coalesce("total", F.lit(0)).cast("decimal(28,2)"))
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.col("total").desc(), "cui"))
    shown = F.struct("rn", F.concat_ws(":", F.col("cui").cast("string"), F.col("total").cast("string")).alias("firm"))
    top = held.withColumn("rn", first).where(F.col("rn") <= SHOWN).groupBy("id").agg(F.transform(F.array_sort(F.collect_list(shown)), lambda x: x["firm"]).alias("firms"))
    people = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("county"))
    zero = F.lit(0).cast("long")
    money = F.when(F.coalesce("confirmed", zero) > 0, "confirmed").when(F.coalesce("with_contracts", zero) > 0, "lead").otherwise("none")
    return people.join(_per_person(t), "id", "left").join(top, "id", "left").select(
        "id", "name", "county", F.coalesce("companies", zero).alias("companies"), as_double(F.coalesce("total", zero)).alias("total"),
        F.coalesce("firms", F.array().cast("array<string>")).alias("firms"), money.alias("money"),
    )
