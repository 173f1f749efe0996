"""Customers against lists made of other tables: an entity stream, releases, an archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.text import capital_names
from vitrine.operators.watchlists import archive_summary, entities_of, flagged, patched, press_matches
from vitrine.plans.registry import query
from vitrine.sources import files, sinks
from vitrine.sources.shared import write_table

_LETTERS = ("0123456789", "aeioumnrst")
_SPELL = "translate(lpad(({0})::VARCHAR, {1}, '0'), '0123456789', 'aeioumnrst')"
#: Names of two or three words; three customers share one.
_NAME = "'" + "Pop' || " + _SPELL.format("{0} % 97", 2) + " || ' ' || 'Ion' || " + _SPELL.format("{0} // 3 % 991", 3) + " || CASE WHEN {0} // 3 % 4 = 0 THEN ' Maria' ELSE '' END"
_KEY = "array_to_string(list_sort(list_distinct(string_split(lower({0}), ' '))), ' ')"
_PERSON = f"""named AS (SELECT c_custkey AS person, c_acctbal AS weight, c_mktsegment = 'BUILDING' AS in_office, {_NAME.format("c_custkey")} AS name FROM customer),
    person AS (SELECT *, {_KEY.format("name")} AS key FROM named), best AS (SELECT * FROM person QUALIFY row_number() OVER (PARTITION BY key ORDER BY weight DESC, person) = 1)"""


def _name(c):
    spell = lambda n, width: F.translate(F.lpad(n.cast("string"), width, "0"), *_LETTERS)
    third = F.floor(c / 3)
    return F.concat(F.lit("Pop"), spell(c % 97, 2), F.lit(" Ion"), spell(third % 991, 3), F.when(third % 4 == 0, F.lit(" Maria")).otherwise(F.lit("")))


def _persons(t):
    name = _name(F.col("c_custkey"))
    key = F.array_join(F.array_sort(F.array_distinct(F.split(F.lower(name), " "))), " ")
    return t("customer").select(F.col("c_custkey").alias("person"), F.col("c_acctbal").alias("weight"), (F.col("c_mktsegment") == "BUILDING").alias("in_office"), name.alias("name"), key.alias("key"))


@query(f"""WITH {_PERSON}, e AS (SELECT o_orderkey AS k, {_NAME.format("o_custkey")} AS name FROM orders WHERE o_orderkey % 6 <> 5 AND o_orderkey % 7 IN (0, 1, 2) AND o_orderkey % 11 <> 0)
    SELECT 'e' || k AS id, ['Person', 'Company', 'Organization', 'LegalEntity', 'Person'][k % 6 + 1] AS schema, {_KEY.format("e.name")} AS key, best.person AS person,
      CASE WHEN k % 2 = 0 THEN ['sanction'] ELSE [] END AS topics FROM e LEFT JOIN best ON best.key = {_KEY.format("e.name")}""")
def sanction_flags(t):
    """A stream of entities filtered by schema and country, and who bears the name (ER-16, SRC-27)."""
    k = F.col("o_orderkey")
    schema = F.element_at(F.array(*map(F.lit, ("Person", "Company", "Organization", "LegalEntity", "Person", "Vessel"))), (k % 6 + 1).cast("int"))
    place = F.when(k % 7 == 0, F.map_from_arrays(F.array(F.lit("country")), F.array(F.array(F.lit("fr"), F.lit("RO")))))
    place = place.when(k % 7 == 1, F.map_from_arrays(F.array(F.lit("citizenship")), F.array(F.array(F.lit("România"))))).when(k % 7 == 2, F.map_from_arrays(F.array(F.lit("nationality")), F.array(F.array(F.lit("rou")))))
    place = place.otherwise(F.map_from_arrays(F.array(F.lit("country")), F.array(F.array(F.lit("md")))))
    name = F.when(k % 11 != 0, F.map_from_arrays(F.array(F.lit("name")), F.array(F.array(_name(F.col("o_custkey")), F.lit("Alias"))))).otherwise(F.map_from_arrays(F.array(F.lit("alias")), F.array(F.array(F.lit("x")))))
    topics = F.when(k % 2 == 0, F.map_from_arrays(F.array(F.lit("topics")), F.array(F.array(F.lit("sanction"))))).otherwise(F.map_from_arrays(F.array(F.lit("notes")), F.array(F.array(F.lit("x")))))
    lines = t("orders").select(F.to_json(F.struct(F.concat(F.lit("e"), k).alias("id"), schema.alias("schema"), F.map_concat(name, place, topics).alias("properties"))).alias("value"))
    path = sinks.write_lines(lines, "watchlist")
    stream = files.read_lines(t("orders").sparkSession, path, "id string, schema string, properties map<string, array<string>>")
    return flagged(entities_of(stream), _persons(t)).select("id", "schema", "key", "person", "topics")


@query(f"""WITH {_PERSON}, m AS (SELECT DISTINCT o_orderkey AS release, {_KEY.format(_NAME.format("o_custkey"))} AS key FROM orders WHERE o_orderkey % 3 = 0),
    h AS (SELECT m.release, best.* FROM m JOIN best USING (key)),
    r AS (SELECT key, list(release ORDER BY release) AS releases FROM (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY key ORDER BY release) <= 5) GROUP BY 1)
    SELECT person, key, count(*) AS n_releases, any_value(releases) AS releases, CASE WHEN len(string_split(key, ' ')) >= 3 OR in_office THEN 'high' ELSE 'med' END AS confidence
    FROM h JOIN r USING (key) GROUP BY person, key, in_office""")
def press_cross(t):
    """Names in capitals of releases and the persons who bear them (ER-17, ST-23)."""
    third = t("orders").where("o_orderkey % 3 = 0")  # the orders that are releases
    line = F.concat(F.lit("Comunicat: "), F.upper(_name(F.col("o_custkey"))), F.lit(", trimis de DNA în judecată."))
    mentions = third.select(F.col("o_orderkey").alias("release"), F.explode(capital_names(line)).alias("name"))
    return press_matches(mentions, _persons(t))


@query(f"""WITH {_PERSON}, a AS (SELECT {_KEY.format(_NAME.format("o_custkey"))} AS key, year(o_orderdate)::INT AS year, nullif(o_orderpriority, '5-LOW') AS role, o_orderstatus AS institution FROM orders),
    s AS (SELECT key, count(*) AS n, list_sort(list_distinct(list(year))) AS years, list_sort(list_distinct(list(role) FILTER (WHERE role IS NOT NULL)))[1:5] AS roles, list_sort(list_distinct(list(institution)))[1:5] AS institutions FROM a GROUP BY 1)
    SELECT person, coalesce(n, 0) AS n, coalesce(years, []) AS years, coalesce(roles, []) AS roles, coalesce(institutions, []) AS institutions FROM person LEFT JOIN s USING (key)""")
def archive_facts(t):
    """Every person with what an archive has under the name: number, years, roles, institutions (ER-18, AG-31)."""
    records = t("orders").select(
        _name(F.col("o_custkey")).alias("name"), F.year("o_orderdate").alias("year"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("role"), F.col("o_orderstatus").alias("institution")
    )
    found = patched(_persons(t), write_table(archive_summary(records), "archive"))
    empty = F.array().cast("array<string>")
    return found.select(
        "person", F.coalesce("archive.n", F.lit(0).cast("long")).alias("n"), F.coalesce("archive.years", F.array().cast("array<int>")).alias("years"),
        F.coalesce("archive.roles", empty).alias("roles"), F.coalesce("archive.institutions", empty).alias("institutions"),
    )
