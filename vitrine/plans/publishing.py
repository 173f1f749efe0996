"""What is published: search index, entity stream, feeds, and incremental ingest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.names import fold
from vitrine.functions.text import personal_data
from vitrine.operators.gold import COMPANY, PERSON, companies, persons
from vitrine.plans.registry import query
from vitrine.streaming.ingest import running_totals


@query(f"""WITH {COMPANY}, {PERSON} SELECT 'p' AS t, CAST(id AS VARCHAR) AS id, nume AS n, strip_accents(lower(nume)) AS k, camera AS x FROM person
    UNION ALL SELECT 'c', CAST(cui AS VARCHAR), nume, strip_accents(lower(nume)), sector FROM company
    UNION ALL SELECT 'o', CAST(n_nationkey AS VARCHAR), n_name, strip_accents(lower(n_name)), NULL FROM nation""")
def search_index(t):
    """Persons, companies and institutions in one compact index (SNK-10, RL-19, FLT-13)."""
    parts = [
        persons(t).select(F.lit("p").alias("t"), F.col("id").cast("string").alias("id"), F.col("nume").alias("n"), F.col("camera").alias("x")),
        companies(t).select(F.lit("c").alias("t"), F.col("cui").cast("string").alias("id"), F.col("nume").alias("n"), F.col("sector").alias("x")),
        t("nation").select(F.lit("o").alias("t"), F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("n")),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.select("t", "id", "n", fold("n").alias("k"), "x")


@query(f"""WITH {COMPANY}, {PERSON} SELECT 'p-' || substr(sha1(CAST(id AS VARCHAR)), 1, 16) AS id, 'Person' AS schema, 'name=' || nume || ';country=ro' AS properties FROM person
    UNION ALL SELECT 'c-' || substr(sha1(CAST(cui AS VARCHAR)), 1, 16), 'Company', 'name=' || nume || ';country=ro' || CASE WHEN bal > 0 THEN ';status=active' ELSE '' END FROM company""")
def ftm_entities(t):
    """The entity stream: id, schema and non-empty properties (SNK-07, JN-27)."""

    def entity(df: DataFrame, prefix: str, key: str, schema: str, status) -> DataFrame:
        props = F.map_filter(F.create_map(F.lit("name"), F.col("nume"), F.lit("country"), F.lit("ro"), F.lit("status"), status), lambda _, v: v.isNotNull())
        shown = F.array_join(F.transform(F.map_entries(props), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
        ident = F.concat(F.lit(prefix), F.substring(F.sha1(F.col(key).cast("string")), 1, 16))
        return df.select(ident.alias("id"), F.lit(schema).alias("schema"), shown.alias("properties"))

    none = F.lit(None).cast("string")
    return entity(persons(t), "p-", "id", "Person", none).unionByName(
        entity(companies(t), "c-", "cui", "Company", F.when(F.col("bal") > 0, "active"))
    )


@query("""SELECT o_orderkey AS id, 'Comunicat ' || o_orderkey AS title, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY o_orderkey DESC LIMIT 60""")
def feed_top(t):
    """The sixty newest items of the feed (SNK-08, TK-06)."""
    top = t("orders").orderBy(F.col("o_orderkey").desc()).limit(60)
    return top.select(F.col("o_orderkey").alias("id"), F.concat_ws(" ", F.lit("Comunicat"), F.col("o_orderkey").cast("string")).alias("title"), F.col("o_orderdate").cast("date").alias("day"))


@query("""SELECT count(*) AS rows, count(*) FILTER (WHERE regexp_matches(text, '\\b[1-8]\\d{12}\\b') OR regexp_matches(text, '\\b0[237]\\d{8}\\b')
    OR regexp_matches(text, '\\bseria\\s+[A-Z]{2}\\s+nr\\.?\\s*\\d{6}\\b', 'i')) AS blocked FROM documents""")
def publication_guard(t):
    """How many rows the fail-closed guard would stop (TX-08)."""
    flagged = F.size(personal_data(F.col("text"))) > 0
    return t("documents").agg(F.count("*").alias("rows"), F.count_if(flagged).alias("blocked"))


@query("""SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def incremental_ingest(t):
    """Events ingested as a stream in micro-batches; the totals equal those of a batch (ST-B, ST-C, ST-D)."""
    return running_totals(t("events"))
