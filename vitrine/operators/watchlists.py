"""Persons found in lists of others: international lists, press releases, archives of declarations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.names import name_key

# Schemas of an entity stream that are persons or organisations, properties that name a country, and names of the country.
SCHEMAS = ("Person", "Company", "Organization", "LegalEntity")
PLACES = ("country", "nationality", "jurisdiction", "citizenship")
COUNTRY = ("ro", "rou", "romania", "românia")
FEWEST_WORDS, SURE_WORDS, SHOWN = 2, 3, 5


def entities_of(stream: DataFrame, country: tuple[str, ...] = COUNTRY) -> DataFrame:
    """Entities (id, schema, properties map of arrays) of the right schema with ``country`` among any of their places, and a name:
    id, schema, name (the first), key, topics, position."""
    p = F.col("properties")
    first = lambda k: F.try_element_at(p[k], F.lit(1))
    places = F.flatten(F.array(*[F.coalesce(p[k], F.array().cast("array<string>")) for k in PLACES]))
    here = F.exists(places, lambda x: F.lower(x).isin(*country))
    kept = stream.where(F.col("schema").isin(*SCHEMAS) & here & (F.coalesce(first("name"), F.lit("")) != ""))
    topics = F.coalesce(p["topics"], F.array().cast("array<string>"))
    return kept.select("id", "schema", first("name").alias("name"), name_key(first("name")).alias("key"), topics.alias("topics"), first("position").alias("position"))


def best_by_key(persons: DataFrame, fewest: int = FEWEST_WORDS) -> DataFrame:
    """One person (person, key, weight, ...) for each name key of ``fewest`` words or more: the weightiest, then the smallest id."""
    words = F.size(F.split("key", " "))
    best = persons.where(words >= fewest).groupBy("key").agg(F.max_by(F.struct("*"), F.struct("weight", -F.col("person"))).alias("p"))
    return best.select("p.*")


def flagged(entities: DataFrame, persons: DataFrame) -> DataFrame:
    """``entities`` with ``person``: who has the same name key, null for nobody. A name is no proof: persons of one name are many."""
    known = best_by_key(persons).select("key", "person")
    return entities.join(known, "key", "left")


def press_matches(mentions: DataFrame, persons: DataFrame, shown: int = SHOWN) -> DataFrame:
    """Persons whose name occurs in releases (release, name): person, key, n_releases, releases (the first ``shown``), confidence.

    A name of three words, or of a person in office, is ``high``, one of two words ``med``. Not for publication: who is
    named in a release is not thereby guilty. The releases of a name are ranked before they are gathered."""
    named = mentions.withColumn("key", name_key("name")).where(F.size(F.split("key", " ")) >= FEWEST_WORDS).select("key", "release").distinct()
    known = best_by_key(persons)
    hits = named.join(known, "key")
    first = F.row_number().over(Window.partitionBy("key").orderBy("release"))
    top = hits.select("key", "release").withColumn("rn", first).where(F.col("rn") <= shown).groupBy("key").agg(F.array_sort(F.collect_list("release")).alias("releases"))
    per = hits.groupBy("key", "person", "in_office").agg(F.count("*").alias("n_releases"))
    sure = (F.size(F.split("key", " ")) >= SURE_WORDS) | F.coalesce("in_office", F.lit(False))
    return per.join(top, "key").select("person", "key", "n_releases", "releases", F.when(sure, "high").otherwise("med").alias("confidence"))


def archive_summary(records: DataFrame, most: int = SHOWN, width: int = 50) -> DataFrame:
    """Per name key of an archive (name, year, role, institution): n, years, the first ``most`` roles and institutions, cut to ``width``.

    Values are made distinct before they are gathered; years are few, roles and institutions are ranked first."""
    keyed = records.withColumn("key", name_key("name")).where("key <> ''")
    out = keyed.groupBy("key").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("year")).alias("years"))
    for column, name in (("role", "roles"), ("institution", "institutions")):
        value = keyed.select("key", F.substring(F.col(column).cast("string"), 1, width).alias("v")).where("v <> ''").distinct()
        ranked = value.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("v"))).where(F.col("rn") <= most)
        out = out.join(ranked.groupBy("key").agg(F.array_sort(F.collect_list("v")).alias(name)), "key", "left")
    empty = F.array().cast("array<string>")
    return out.select("key", "n", "years", F.coalesce("roles", empty).alias("roles"), F.coalesce("institutions", empty).alias("institutions"))


def patched(persons: DataFrame, summary: DataFrame) -> DataFrame:
    """``persons`` (key, ...) with ``archive``: the summary of their name, null without one."""
    facts = summary.select("key", F.struct("n", "years", "roles", "institutions").alias("archive"))
    return persons.join(facts, "key", "left")
