"""The person registry: stable ids for mentions, with review where the evidence is between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.names import make_id, name_key
from vitrine.functions.similarity import name_similarity
from vitrine.operators.blocking import MOST, bounded_block_join

MATCH, REVIEW = 0.85, 0.62


def person_id(name: str = "name", birth: str = "birth_date") -> F.Column:
    """Id of a new person: its name key and year of birth."""
    return make_id("p", name_key(name), F.year(birth))


def _tokens(key: str) -> F.Column:
    return F.filter(F.split(key, " "), lambda x: x != "")


def _token_pairs(key: str) -> F.Column:
    """Every two tokens of a key (sorted), as one string; a key of one token as itself."""
    t = _tokens(key)
    pairs = F.flatten(F.transform(t, lambda a: F.transform(F.filter(t, lambda b: a < b), lambda b: F.concat_ws(" ", a, b))))
    return F.when(F.size(t) == 1, t).otherwise(pairs)


def _shared_token(asked: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """(a, c): names of which one has a single token that the other, of two tokens at most, has too."""
    short = lambda df, n: df.where(F.size(_tokens("name")) <= n)
    by_token = lambda df, alias: df.select(F.explode(_tokens("name")).alias("k"), F.col("name").alias(alias))
    one_two = bounded_block_join(by_token(short(asked, 1), "a"), by_token(short(known, 2), "c"), ["k"], "a", "c", most)
    two_one = bounded_block_join(by_token(short(asked, 2), "a"), by_token(short(known, 1), "c"), ["k"], "a", "c", most)
    return one_two.select("a", "c").unionAll(two_one.select("a", "c"))


def candidates(asked: DataFrame, known: DataFrame, most: int = MOST) -> DataFrame:
    """(a, c, base): distinct name keys (name) of both sides that can reach REVIEW without a date of birth.

    0.6 Jaccard + 0.4 Jaro-Winkler reaches 0.62 only from a Jaccard above 0.36: two common tokens, or one that is the
    whole of one name and half of the other. So a token alone is a block for names of one token, and all other names meet
    by pairs of tokens, however common each token is. A block of more than ``most`` names a side is dealt out."""
    by_pair = lambda df, alias: df.where(F.size(_tokens("name")) > 1).select(F.explode(_token_pairs("name")).alias("k"), F.col("name").alias(alias))
    pairs = bounded_block_join(by_pair(asked, "a"), by_pair(known, "c"), ["k"], "a", "c", most).select("a", "c")
    pairs = pairs.unionAll(_shared_token(asked, known, most)).distinct()
    return pairs.withColumn("base", name_similarity(F.col("a"), F.col("c")))


def resolve(mentions: DataFrame, registry: DataFrame, crosswalk: DataFrame, most: int = MOST) -> DataFrame:
    """mention, status (MATCHED, REVIEW, NEW, INVALID), person, score.

    ``mentions``: mention, name, birth_date, system, ext_id. ``registry``: person, canonical,
    birth_date. ``crosswalk``: system, ext_id, person. An external id decides alone; otherwise the
    best registered name that shares a four-letter token prefix is scored (+0.3 for the same birth
    date, x0.3 for another) and ties go to the smaller id; a blank name is invalid. NEW has no score: what
    stays below REVIEW is not looked for.

    Names are compared once each, not once a mention. Without dates they meet by ``candidates``; persons of the same date of
    birth meet by date and prefix, where a low similarity is enough. All pairs that reach REVIEW are found,
    and no block holds more than about ``most`` distinct names a side."""
    by_id = crosswalk.groupBy("system", "ext_id").agg(F.min("person").alias("by_id"))
    asked = mentions.join(by_id, ["system", "ext_id"], "left").withColumn("a", F.coalesce(name_key("name"), F.lit("")))
    open_ = asked.where("by_id is null AND a <> ''").select("a", "birth_date").distinct()
    known = registry.select("person", name_key("canonical").alias("c"), F.col("birth_date").alias("born")).where("c <> ''")

    names = candidates(open_.select(F.col("a").alias("name")).distinct(), known.select(F.col("c").alias("name")).distinct(), most)
    per_name = known.groupBy("c").agg(F.min("person").alias("any"), F.min(F.when(F.col("born").isNull(), F.col("person"))).alias("undated"))
    near = names.where(F.col("base") >= REVIEW).join(per_name, "c")
    first = lambda p: F.min(F.when(F.col(p).isNotNull(), F.struct((-F.col("base")).alias("minus"), F.col(p).alias("person"))))
    near = near.groupBy("a").agg(first("any").alias("any"), first("undated").alias("undated"))

    prefixes = lambda c: F.array_distinct(F.transform(_tokens(c), lambda x: F.substring(x, 1, 4)))
    left = open_.where("birth_date is not null").select("a", F.col("birth_date").alias("born"), F.explode(prefixes("a")).alias("k"))
    per_date = known.where("born is not null").groupBy("c", "born").agg(F.min("person").alias("person"))
    right = per_date.select("c", "born", "person", F.explode(prefixes("c")).alias("k"))
    dated = bounded_block_join(left, right, ["born", "k"], "a", "c", most).select("a", "born", "c", "person").distinct()
    score = F.least(F.lit(1.0), name_similarity(F.col("a"), F.col("c")) + 0.3)
    dated = dated.withColumn("score", score).where(F.col("score") >= REVIEW)
    dated = dated.groupBy("a", F.col("born").alias("birth_date")).agg(F.min(F.struct((-F.col("score")).alias("minus"), "person")).alias("dated"))

    out = asked.join(near, "a", "left").join(dated, ["a", "birth_date"], "left")
    best = F.when(F.col("birth_date").isNull(), F.col("any")).otherwise(F.least("undated", "dated"))
    out = out.withColumn("best", best).withColumn("score", F.bround(-F.col("best.minus"), 4))
    status = (
        F.when(F.col("a") == "", "INVALID")
        .when(F.col("by_id").isNotNull() | (F.col("score") >= MATCH), "MATCHED")
        .when(F.col("score").isNotNull(), "REVIEW")
        .otherwise("NEW")
    )
    person = F.when(status == "INVALID", None).when(status == "NEW", person_id()).otherwise(F.coalesce("by_id", "best.person"))
    return out.select("mention", status.alias("status"), person.alias("person"), F.when(F.col("by_id").isNotNull(), 1.0).otherwise(F.col("score")).alias("score"))
