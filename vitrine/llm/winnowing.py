"""Benchmark decontamination by winnowed fingerprints, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import write_table
from vitrine.sources.tables import table

#: Words of a window, words of a k-gram (fewer in shorter items), fingerprints that are broadcast at most (16 bytes each).
WINDOW, GRAM, MOST_BROADCAST = 10, 4, 500_000
#: A fingerprint holds hash, length class and word position; an array of words in a row has fewer than 2**27 of them.
_PLACE = (1 << 27) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text in which A-Z are lower-cased; none for null."""
    given = F.coalesce(F.col(text), F.lit(""))
    plain = F.octet_length(given) == F.char_length(given)
    folded = F.when(plain, F.lower(given)).otherwise(F.translate(given, _UPPER, _LOWER))
    return F.array_remove(F.split(folded, _GAP), "")


def text_key(text: str = "text") -> Column:
    """What rows of equal text share."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _shifted(array: str, other: str, gap: int, join) -> Column:
    """join(array[i], other[i + gap]) for every i that has both."""
    n = F.greatest(F.size(other) - gap, F.lit(0))
    return F.zip_with(F.slice(array, F.lit(1), n), F.slice(other, F.lit(1 + gap), n), join)


def _winnowed(df: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """``keep`` and ``prints``: for each length n, the least k-gram of every window of n words of ``words``.

    A print is hash (33 bits), n and position of the k-gram's first word, so the least of a window is
    its first least k-gram. Windows and k-grams are built by doubling: each step joins an array with itself.
    """
    df = df.withColumn("gram1", F.transform("words", lambda w: F.xxhash64(w)))
    for k in range(2, min(GRAM, max(lengths, default=1)) + 1):
        half = k // 2
        df = df.withColumn(f"gram{k}", _shifted(f"gram{k - half}", f"gram{half}", k - half, lambda a, b: F.xxhash64(a, b)))
    for n in lengths:
        k = min(GRAM, n)
        df = df.withColumn(f"least{n}", F.transform(f"gram{k}", _placed(n)))
        width, wide = n - k + 1, 1
        while wide < width:
            step = min(wide, width - wide)
            df = df.withColumn(f"least{n}", _shifted(f"least{n}", f"least{n}", step, lambda a, b: F.least(a, b)))
            wide += step
    prints = [F.array_distinct(f"least{n}") for n in lengths]
    return df.select(*keep, F.concat(*prints).alias("prints"))


def _placed(n: int):
    high, length = F.lit(-(1 << 31)).cast("long"), F.lit(n << 27).cast("long")
    return lambda gram, i: gram.bitwiseAND(high).bitwiseOR(length).bitwiseOR(i.cast("long"))


def _named(fingerprint: str = "p") -> Column:
    """The part of a print that equal k-grams of one length class share."""
    return F.shiftrightunsigned(fingerprint, 27)


def contamination(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", window: int = WINDOW, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """Which words of the documents lie in windows of the items: (key, n_hit, items), a row per contaminated text.

    A window is ``window`` consecutive words of an item, or all words of a shorter one; ``key`` is
    ``text_key`` of the document, ``items`` the sorted ids (as strings) of the items with a window in it.
    Every document keeps the least k-gram of each of its own windows (k = 4, 7 k-grams a window of
    10), so a shared window shares a fingerprint. Fingerprints meet those of the items (broadcast up to
    ``most_broadcast`` of them, by shuffle beyond), and around each hit all windows that hold it are
    compared by their words. A window occurs once in the table of windows, with the set of its items,
    so a passage that many items share gives a hit one row.

    Null and empty texts have no words and are clean; equal texts are looked up once; rows of one
    item id are one item; a null item id counts as the empty string; an empty table of items hits nothing; other
    columns are ignored.
    """
    if not 0 < window < 16:
        raise ValueError("a window has 1 to 15 words")  # the print's four bits
    listed = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words().alias("words"))
    listed = listed.withColumn("n", F.least(F.size("words"), F.lit(window))).where("n > 0")
    listed = write_table(listed.repartition("item", "words"), "winnow-items")
    lengths = sorted(r[0] for r in listed.select("n").distinct().collect())  # at most ``window`` numbers
    texts = docs.select(text_key().alias("key"), "text")
    docs = texts.select("key", words().alias("words"))
    own = [_winnowed(listed.where(F.col("n") == n), [n], ["item"]) for n in lengths]
    if not own:
        return docs.limit(0).select("key", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    known = own[0]
    for more in own[1:]:
        known = known.unionByName(more)
    known = known.select(F.explode_outer("prints").alias("p")).select(_named().alias("name")).distinct()
    known = write_table(known, "winnow-prints")
    small = known.count() <= most_broadcast
    # outer: an inner explode would first filter on the size of the whole nested expression
    prints = _winnowed(docs, lengths, ["key"]).select("key", F.explode_outer("prints").alias("p")).withColumn("name", _named())
    hits = prints.join(F.broadcast(known) if small else known, "name", "left_semi")
    seeds = write_table(hits.groupBy("key").agg(F.collect_set("p").alias("seeds")), "winnow-seeds")  # of one text

    n, at = F.col("n"), F.size("words") - F.col("n")
    windows = F.transform(F.sequence(F.lit(0), at), lambda i: F.array_join(F.slice("words", i + 1, n), " "))
    places = listed.select("item", "n", F.explode(F.array_distinct(windows)).alias("window"))
    sets = places.groupBy("n", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    sets = sets.withColumn("set_id", F.unhex(F.sha2(F.array_join(F.transform("items", lambda i: F.concat(F.char_length(i), F.lit(":"), i)), ","), 256)))
    sets = write_table(sets, "winnow-sets")

    length = lambda p: F.shiftright(p, 27).bitwiseAND(F.lit(15).cast("long")).cast("int")
    first = lambda p: p.bitwiseAND(F.lit(_PLACE).cast("long")).cast("int")
    around = lambda p: F.transform(
        F.sequence(F.greatest(first(p) - length(p) + F.least(length(p), F.lit(GRAM)), F.lit(0)), F.least(first(p), F.size("words") - length(p))),
        lambda i: F.struct(length(p).alias("n"), i.alias("start")),
    )
    # texts meet their seeds by shuffle at every size, and are split into words only then
    near = texts.hint("merge").join(seeds, "key").withColumn("words", words())
    near = near.withColumn("near", F.array_distinct(F.flatten(F.transform("seeds", around))))
    seen = F.transform("near", lambda s: F.struct(s["n"].alias("n"), s["start"].alias("start"), F.array_join(F.slice("words", s["start"] + 1, s["n"]), " ").alias("window")))
    near = near.select("key", F.inline_outer(seen))
    found = near.join(sets.select("n", "window", "set_id"), ["n", "window"]).select("key", "start", "n", "set_id").distinct()
    found = write_table(found, "winnow-found")

    line = Window.partitionBy("key").orderBy("start", "n")  # the hits of one text
    before = F.max(F.col("start") + F.col("n")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("start") + F.col("n") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    hit = found.select("key", "start", "n").distinct().withColumn("new", new).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    named = sets.select("set_id", "items").dropDuplicates(["set_id"])
    items_of = found.select("key", "set_id").distinct().join(named, "set_id")
    items_of = items_of.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return hit.join(items_of, "key")


def decontaminate(docs: DataFrame, items: DataFrame, item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; other columns stay as they are."""
    dirty = contamination(docs, items, item_id, window).select(F.col("key").alias("__dirty"))
    return docs.join(write_table(dirty, "winnow-dirty"), text_key() == F.col("__dirty"), "left_anti")


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against ``benchmark``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = table(spark, sf_dir, "documents")
    found = write_table(contamination(docs, table(spark, sf_dir, "benchmark")), "winnow-result")
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0))
    each = docs.select("doc_id", n_words.cast("long").alias("n_words"), text_key().alias("key")).hint("merge").join(found, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return each.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


QUERIES = {"op12_winnowing": op12_winnowing}
_SQL_WORDS = f"regexp_extract_all(coalesce(translate(text, '{_UPPER}', '{_LOWER}'), ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = {
    "op12_winnowing": f"""WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_SQL_WORDS} AS w FROM benchmark),
    win AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda s: array_to_string(w[s:s + n - 1], ' '))) AS win
      FROM (SELECT *, least(len(w), {WINDOW}) AS n FROM i) WHERE n > 0),
    d AS (SELECT row_number() OVER () AS id, doc_id, {_SQL_WORDS} AS w FROM documents),
    dw AS (SELECT id, n, unnest(range(1, len(w) - n + 2)) AS s, unnest(list_transform(range(1, len(w) - n + 2), lambda s: array_to_string(w[s:s + n - 1], ' '))) AS win
      FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
    h AS (SELECT id, s, n, item FROM dw JOIN win USING (n, win)),
    c AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT id, s, n FROM h)) GROUP BY 1),
    m AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM h) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (id) LEFT JOIN m USING (id)"""
}
