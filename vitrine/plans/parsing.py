"""Queries that apply the dialects of numbers, dates and names to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import dialects, names, numbers, text
from vitrine.plans.registry import query

_MONEY = "trim(format('{:t.}', floor(l_extendedprice)::BIGINT)) || ',' || lpad((round(l_extendedprice * 100)::BIGINT % 100)::VARCHAR, 2, '0')"


def _money():
    whole = F.replace(F.format_number(F.floor("l_extendedprice"), 0), F.lit(","), F.lit("."))
    return F.concat(whole, F.lit(","), F.lpad((F.round(F.col("l_extendedprice") * 100).cast("long") % 100).cast("string"), 2, "0"))


@query("""SELECT l_orderkey, l_linenumber, round(l_extendedprice * 100)::BIGINT / 100 AS strict, round(l_extendedprice * 100)::BIGINT / 100 AS comma,
    NULL::DOUBLE AS none, floor(l_extendedprice)::BIGINT AS digits FROM lineitem""")
def number_dialects(t):
    """Numbers in the strict, comma and digits dialects (NM-07, NM-08, NM-09, NM-15)."""
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", dialects.strict_number(_money()).alias("strict"), dialects.comma_number(_money()).alias("comma"),
        dialects.strict_number(F.concat(_money(), F.lit(" lei"))).alias("none"), dialects.digits_number(F.concat(F.lit("nr. "), F.floor("l_extendedprice"))).alias("digits"),
    )


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > 1000 THEN floor(l_extendedprice) + 0.75 ELSE 0.0 END AS grouped,
    2 AS n_areas, 12.5 + CASE WHEN l_quantity > 5 THEN l_quantity ELSE 0 END AS area FROM lineitem""")
def sums_in_text(t):
    """Sums of the amounts, with their decimals, and of the areas that a text names (NM-10, NM-14)."""
    grouped = F.replace(F.format_number(F.floor("l_extendedprice"), 0), F.lit(","), F.lit("."))
    area = dialects.areas(F.concat(F.lit("teren 12,5 mp, casa "), F.col("l_quantity").cast("int"), F.lit(" m2")))
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", dialects.grouped_sum(F.concat(F.lit("total "), grouped, F.lit(",75 lei")), 1000.0).alias("grouped"),
        area["n"].alias("n_areas"), area["total"].alias("area"),
    )


@query("""SELECT o_orderkey, CASE WHEN o_totalprice * f >= 1e9 THEN printf('%.1f mld lei', o_totalprice * f / 1e9) WHEN o_totalprice * f >= 1e6 THEN printf('%.1f mil lei', o_totalprice * f / 1e6)
    WHEN o_totalprice * f >= 1e3 THEN printf('%.1f mii lei', o_totalprice * f / 1e3) ELSE printf('%.0f lei', o_totalprice * f) END AS shown,
    CASE WHEN o_totalprice > 200 THEN o_totalprice ELSE 0 END * 5.05 AS lei FROM (SELECT *, [0.00137, 1.0, 97.1, 31234.7][o_orderkey % 4 + 1]::DOUBLE AS f FROM orders)""")
def money_shown(t):
    """Amounts as they are shown, and in lei (ST-20, NM-06, NM-11)."""
    price = F.col("o_totalprice")
    scaled = price * F.element_at(F.array(*map(F.lit, (0.00137, 1.0, 97.1, 31234.7))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t("orders").select(
        "o_orderkey", dialects.short_money(scaled).alias("shown"),
        numbers.to_lei(F.when(price > 200, numbers.capped(price, 1e12)).otherwise(0.0), F.lit("eur")).alias("lei"),
    )


@query("""SELECT o_orderkey, o_orderdate::DATE AS dated, year(o_orderdate)::INT AS year, o_orderdate::DATE + INTERVAL 12 HOUR AS noon FROM orders""")
def dates_in_names(t):
    """Dates and years of file names and addresses (DT-04, DT-05, DT-06, DT-08)."""
    name = F.concat(F.lit("raport_01.02.1990_"), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(".pdf"))
    url = F.concat(F.lit("https://x.ro/a/"), F.year("o_orderdate"), F.lit("/b12345.html"))
    return t("orders").select("o_orderkey", dialects.last_date_in(name).alias("dated"), dialects.year_in(url).alias("year"), dialects.noon(F.col("o_orderdate")).alias("noon"))


@query("""SELECT p_partkey, upper(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'))) AS place,
    CASE WHEN length(p_name) > 12 THEN rtrim(substr(p_name, 1, 11)) || '…' ELSE p_name END AS short FROM part""")
def shown_names(t):
    """Names as keys of places, and shortened (ST-19, ST-26, ST-29)."""
    return t("part").select("p_partkey", dialects.place_name(F.concat(F.lit(" "), "p_name", F.lit("  "))).alias("place"), dialects.shortened(F.col("p_name"), 12).alias("short"))


@query("""SELECT confidence, count(*) AS n FROM (SELECT CASE WHEN len(k) >= 3 THEN 'high' WHEN len(k) = 2 THEN 'context' ELSE 'candidate' END AS confidence
    FROM (SELECT list_distinct(list_filter(string_split_regex(lower(p_name), '[^a-z]+'), lambda x: len(x) >= 2)) AS k FROM part)) GROUP BY 1""")
def confidence_tiers(t):
    """Confidence by the number of words of a name key (ST-15)."""
    return t("part").groupBy(dialects.confidence(names.name_key("p_name")).alias("confidence")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name || 'ă' AS repaired, p_name || ' ș' AS fixed FROM part")
def repaired_text(t):
    """Double encoding and cedillas repaired (ST-02, ST-25)."""
    twice = F.decode(F.encode(F.concat("p_name", F.lit("ă")), "UTF-8"), "ISO-8859-1")
    return t("part").select("p_partkey", text.repair_encoding(twice).alias("repaired"), names.fix_diacritics(F.concat("p_name", F.lit(" ş"))).alias("fixed"))


@query("""SELECT o_orderkey, 'BUNURI ' || o_orderkey || ' ' AS part, CASE WHEN round(o_totalprice, 2) > 100 THEN round(o_totalprice, 2) ELSE 0 END AS lei FROM orders""")
def declaration_sections(t):
    """A section of a declaration and the sum it names (TX-01, NM-04, NM-13)."""
    doc = F.concat(F.lit("ANTET BUNURI "), "o_orderkey", F.lit(" VENITURI "), F.format_string("%.2f", "o_totalprice"), F.lit(" lei, 50 lei"))
    found = t("orders").withColumn("doc", doc)
    return found.select("o_orderkey", text.section(F.col("doc"), "BUNURI", ["VENITURI"]).alias("part"), numbers.amounts_in(F.col("doc")).alias("lei"))


@query("SELECT c_custkey, c_acctbal / nullif(c_custkey % 3, 0) AS ratio, 100.0 * (c_acctbal - lo) / nullif(hi - lo, 0) AS scaled FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)")
def guarded_ratios(t):
    """Ratios with a guard for zero, and a score scaled to 0..100 (NM-16, WN-09)."""
    customer = t("customer")
    ends = customer.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    scaled = 100.0 * F.try_divide(F.col("c_acctbal") - F.col("lo"), F.col("hi") - F.col("lo"))
    return customer.join(F.broadcast(ends)).select("c_custkey", F.try_divide("c_acctbal", F.col("c_custkey") % 3).alias("ratio"), scaled.alias("scaled"))


@query("""SELECT c_nationkey, n, running FROM (SELECT c_nationkey, n, sum(n) OVER (ORDER BY n DESC, c_nationkey) AS running
    FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)) WHERE running <= (SELECT count(*) FROM customer) / 2""")
def greedy_prefix(t):
    """Groups by size until a cap of nodes is reached (TK-11)."""
    from pyspark.sql import Window

    customer = t("customer")
    sizes = customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy(F.desc("n"), "c_nationkey").rowsBetween(Window.unboundedPreceding, 0))  # one row a group
    total = F.broadcast(customer.agg(F.count("*").alias("all")))
    return sizes.withColumn("running", running).join(total).where(F.col("running") <= F.col("all") / 2).select("c_nationkey", "n", "running")
