"""Queries that apply the domain functions to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import dates, names, numbers, text
from vitrine.functions.names import ORGANISATION_STOP_WORDS, PARTIES, TITLES
from vitrine.plans.registry import query

_TITLES = "(" + ", ".join(f"'{x}'" for x in TITLES) + ")"
_STOP = "[" + ", ".join(f"'{x}'" for x in ORGANISATION_STOP_WORDS) + "]"
_TOKENS = f"list_filter(string_split_regex(lower(strip_accents({{0}})), '[^a-z]+'), lambda x: len(x) >= 2 AND x NOT IN {_TITLES})"
_ASCII = "regexp_replace(lower(strip_accents({0})), '[^\\x00-\\x7F]', '', 'g')"
_PARTY = "CASE " + " ".join(
    f"WHEN trim(n) = '{c.lower()}' OR " + " OR ".join(f"contains(n, '{p}')" for p in ps) + f" THEN '{c}'" for c, ps in PARTIES
) + " END"


@query(f"SELECT p_partkey, array_to_string(list_sort(list_distinct({_TOKENS.format('p_name')})), ' ') AS name_key FROM part")
def name_key(t):
    """Order-free keys of names (ST-04, ST-05)."""
    return t("part").select("p_partkey", names.name_key("p_name").alias("name_key"))


@query("SELECT doc_id, md5(strip_accents(lower(text))) AS folded FROM documents")
def accent_fold(t):
    """Whole texts without accents (ST-01, ST-03)."""
    return t("documents").select("doc_id", F.md5(names.fold("text")).alias("folded"))


@query(f"""SELECT doc_id, len(k) AS n, md5(array_to_string(k, ' ')) AS tokens FROM (SELECT doc_id,
    list_sort(list_filter(list_distinct(regexp_extract_all({_ASCII.format('text')}, '[a-z]{{4,}}')), lambda x: NOT list_contains({_STOP}, x))) AS k FROM documents)""")
def org_tokens(t):
    """Telling words of whole texts (ST-13, ST-14)."""
    k = names.org_tokens("text")
    return t("documents").select("doc_id", F.size(k).cast("long").alias("n"), F.md5(F.array_join(k, " ")).alias("tokens"))


@query(f"SELECT doc_id, {_PARTY} AS cod FROM (SELECT doc_id, {_ASCII.format('text')} AS n FROM documents)")
def canonical_party(t):
    """The first party that a text names (ST-16)."""
    return t("documents").select("doc_id", names.party_code("text").alias("cod"))


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
    'o:' || substr(sha256(p_brand || '|' || p_partkey), 1, 16) AS id, 'e-' || substr(sha1(p_name), 1, 16) AS edge FROM part""")
def slugs_and_ids(t):
    """Slugs and hashed identifiers (ST-17, ST-18)."""
    edge = F.concat(F.lit("e-"), F.substring(F.sha1("p_name"), 1, 16))
    return t("part").select("p_partkey", names.slug("p_name").alias("slug"), names.make_id("o", "p_brand", "p_partkey").alias("id"), edge.alias("edge"))


def _shown(sep_thousand, sep_decimal):
    """An amount of the line items as text with the given separators."""
    whole = F.format_number(F.floor("l_extendedprice"), 0)
    cents = F.lpad((F.round(F.col("l_extendedprice") * 100).cast("long") % 100).cast("string"), 2, "0")
    return F.concat(F.replace(whole, F.lit(","), F.lit(sep_thousand)), F.lit(sep_decimal), cents)


_RO = "replace(format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)), ',', '.') || ',' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')"


@query(f"""SELECT l_orderkey, l_linenumber, CAST(replace(replace(s, '.', ''), ',', '.') AS DOUBLE) AS contracts,
    CAST(replace(split_part(s, ',', 1), '.', '') AS DOUBLE) AS budget, CAST(replace(replace(s, '.', ''), ',', '.') AS DOUBLE) AS bulk
    FROM (SELECT l_orderkey, l_linenumber, {_RO} AS s FROM lineitem)""")
def parse_ro_number(t):
    """Amounts written the local way, read by three presets (NM-01, NM-03, NM-05)."""
    s = F.col("s")
    whole = F.substring_index(s, ",", 1)  # 1.234 means 1234 in the budgets
    rows = t("lineitem").select("l_orderkey", "l_linenumber", _shown(".", ",").alias("s"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        numbers.parse_number(s).alias("contracts"),
        numbers.parse_number(whole, "thousands").alias("budget"),
        numbers.parse_bulk(s).alias("bulk"),
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS named, CAST(o_orderdate AS DATE) AS dotted, CAST(last_day(o_orderdate) AS DATE) AS month_end FROM orders""")
def ro_dates(t):
    """Dates by month name and in dotted form, and the end of the month (DT-01, DT-03, DT-09)."""
    months = F.array(*map(F.lit, ["ian.", "februarie", "MARTIE", "apr", "mai", "iunie", "iul", "august", "sept.", "octombrie", "noi", "decembrie"]))
    day, year = F.dayofmonth("o_orderdate").cast("string"), F.year("o_orderdate").cast("string")
    named = dates.day_month_year(day, F.element_at(months, F.month("o_orderdate")), year)
    dotted = dates.iso_or_dotted(F.concat_ws("/", day, F.month("o_orderdate").cast("string"), year))
    return t("orders").select("o_orderkey", named.alias("named"), dotted.alias("dotted"), F.last_day("o_orderdate").alias("month_end"))


@query("""SELECT doc_id, regexp_matches(text, '\\b[1-8]\\d{12}\\b') AS cnp, regexp_matches(text, '\\b0[237]\\d{8}\\b') AS telefon,
    regexp_matches(text, '\\bseria\\s+[A-Z]{2}\\s+nr\\.?\\s*\\d{6}\\b', 'i') AS ci FROM documents""")
def pii_scan(t):
    """Personal data in whole texts (TX-07)."""
    flags = [F.col("text").rlike(p).alias(n) for n, p in zip(("cnp", "telefon", "ci"), text.PERSONAL.values(), strict=True)]
    return t("documents").select("doc_id", *flags)


@query("""SELECT doc_id, ['lege/' || (doc_id % 300) || '/2010', 'oug/57/2019', 'oug/5/2001', 'hg/' || (doc_id % 7) || '/2004', 'og/2/2000'] AS laws,
    len(list_distinct(regexp_extract_all(text, '\\bhttps?://[^\\s"<>]+'))) AS links FROM documents""")
def law_references(t):
    """Citations of laws behind whole texts, distinct and by kind, and the texts' links (TX-09)."""
    links = F.array_distinct(F.regexp_extract_all("text", F.lit(r'\bhttps?://[^\s"<>]+'), F.lit(0)))
    n, m = (F.col("doc_id") % 300).cast("string"), (F.col("doc_id") % 7).cast("string")
    cited = F.concat(
        F.coalesce("text", F.lit("")), F.lit(" Legea nr. "), n, F.lit("/2010, O.U.G. 57 / 2019; Ordonanța de urgență nr. 5/2001 HG nr."), m,
        F.lit("/2004, legea "), n, F.lit("/2010, Hotărârea 00"), m, F.lit("/2004, ordonanta 2/2000"),
    )
    return t("documents").select("doc_id", text.law_references(cited).alias("laws"), F.size(links).cast("long").alias("links"))


@query("""WITH w AS (SELECT doc_id, upper(regexp_replace(regexp_extract(coalesce(text, ''), '^\\S+'), '[^a-zA-Z]', '', 'g')) AS w FROM documents),
    n AS (SELECT doc_id, w || 'ESCU' AS w FROM w)
    SELECT doc_id, [w || ' POP-ȘTEF', 'ION ' || w || ' UAT ȚIC', 'BB CC DD EE', 'FF GG'] AS names FROM n""")
def caps_names(t):
    """Names in capitals among words, signs and abbreviations, built from the first word of every text (ST-23)."""
    first = F.upper(F.regexp_replace(F.regexp_extract(F.coalesce("text", F.lit("")), r"^\S+", 0), "[^a-zA-Z]", ""))
    w = F.concat(first, F.lit("ESCU"))
    line = F.concat(F.lit("Inculpatul "), w, F.lit("  POP-ȘTEF, DNA SRL și ION "), w, F.lit(" UAT ȚIC. "), w, F.lit(" POP-ȘTEF; A1 BB CC DD EE FF GG x B. X"))
    return t("documents").select("doc_id", text.capital_names(line).alias("names"))


@query("""SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '\\s+', ' ', 'g')) AS title,
    len(l) AS links, array_to_string(l, ' ') AS targets FROM (SELECT page_id, html, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1, 'i') AS l FROM pages)""")
def page_links(t):
    """Titles and link targets of pages (SRC-18, SRC-19, TX-20)."""
    found = text.links(F.col("html"))
    return t("pages").select("page_id", text.page_title(F.col("html")).alias("title"), F.size(found).cast("long").alias("links"), F.array_join(found, " ").alias("targets"))


@query("""SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS raw, CAST(c_custkey AS VARCHAR) AS cui FROM customer""")
def company_codes(t):
    """Registration codes without prefix and leading zeros (ST-30)."""
    raw = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    return t("customer").select("c_custkey", raw.alias("raw"), names.company_code(F.concat(F.lit("RO "), raw)).alias("cui"))
