"""Elements of all pages by a walk over their tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.plans.registry import query
from vitrine.sources.pages import below_headings, elements

_TOKENS = """x AS (SELECT page_id, unnest(range(len(x))) AS i, unnest(x) AS x FROM (SELECT page_id,
      regexp_extract_all(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'g'), '<h[1-6][\\s>]|<a\\s[^>]*href="[^"]*"[^>]*>') AS x FROM pages)),
    n AS (SELECT *, x LIKE '<h%' AS heading, count(*) FILTER (WHERE x LIKE '<h%') OVER (PARTITION BY page_id ORDER BY i) AS heading_no FROM x)"""


@query(f"""WITH {_TOKENS} SELECT page_id, i AS pos, replace(regexp_extract(x, 'href="([^"]*)"', 1), '&amp;', '&') AS target, heading_no FROM n WHERE NOT heading""")
def links_below_headings(t):
    """All links of all pages with the nearest heading before them (SRC-18, SRC-20)."""
    found = elements(t("pages").select("page_id", "html"))
    return below_headings(found.where("kind IN ('link', 'heading')"), "page_id").select("page_id", "pos", "target", "heading_no")


@query(f"""WITH {_TOKENS} SELECT page_id, count(*) FILTER (WHERE NOT heading) AS links, count(DISTINCT regexp_extract(x, 'href="([^"]*)"', 1)) FILTER (WHERE NOT heading) AS targets,
    count(*) FILTER (WHERE heading) AS headings FROM n GROUP BY 1""")
def page_profiles(t):
    """Links, distinct targets and headings of every page that has any (SRC-18)."""
    found = elements(t("pages").select("page_id", "html")).groupBy("page_id")
    kind = lambda k: F.col("kind") == k
    return found.agg(F.count_if(kind("link")).alias("links"), F.countDistinct(F.when(kind("link"), F.col("target"))).alias("targets"), F.count_if(kind("heading")).alias("headings")).where("links + headings > 0")
