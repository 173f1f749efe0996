"""Half-structured answers of registers, and names in the order and equality of a language."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import paths
from vitrine.functions.names import fold
from vitrine.plans.registry import query

# Parts of a register's state of a company and the status they mean, in order.
STATES = (("RADIAT", "STRUCK_OFF"), ("INREGISTRAT", "ACTIVE"), ("INREGISTRARE", "ACTIVE"))


def _entry():
    """An event as a register's answer, with steps missing, null, empty or of another kind."""
    k = F.col("event_id")
    flag = (
        F.when(k % 6 == 1, F.lit('{"statusInactivi": true}')).when(k % 6 == 2, F.lit('{"statusInactivi": false}')).when(k % 6 == 3, F.lit("null"))
        .when(k % 6 == 4, F.lit('{"statusInactivi": ""}')).when(k % 6 == 5, F.lit('{"statusInactivi": 1}'))
    )
    state = F.when(k % 4 == 0, F.lit("INREGISTRAT din data 1990")).when(k % 4 == 1, F.lit("radiat din 2001")).when(k % 4 == 2, F.lit("transfer"))
    general = F.to_json(
        F.struct(F.col("user_id").alias("cui"), F.concat(F.lit("  Firma "), F.col("event_type")).alias("denumire"), F.when(k % 3 == 0, F.lit(" ")).otherwise(F.lit("J1/2")).alias("nrRegCom"), state.alias("stare_inregistrare"))
    )
    part = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    vat = F.when(k % 5 == 0, F.lit('{"scpTVA": true}')).when(k % 5 == 1, F.lit('{"scpTVA": "no boolean"}')).when(k % 5 == 2, F.lit("[]"))
    parts = F.concat_ws(
        ", ", part("stare_inactiv", flag), F.when(k % 7 != 0, part("date_generale", general)), part("inregistrare_scop_Tva", vat), F.when(k % 8 != 0, part("props", F.col("props"))), part("value", F.col("value").cast("string"))
    )
    return F.when(k % 97 == 0, F.lit("{broken")).otherwise(F.concat(F.lit("{"), parts, F.lit("}")))


@query("""SELECT event_id, CASE WHEN ok AND event_id % 7 <> 0 THEN user_id ELSE -1 END AS cui, CASE WHEN ok AND event_id % 7 <> 0 THEN 'Firma ' || event_type END AS name,
    CASE WHEN ok AND event_id % 7 <> 0 AND event_id % 3 <> 0 THEN 'J1/2' END AS reg_com,
    CASE WHEN ok AND event_id % 6 IN (1, 5) THEN 'INACTIVE' WHEN ok AND event_id % 7 <> 0 AND event_id % 4 = 0 THEN 'ACTIVE' WHEN ok AND event_id % 7 <> 0 AND event_id % 4 = 1 THEN 'STRUCK_OFF' ELSE 'UNKNOWN' END AS status,
    CASE WHEN ok AND event_id % 5 = 0 THEN true END AS vat_payer, CASE WHEN ok AND event_id % 8 <> 0 THEN coalesce((props->>'$.k')::BIGINT, 0) ELSE 0 END AS k
    FROM (SELECT *, event_id % 97 <> 0 AS ok FROM events)""")
def register_answers(t):
    """Every event as a register's nested answer, read by paths with defaults (TX-18)."""
    found = t("events").select("event_id", paths.document(_entry()).alias("d"))
    d = F.col("d")
    return found.select(
        "event_id",
        paths.at(d, "$.date_generale.cui", "$.cui", kind="bigint", default=-1).alias("cui"),
        paths.clean(d, "$.date_generale.denumire").alias("name"),
        paths.clean(d, "$.date_generale.nrRegCom").alias("reg_com"),
        F.when(paths.truthy(d, "$.stare_inactiv.statusInactivi"), "INACTIVE").otherwise(paths.mapped(paths.at(d, "$.date_generale.stare_inregistrare"), STATES, "UNKNOWN")).alias("status"),
        paths.at(d, "$.inregistrare_scop_Tva.scpTVA", kind="boolean").alias("vat_payer"),
        paths.at(d, "$.props.k", "$.k", kind="bigint", default=0).alias("k"),
    )


def _label(t):
    """The first three words of every document, as a label."""
    return t("documents").select("doc_id", F.array_join(F.slice(F.split(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")), " "), 1, 3), " ").alias("label"))


_LABEL = r"label AS (SELECT doc_id, array_to_string(string_split(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), ' ')[1:3], ' ') AS label FROM documents)"


@query(f"WITH {_LABEL} SELECT doc_id, label FROM label ORDER BY label COLLATE ro, doc_id LIMIT 150")
def labels_in_order(t):
    """The first 150 labels in a language's order, in which accents and case only decide between equal words (TK-12)."""
    return _label(t).orderBy(F.collate("label", "ro"), "doc_id").limit(150)


@query(f"""WITH {_LABEL}, w AS (SELECT doc_id, unnest(string_split(label, ' ')) AS word FROM label)
    SELECT lower(strip_accents(word)) AS folded, count(*) AS n, count(DISTINCT word) AS spellings FROM w WHERE word <> '' AND regexp_matches(word, '^[a-zA-ZàâäéèêëîïôöùûüçÀÂÄÉÈÊËÎÏÔÖÙÛÜÇ]+$') GROUP BY 1""")
def spellings(t):
    """Words of the labels that are equal but for accents and case, by a collated column (FLT-03, TK-12)."""
    word = _label(t).select(F.explode(F.split("label", " ")).alias("word")).where(F.col("word").rlike("^[a-zA-ZàâäéèêëîïôöùûüçÀÂÄÉÈÊËÎÏÔÖÙÛÜÇ]+$"))
    per = word.groupBy(F.collate("word", "UNICODE_CI_AI").alias("same")).agg(F.count("*").alias("n"), F.countDistinct("word").alias("spellings"))
    return per.select(fold(F.collate("same", "UTF8_BINARY")).alias("folded"), "n", "spellings")
