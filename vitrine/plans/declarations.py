"""Declarations of interests read from whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.sections import ENTITY, FORM, NUMBERED, SECTIONS, SENTENCES, interests
from vitrine.functions.wealth import declaration_kinds, wealth, wealth_ocr
from vitrine.plans.registry import query

#: Headings as a form prints them, one for each section, in another order than the sections have.
_HEADINGS = ("5. Contracte, inclusiv cele de asistență juridică", "1. Asociat sau acționar la societăți comerciale", "4. Membru al partidelor politice", "2. Calitatea de membru în organele de conducere", "3. Membru în cadrul asociațiilor profesionale și/sau sindicale")
_BOILER = ("unde este cazul",)


def _text():
    """Sentences of a document as the lines of a form: headings, rows, firms, lines of the form itself."""
    sentence = F.transform(F.split(F.coalesce("text", F.lit("")), r"[.\n]+"), lambda s: F.trim(s))
    heading = F.array(*map(F.lit, _HEADINGS))
    line = lambda s, i: (
        F.when(i % 9 == 3, F.element_at(heading, ((i / 9).cast("int") + F.col("doc_id") % 3).cast("int") % 5 + 1))
        .when(i % 9 == 4, F.concat(F.lit("1.1 "), s))
        .when(i % 9 == 5, F.concat(F.lit("- SC "), F.substring(s, 1, 20), F.lit(" SRL, 1.500,75 lei")))
        .when(i % 9 == 6, F.lit("Unitatea - denumirea și adresa"))
        .when(i % 9 == 7, F.lit("Unde  este cazul"))
        .otherwise(s)
    )
    return F.array_join(F.transform(sentence, lambda s, i: line(s, i)), "\n")


def _sql_any(text: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in parts) + ")"


_FOLD = "lower(strip_accents({0}))"
_SQL = f"""WITH s AS (SELECT doc_id, row_number() OVER () AS id, list_transform(regexp_split_to_array(coalesce(text, ''), '[.\\n]+'), lambda x: trim(x)) AS s FROM documents),
    l AS (SELECT doc_id, id, unnest(range(len(s))) AS i, unnest(s) AS s FROM s),
    r AS (SELECT doc_id, id, i, CASE i % 9 WHEN 3 THEN {list(_HEADINGS)}[(i // 9 + doc_id % 3) % 5 + 1] WHEN 4 THEN '1.1 ' || s
      WHEN 5 THEN '- SC ' || substr(s, 1, 20) || ' SRL, 1.500,75 lei' WHEN 6 THEN 'Unitatea - denumirea și adresa' WHEN 7 THEN 'Unde  este cazul' ELSE s END AS raw FROM l),
    t AS (SELECT id, length(trim(string_agg(raw, chr(10) ORDER BY i))) >= 80 AS enough FROM r GROUP BY 1),
    a AS (SELECT *, trim(raw, ' -•' || chr(9) || '|') AS line FROM r),
    b AS (SELECT *, trim(regexp_replace({_FOLD.format("line")}, '\\s+', ' ', 'g')) AS spaced, replace({_FOLD.format("line")}, ' ', '') AS bare FROM a),
    f AS (SELECT *, length(spaced) < 4 OR {_sql_any("replace(spaced, ' ', '')", FORM)} OR spaced IN ('{"', '".join(_BOILER)}') AS form,
      len(string_split(spaced, ' ')) > 12 OR {_sql_any("spaced", SENTENCES)} AS long FROM b),
    e AS (SELECT *, regexp_matches(line, '{ENTITY}') AND NOT long AND NOT form AS entity, regexp_matches(line, '{NUMBERED}') AND NOT form AS numbered FROM f),
    hit AS ({" UNION ALL ".join(f"SELECT id, {k} AS k, min(i) AS start FROM b WHERE {_sql_any('bare', p)} GROUP BY 1" for k, (_, p) in enumerate(SECTIONS))}),
    begins AS (SELECT id, start, max(k) AS k FROM hit GROUP BY 1, 2),
    inside AS (SELECT e.*, k FROM e ASOF JOIN begins ON e.id = begins.id AND e.i >= begins.start WHERE e.i <> begins.start),
    named AS (SELECT id, list_sort(list_distinct(list(substr(line, 1, 80)))) AS entities FROM (SELECT * FROM inside WHERE entity QUALIFY row_number() OVER (PARTITION BY id ORDER BY i) <= 60) GROUP BY 1),
    c AS (SELECT id, {", ".join(f"count(*) FILTER (WHERE k = {k} AND (entity OR numbered)) AS {name}" for k, (name, _) in enumerate(SECTIONS))},
      sum(CASE WHEN k = 0 AND contains(line, '1.500,75 lei') THEN 1500.75::DOUBLE ELSE 0 END) AS shares,
      sum(CASE WHEN k = 4 AND contains(line, '1.500,75 lei') THEN 1500.75::DOUBLE ELSE 0 END) AS contracts FROM inside GROUP BY 1)
    SELECT doc_id, enough AS text_extracted, {", ".join(f"CASE WHEN enough THEN coalesce({name}, 0) ELSE 0 END AS {name}" for name, _ in SECTIONS)},
      CASE WHEN enough THEN coalesce(shares, 0) ELSE 0 END AS shares, CASE WHEN enough THEN coalesce(contracts, 0) ELSE 0 END AS contracts_lei,
      CASE WHEN enough THEN coalesce(entities, []) ELSE [] END AS entities, enough AND coalesce({" + ".join(name for name, _ in SECTIONS)}, 0) > 0 AS has_any
    FROM (SELECT DISTINCT doc_id, id FROM s) JOIN t USING (id) LEFT JOIN c USING (id) LEFT JOIN named USING (id)"""


@query(_SQL)
def interest_sections(t):
    """Sections, rows, amounts and entities of every document rewritten as a declaration of interests (TX-05, TX-01)."""
    read = t("documents").select("doc_id", interests(_text(), _BOILER).alias("d"))
    return read.select("doc_id", "d.text_extracted", "d.counts.*", F.col("d.amounts.actionariat").alias("shares"), F.col("d.amounts.contracte").alias("contracts_lei"), "d.entities", "d.has_any")


def _wealth_text():
    """A declaration of wealth with a document's text between its sections and numbers from the document's number."""
    n = F.col("doc_id")
    body = F.regexp_replace(F.substring(F.coalesce("text", F.lit("")), 1, 4000), r"[0-9]", "")
    grouped = F.replace(F.format_number(n * 1001 + 1500, 0), F.lit(","), F.lit("."))
    s = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return s(
        F.when(n % 5 == 0, F.lit("Declarație de avere\n")).when(n % 5 == 1, F.lit("Declaratie de interese, organele de conducere\n")).otherwise(F.lit("Act\n")), body,
        "\nI. Bunuri imobile\n1. Terenuri\nIlfov 1.250 m², Cluj ", (n % 9).cast("string"), " mp\n2. Clădiri\nBucurești 80,5 m²\n",
        "II. Bunuri mobile\nautoturism Dacia, ", F.when(n % 2 == 0, F.lit("Tractor U650, ")).otherwise(F.lit("")), "remorcă\nIII. Bunuri mobile\nceas 9.000 lei\n",
        "IV. Active financiare\ncont ", grouped, " lei; depozit 200 EUR; 50 lei\nV. Datorii\ncredit ", grouped, ",50 RON\nVI. Cadouri\n500 lei\nVII. Venituri\nsalariu ", grouped, ",25 lei; ", (n % 100).cast("string"), " lei\n",
    )


@query("""SELECT doc_id, true AS text_extracted, false AS needs_ocr, 2 AS land, 1 AS buildings, 1330.5::DOUBLE + CASE WHEN doc_id % 9 > 5 THEN doc_id % 9 ELSE 0 END AS area,
    doc_id * 1001 + 2510.0::DOUBLE AS accounts, doc_id * 1001 + 1500.25::DOUBLE AS income, doc_id * 1001 + 1500.5::DOUBLE AS debts, CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 2 END AS vehicles,
    CASE WHEN doc_id % 5 = 1 THEN ['avere', 'interese'] ELSE ['avere'] END AS kinds FROM documents""")
def wealth_declarations(t):
    """The aggregates of every document written as a declaration of wealth, and what kinds it holds (TX-02, TX-06)."""
    read = t("documents").select("doc_id", _wealth_text().alias("d"))
    return read.select("doc_id", F.inline(F.array(wealth(F.col("d")))), declaration_kinds(F.col("d")).alias("kinds"))


@query("""SELECT doc_id, true AS text_extracted, 3 AS land, doc_id * 1001 + 1500.0::DOUBLE AS accounts, doc_id * 1001 + 1500.25::DOUBLE AS income, CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 2 END AS vehicles FROM documents""")
def wealth_recognised(t):
    """The same from text without currencies, accents and case (TX-03)."""
    noisy = F.regexp_replace(F.upper(F.replace(_wealth_text(), F.lit("Cluj "), F.lit("Cluj 1"))), "LEI|EUR|RON", "l3i")
    read = t("documents").select("doc_id", wealth_ocr(noisy).alias("d"))
    return read.select("doc_id", "d.*")
