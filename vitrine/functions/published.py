"""Published papers: reports of parties, pages of bills and motions, curricula, as column expressions.

Null papers are read as empty: no finding, empty arrays and texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.dates import day_month_year
from vitrine.functions.dialects import comma_number
from vitrine.functions.names import party_code

# What a report speaks of, and parts of words that tell it.
REPORT_KINDS = (
    ("cotizatii", ("cotiza",)), ("donatii", ("dona",)), ("imprumuturi", ("imprumut", "împrumut")), ("subventii", ("subven",)),
    ("cheltuieli", ("cheltuiel",)), ("venituri_totale", ("venituri ob", "veniturilor ob", "total venituri")),
)
# Where a report names its party, its year, its sums and who signs it; year and sums are read in lower case.
PARTY, PARTY_IN_HEAD = r"Denumirea partidului politic:\s*([^<\n]+)", r'S_EMT_BDY">\s*<li>([^<]+)'
YEAR, ANY_YEAR = r"(?U)(?:primite|ob[țt]inut\w*|cheltuiel\w*|sumele primite)\D{0,30}anul\s+(\d{4})", r"(?U)\banul\s+(\d{4})"
TABLE_TOTAL = r"[Cc]uantumul total\s*\|\s*([\d.]+,\d{2})"
INCOME = r"(?:total venituri|cuantumul total al veniturilor)\D{0,40}?([\d.]+,\d{2})"
SPENDING = r"(?:total cheltuieli|cuantumul total al cheltuielilor)\D{0,40}?([\d.]+,\d{2})"
SIGNATORY = r"reprezentantului legal\s*\|?\s*([A-ZȘȚĂÂÎ][^|<\n]{3,60}?)\s*(?:\||<|\z)"
# A note of publication in the gazette, its number and its date.
PUBLISHED, NUMBER, DATED = r"MONITORUL OFICIAL nr\. \d+ din [^<]+", r"nr\.?\s*(\d+)", r"(?iu)din\s+(\d{1,2})\s+([a-zăâîșţț]+)\s+(\d{4})"
# Links to the initiators of a bill, the line that counts them, the government.
INITIATOR, INITIATORS, COUNTED, GOVERNMENT = r"structura\w*\.mp\?[^\"']*idm=(\d+)", r"Initiator:\s*([^<\n]{0,120})", r"(\d+)\s+deputati", r"[Gg]uvernul"
# Fields of a page about a motion.
TITLE, DAY = r"Titlu\s*:?\s*([^|]{6,180}?)\s*(?:Data|Tip|Ini[tţ]iator)", r"(\d{2}\.\d{2}\.\d{4})"
OUTCOME = r"(?iu)(Adoptat[ăa]|Respins[ăa]|Dezbatere|Retras[ăa])"
FOR, AGAINST = r"(?iu)pentru mo[tţ]iune\D{0,8}(\d+)", r"(?iuU)[iî]mpotriv\w*\D{0,8}(\d+)"
# The kinds of a bill's papers by the letters that begin their file's name.
PAPERS = {
    "em": "expunere_motive", "pl": "forma_initiator", "csm": "aviz_csm", "cl": "aviz_consiliu_legislativ", "gv": "punct_vedere_guvern",
    "av": "aviz_comisie", "rp": "raport", "rs": "raport_suplimentar", "rd": "raport", "se": "sesizare", "ce": "cerere", "pvc": "proces_verbal",
}
# Lines of a curriculum about education and experience; the second of each pair is for pages with menus.
EDUCATION = (
    r"(?iu)(studii|educa[țt]i|formare|absolv|facult|universit|licen[țt]|master|doctor|colegiu|liceu|diplom|specializ|academ)",
    r"(?iuU)(universitat\w*|facultat\w*|absolvit|licen[țt]iat|masterat|master[au]?l? (?:[îiI]n|de|la)|doctor(?:at|and)|diplom[ăa] de|[îi]nv[ăa][țt][ăa]m[âa]nt superior|academia)\s+[A-ZȘȚĂÂÎ\"]",
)
EXPERIENCE = (
    r"(?iu)(experien[țt]|activitate profesional|funct|angajator|perioad|director|manager|[șs]ef |consilier|inginer|economist|\d{4}\s*[-–]\s*\d{4}|\d{4}\s*[-–]\s*prezent)",
    r"(?iu)(\d{4}\s*[-–]\s*(?:\d{4}|prezent)|perioad[ăa]\s*:?\s*\d|func[țt]ia\s*:?\s*[A-ZȘȚĂÂÎ]|director (?:general|executiv|adjunct))",
)
# What the words of the first of each pair begin with, looked at before the words are tried.
_FIRST = ("sefaulmdc", r"eafpdmsșci\d")
SHORTEST, LONGEST_LINE, LONGEST_LINE_OF_PAGE, SHORTEST_LINE_OF_PAGE, LONGEST = 120, 200, 220, 15, (1400, 1600)


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _found(text: Column, pattern: str) -> Column:
    """The first group of the first match; null without one."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def table_text(html: Column) -> Column:
    """The text of a page with " | " after each cell and a new line after each row; styles and scripts dropped."""
    plain = F.regexp_replace(_given(html), r"(?s)<style.*?</style>|<script.*?</script>", " ")
    rows = F.replace(F.replace(plain, F.lit("</td>"), F.lit(" | ")), F.lit("</tr>"), F.lit("\n"))
    return F.replace(F.regexp_replace(rows, "<[^>]+>", " "), F.lit("\u00a0"), F.lit(" "))


def publication(note: Column) -> Column:
    """struct(number, year, date) of a note such as "Monitorul Oficial nr. 391 din 30 aprilie 2025"; null parts where it has none."""
    day, month, year = (F.regexp_extract(note, DATED, i) for i in (1, 2, 3))
    return F.struct(_found(note, NUMBER).try_cast("int").alias("number"), year.try_cast("int").alias("year"), day_month_year(day, month, year).alias("date"))


def party_report(html: Column) -> Column:
    """struct(party, code, year, kinds, income, spending, signatory, gazette, published) of a party's report.

    The income is the last total of the central table if the report has one, else the first sum behind the words for it."""
    return _let(_given(html), lambda page: _let(table_text(page), lambda flat: _report(page, flat)))


def _report(page: Column, flat: Column) -> Column:
    def read(low: Column, line: Column) -> Column:
        totals = F.regexp_extract_all(flat, F.lit(TABLE_TOTAL), F.lit(1))
        central = F.when(_any(low, ("situa",)) & _any(low, ("centraliz",)) & _any(low, ("venitur",)), comma_number(F.get(totals, F.size(totals) - 1)))
        return F.struct(
            F.coalesce(_found(low, YEAR), _found(line, ANY_YEAR)).cast("int").alias("year"), F.array_compact(F.array(*[F.when(_any(low, parts), F.lit(kind)) for kind, parts in REPORT_KINDS])).alias("kinds"),
            F.coalesce(central, comma_number(_found(low, INCOME))).alias("income"), comma_number(_found(low, SPENDING)).alias("spending"),
        )

    def party(name: Column) -> Column:
        return F.struct(name.alias("name"), party_code(name).alias("code"))

    def joined(all_: Column) -> Column:
        who, of, note = all_["party"], all_["line"], all_["note"]
        signatory = F.trim(F.regexp_replace(_found(flat, SIGNATORY), r"\s+", " "))
        return F.struct(
            who["name"].alias("party"), who["code"].alias("code"), of["year"].alias("year"), of["kinds"].alias("kinds"), of["income"].alias("income"),
            of["spending"].alias("spending"), signatory.alias("signatory"), note["number"].alias("gazette"), note["date"].alias("published"),
        )

    named = F.trim(F.coalesce(_found(page, PARTY), _found(page, PARTY_IN_HEAD), F.lit("")))
    parts = F.struct(
        _let(named, party).alias("party"), _let(F.regexp_replace(flat, r"[ \t]+", " "), lambda line: _let(F.lower(line), lambda low: read(low, line))).alias("line"), _let(F.regexp_extract(page, PUBLISHED, 0), publication).alias("note")
    )
    return _let(parts, joined)


def bill(html: Column) -> Column:
    """struct(initiators, n_initiators, government, line) of a bill's page.

    Initiators are the different ids of its links, as texts in order; their number is the one the page states, else theirs. The
    government is looked for up to 400 characters behind the first "Initiator", or in the first 3000 without it."""
    page = F.replace(F.replace(_given(html), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
    ids = F.array_sort(F.array_distinct(F.regexp_extract_all(page, F.lit(INITIATOR), F.lit(1))))
    line = F.trim(F.regexp_replace(_given(_found(page, INITIATORS)), r"\s+", " "))
    at = F.instr(page, F.lit("Initiator"))
    start = F.substring(page, F.lit(1), F.when(at > 0, at - 1 + 400).otherwise(3000))
    n = F.coalesce(_found(line, COUNTED).try_cast("int"), F.size(ids))
    return F.struct(ids.alias("initiators"), n.alias("n_initiators"), F.rlike(start, F.lit(GOVERNMENT)).alias("government"), line.alias("line"))


def motion(html: Column) -> Column:
    """struct(title, day, outcome, votes_for, votes_against, paper) of a motion's page; paper is its first link to a PDF."""
    page = _given(html)
    body = F.regexp_replace(F.regexp_replace(page, "<[^>]+>", " "), r"\s+", " ")
    outcome = F.lower(_found(body, OUTCOME))
    return F.struct(
        F.trim(_given(_found(body, TITLE))).alias("title"), F.try_to_date(_found(body, DAY), "dd.MM.yyyy").alias("day"),
        F.concat(F.upper(F.substring(outcome, 1, 1)), F.substring(outcome, 2, 100)).alias("outcome"),
        _found(body, FOR).try_cast("int").alias("votes_for"), _found(body, AGAINST).try_cast("int").alias("votes_against"),
        _found(page, r'(?i)<a\s[^>]*?href="([^"]*\.pdf)"').alias("paper"),
    )


def paper_kind(url: Column) -> Column:
    """The kind of a bill's paper by the letters before the first digit of its file's name; "alt" for others."""
    kinds = F.create_map(*[F.lit(x) for pair in PAPERS.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, F.regexp_extract(F.lower(F.substring_index(_given(url), "/", -1)), r"^([a-z]+)\d", 1)), F.lit("alt"))


def _lines(lines: Column, pattern: str, longest: int, most: int) -> Column:
    hit = F.transform(F.filter(lines, lambda x: F.rlike(x, F.lit(pattern))), lambda x: F.substring(x, 1, longest))
    return F.substring(F.array_join(F.array_distinct(hit), " | "), 1, most)


def curriculum(text: Column) -> Column:
    """struct(status, education, experience) of a curriculum's text: its different lines about each, in order, joined by bars.

    Texts below 120 characters are "scanned" and have neither."""
    given = _given(text)
    lines = F.filter(F.transform(F.split(given, r"\R"), lambda x: F.trim(x)), lambda x: x != "")
    read = F.length(given) >= SHORTEST
    asked = (p[0].replace("(?iu)", f"(?iu)(?=[{first}])", 1) for p, first in zip((EDUCATION, EXPERIENCE), _FIRST))
    parts = (_lines(lines, p, LONGEST_LINE, most) for p, most in zip(asked, LONGEST))
    education, experience = (F.when(read, p).otherwise("") for p in parts)
    return F.struct(F.when(read, "ok").otherwise("scanned").alias("status"), education.alias("education"), experience.alias("experience"))


def curriculum_page(html: Column) -> Column:
    """struct(education, experience) of a page, by the stricter patterns and lines above 15 characters outside menus, heads and feet; null if it has neither."""
    body = F.regexp_replace(F.regexp_replace(_given(html), r"(?is)<(script|style|nav|header|footer)[^>]*>.*?</\1>", " "), "<[^>]+>", "\n")
    lines = F.filter(F.transform(F.split(F.regexp_replace(body, r"[ \t]+", " "), r"\R"), lambda x: F.trim(x)), lambda x: F.length(x) > SHORTEST_LINE_OF_PAGE)
    education, experience = (_lines(lines, p[1], LONGEST_LINE_OF_PAGE, most) for p, most in zip((EDUCATION, EXPERIENCE), LONGEST))
    return F.when((education != "") | (experience != ""), F.struct(education.alias("education"), experience.alias("experience")))
