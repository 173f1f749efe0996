"""Names told by files, offices and companies, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.names import ascii_fold

# Fixed value: words and numbers of a file's name that are no person's name.
MARKERS = (
    r"(?iU)\b(?:DA|DI|DAI|DAV|DAA|A|I|DECL|DECLARATIE|DECLARATIA|AVERE|AVERI|INTERESE|INTERES|DE|SI|FINAL|FINALA|COPY|COPIE|SEMNAT|SEMNATA|"
    r"ANONIM\w*|REDACT\w*|SCAN\w*|NR|SEM|ACTUALIZ\w*|MODIF\w*|UPDATE|REV|VERSIUNE|FORMULAR|ZILE|LA|DUPA|NUMIRE|NUMARE|INCETARE|INCEPERE|"
    r"EXERCITARE|MANDAT|MANDATULUI|ANUAL\w*|PANA|LUNA|LUNI|CONFORM|ART|LEGEA|DATA|IANUARIE|FEBRUARIE|MARTIE|APRILIE|MAI|IUNIE|IULIE|AUGUST|"
    r"SEPTEMBRIE|OCTOMBRIE|NOIEMBRIE|DECEMBRIE|2\d{3}|20\d\d20\d\d|\d{1,2})\b"
)
# Markers that make a single word a surname, and words that name nobody.
DECLARED = r"(?iU)\b(?:declaratie|avere|interese|da|di|dai)\b"
NOBODY = ("DA BA", "DA", "DI", "FORMULAR", "DECLARATIE", "MODEL", "TEMPLATE", "ANONIM")
# Offices before a name, and the letters a name begins with.
OFFICE = r"(?iU)^(?:Deputat(?:ul|a)?|Senator(?:ul|ea|oarea)?)\b[:\s]*"
LETTER = "[A-Za-zĂÂÎȘȚăâîșț]"
# Words of company names that are no brand.
NO_BRAND = (
    "SOCIETATEA", "COMPANIA", "NATIONALA", "NATIONAL", "REGIA", "AUTONOMA", "SRL", "ROMANA", "ROMANIA", "PENTRU", "TRANSPORT", "ADMINISTRARE",
    "PRODUCERE", "GAZE", "NATURALE", "ENERGIE", "ELECTRICA", "SERVICII", "GRUP", "HOLDING", "FILIALA",
)
MOST_BRANDS = 5


def _words(text: Column) -> Column:
    """Words of two characters or more that begin with a letter."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: (F.length(w) >= 2) & F.rlike(w, F.lit("^" + LETTER)))


def name_of_file(url: Column) -> Column:
    """The person whom the file of a declaration names, in capitals; null for none.

    Separators, single letters, markers and digits go. One word of four letters or more is a surname behind a marker of a declaration only."""
    last = F.substring_index(url, "/", -1)
    plain = F.regexp_replace(F.coalesce(F.try_url_decode(last), last), r"(?i)\.pdf$", "")
    spaced = F.regexp_replace(F.regexp_replace(plain, r"[._\-+]+", " "), rf"(?U)\b{LETTER}\b", " ")
    words = _words(F.regexp_replace(F.regexp_replace(spaced, MARKERS, " "), r"\d", " "))
    name = F.upper(F.array_join(words, " "))
    alone = (F.size(words) == 1) & F.rlike(spaced, F.lit(DECLARED)) & (F.length(name) >= 4)
    return F.when(((F.size(words) >= 2) & (F.length(name) >= 5) | alone) & ~name.isin(*NOBODY), name)


def name_of_office(office: Column) -> Column:
    """The person behind the word for a member of parliament, in capitals; null without that word or with fewer than two words."""
    words = _words(F.trim(F.regexp_replace(office, OFFICE, "")))
    return F.when(F.rlike(office, F.lit(OFFICE)) & (F.size(words) >= 2), F.upper(F.array_join(words, " ")))


def sorted_words(name: Column, least: int = 1) -> Column:
    """The words of a name of ``least`` letters or more without accents, in capitals and sorted, repeats kept."""
    found = F.regexp_extract_all(F.upper(ascii_fold(F.coalesce(name, F.lit("")))), F.lit("[A-Z]{1,}"), F.lit(0))
    return F.array_join(F.array_sort(F.filter(found, lambda w: F.length(w) >= least)), " ")


def brands(name: Column) -> Column:
    """At most five words that may be a company's brand, in lower case and in order: what stands in quotes, the last and the first
    telling word, the last and first pair joined by a hyphen, the two longest."""
    plain = F.upper(ascii_fold(F.coalesce(name, F.lit(""))))
    quoted = F.transform(F.regexp_extract_all(plain, F.lit(r'"([A-Z0-9 \-]{2,30})"'), F.lit(1)), lambda q: F.regexp_replace(q, "[^A-Z0-9]", ""))
    words = F.filter(F.regexp_extract_all(plain, F.lit("[A-Z0-9]{3,}"), F.lit(0)), lambda w: ~w.isin(*NO_BRAND))
    n = F.size(words)
    pair = lambda i: F.when(n >= 2, F.concat(F.get(words, i), F.lit("-"), F.get(words, i + 1)))
    ranked = F.array_sort(F.transform(words, lambda w, i: F.struct((-F.length(w)).alias("n"), i.alias("i"), w.alias("w"))))
    longest = F.transform(F.slice(ranked, 1, 2), lambda x: x["w"])
    told = F.array(F.get(words, n - 1), F.get(words, F.lit(0)), pair(n - 2), pair(F.lit(0)))
    found = F.transform(F.array_compact(F.concat(quoted, told, longest)), lambda w: F.lower(w))
    return F.slice(F.array_distinct(F.filter(found, lambda w: F.length(w).between(3, 28))), 1, MOST_BRANDS)
