"""Names, organisations and codes as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fold_table() -> tuple[str, str]:
    """Latin letters whose decomposition starts with one ASCII letter, and that letter."""
    pairs = []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(point))
        if len(base) > 1 and base[0].isascii() and all(unicodedata.combining(c) for c in base[1:]):
            pairs.append((chr(point), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _fold_table()

# Titles that are no part of a name.
TITLES = (
    "dr", "drd", "prof", "conf", "lect", "asist", "ing", "ec", "av", "jr", "sr", "gen", "col", "mr", "cpt", "lt", "plt", "slt",
    "mp", "pr", "ps", "phd", "dl", "dna", "d-na", "dlui", "doamna", "domnul",
)

# Words of organisation names that tell no organisation from another.
ORGANISATION_STOP_WORDS = (
    "sa", "srl", "ra", "regia", "autonoma", "compania", "nationala", "national", "societatea",
    "directia", "sanitara", "veterinara", "siguranta", "alimentelor", "pentru", "agentia",
    "ministerul", "minister", "inspectoratul", "scolar", "scolara", "judetean", "judeteana",
    "casa", "primaria", "comuna", "orasul", "oras", "municipiul", "municipiu", "sectorul", "sector",
    "consiliul", "consiliu", "judetul", "din", "prin", "anul", "deputat", "senator", "publica",
    "publice", "serviciul", "serviciu", "oficiul", "administratia", "centrul", "institutul",
    "spitalul", "scoala", "liceul", "gradinita", "colegiul", "transport", "energie", "apa",
    "salubritate", "termice", "locala", "local", "dezvoltare", "exploatare", "intretinere",
    "dsvsa", "dsp", "itm", "isj", "ocpi", "ajofm", "dgaspc", "anpm", "apm", "cas", "cjp", "dgrfp",
    "ajfp", "ansvsa", "cnas", "cnpp",
)

# Party codes and the patterns that name them, in order of precedence.
PARTIES = (
    ("PSD", ("psd", "social democrat")), ("PNL", ("pnl", "national liberal")),
    ("AUR", ("aur", "alianta pentru unirea romanilor")),
    ("USR", ("usr", "uniunea salvati romania", "salvati romania", "plus")),
    ("UDMR", ("udmr", "maghiara", "rmdsz")), ("POT", ("pot", "partidul oamenilor tineri")), ("SOS", ("sos", "s.o.s")),
    ("PMP", ("pmp", "miscarea populara")), ("PRO", ("pro romania",)), ("ALDE", ("alde",)), ("PDL", ("pdl", "democrat liberal")),
    ("PRM", ("prm", "romania mare")), ("PC", ("partidul conservator",)), ("PPDD", ("poporului dan diaconescu", "ppdd")),
    ("UNPR", ("unpr",)), ("FC", ("forta civica",)), ("FD", ("forta dreptei",)), ("PNTCD", ("pntcd", "taranesc crestin")), ("PFN", ("pfn",)),
)


def strip_accents(c: ColumnOrName) -> Column:
    """Accented Latin letters as their base letters; combining marks dropped."""
    return F.regexp_replace(F.translate(_col(c), _FROM, _TO), r"\p{Mn}", "")


def fold(c: ColumnOrName) -> Column:
    """Lower case without accents."""
    return strip_accents(F.lower(_col(c)))


def ascii_fold(c: ColumnOrName) -> Column:
    """Lower case without accents and without anything beyond ASCII."""
    return F.regexp_replace(fold(c), r"[^\x00-\x7F]", "")


def fix_diacritics(c: ColumnOrName) -> Column:
    """Cedilla forms as comma-below forms, accents kept."""
    return F.translate(_col(c), "şŞţŢ", "șȘțȚ")


def name_tokens(c: ColumnOrName) -> Column:
    """Alphabetic tokens of two letters or more, folded, without titles, in order."""
    parts = F.split(fold(c), "[^a-z]+")
    return F.filter(parts, lambda x: (F.length(x) >= 2) & ~x.isin(*TITLES))


def name_key(c: ColumnOrName) -> Column:
    """Key of a name, whatever the order of its parts."""
    return F.array_join(F.array_sort(F.array_distinct(name_tokens(c))), " ")


def canonical_name(c: ColumnOrName) -> Column:
    """Display form: titles dropped, blanks collapsed, each part capitalised."""
    parts = F.split(F.trim(F.regexp_replace(_col(c), r"\s+", " ")), " ")
    kept = F.filter(parts, lambda x: ~F.btrim(fold(x), F.lit(".")).isin("", *TITLES))
    return F.array_join(F.transform(kept, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1_000_000)))), " ")


def split_name(c: ColumnOrName) -> Column:
    """struct(surname, given) where capitals tell the surname, else nulls."""
    parts = F.filter(F.split(F.trim(F.regexp_replace(_col(c), r"\s+", " ")), " "), lambda x: ~F.btrim(fold(x), F.lit(".")).isin("", *TITLES))
    capital = lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) >= 2)
    upper, rest = F.filter(parts, capital), F.filter(parts, lambda x: ~capital(x))
    both = (F.size(upper) > 0) & (F.size(rest) > 0)
    title = lambda a: F.initcap(F.array_join(a, " "))
    return F.struct(F.when(both, title(upper)).alias("surname"), F.when(both, title(rest)).alias("given"))


def org_tokens(c: ColumnOrName) -> Column:
    """Distinct telling words (four letters or more) of an organisation's name, sorted."""
    found = F.regexp_extract_all(ascii_fold(c), F.lit("[a-z]{4,}"), F.lit(0))
    return F.array_sort(F.array_except(F.array_distinct(found), F.array(*map(F.lit, ORGANISATION_STOP_WORDS))))


def party_code(c: ColumnOrName) -> Column:
    """Code of the first party whose code or pattern the name holds; null for none."""
    name = ascii_fold(c)
    out = None
    for code, patterns in PARTIES:
        hit = F.trim(name) == code.lower()
        for p in patterns:
            hit = hit | F.contains(name, F.lit(p))
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return out


def slug(c: ColumnOrName) -> Column:
    """Lower-case ASCII words joined by hyphens."""
    return F.btrim(F.regexp_replace(ascii_fold(c), "[^a-z0-9]+", "-"), F.lit("-"))


def make_id(prefix: str, *parts: ColumnOrName) -> Column:
    """prefix: and the first 16 hex digits of the SHA-256 of the parts joined by |."""
    joined = F.concat_ws("|", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(joined, 256), 1, 16))


def company_code(c: ColumnOrName) -> Column:
    """A registration code without separators, the domestic prefix and leading zeros; foreign prefixes stay."""
    s = F.upper(F.regexp_replace(_col(c), "[^0-9A-Za-z]", ""))
    s = F.when(s.rlike("^RO[0-9]*$"), F.substring(s, 3, 1_000_000)).otherwise(s)
    digits = F.when(F.ltrim(s, F.lit("0")) == "", F.lit("0")).otherwise(F.ltrim(s, F.lit("0")))
    return F.when(s == "", F.lit(None)).when(s.rlike("^[0-9]+$"), digits).otherwise(s)
