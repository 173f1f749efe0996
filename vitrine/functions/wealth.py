"""Declarations of wealth: what a document is, the sums and counts of its sections, also from noisy recognised text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.dialects import areas, grouped_sum
from vitrine.functions.names import strip_accents
from vitrine.functions.numbers import amounts_in
from vitrine.functions.text import section

# The numbered headings of the form, in order, and its two kinds of property.
HEADINGS = ("I. Bunuri imobile", "II. Bunuri mobile", "III. Bunuri mobile", "IV. Active financiare", "V. Datorii", "VI. Cadouri", "VII. Venituri")
LAND, BUILDINGS, INCOME = "1. Terenuri", "2. Clădiri", "Venituri ale declarantului"
# How words for vehicles begin, as printed and as recognised.
VEHICLES = r"(?iU)\b(?:autoturism|autovehicul|motociclet|tractor|remorc|iaht|şalup|salup)\w*"
VEHICLES_OCR = "autoturism|autovehic|motociclet|tractor|remorc"
# Fixed value: an area in recognised text.
AREA_OCR = r"(?i)\d{2,5}(?:[.,]\d+)?\s*(?:m\s*2|m2|mp|rn2|m²|ha)(?![\p{L}\p{N}_])"
# Phrases without blanks that tell what a document is.
KINDS = (
    ("avere", ("declaratiedeavere", "bunuriimobile", "activefinanciare")),
    ("interese", ("declaratiedeinterese", "asociatsauactionar", "organeledeconducere")),
)
SHORTEST, SHORTEST_OCR = 100, 80


def declaration_kinds(text: Column) -> Column:
    """Which declarations a document holds: avere, interese, both or none, as a sorted array."""
    bare = F.replace(F.lower(strip_accents(F.coalesce(text, F.lit("")))), F.lit(" "), F.lit(""))
    found = [F.when(reduce(lambda a, b: a | b, [F.contains(bare, F.lit(p)) for p in phrases]), F.lit(kind)) for kind, phrases in KINDS]
    return F.array_compact(F.array(*found))


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def wealth(text: Column) -> Column:
    """struct(text_extracted, needs_ocr, land, buildings, area, accounts, income, debts, vehicles) of a printed declaration.

    Areas (square metres, those above 5) are of the land and the buildings of section I, amounts (lei, those above 100) of the
    sections for accounts, debts and income; a section ends at the next heading. Null and texts below 100 characters are not
    extracted and need recognition; all values are 0 then."""
    given = F.coalesce(text, F.lit(""))
    enough = F.length(F.trim(given)) >= SHORTEST
    part = lambda heading: section(given, heading, list(HEADINGS))
    property_ = part(HEADINGS[0])
    land, buildings = areas(section(property_, LAND, [BUILDINGS, HEADINGS[1]])), areas(section(property_, BUILDINGS, [HEADINGS[1]]))
    income = F.coalesce(F.nullif(part(HEADINGS[6]), F.lit("")), part(INCOME))
    values = {
        "land": land["n"],
        "buildings": buildings["n"],
        "area": land["total"] + buildings["total"],
        "accounts": amounts_in(part(HEADINGS[3])),
        "income": amounts_in(income),
        "debts": amounts_in(part(HEADINGS[4])),
        "vehicles": _count(part(HEADINGS[1]), VEHICLES).cast("long"),
    }
    return F.struct(enough.alias("text_extracted"), (~enough).alias("needs_ocr"), *[F.when(enough, v).otherwise(0).alias(k) for k, v in values.items()])


def wealth_ocr(text: Column) -> Column:
    """struct(text_extracted, land, accounts, income, vehicles) of recognised text, where currencies and headings are broken.

    Sections are told by their words alone, sums are of numbers in groups of three above 1000."""
    given = F.coalesce(text, F.lit(""))
    enough = F.length(F.trim(given)) >= SHORTEST_OCR
    plain = F.lower(strip_accents(given))
    values = {
        "land": _count(section(plain, "bunuri imobile", ["bunuri mobile", "active financiare", "datorii"]), AREA_OCR).cast("long"),
        "accounts": grouped_sum(section(plain, "active financiare", ["datorii", "venituri", "bunuri", "cadouri"]), 1000.0),
        "income": grouped_sum(section(plain, "venituri", ["prezenta", "raspundere", "intocmit", "semnatura"]), 1000.0),
        "vehicles": _count(section(plain, "bunuri mobile", ["active financiare", "bunuri imobile"]), VEHICLES_OCR).cast("long"),
    }
    return F.struct(enough.alias("text_extracted"), *[F.when(enough, v).otherwise(0).alias(k) for k, v in values.items()])


def board_lines(text: Column) -> Column:
    """The lines of more than three characters below the heading of the governing bodies, up to the next heading."""
    part = section(F.coalesce(text, F.lit("")), "organele de conducere", ["calitatea de membru în", "alte contracte", "Prezenta declaratie", "VII."])
    lines = F.transform(F.split(part, "\r\n|\n|\r"), lambda x: F.btrim(x, F.lit(" -•\t")))
    return F.filter(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.length(x) > 3)
