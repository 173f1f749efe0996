"""Dates with month names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.names import fold

# Month names and abbreviations.
MONTHS = {
    "ian": 1, "ianuarie": 1, "feb": 2, "februarie": 2, "mar": 3, "mart": 3, "martie": 3, "apr": 4, "aprilie": 4, "mai": 5,
    "iun": 6, "iunie": 6, "iul": 7, "iulie": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "septembrie": 9,
    "oct": 10, "octombrie": 10, "noi": 11, "nov": 11, "noiembrie": 11, "dec": 12, "decembrie": 12,
}


def month_number(name: Column) -> Column:
    """Number of a month by its name, abbreviation or first three letters; null for none."""
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    key = F.rtrim(fold(name), F.lit("."))
    return F.coalesce(months[key], months[F.substring(key, 1, 3)])


def day_month_year(day: Column, month: Column, year: Column) -> Column:
    """The date, null where there is none (31 February)."""
    text = F.format_string("%04d-%02d-%02d", year.try_cast("int"), month_number(month), day.try_cast("int"))
    return F.when(month_number(month).isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def iso_or_dotted(c: Column) -> Column:
    """yyyy-mm-dd, dd.mm.yyyy or dd/mm/yyyy."""
    s = F.substring(F.trim(c), 1, 10)
    return F.coalesce(
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd")),
        F.try_to_date(F.regexp_replace(s, "/", "."), "d.M.yyyy"),
    )
