"""Further dialects of numbers, dates, names and declarations, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.names import fold
from vitrine.functions.numbers import parse_number


def strict_number(c: Column) -> Column:
    """A number in groups of three after dots with a decimal comma, the whole text; else null."""
    whole = c.rlike(r"^-?\d{1,3}(\.\d{3})*(,\d+)?$")
    return F.when(whole, F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"))


def comma_number(c: Column) -> Column:
    """A number whose dots are dropped and whose comma is the point; else null."""
    return F.replace(F.replace(F.trim(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def digits_number(c: Column) -> Column:
    """The digits of a text as a whole number; null without any."""
    return F.nullif(F.regexp_replace(c, r"\D", ""), F.lit("")).try_cast("long")


def grouped_sum(text: Column, least: float) -> Column:
    """Sum of the numbers in groups of three after dots or blanks that exceed ``least``, with one or two decimals after a comma."""
    found = F.regexp_extract_all(text, F.lit(r"\d{1,3}(?:[.\s]\d{3})+(?:,\d{1,2})?"), F.lit(0))
    values = F.transform(found, lambda x: F.replace(F.regexp_replace(x, r"[.\s]", ""), F.lit(","), F.lit(".")).cast("double"))
    return F.aggregate(F.filter(values, lambda v: v > least), F.lit(0.0), lambda a, v: a + v)


def areas(text: Column) -> Column:
    """(count, total) of the areas that a text names as a number and m: all are counted, those above 5 square metres added up."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)(\d{1,5}(?:[.,]\d+)?)\s*m\s*²?"), F.lit(1))
    values = F.filter(F.transform(found, lambda x: parse_number(x, "groups")), lambda v: v > 5)
    return F.struct(F.size(found).cast("long").alias("n"), F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("total"))


def _fixed(x: Column, decimals: int) -> Column:
    """A number from 0 to below 1000 with 0 or 1 decimals, rounded by its exact binary value, ties to even (Spark's formatting
    rounds the shortest decimal that stands for it, half up). From 1000 on Spark's own."""
    bits = 52
    mask, half = (1 << bits) - 1, 1 << (bits - 1)
    units = (x * float(1 << bits)).try_cast("long")  # exact below 1000
    whole, part = F.shiftright(units, bits), units.bitwiseAND(F.lit(mask)) * 10**decimals
    digit, rest = F.shiftright(part, bits), part.bitwiseAND(F.lit(mask))
    n = whole * 10**decimals + digit
    n = n + F.when((rest > half) | ((rest == half) & (n % 2 == 1)), 1).otherwise(0)
    shown = n.cast("string") if decimals == 0 else F.concat_ws(".", F.floor(n / 10).cast("string"), (n % 10).cast("string"))
    return F.when((x >= 0) & (x < 1000), shown).otherwise(F.format_string(f"%.{decimals}f", x))


def short_money(c: Column) -> Column:
    """An amount in lei, thousands (mii), millions (mil) or billions (mld) with one decimal."""
    of = lambda unit, name: F.concat(_fixed(c / unit, 1), F.lit(name))
    return F.when(c >= 1e9, of(1e9, " mld lei")).when(c >= 1e6, of(1e6, " mil lei")).when(c >= 1e3, of(1e3, " mii lei")).otherwise(F.concat(_fixed(c, 0), F.lit(" lei")))


def last_date_in(name: Column) -> Column:
    """The last dd.mm.yyyy, dd-mm-yyyy or dd_mm_yyyy of a file name as a date."""
    found = F.regexp_extract_all(name, F.lit(r"(\d{2}[._-]\d{2}[._-]\d{4})"), F.lit(1))
    last = F.when(F.size(found) > 0, F.element_at(found, -1))
    return F.try_to_date(F.regexp_replace(last, "[._]", "-"), "dd-MM-yyyy")


def year_in(c: Column) -> Column:
    """The first year from 1990 to 2039 of an address or text."""
    return F.nullif(F.regexp_extract(c, r"(?:^|\D)(199\d|20[0-3]\d)(?:\D|$)", 1), F.lit("")).cast("int")


def noon(date: Column) -> Column:
    """Noon of a day."""
    return F.to_timestamp(F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" 12:00:00")))


def place_name(c: Column) -> Column:
    """A county or an administrator: accents off, upper case, one blank between words."""
    return F.upper(F.trim(F.regexp_replace(fold(c), r"[^a-z0-9]+", " ")))


def shortened(c: Column, most: int) -> Column:
    """White space collapsed, and at most ``most`` characters, the last an ellipsis where some are cut."""
    text = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…"))).otherwise(text)


def confidence(key: Column) -> Column:
    """How far a name key of so many words is to be trusted."""
    n = F.size(F.split(key, " "))
    return F.when(n >= 3, "high").when(n == 2, "context").otherwise("candidate")
