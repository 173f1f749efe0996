"""Values at paths of half-structured documents (VARIANT), with defaults where a step is missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def document(json: Column) -> Column:
    """A JSON text as VARIANT; null where it is none."""
    return F.try_parse_json(json)


def at(doc: Column, *paths: str, kind: str = "string", default=None) -> Column:
    """The value at the first of ``paths`` that has one which can be read as ``kind``; else ``default``.

    A missing step, a null on the way and a value of another kind all count as no value, so no chain of defaults is
    needed at each step."""
    found = [F.try_variant_get(doc, p, kind) for p in paths]
    return F.coalesce(*found, *([] if default is None else [F.lit(default)]))


def clean(doc: Column, *paths: str) -> Column:
    """The trimmed text at the first path, null where it is empty."""
    return F.nullif(F.trim(at(doc, *paths)), F.lit(""))


def truthy(doc: Column, path: str) -> Column:
    """Whether the value at ``path`` says yes: true, a number but 0, a text, list or object that is not empty; a missing one says no."""
    value = F.try_variant_get(doc, path, "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(doc, path, "string")
    no = F.coalesce(kind.isin("VOID", "OBJECT<>", "ARRAY<>"), F.lit(True)) | text.isin("", "[]", "{}")
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
    return F.when(kind == "BOOLEAN", F.coalesce(F.try_variant_get(doc, path, "boolean"), F.lit(False))).when(number, F.try_variant_get(doc, path, "double") != 0).otherwise(~no)


def mapped(value: Column, rules: tuple[tuple[str, str], ...], default: str) -> Column:
    """The code of the first rule (part of the upper-cased value, code) that holds, else ``default``."""
    upper = F.upper(F.coalesce(value, F.lit("")))
    return reduce(lambda out, r: F.when(F.contains(upper, F.lit(r[0])), r[1]).otherwise(out), reversed(rules), F.lit(default))
