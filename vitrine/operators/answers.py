"""The questions that users ask of the finished tables: searches with optional conditions, records, ranked lists, named views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.names import fold

MOST = 100


def holds(column: Column, text: str) -> Column:
    """Whether a column holds a text, whatever the case and accents; null counts as empty, the empty text is in everything."""
    return F.contains(F.coalesce(fold(column), F.lit("")), fold(F.lit(text)))


def any_holds(items: Column, text: str, *fields: str) -> Column:
    """Whether any element of an array, or any of the fields of its structs, holds a text; null and empty arrays hold nothing but the empty text."""
    hit = lambda x: F.greatest(*[holds(x[f], text) for f in fields]) if len(fields) > 1 else holds(x[fields[0]] if fields else x, text)
    return F.lit(text == "") | F.coalesce(F.exists(items, hit), F.lit(False))


def search(df: DataFrame, order: list, limit: int, texts: dict[str, str] | None = None, where: Column | None = None) -> DataFrame:
    """The first rows in ``order`` whose columns hold all of ``texts`` (empty ones ask nothing) and fulfil ``where``.

    ``limit`` is kept between 1 and 100. Ties follow the order, so it should end in a key."""
    for column, text in (texts or {}).items():
        if text:
            df = df.where(holds(F.col(column), text))
    if where is not None:
        df = df.where(where)
    return df.orderBy(*order).limit(max(1, min(limit, MOST)))


def members_by_party(members: DataFrame, party: str, chamber: str, chambers: dict[str, str]) -> DataFrame:
    """One row a party: members of each chamber (result column: value of ``chamber``). Members without a party count nowhere."""
    counts = [F.count(F.when(F.col(chamber) == value, 1)).alias(name) for name, value in chambers.items()]
    return members.where(F.col(party).isNotNull()).groupBy(party).agg(*counts)


def grants(paid: DataFrame, members: DataFrame, reports: DataFrame, code: str = "") -> DataFrame:
    """(party, paid, members.*, reports): what every party was paid, its members and reports, most paid first.

    The inputs have one row a party (column ``party``); a party is listed if any of them has it, with 0 for what it lacks.
    ``code`` asks for one party, in any case."""
    all_ = paid.join(members, "party", "full").join(reports, "party", "full")
    found = all_.na.fill(0)
    if code.strip():
        found = found.where(F.upper("party") == code.strip().upper())
    return found.orderBy(F.col("paid").desc(), "party")


def share_of(holdings: DataFrame, key: str, holder: str, percent: str, pattern: str) -> DataFrame:
    """(key, share): the percents of the holders whose folded name matches ``pattern``, added up per key; 0 where none does."""
    return holdings.groupBy(key).agg(F.coalesce(F.sum(F.when(fold(holder).rlike(pattern), F.col(percent))), F.lit(0.0)).alias("share"))


def committee(members: DataFrame, text: str, name: str = "name") -> DataFrame:
    """The members (rows) of the first committee, by name, whose name holds ``text``, with their number in ``n_members``; no row without one.

    The committee is looked for among the names alone and its members stay rows, so none is gathered, however large it is."""
    first = search(members.groupBy(name).agg(F.count("*").alias("n_members")), [name], 1, {name: text})
    return members.join(first, name)


def view(views: dict[str, Callable[[], DataFrame]], name: str) -> DataFrame:
    """The named view, built when it is asked for. A name that is not known raises, with those that are."""
    if name not in views:
        raise KeyError(f"no view {name!r}; known: {', '.join(sorted(views))}")
    return views[name]()
