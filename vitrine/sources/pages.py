"""Links, headings and table cells of pages: a table function that walks the tags, and matches by position."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ELEMENTS = "pos int, kind string, text string, target string, name string, level int, table_no int, row_no int, cell_no int"
_SILENT = ("script", "style", "template", "noscript")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_CONTAINERS = ("ul", "ol", "dl", "div", "section", "article", "nav", "header", "footer", "main", "aside")


class _Walker(HTMLParser):
    """Collects elements in the order in which they begin; text goes to every element that is open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.open: list[tuple[str, dict]] = []
        self.tables: list[list[int]] = []  # of each open table its number, row and cell
        self.n_tables, self.silent = 0, 0

    def _begin(self, tag: str, kind: str, **more) -> None:
        place = self.tables[-1] if self.tables else (None, None, None)
        entry = {"kind": kind, "text": [], "target": None, "name": None, "level": None, "table": place[0], "row": place[1], "cell": place[2]} | more
        self.found.append(entry)
        self.open.append((tag, entry))

    def _end(self, *tags: str, alone: bool = False) -> None:
        """Close the innermost open element of one of ``tags``, and (if not ``alone``) what is open within it."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                del self.open[i : i + 1 if alone else None]
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        named = dict(attrs)
        if tag in _SILENT:
            self.silent += 1
        elif tag == "a" and named.get("href") is not None:
            self._end("a", alone=True)
            self._begin("a", "link", target=named["href"], name=named.get("id"))
        elif tag in _HEADINGS:
            self._end(*_HEADINGS, alone=True)
            self._begin(tag, "heading", level=int(tag[1]), name=named.get("id"))
        elif tag == "table":
            self.n_tables += 1
            self.tables.append([self.n_tables, 0, 0])
            self.open.append((tag, {"text": []}))
        elif tag in _CONTAINERS:
            self.open.append((tag, {"text": []}))
        elif tag == "tr" and self.tables:
            self._within_table("td", "th")
            self.tables[-1][1:] = [self.tables[-1][1] + 1, 0]
        elif tag in ("td", "th") and self.tables:
            self._within_table("td", "th")
            self.tables[-1][2] += 1
            self._begin(tag, "header" if tag == "th" else "cell", name=named.get("id"))
        elif tag == "br":
            self.handle_data(" ")

    def _within_table(self, *tags: str) -> None:
        inner = [t for t, _ in self.open]
        start = len(inner) - 1 - inner[::-1].index("table") if "table" in inner else 0
        for i in range(len(self.open) - 1, start, -1):
            if self.open[i][0] in tags:
                del self.open[i:]
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "table" and self.tables:
            self._end("table")
            self.tables.pop()
        elif tag in ("td", "th") and self.tables:
            self._within_table("td", "th")
        elif tag == "a" or tag in _HEADINGS:
            self._end(tag, alone=True)
        elif tag in _CONTAINERS:
            self._end(tag)  # with a link that has no end

    def handle_data(self, data: str) -> None:
        if not self.silent:
            for _, entry in self.open:
                entry["text"].append(data)


@F.udtf(returnType=ELEMENTS)
class PageElements:
    """The links, headings and cells of one page, numbered by the place where they begin."""

    def eval(self, html: str) -> Iterator[tuple]:
        if not html:
            return
        walker = _Walker()
        walker.feed(html)
        walker.close()
        for pos, e in enumerate(walker.found):
            yield pos, e["kind"], " ".join("".join(e["text"]).split()), e["target"], e["name"], e["level"], e["table"], e["row"], e["cell"]


def elements(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of ``pages`` but ``html``, with a row for each element of the page (``ELEMENTS``); pages without one have none."""
    found = pages.lateralJoin(PageElements(F.col(html).outer()))
    return found.drop(html)


def below_headings(found: DataFrame, page: str, least_level: int = 6) -> DataFrame:
    """The links of ``elements`` with ``heading``, ``heading_no`` and ``heading_level`` of the nearest heading before them (of level ``least_level`` or
    higher); null above the first."""
    is_heading = (F.col("kind") == "heading") & (F.col("level") <= least_level)
    before = Window.partitionBy(page).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)  # the elements of one page
    held = F.when(is_heading, F.struct("text", "level"))
    placed = found.withColumn("h", F.last(held, ignorenulls=True).over(before)).withColumn("heading_no", F.count_if(is_heading).over(before))
    return placed.where("kind = 'link'").select(page, "pos", "target", "text", F.col("h.text").alias("heading"), F.col("h.level").alias("heading_level"), "heading_no")


def rows_by_name(found: DataFrame, page: list[str], names: dict[str, str]) -> DataFrame:
    """Table rows put together from cells whose id ends in a suffix: a column of text for each of ``names`` (column, suffix).

    Rows without any such cell are left out; of several cells with one suffix the first counts."""
    cells = found.where(F.col("kind").isin("cell", "header"))
    value = lambda suffix: F.min_by(F.when(F.endswith("name", F.lit(suffix)), F.col("text")), F.when(F.endswith("name", F.lit(suffix)), F.col("pos")))
    per = cells.groupBy(*page, "table_no", "row_no").agg(*[value(s).alias(c) for c, s in names.items()])
    known: Column = F.coalesce(*names)
    return per.where(known.isNotNull())


def table_records(found: DataFrame, page: list[str], names: dict[str, list[str]]) -> DataFrame:
    """Table rows below the header row of their table: a column for each of ``names`` (column, labels compared in lower case).

    The header is the first row with header cells, or the first row; a table without any of the labels has no rows."""
    cells = found.where(F.col("kind").isin("cell", "header"))
    table = [*page, "table_no"]
    first = cells.groupBy(*table).agg(F.coalesce(F.min(F.when(F.col("kind") == "header", F.col("row_no"))), F.min("row_no")).alias("header_row"))
    placed = cells.join(first, table)
    label = F.lower(F.trim("text"))
    which = F.coalesce(*[F.when(label.isin([x.lower() for x in labels]), F.lit(c)) for c, labels in names.items()])
    heads = placed.where("row_no = header_row").select(*table, "cell_no", which.alias("column")).where("column is not null")
    body = placed.where("row_no > header_row").join(heads, [*table, "cell_no"])
    value = lambda c: F.min_by(F.when(F.col("column") == c, F.col("text")), F.when(F.col("column") == c, F.col("cell_no")))
    return body.groupBy(*table, "row_no").agg(*[value(c).alias(c) for c in names])
