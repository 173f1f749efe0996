"""Workbooks (zipped spreadsheet XML): written and read in tasks, tables found by their headers, block headers carried on."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
ROWS = "path string, sheet_no int, sheet string, row int, cells array<string>"
#: Rows in which a header is looked for, rows of one Arrow batch.
HEADER_ROWS, BATCH = 12, 5000


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _texts(element: ElementTree.Element) -> str:
    """The text of a string item: its runs, without phonetic guides."""
    return "".join(t.text or "" for part in element if part.tag != f"{_MAIN}rPh" for t in part.iter(f"{_MAIN}t"))


def sheet_rows(content: bytes) -> Iterator[tuple[int, str, int, list[str | None]]]:
    """(sheet number, sheet name, row number, cells) of a workbook's worksheets in order, rows without a value left out.

    Cells stand at their columns; numbers are as they are written, booleans are true or false, errors and empty cells null."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as file:
                for _, element in ElementTree.iterparse(file):
                    if element.tag == f"{_MAIN}si":
                        shared.append(_texts(element))
                        element.clear()
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        for number, sheet in enumerate(sheets, 1):
            target = targets.get(sheet.get(f"{_LINK}id"), "")
            name = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            if "worksheets/" not in name or name not in book.namelist():
                continue  # a chart
            with book.open(name) as file:
                at = 0
                for _, element in ElementTree.iterparse(file):
                    if element.tag != f"{_MAIN}row":
                        continue
                    at = int(element.get("r", at + 1))
                    cells: list[str | None] = []
                    for cell in element.iter(f"{_MAIN}c"):
                        column = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                        kind, value, inline = cell.get("t", "n"), cell.find(f"{_MAIN}v"), cell.find(f"{_MAIN}is")
                        if kind == "inlineStr":
                            text = _texts(inline) if inline is not None else None
                        elif value is None or value.text is None or kind == "e":
                            text = None
                        elif kind == "s":
                            text = shared[int(value.text)]
                        else:
                            text = {"1": "true", "0": "false"}.get(value.text) if kind == "b" else value.text
                        cells += [None] * (column + 1 - len(cells))
                        cells[column] = text
                    if any(c is not None for c in cells):
                        yield number, sheet.get("name", ""), at, cells
                    element.clear()


def workbook(sheets: list[tuple[str, list[list]]]) -> bytes:
    """A workbook of (name, rows); text goes inline, numbers and booleans as such, None as no cell."""

    def cell(row: int, column: int, value) -> str:
        letters, n = "", column + 1
        while n:
            n, rest = divmod(n - 1, 26)
            letters = chr(65 + rest) + letters
        at = f'r="{letters}{row}"'
        if isinstance(value, bool):
            return f'<c {at} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c {at}><v>{value!r}</v></c>"
        return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    space = f'xmlns="{_MAIN[1:-1]}"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        parts, links, types = [], [], []
        for i, (name, rows) in enumerate(sheets, 1):
            body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row) if v is not None)}</row>' for r, row in enumerate(rows, 1))
            book.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
            parts.append(f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>')
            links.append(f'<Relationship Id="rId{i}" Type="{_LINK[1:-1]}/worksheet" Target="worksheets/sheet{i}.xml"/>')
            types.append(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
        book.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="{_LINK[1:-1]}"><sheets>{"".join(parts)}</sheets></workbook>')
        package = "http://schemas.openxmlformats.org/package/2006"
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">{"".join(links)}</Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{_LINK[1:-1]}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        main = '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        default = '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        book.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types">{default}{main}{"".join(types)}</Types>')
    return out.getvalue()


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the workbooks below ``path``, by Spark's own reader (any file system)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xls[xm]").option("recursiveFileLookup", "true").load(path).select("path", "content")


def rows_of(books: DataFrame) -> DataFrame:
    """All rows of the workbooks (path, content): path, sheet_no, sheet, row, cells. A file that is no workbook raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out: list[tuple] = []
                for row in sheet_rows(content.as_py()):
                    out.append((path, *row))
                    if len(out) == BATCH:
                        yield packed(out)
                        out = []
                if out:
                    yield packed(out)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.string())]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["path", "sheet_no", "sheet", "row", "cells"])

    return books.select("path", "content").mapInArrow(run, ROWS)


def table_rows(rows: DataFrame, headers: dict[str, list[str]], least: int | None = None, first: int = HEADER_ROWS) -> DataFrame:
    """Rows below each sheet's header: path, sheet_no, sheet, row, cells and one column for each of ``headers``.

    ``headers`` names a column and the labels it may have (compared trimmed, in lower case). A sheet's header is the
    first of its first ``first`` rows that holds ``least`` of the columns or more (all, if not given); sheets
    without one have no rows. A column that the header lacks is null.
    """
    sheet = ["path", "sheet_no"]
    plain = F.transform("cells", lambda c: F.lower(F.trim(c)))
    place = lambda labels: F.array_min(F.filter(F.array(*[F.nullif(F.array_position("plain", lab), F.lit(0).cast("long")) for lab in labels]), lambda p: p.isNotNull()))
    found = rows.where(F.col("row") <= first).withColumn("plain", plain)
    found = found.select(*sheet, "row", *[place(labels).alias(f"at_{name}") for name, labels in headers.items()])
    known = sum((F.col(f"at_{name}").isNotNull().cast("int") for name in headers), F.lit(0))
    found = found.where(known >= (len(headers) if least is None else least))
    places = F.struct(F.col("row").alias("header"), *[f"at_{name}" for name in headers])
    found = found.groupBy(*sheet).agg(F.min_by(places, "row").alias("h")).select(*sheet, "h.*")  # a row per sheet
    body = rows.join(found, sheet).where("row > header")
    return body.select(*rows.columns, *[F.try_element_at("cells", F.col(f"at_{name}").cast("int")).alias(name) for name in headers])


def carried(rows: DataFrame, mark: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the last non-null ``mark`` at or above each row of its sheet."""
    above = Window.partitionBy("path", "sheet_no").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(mark, ignorenulls=True).over(above))


def block_label(pattern: str, columns: int = 3) -> Column:
    """What follows ``pattern`` in the first of the first ``columns`` cells that begins with it, else null."""
    cells = F.filter(F.slice("cells", 1, columns), lambda c: c.rlike(rf"^\s*(?:{pattern})"))
    return F.nullif(F.trim(F.regexp_replace(F.try_element_at(cells, F.lit(1)), rf"^\s*(?:{pattern})", "")), F.lit(""))


def labelled_cells(rows: DataFrame, label: str, columns: dict[str, int], label_column: int = 0) -> DataFrame:
    """Per sheet the ``columns`` (counted from 0) of the first row whose label cell matches the pattern ``label``."""
    cell = lambda i: F.try_element_at("cells", F.lit(i + 1))
    hit = rows.where(cell(label_column).rlike(label)).select("path", "sheet_no", "sheet", "row", *[cell(i).alias(n) for n, i in columns.items()])
    values = F.struct("sheet", "row", *columns)
    return hit.groupBy("path", "sheet_no").agg(F.min_by(values, "row").alias("v")).select("path", "sheet_no", "v.*")
