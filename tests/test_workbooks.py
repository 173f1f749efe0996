"""Workbooks as files, with what other writers put into them."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from vitrine.sources.workbooks import block_label, carried, labelled_cells, rows_of, table_rows, workbook, workbooks

SPACE = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def test_files_are_read_from_a_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.xlsx").write_bytes(workbook([("One", [["x", 1, 2.5, True, None, "a < b & c"], [], ["Ä", -3]]), ("Two", [])]))
    (tmp_path / "deep" / "b.xlsx").write_bytes(workbook([('"Q"', [[None] * 27 + ["far"]])]))
    (tmp_path / "note.txt").write_text("no workbook")
    rows = sorted((r["path"].rsplit("/", 1)[1], r["sheet_no"], r["sheet"], r["row"], r["cells"]) for r in rows_of(workbooks(spark, f"file://{tmp_path}")).collect())
    assert rows == [
        ("a.xlsx", 1, "One", 1, ["x", "1", "2.5", "true", None, "a < b & c"]),
        ("a.xlsx", 1, "One", 3, ["Ä", "-3"]),
        ("b.xlsx", 1, '"Q"', 1, [None] * 27 + ["far"]),
    ]


def test_shared_strings_rich_text_errors_and_gaps(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("xl/workbook.xml", f'<workbook {SPACE} xmlns:r="{links}"><sheets><sheet name="S" sheetId="7" r:id="x"/><sheet name="Chart" sheetId="8" r:id="y"/></sheets></workbook>')
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}"><Relationship Id="x" Target="/xl/worksheets/s.xml"/><Relationship Id="y" Target="chartsheets/c.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {SPACE}><si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>")
        cells = '<c r="B4" t="s"><v>1</v></c><c r="D4" t="e"><v>#N/A</v></c><c r="E4" t="str"><f>A1</f><v>made</v></c><c r="F4" t="b"><v>0</v></c>'
        book.writestr("xl/worksheets/s.xml", f'<worksheet {SPACE}><sheetData><row><c t="s"><v>0</v></c><c><v>7</v></c></row><row r="4">{cells}</row><row r="9"><c r="A9"/></row></sheetData></worksheet>')
    books = spark.createDataFrame([("p", bytearray(out.getvalue()))], "path string, content binary")
    assert [(r["row"], r["cells"]) for r in rows_of(books).orderBy("row").collect()] == [(1, ["plain", "7"]), (4, [None, "rich", None, None, "made", "false"])]
    assert rows_of(books.limit(0)).count() == 0
    with pytest.raises(Exception, match="BadZipFile"):
        rows_of(spark.createDataFrame([("p", bytearray(b"no zip"))], "path string, content binary")).collect()


def test_headers_blocks_and_labels(spark):
    late = [["t"]] * 12 + [["id", "v"], [1, 2]]
    sheet = [["Report of id"], ["id", None, "Value "], [None, "Judetul: Alba"], [1, None, 10], ["Judetul:Arad", None, None], [2, None, 20], ["TOTAL x", 3, 30], ["TOTAL y", 4, 40]]
    books = spark.createDataFrame([("p", bytearray(workbook([("s", sheet), ("late", late), ("none", [["a"]])])))], "path string, content binary")
    rows = rows_of(books)
    found = table_rows(carried(rows, block_label("Judetul:"), "county"), {"id": ["id"], "value": ["value", "v"], "more": ["more"]}, least=2)
    assert [(r["sheet"], r["row"], r["county"], r["id"], r["value"], r["more"]) for r in found.where(F.col("id").rlike("^[0-9]+$")).orderBy("row").collect()] == [("s", 4, "Alba", "1", "10", None), ("s", 6, "Arad", "2", "20", None)]
    got = labelled_cells(rows, "^TOTAL", {"a": 1, "b": 2}).collect()
    assert [(r["sheet"], r["row"], r["a"], r["b"]) for r in got] == [("s", 7, "3", "30")]
