"""Tables written as workbooks and read back: headers searched, block headers carried on, labelled cells."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from vitrine.plans.registry import query
from vitrine.sources.shared import write_table
from vitrine.sources.workbooks import block_label, carried, labelled_cells, rows_of, table_rows, workbook

_HEADERS = {"part": ["part", "cod"], "name": ["name", "denumire"], "size": ["size"], "price": ["price", "pret"]}


def _books(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of parts as a workbook: two sheets, a block for each brand, the header in another row of every book."""
    for batch in batches:
        rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("p_brand", "p_partkey", "p_name", "p_size", "p_retailprice")), strict=True))
        if not rows:
            continue
        first, number = rows[0][1], len(rows)
        title = [["Parts & prices"], [None, "unit: lei"]] * (1 + first % 4)
        header = ["Cod", "Denumire", None, " Size", "PRICE"] if first % 2 else ["part", "Name", "note", "size", "price"]

        def body(part: list, title=title, header=header) -> list[list]:
            out, brand = [*title, header], None
            for b, key, name, size, price in part:
                if b != brand:
                    out += [[None, f"Brand: {b}"], []]
                    brand = b
                out.append([key, name, None, size, price])
            return out

        summary = [["Summary"], ["rows", number], ["total", sum(r[3] or 0 for r in rows)]]
        content = workbook([("first", body(rows[: number // 2])), ("second", body(rows[number // 2 :])), ("summary", summary)])
        yield pa.RecordBatch.from_pydict({"path": [f"parts-{first}.xlsx"], "content": [content]})


def _read(t):
    part = t("part").select("p_brand", "p_partkey", "p_name", "p_size", "p_retailprice")
    return rows_of(write_table(part.mapInArrow(_books, "path string, content binary"), "workbooks"))


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def workbook_tables(t):
    """All parts written as workbooks and read back by their headers, the brand from the header of the block (SRC-08, SRC-10)."""
    rows = carried(_read(t), block_label("Brand:"), "brand")
    found = table_rows(rows, _HEADERS).where(F.col("part").isNotNull() & F.col("name").isNotNull())
    return found.select(
        F.col("part").cast("long").alias("p_partkey"),
        F.col("name").alias("p_name"),
        F.col("brand").alias("p_brand"),
        F.col("size").cast("int").alias("p_size"),
        F.col("price").cast("double").alias("p_retailprice"),
    )


@query("SELECT count(*) AS n, sum(p_size)::BIGINT AS total FROM part")
def workbook_totals(t):
    """The labelled cells of every workbook's summary, added up (SRC-11)."""
    rows = _read(t)
    cells = labelled_cells(rows, "^rows$", {"value": 1}).select(F.lit("n").alias("what"), "value")
    cells = cells.unionAll(labelled_cells(rows, "^total$", {"value": 1}).select(F.lit("total"), "value"))
    number = F.col("value").cast("long")
    return cells.agg(F.sum(F.when(F.col("what") == "n", number)).alias("n"), F.sum(F.when(F.col("what") == "total", number)).alias("total"))
