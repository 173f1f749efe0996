"""Sources other than Parquet: separated text, JSON in its shapes, XML rates, mixed encodings, cached files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators that are tried, in order of preference on ties.
SEPARATORS = "^|;,\t"
BAD = "_malformed"


def header_line(spark: SparkSession, path: str) -> str:
    """The first line of the files at ``path``, without a byte order mark."""
    first = spark.read.text(path).limit(1).collect()
    return first[0]["value"].lstrip("﻿") if first else ""


def sniffed_separator(line: str, candidates: str = SEPARATORS) -> str:
    """The candidate that a header line holds most often."""
    return max(candidates, key=lambda c: (line.count(c), -candidates.index(c)))


def read_separated(spark: SparkSession, path: str, candidates: str = SEPARATORS, quote: str = '"') -> DataFrame:
    """All columns of separated text with a header as strings, and ``_malformed``: the whole line of a
    row with another number of fields, else null. An empty file gives no columns but that."""
    line = header_line(spark, path)
    sep = sniffed_separator(line, candidates)
    names = [n.strip().strip(quote) for n in line.split(sep)] if line else []
    schema = ", ".join([f"`{n}` string" for n in names] + [f"`{BAD}` string"])
    options = {"sep": sep, "quote": quote, "header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "columnPruning": "false"}
    return spark.read.schema(schema).options(**options).csv(path)


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(BAD).isNull()).drop(BAD)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents that span lines; a missing path has no rows."""
    try:
        return spark.read.schema(schema).option("multiLine", "true").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one on each line."""
    return spark.read.schema(schema).json(path)


def list_or_values(document: Column, item: str) -> Column:
    """The items of a JSON list, or the values of a JSON object, as an array of ``item``."""
    text = F.trim(document)
    listed = F.from_json(F.when(F.startswith(text, F.lit("[")), text), f"array<{item}>")
    return F.coalesce(listed, F.map_values(F.from_json(F.when(F.startswith(text, F.lit("{")), text), f"map<string, {item}>")))


def zipped(*columns: str) -> Column:
    """Rows of parallel arrays: one struct for each position."""
    return F.arrays_zip(*columns)


def xml_rates(xml: Column) -> Column:
    """currency, rate of each ``Rate`` element, its value divided by its multiplier."""
    pattern = r'<Rate currency="([A-Z]+)"(?: multiplier="(\d+)")?>([\d.]+)</Rate>'
    parts = F.arrays_zip(*(F.regexp_extract_all(xml, F.lit(pattern), F.lit(i)).alias(n) for i, n in ((1, "c"), (2, "m"), (3, "v"))))
    return F.transform(
        parts,
        lambda r: F.struct(r["c"].alias("currency"), (r["v"].cast("double") / F.coalesce(F.nullif(r["m"], F.lit("")).cast("double"), F.lit(1.0))).alias("rate")),
    )


#: Letters at the places of Latin-1 where Latin-2 has Romanian ones.
LATIN1, LATIN2 = "ÃãªºÞþ", "ĂăŞşŢţ"


def decoded(raw: Column) -> Column:
    """Bytes as text: UTF-8 where they are, else Latin-2 as far as Romanian needs it."""
    latin = F.translate(F.decode(raw, "ISO-8859-1"), LATIN1, LATIN2)
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(latin)


def read_globs(spark: SparkSession, globs: list[str], schema: str) -> DataFrame:
    """JSON lines of several globs with the name of the file's folder as ``origin``."""
    found = [spark.read.schema(schema).json(g).withColumn("origin", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)) for g in globs]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def content_cache(fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cache of (url, content): each content once under its sha256, and the address of every url."""
    keyed = fetched.withColumn("sha256", F.sha2("content", 256))
    blobs = keyed.groupBy("sha256").agg(F.any_value("content").alias("content"))
    return blobs, keyed.select("url", "sha256").distinct()
