"""Dumps of financial statements: text files with a header or by position, read to one row for each company asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The indicator of the form (i1 to i20) that holds each figure.
INDICATORS = {"debts": 7, "turnover": 13, "profit": 18, "loss": 19, "employees": 20}
KEY = "cui"
#: Fields before the first indicator in files without a header: the company and its kind of activity.
LEADING = 2


def _layouts(lines: DataFrame) -> DataFrame:
    """(file, separator, positions) from the first line of each file; one row a file."""
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("head"))
    count = lambda sign: F.length("head") - F.length(F.replace("head", F.lit(sign), F.lit("")))
    known = first.withColumn("separator", F.when(count(";") >= count(","), ";").otherwise(","))
    names = F.transform(F.split("head", F.col("separator")), lambda x: F.lower(F.trim(x)))
    known = known.withColumn("names", names)
    headed = F.element_at("names", 1) == KEY
    place = lambda n: F.when(headed, F.nullif(F.array_position("names", F.lit(f"i{n}")), F.lit(0))).otherwise(F.lit(LEADING + n)).cast("int")
    return known.select("file", "separator", F.struct(*[place(n).alias(name) for name, n in INDICATORS.items()]).alias("place"))


def _whole(field: Column) -> Column:
    """The digits and signs of a field as a whole number; null where they are none."""
    return F.regexp_replace(field, "[^0-9-]", "").try_cast("bigint")


def statements(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(cui, turnover, result, debts, employees) of the companies in ``wanted`` (column ``cui``) from all files below ``path``.

    Files are parted by semicolons or commas, whichever their first line has more of (ties: semicolons), with a header that
    begins with CUI and names indicators in any order, or without one. Of several rows of a company the first counts, by path and
    place in the file. The result is the profit, or the loss as a negative number where the profit is missing or zero, or null. Rows
    without a number for a company (headers, broken and empty lines) are passed over; fields that are missing or hold no
    number are null. Nulls and repeats in ``wanted`` change nothing; no file gives no row.
    """
    text = spark.read.option("recursiveFileLookup", True).text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("at")
    )  # within a block of a file the numbers rise with the lines
    fields = F.split("value", F.col("separator"))
    placed = lines.join(_layouts(lines), "file").select(F.struct("file", "block", "at").alias("order"), fields.alias("fields"), "place")
    figures = {name: _whole(F.get("fields", F.col("place")[name] - 1)) for name in INDICATORS}
    read = placed.select(F.trim(F.get("fields", F.lit(0))).try_cast("bigint").alias(KEY), "order", *[c.alias(n) for n, c in figures.items()])
    asked = wanted.select(F.col(KEY).cast("bigint").alias(KEY)).dropna().distinct()
    first = read.join(asked, KEY, "left_semi").groupBy(KEY).agg(F.min_by(F.struct(*INDICATORS), "order").alias("f"))
    result = F.coalesce(F.nullif(F.col("f.profit"), F.lit(0)), -F.nullif(F.col("f.loss"), F.lit(0)))
    return first.select(KEY, F.col("f.turnover").alias("turnover"), result.alias("result"), F.col("f.debts").alias("debts"), F.col("f.employees").alias("employees"))
