"""The relational star (company, person, their links, contracts) as views over the source tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Loader = Callable[[str], DataFrame]


def money(column: Column | str) -> Column:
    """A double amount as an exact decimal, so that totals do not depend on the order of addition."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def as_double(column: Column) -> Column:
    return column.cast("double")


#: Rows that one task joins or counts, and the number of tasks below which Spark deals them as it likes.
TASK_ROWS, FEW_TASKS = 250_000, 8


def tasks_of(rows: DataFrame) -> int:
    """Tasks for joins and aggregates over ``rows`` (a table as it is read, whose count is in its files)."""
    return rows.count() // TASK_ROWS + 1


def spread(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``tasks``, which adaptive execution does not merge: it merges by shuffled bytes, and a
    few bytes a row make tasks whose sorts and hash tables grow with the input."""
    return df if tasks <= FEW_TASKS else df.repartition(tasks, *keys)


def contract_totals(t: Loader) -> DataFrame:
    """Per supplier: number and value of its contract lines."""
    return t("lineitem").groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).alias("total"), F.count("*").alias("nr"))


def companies(t: Loader) -> DataFrame:
    """cui, nume, judet, sector, bal, contracte_ron, contracte_nr of every supplier."""
    return (
        t("supplier")
        .join(contract_totals(t), F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("cui"),
            F.col("s_name").alias("nume"),
            F.col("n_name").alias("judet"),
            F.col("r_name").alias("sector"),
            F.col("s_acctbal").alias("bal"),
            F.coalesce("total", F.lit(0)).alias("contracte_ron"),
            F.coalesce("nr", F.lit(0)).alias("contracte_nr"),
        )
    )


def persons(t: Loader) -> DataFrame:
    """id, nume, camera (market segment), judet of every customer."""
    return (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("nume"),
            F.col("c_mktsegment").alias("camera"),
            F.col("n_name").alias("judet"),
        )
    )


def links(t: Loader) -> DataFrame:
    """Distinct (id, cui): persons and the companies they are tied to by their orders."""
    return spread(tied(t), tasks_of(t("lineitem")), "id").distinct()


def tied(t: Loader) -> DataFrame:
    """The rows (id, cui) of ``links``, one for every contract line."""
    n = tasks_of(t("lineitem"))
    lines, orders = t("lineitem").select("l_orderkey", "l_suppkey"), t("orders").select("o_orderkey", "o_custkey")
    joined = spread(lines, n, "l_orderkey").join(spread(orders, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(F.col("o_custkey").alias("id"), F.col("l_suppkey").alias("cui"))


def contracts(t: Loader) -> DataFrame:
    """One row per contract line: authority, supplier, order, line, amount, day, priority."""
    n = tasks_of(t("lineitem"))
    return (
        spread(t("lineitem"), n, "l_orderkey")
        .join(spread(t("orders"), n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("authority"),
            F.col("l_suppkey").alias("supplier"),
            F.col("l_orderkey").alias("notice"),
            F.col("l_linenumber").alias("lot"),
            money("l_extendedprice").alias("amount"),
            F.col("l_shipdate").cast("date").alias("day"),
            F.col("o_orderpriority").alias("procedure"),
            F.col("l_returnflag").alias("flag"),
        )
    )


#: The same views as common table expressions of DuckDB's SQL.
COMPANY = """company AS (SELECT s_suppkey AS cui, s_name AS nume, n_name AS judet, r_name AS sector, s_acctbal AS bal,
    coalesce(total, 0) AS contracte_ron, coalesce(nr, 0) AS contracte_nr FROM supplier LEFT JOIN
    (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total, count(*) AS nr FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
PERSON = """person AS (SELECT c_custkey AS id, c_name AS nume, c_mktsegment AS camera, n_name AS judet
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
LINK = """link AS (SELECT DISTINCT o_custkey AS id, l_suppkey AS cui FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CONTRACT = """contract AS (SELECT o_custkey AS authority, l_suppkey AS supplier, l_orderkey AS notice, l_linenumber AS lot,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_shipdate AS DATE) AS day, o_orderpriority AS procedure, l_returnflag AS flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
