"""Financial statements written as dumps of three layouts and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.plans.registry import query
from vitrine.sources.shared import shared_dir
from vitrine.sources.statements import statements

#: The years of the orders in each kind of dump, told by year % 3.
_KINDS = ({"sep": ";", "header": True}, {"sep": ",", "header": True}, {"sep": ";", "header": False})


def _form(orders):
    """Every order as the statement of its customer: cui, caen, i1 to i20."""
    k = F.col("o_orderkey")
    told = {
        7: F.when(k % 4 == 0, F.lit("-")).otherwise((k * 3).cast("string")),
        13: F.concat(F.replace(F.format_number(F.floor("o_totalprice"), 0), F.lit(","), F.lit(".")), F.lit(" lei")),
        18: F.when(k % 3 == 0, F.lit("0")).otherwise((k % 1000).cast("string")),
        19: (k % 5).cast("string"),
        20: F.when(k % 7 == 0, F.lit(None)).otherwise((k % 50).cast("string")),
    }
    values = [told.get(n, F.lit(str(n))).alias(f"i{n}") for n in range(1, 21)]
    return orders.select(F.col("o_custkey").cast("string").alias("CUI"), F.lit("6201").alias("CAEN"), *values, k.alias("k"))


@query("""WITH first AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) % 3, o_orderkey) = 1)
    SELECT o_custkey AS cui, floor(o_totalprice)::BIGINT AS turnover, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 1000 <> 0 THEN o_orderkey % 1000
        WHEN o_orderkey % 5 <> 0 THEN -(o_orderkey % 5) END AS result,
      CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey * 3 END AS debts, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 50 END AS employees FROM first""")
def financial_statements(t):
    """Orders as dumps of financial statements (semicolons, commas with other columns first, by position), read for solvent customers (SRC-09)."""
    orders = t("orders")
    root = shared_dir(orders.sparkSession, "statements")
    for kind, options in enumerate(_KINDS):
        part = _form(orders.where(F.year("o_orderdate") % 3 == kind)).orderBy("k").drop("k")
        moved = part.select("CUI", *[f"i{n}" for n in range(20, 0, -1)]) if kind == 1 else part
        moved.write.csv(f"{root}/{kind}", emptyValue="", **options)
    wanted = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("cui"))
    return statements(orders.sparkSession, root, wanted)
