"""ECOD outlier scores (Li et al., 2022) from empirical cumulative distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.sources.shared import write_table


def tails(df: DataFrame, feature: str) -> DataFrame:
    """(value, left, right) of a feature: share of rows at most and at least the value.

    The cumulative counts run over a histogram of distinct values, in range-partitioned stretches
    with the counts of whole stretches added, so no window sees all rows in one task."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hist = df.groupBy(F.col(feature).alias("value")).agg(F.count("*").alias("c"))
    placed = hist.repartitionByRange(n, "value").withColumn("part", F.spark_partition_id())
    placed = write_table(placed, "tails")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("part").agg(F.sum("c").alias("s")).select("part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    total = placed.agg(F.sum("c").alias("total"))
    run = F.sum("c").over(Window.partitionBy("part").orderBy("value"))
    rows = placed.withColumn("run", run).join(base, "part").withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one")
    upto = F.col("base") + F.col("run")
    return rows.select("value", (upto / F.col("total")).alias("left"), ((F.col("total") - upto + F.col("c")) / F.col("total")).alias("right"))


def ecod(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    """key, score, driver: per feature the largest of the left, right and skew-chosen tail
    (negative logarithms), summed; the driver is the feature that adds most. A null feature adds 0."""
    skews = df.agg(*[F.skewness(f).alias(f"skew_{f}") for f in features]).withColumn("one", F.lit(1))
    out = df.select(key, *features, F.lit(1).alias("one")).join(skews, "one")
    for f in features:
        sides = tails(df.where(F.col(f).isNotNull()), f).toDF("value", f"left_{f}", f"right_{f}")
        out = out.join(sides, F.col(f) == F.col("value"), "left").drop("value")
        left, right = -F.log(f"left_{f}"), -F.log(f"right_{f}")
        chosen = F.when(F.col(f"skew_{f}") < 0, left).otherwise(right)
        out = out.withColumn(f"o_{f}", F.coalesce(F.greatest(left, right, chosen), F.lit(0.0))).drop(f"left_{f}", f"right_{f}")
    total = reduce(lambda a, b: a + b, [F.col(f"o_{f}") for f in features])
    most = F.array_max(F.array(*[F.struct(F.col(f"o_{f}").alias("o"), F.lit(f).alias("f")) for f in features]))
    return out.select(key, total.alias("score"), most["f"].alias("driver"))
