"""Components of graphs whose order of nodes makes long ways."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import graph


def test_ascending_chain_is_one_component(spark):
    chain = spark.range(1, 1000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    other = spark.createDataFrame([(5003, 5002), (5002, 5001), (5001, 5001)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(chain.unionByName(other), "t").collect()}
    assert got == {i: 1 for i in range(1, 1001)} | {i: 5001 for i in (5001, 5002, 5003)}


def test_edges_that_are_left_raise(spark):
    chain = spark.range(1, 30).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with pytest.raises(RuntimeError):
        graph.components(chain, "t", rounds=1)
