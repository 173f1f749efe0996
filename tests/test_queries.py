"""Every query against the same query in DuckDB's SQL, on the smallest tables."""

import pytest

from conftest import SMALL
from vitrine.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(name, spark, duck, same):
    same(catalogue.QUERIES[name](spark, SMALL), duck, catalogue.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_without_sql_runs(name, spark):
    assert catalogue.QUERIES[name](spark, SMALL).columns


def test_scores_keep_rows_with_null_features(spark):
    from vitrine.operators.anomaly import ecod

    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0), (3, 9.0, None), (4, 2.0, 2.5)], "k long, x double, y double")
    assert sorted(r["k"] for r in ecod(df, "k", ["x", "y"]).collect()) == [1, 2, 3, 4]
