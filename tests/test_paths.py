"""Paths of half-structured documents."""

import pytest
from pyspark.sql import functions as F

from vitrine.functions import paths


@pytest.mark.parametrize(
    ("value", "want"),
    [("true", True), ("false", False), ("null", False), ("0", False), ("0.0", False), ("2", True), ("-0.5", True), ('""', False), ('"x"', True), ("[]", False), ("[0]", True), ("{}", False), ('{"a": null}', True)],
)
def test_what_says_yes(spark, value, want):
    df = spark.createDataFrame([(f'{{"a": {{"b": {value}}}}}',)], "j string")
    assert df.select(paths.truthy(paths.document(F.col("j")), "$.a.b")).first()[0] is want


def test_missing_steps_have_defaults(spark):
    rows = [('{"a": {"b": 5}}',), ('{"a": null, "c": "7"}',), ("{}",), ("no json",), (None,), ('{"a": [1]}',)]
    df = spark.createDataFrame(rows, "j string")
    d = paths.document(F.col("j"))
    got = [r[0] for r in df.select(paths.at(d, "$.a.b", "$.c", kind="bigint", default=-1)).collect()]
    assert got == [5, 7, -1, -1, -1, -1]
    assert [r[0] for r in df.select(paths.truthy(d, "$.a.b")).collect()] == [True, False, False, False, False, False]
