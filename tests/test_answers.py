"""Questions asked of small tables."""

import pytest
from pyspark.sql import functions as F

from vitrine.operators import answers


@pytest.fixture
def firms(spark):
    return spark.createDataFrame([(1, "Șantier", "x"), (2, "SANTIERUL", None), (3, None, "X"), (4, "alt", "y")], "id int, name string, sector string")


def ids(df):
    return [r.id for r in df.collect()]


def test_search(firms):
    assert ids(answers.search(firms, ["id"], 10, {"name": "șantier", "sector": ""})) == [1, 2]
    assert ids(answers.search(firms, ["id"], 10, {"sector": "X"})) == [1, 3]
    assert ids(answers.search(firms, [F.col("id").desc()], 0)) == [4]
    assert ids(answers.search(firms, ["id"], 10, where=F.col("id") > 2)) == [3, 4]


def test_arrays(spark):
    df = spark.createDataFrame([(1, [("Ana", None)]), (2, [("b", "ÁNA"), (None, None)]), (3, []), (4, None)], "id int, a array<struct<n:string,m:string>>")
    assert ids(df.where(answers.any_holds(F.col("a"), "ana", "n", "m")).orderBy("id")) == [1, 2]
    assert ids(df.where(answers.any_holds(F.col("a"), "ana", "n")).orderBy("id")) == [1]
    assert ids(df.where(answers.any_holds(F.col("a"), "", "n")).orderBy("id")) == [1, 2, 3, 4]
    assert spark.range(1).select(answers.any_holds(F.array(F.lit("x"), F.lit(None)), "X").alias("h")).first().h


def test_grants(spark):
    members = spark.createDataFrame([("PSD", "d"), ("PSD", "s"), ("PSD", "s"), ("AUR", "d"), (None, "d"), ("AUR", None)], "party string, chamber string")
    counted = answers.members_by_party(members, "party", "chamber", {"deputies": "d", "senators": "s"})
    paid = spark.createDataFrame([("PSD", 5.0), ("USR", 7.0)], "party string, paid double")
    reports = spark.createDataFrame([("PNL", 2)], "party string, reports long")
    want = [("USR", 7.0, 0, 0, 0), ("PSD", 5.0, 1, 2, 0), ("AUR", 0.0, 1, 0, 0), ("PNL", 0.0, 0, 0, 2)]
    assert [tuple(r) for r in answers.grants(paid, counted, reports).collect()] == want
    assert [tuple(r) for r in answers.grants(paid, counted, reports, " psd ").collect()] == want[1:2]
    assert answers.grants(paid, counted, reports, "none").collect() == []


def test_shares(spark):
    held = spark.createDataFrame([(1, "Statul Român", 40.0), (1, "Ministerul X", 10.5), (1, "Fond", 49.5), (2, None, 3.0)], "k int, holder string, pct double")
    assert {tuple(r) for r in answers.share_of(held, "k", "holder", "pct", "statul|minister").collect()} == {(1, 50.5), (2, 0.0)}


def test_committee(spark):
    members = spark.createDataFrame([("Buget, finanțe", "A"), ("Buget, finanțe", "B"), ("Juridică", "C"), (None, "D")], "name string, member string")
    assert {tuple(r) for r in answers.committee(members, "FINANTE").collect()} == {("Buget, finanțe", "A", 2), ("Buget, finanțe", "B", 2)}
    assert answers.committee(members, "none").collect() == []


def test_views(spark):
    views = {"one": lambda: spark.range(1), "never": lambda: 1 / 0}
    assert answers.view(views, "one").count() == 1
    with pytest.raises(KeyError, match="never, one"):
        answers.view(views, "two")
