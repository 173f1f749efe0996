"""Domain functions on single values, with the expectations of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from vitrine.functions import dates, names, numbers, text
from vitrine.functions.similarity import name_similarity


def one(spark, column, **values):
    fields = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], fields).select(column.alias("x")).first()["x"]


def test_name_key_ignores_order_and_accents(spark):
    keys = {one(spark, names.name_key("n"), n=n) for n in ("Popescu Ion", "ION POPESCU", "Ión  Popéscu")}
    assert len(keys) == 1


@pytest.mark.parametrize(("a", "b", "low", "high"), [("Ion Popescu", "Popescu Ion", 1, 1), ("Ion Popescu", "Maria Vasile", 0, 0.4), ("Ion Popescu", "Ion Marin Popescu", 0.41, 0.99)])
def test_name_similarity(spark, a, b, low, high):
    assert low <= one(spark, name_similarity(F.col("a"), F.col("b")), a=a, b=b) <= high


@pytest.mark.parametrize(("s", "want"), [("1.234,56", 1234.56), ("12500", 12500.0), ("abc", None)])
def test_parse_number(spark, s, want):
    assert one(spark, numbers.parse_number(F.col("s")), s=s) == want


@pytest.mark.parametrize(("d", "m", "y", "want"), [("8", "septembrie", "1977", "1977-09-08"), ("31", "februarie", "1990", "None")])
def test_day_month_year(spark, d, m, y, want):
    assert str(one(spark, dates.day_month_year(F.col("d"), F.col("m"), F.col("y")), d=d, m=m, y=y)) == want


def test_personal_data_is_found_and_stops_publication(spark):
    assert one(spark, text.personal_data(F.col("t")), t="cod 1960101123456") == ["CNP"]
    assert one(spark, text.personal_data(F.col("t")), t="nimic aici") == []
    clean = spark.createDataFrame([("nimic",)], "t string")
    assert text.assert_clean(clean) is clean
    with pytest.raises(ValueError):
        text.assert_clean(spark.createDataFrame([("tel 0722123456",)], "t string"))


def test_law_references(spark):
    found = one(spark, text.law_references(F.col("t")), t="Legea nr. 176/2010 si O.U.G. 109/2011, HG nr. 617/2023, Legea 176/2010")
    assert found == ["lege/176/2010", "oug/109/2011", "hg/617/2023"]


def test_money_is_rounded_as_its_binary_value(spark):
    from vitrine.functions.dialects import short_money

    values = [0.0, 0.5, 1.5, 2.5, 999.4, 999.5, 999.96, 1000.0, 1049.999, 1050.0, 1250.0, 405950.0, 358650.0, 999950.0, 1e6, 2.25e6, 1.35e9, 1e12, 5e12, 0.49999999999999994]

    def shown(v):
        for unit, name in ((1e9, "mld"), (1e6, "mil"), (1e3, "mii")):
            if v >= unit:
                return f"{v / unit:.1f} {name} lei"
        return f"{v:.0f} lei"

    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(short_money(F.col("v"))).collect()] == [shown(v) for v in values]


def test_names_in_capitals(spark):
    line = "DNA SRL, ION  POPESCU; A1 BB CC DD EE FF GG x B. X și ION POPESCU-ȘTEF PSD și ION POPESCU"
    assert one(spark, text.capital_names(F.col("t")), t=line) == ["ION POPESCU", "BB CC DD EE", "FF GG", "ION POPESCU-ȘTEF PSD"]
    assert one(spark, text.capital_names(F.col("t")), t="") == []
