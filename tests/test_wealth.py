"""Declarations of wealth, printed and recognised."""

import pytest

from vitrine.functions import wealth

TEXT = """DECLARAȚIE DE AVERE
I. Bunuri imobile
1. Terenuri
agricol, 1.500 m², 3 m
2. Clădiri
apartament 75,5 m²
casă 1200 mp
II. Bunuri mobile
Autoturism Dacia, şalupă, motocicletă
III. Bunuri mobile, bijuterii 7.000 EUR
IV. Active financiare
cont curent 150.000 lei, 75.500,50 RON, 100 lei, 1,234.5 USD
V. Datorii
BCR 2.000 EUR
VI. Cadouri
VII. Venituri
salariu 60.000 lei
Prezenta declaratie"""


def read(spark, function, text):
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(function(df["t"]).alias("d")).first()["d"]
    return found.asDict() if hasattr(found, "asDict") else found


def test_printed_declaration(spark):
    found = read(spark, wealth.wealth, TEXT)
    assert found == {
        "text_extracted": True, "needs_ocr": False, "land": 2, "buildings": 2, "area": 1500 + 75.5 + 1200, "accounts": pytest.approx(150000 + 75500.5 + 1234.5 * 4.5),
        "income": 60000.0, "debts": pytest.approx(10100.0), "vehicles": 3,
    }


def test_recognised_declaration(spark):
    noisy = "BUNURI IMOBILE teren 1500 rn2, casa 80 m 2, 12 marfa BUNURI MOBILE autoturism, AUTOVEHICUL ACTIVE FINANCIARE 150.000 75 500,50 999 DATORII 9.000 VENITURI 60.000 le1 Prezenta 70.000"
    assert read(spark, wealth.wealth_ocr, noisy) == {"text_extracted": True, "land": 2, "accounts": 225500.5, "income": 60000.0, "vehicles": 2}


def test_short_and_missing_texts(spark):
    for text in (None, "", "x" * 99, "I. Bunuri imobile"):
        found = read(spark, wealth.wealth, text)
        assert found["needs_ocr"] and not found["text_extracted"] and found["area"] == 0 and found["accounts"] == 0 and found["land"] == 0
    assert not read(spark, wealth.wealth_ocr, "x" * 79)["text_extracted"]


def test_kinds(spark):
    assert read(spark, wealth.declaration_kinds, TEXT) == ["avere"]
    assert read(spark, wealth.declaration_kinds, "Declarație de  INTERESE și bunuri imobile") == ["avere", "interese"]
    assert read(spark, wealth.declaration_kinds, None) == []


def test_lines_of_governing_bodies(spark):
    text = "2. organele de conducere ale societăților\n - SC Alfa SRL, administrator\n\n • abc\n\tBeta SA\ncalitatea de membru în partide\nGama SRL"
    assert read(spark, wealth.board_lines, text) == ["SC Alfa SRL, administrator", "Beta SA"]
    assert read(spark, wealth.board_lines, "nothing") == [] == read(spark, wealth.board_lines, None)
