"""Declarations of interests line by line."""

from pyspark.sql import functions as F

from vitrine.functions.sections import interests

TEXT = """Subsemnata, declar pe propria răspundere:
1. Asociat sau acționar la societăți comerciale
Unitatea - denumirea și adresa
1.1 SC Alfa SRL 12 părți 5.000 lei
- Beta S.A.
un rând care nu spune nimic
2. Calitatea de membru în organele de conducere
2.1 Gama
Nota: se vor declara și SC Delta SRL
asociat sau acționar scris încă o dată, fundația Epsilon
precum si SC Zeta SRL
4. Membru al partidelor politice
PNL
5. Contracte, inclusiv cele de asistență juridică, asistenta juridica
5.1 contract 1.234,50 EUR"""


def read(spark, text, boilerplate=()):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(interests(df["text"], boilerplate).alias("d")).first()["d"].asDict(recursive=True)


def test_sections_count_rows_and_entities(spark):
    found = read(spark, TEXT)
    assert found["counts"] == {"actionariat": 2, "conducere": 2, "prof_sindicat": 0, "partid": 0, "contracte": 1}
    assert found["entities"] == ["1.1 SC Alfa SRL 12 părți 5.000 lei", "Beta S.A.", "asociat sau acționar scris încă o dată, fundația Epsilon"]
    assert found["amounts"]["actionariat"] == 5000.0 and found["amounts"]["contracte"] == 6234.23
    assert found["text_extracted"] and found["has_any"]


def test_lines_of_the_form_are_taken_off(spark):
    assert read(spark, TEXT, ("beta s.a.",))["counts"]["actionariat"] == 1


def test_short_and_missing_texts(spark):
    for text in (None, "", "1.1 SC Alfa SRL", "x" * 79):
        found = read(spark, text)
        assert not found["text_extracted"] and not found["has_any"] and found["entities"] == [] and set(found["counts"].values()) == {0}
    assert read(spark, "x" * 80)["text_extracted"]


def test_one_line_that_opens_two_sections(spark):
    text = "organele de conducere ale partidelor politice\nPartidul X\n" + "fara sens " * 10
    assert read(spark, text)["counts"] == {"actionariat": 0, "conducere": 0, "prof_sindicat": 0, "partid": 1, "contracte": 0}


def test_the_text_is_worked_out_once(spark):
    df = spark.range(3).coalesce(1).selectExpr("concat('1. Asociat sau acționar\n1.1 SC Alfa SRL ', repeat('x', 80), id) AS text")
    text = df.select(interests(F.reverse(F.reverse("text"))).alias("d"))
    plan = text._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(reverse(") == 1
    assert all(r["d"]["counts"]["actionariat"] == 1 for r in text.collect())


def test_blanks_tabs_and_twelve_words(spark):
    head = "asociat sau acționar la societăți\n" + "x" * 80 + "\n"
    twelve = "SC Alfa SRL" + " a" * 9
    found = [read(spark, head + x)["counts"]["actionariat"] for x in (twelve, twelve + " b", twelve.replace(" a", " \t  a"), twelve.replace(" a", " \t  a") + "\tb", "un\t itatea SC Alfa SRL", "SRL")]
    assert found == [1, 0, 1, 0, 0, 0]
