"""Every language is learned, whatever its documents look like."""

import numpy as np
from pyspark.sql import functions as F

from vitrine.llm import ppm_language


def test_more_than_64_languages_are_learned(spark):
    rows = [(10 * i + j, chr(0x4E00 + 50 * i + j % 2) * 40 + " abc", f"l{i:03d}") for i in range(70) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = ppm_language.train(docs)
    assert model.languages == sorted({r[2] for r in rows})
    found = ppm_language.predict(docs, model)
    assert found.where("lang <> lang_pred").count() == 0


def test_groups_of_languages_pay_what_one_table_pays(spark):
    docs = spark.createDataFrame([(i, "abra kadabra "[i % 7 :] * 3, f"l{i % 5}") for i in range(60)], "doc_id long, text string, lang string")
    counts = ppm_language.gram_counts(ppm_language.training_pieces(docs)).toPandas()
    one, many = ppm_language.PpmModel(counts), ppm_language.PpmModels(counts, group=2)
    data = np.frombuffer(b"abra kazam\xc3\xa9 zzz", np.uint8)
    offsets = np.array([0, 6, 6, len(data)])
    assert len(many.models) == 3 and np.allclose(one.code_lengths(data, offsets), many.code_lengths(data, offsets))


def test_long_and_repeated_documents_are_sampled_by_pieces(spark):
    docs = spark.createDataFrame([(i, "x") for i in (1, 3, 4)], "doc_id long, lang string").where(~ppm_language.held_out())
    long_ = docs.select("doc_id", F.lit("long").alias("lang"), F.repeat(F.concat(F.lit("word "), F.col("doc_id").cast("string")), 200_000).alias("text"))
    again = spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("again").alias("lang"), F.lit("one row " * 20).alias("text"))
    both = long_.unionByName(again)
    sizes = {r["lang"]: r["n"] for r in ppm_language.training_pieces(both, 100_000).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert 40_000 < sizes["long"] < 200_000 and sizes["again"] > 0
    assert ppm_language.train(both, 100_000).languages == ["again", "long"]
