"""A corpus from raw documents: language, near copies, repeated passages, mix, packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm import curve_packing, ngram_join, ppm_language, source_mix, suffix_dedup
from vitrine.llm.common import bounded_batches, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bits a byte above which a document is text of no learned language.
MOST_BITS = 6.0
#: Near copies: words per shingle and least similarity.
WORDS, LEAST = 5, (80, 100)

#: Chunks that a worker remembers while it packs: it lives on into other stages.
REMEMBER = 250_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are text of a learned language, with the language they are in.

    Null texts, texts without a letter and texts that every language codes in more than MOST_BITS
    bits a byte go."""
    bounded_batches(spark)
    found = ppm_language.predict(docs.select(*COLUMNS), ppm_language.train(docs))
    kept = found.where((F.col("lang_pred") != ppm_language.UNDETERMINED) & (F.col("bits_per_byte") <= MOST_BITS))
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies; one of each repeated row."""
    bounded_batches(spark)
    groups = ngram_join.similarity_groups(docs, WORDS, LEAST)
    others = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.select(*COLUMNS).join(others, "doc_id", "left_anti")
    turn = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("source", "lang"))
    return kept.withColumn("turn", turn).where("turn = 1").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that 200-byte strings repeat; what is left empty goes.

    Cut characters go whole: bytes that no longer make one are dropped."""
    bounded_batches(spark)
    kept = suffix_dedup.remove_repeats(docs, carry=["lang", "source"], whole_characters=True)
    kept = kept.withColumn("text", F.col("kept").cast("string")).where("text <> ''")
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    same = Window.partitionBy("doc_id", "source", "size").orderBy("copies")
    copies = source_mix.mix(docs).withColumn("turn", F.row_number().over(same)).where("copies > 0")
    copies = copies.select(*(F.col(c).alias(f"{c}_") for c in ("doc_id", "source", "size", "turn", "copies")))
    keyed = docs.select(*COLUMNS, source_mix.word_count().alias("size"))
    keyed = keyed.withColumn("turn", F.row_number().over(same.orderBy("text")))
    on = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in ("doc_id", "source", "size", "turn")]
    each = F.explode(F.sequence(F.lit(1), F.col("copies_").cast("int")))
    return keyed.join(copies, on).select(*COLUMNS, each.alias("copy")).drop("copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as packed sequences of 1024 ids."""
    bounded_batches(spark)
    return curve_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), remember=REMEMBER, live_on=False)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("mix", mix),
    ("pack", pack),
]
#: SQL expresses neither the language model nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
