"""Similarity groups of a table with repeated rows."""

import duckdb
import numpy as np

import vitrine.llm as llm
from vitrine.llm import ngram_join


def test_rows_there_twice_find_the_same_groups(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(8):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 100)]
        rows += [(10 * group + i, " ".join(words[: 20 * i] + ["changed"] * (i > 0) + words[20 * i + (i > 0) :])) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(llm.oracle_sql()["op7_ngram_join"]).fetchall())
    assert len({r[2] for r in want}) == 8
    assert sorted(tuple(r) for r in ngram_join.similarity_groups(docs.unionByName(docs), block=2).collect()) == sorted(2 * want)
