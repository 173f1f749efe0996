"""Large groups, equal and odd vectors, and packed pieces against brute force."""

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from conftest import SMALL
from tokenizers import Tokenizer

import vitrine.llm as llm
from vitrine.llm import curve_packing, lattice_dedup, ngram_join, posting_ann


def test_large_components_equal_sql(spark):
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
    rows = []
    for i in range(80):  # near copies of one text, some of them too far from it
        words = list(base)
        for k in rng.integers(0, 300, int(rng.integers(0, 14))):
            words[k] = f"z{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 100))) for i in range(80, 160)]  # a chain
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(llm.oracle_sql()["op7_ngram_join"]).fetchall())
    assert sorted(tuple(r) for r in ngram_join.similarity_groups(docs, block=12, grams=4000).collect()) == want


def test_heap_merge_counts():
    rng = np.random.default_rng(2)
    for need in (1, 2, 5, 9):
        lists = [sorted(set(rng.integers(0, 60, 25).tolist())) for _ in range(12)]
        counts = Counter(x for one in lists for x in one)
        found, times = ngram_join.merge_skip(lists, need)
        assert dict(zip(found, times, strict=True)) == {x: n for x, n in counts.items() if n >= need}


def test_long_sets_that_link_share_a_part():
    rng = np.random.default_rng(3)
    for least, size in (((90, 100), 2000), ((80, 100), 700), ((90, 100), 300), ((80, 100), 40)):
        for _ in range(30):
            both = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            apart = int(size * (1 - least[0] / 100) / (least[0] / 100) / 2)  # just linked
            one, two = (np.sort(np.concatenate([both, rng.integers(0, 1 << 63, apart, dtype=np.uint64)])) for _ in range(2))
            keys, sets = ngram_join.part_keys(np.concatenate([one, two]), np.array([len(one), len(one) + len(two)]), least)
            assert set(keys[sets == 0].tolist()) & set(keys[sets == 1].tolist())
            assert size < 500 or len(keys) <= 2 * ngram_join.PARTS


def test_equal_and_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (7, [2.0, 4.0]), (2, [2.0, 1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None])]
    table = spark.createDataFrame(rows + [(20, [-3.0, 2.0, 1.0])] * 2, "vec_id long, embedding array<double>").selectExpr("*", "vec_id AS m", "vec_id AS component")
    found = sorted(tuple(r) for r in lattice_dedup.near_duplicates(table).collect())
    linked = [(0, 2, 0, True), (1, 2, 0, False), (7, 2, 0, False)]
    assert found == sorted(linked + [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 20, 20)])
    near = posting_ann.nearest(table, table.where("vec_id in (0, 3, 4, 5, 20)")).collect()
    assert [tuple(r) for r in sorted(near)] == [(0, 1, 7, 10.0), (0, 2, 1, 5.0), (20, 1, 2, -4.0)]
    assert posting_ann.nearest(table.limit(0), table.limit(0)).count() == 0


def test_lists_are_pruned_at_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((200, 24)) * 3
    x = centres[rng.integers(0, 200, 8000)] + rng.standard_normal((8000, 24)) * 0.4
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got: dict[int, set] = {}
    for r in posting_ann.nearest(table, table.where("vec_id % 200 = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q in range(0, 8000, 200):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9
    index = posting_ann.fit(table)
    rows, _ = posting_ann.near_lists(index, posting_ann.as_queries(x[::200]), index.ratio, posting_ann.LEAST_LISTS, index.most)
    assert len(rows) / 40 < len(index.centroids) / 4


def test_pieces_equal_the_plain_tokenizer(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "a <|endoftext|> b"), (-4, "word " * 5000)], "doc_id long, text string")
    docs = docs.unionByName(odd)
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = curve_packing.pack_documents(docs, path, partitions=5).toPandas()
    for doc, pieces in got.groupby("doc_id"):
        pieces = pieces.sort_values("start")
        ids = np.concatenate([np.frombuffer(x, "<u2") for x in pieces["ids"]]).tolist()
        assert ids == [*plain.encode(text.pop(doc), add_special_tokens=False).ids, 0]
    assert not text
    filled = got.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 1024 and (filled < 1024).sum() <= 5
