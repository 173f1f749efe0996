"""The corpus operators against SQL, brute force, round trips and held-out accuracy."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import vitrine.llm as llm
from conftest import SMALL
from vitrine.llm import arc_warc, curve_packing, html_blocks, lattice_dedup, ngram_join, packed_ids, posting_ann, ppm_language, source_mix, suffix_dedup

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, component long, key string"
ODD = [
    (1, "one two three four five six", "en", "a", 1, 9, "x"),
    (1, "one two three four five six", "en", "a", 1, 9, "x"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "", 0, 0, ""),
    (None, "one two three four five six", "en", "a", 1, 1, "y"),
    (4, " \t\n", "fr", "b", 3, 1, "z"),
    (5, "Ünïcode wörd — 漢字 \U0001f600 tail", "de", "b", 3, 1, "z"),
    (6, "long " * 60_000, "en", "a", 1, 1, "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENT)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(name, spark, duck, same):
    same(llm.queries()[name](spark, SMALL), duck, llm.oracle_sql()[name])


def test_arc_versions_read_back_as_warc():
    for version in (1, 2):
        content = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>\n2 x y\n</p>"
        arc = arc_warc.arc_header(version, "n") + 2 * arc_warc.arc_record(version, "http://a/ b", "20010203040506", "text/html", content, 0, "n")
        records = list(arc_warc.read_arc(arc))
        assert [r["content"] for r in records] == [content] * 2
        fields, block = arc_warc.parse_warc(arc_warc.warc_from_arc(records[0], None))
        assert block == content and fields["WARC-Date"] == "2001-02-03T04:05:06Z" and fields["WARC-Target-URI"] == "http://a/%20b"
    with pytest.raises(ValueError):
        list(arc_warc.read_arc(arc[:-20]))


def test_archives_of_odd_pages(spark, tmp_path):
    big = "x" * 3_000_000
    rows = [(1, "u", None, 1), (2, None, "", 2), (3, "u", "y" * 200, 3), (4, "u", "y" * 200, 4), (None, "u", "y" * 200, 5), (5, "u", big, 6), (3, "u", "y" * 200, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest long")
    got = arc_warc.read_archives(arc_warc.write_archives(pages, f"file://{tmp_path}/a", 2))
    found = {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got.collect()}
    assert got.count() == 7
    assert {(1, 0, "response", None), (2, 0, "response", None), (3, 200, "response", None), (4, 200, "revisit", 3), (5, 3_000_000, "response", None)} <= found
    assert arc_warc.read_archives(arc_warc.write_archives(pages.limit(0), f"file://{tmp_path}/b")).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 8)) * 2
    p = lattice_dedup.nearest_e8(x)
    best = ((x - p) ** 2).sum(axis=1)
    for v in lattice_dedup._minimal_vectors():
        assert (((x - p - v) ** 2).sum(axis=1) >= best - 1e-9).all()


def test_odd_vectors_link_with_nothing(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, []), (8, [0.0, 1.0]), (9, [1.0]), (2, [2.0, 0.1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: tuple(r)[1:] for r in lattice_dedup.near_duplicates(vectors).collect()}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False)
    assert all(got[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9))
    assert lattice_dedup.near_duplicates(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("vocabulary", [2, 3, 256, 257, 49_408, 65_537])
def test_packed_ids_unpack(vocabulary):
    ids = np.random.default_rng(1).integers(0, vocabulary, 1001).astype(np.uint32)
    bits = packed_ids.bits_for(vocabulary)
    assert (packed_ids.unpack(packed_ids.pack(ids, bits), len(ids), bits) == ids).all()


def _ids(name, text, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_shards_hold_the_tokenizer_ids(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd.select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packed_ids.read_shards(packed_ids.write_shards(docs, f"file://{tmp_path}", path, True)).orderBy("start").collect()
    texts = docs.orderBy(F.col("doc_id").asc_nulls_first(), F.length("text")).collect()
    at, want = 0, []
    for row in texts:
        ids = np.array(_ids("word_bpe_49k.json", row["text"], 1), "<u4")
        want.append((row["doc_id"], len(ids), zlib.crc32(ids)))
    assert [tuple((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got] == want
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]


def test_packed_sequences_hold_every_id_once(spark, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = curve_packing.pack_documents(odd.where("doc_id in (3, 4, 5, 6)"), path, partitions=3).collect()
    for doc_id, text in ((3, ""), (4, " \t\n"), (5, ODD[6][1]), (6, ODD[7][1])):
        pieces = sorted((r["start"], r["length"], r["ids"]) for r in rows if r["doc_id"] == doc_id)
        ids = np.concatenate([np.frombuffer(p[2], "<u2") for p in pieces])
        assert ids.tolist() == _ids("byte_bpe_50k.json", text, 0)
        assert [p[0] for p in pieces] == np.cumsum([0, *[p[1] for p in pieces[:-1]]]).tolist()
    for sequence in {r["sequence_id"] for r in rows}:
        filled = sorted((r["offset"], r["length"]) for r in rows if r["sequence_id"] == sequence)
        assert [o for o, _ in filled] == np.cumsum([0, *[n for _, n in filled[:-1]]]).tolist() and sum(filled[-1]) <= 1024
    assert curve_packing.pack_documents(none, path).count() == 0


def test_hilbert_neighbours_touch():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = curve_packing.hilbert_keys(cells, 3)
    ordered = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(side**3)) and (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def test_main_text():
    page = (
        "<html><head><title>t</title></head><body><nav><a href=x>Home</a> <a href=y>News</a></nav><article><h1>A title of it</h1>"
        "<p>Tom &amp; Ann went  <b>out</b>\nfor a long walk in the park today and came back late.</p>"
        "<p>They said that it had been a good day for all of them in spite of rain.</p></article>"
        "<div class='comments'><p>What a nice text this is, thank you for writing it.</p></div><footer>Copyright</footer><script>x<y</script></body></html>"
    )
    want = "A title of it\n\nTom & Ann went out for a long walk in the park today and came back late.\n\nThey said that it had been a good day for all of them in spite of rain."
    assert html_blocks.main_text(page, html_blocks.trained()) == want
    assert html_blocks.main_text("", html_blocks.trained()) == ""


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (None, None, "", 6), (2, "u", "<p" * 50_000, 7)], "page_id long, url string, html string, text long")
    assert [(r["text"], r["n_chars"]) for r in html_blocks.extract(pages).collect()][:2] == [("", 0), ("", 0)]
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_mix_follows_targets(spark, odd, none):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"), F.when(F.col("id") % 3 > 0, "a").otherwise(F.when(F.col("id") % 2 > 0, "b")).alias("source"))
    rows = source_mix.mix(docs).collect()
    for source in ("a", "b", None):
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 100
        assert all(0 <= r["copies"] <= 2 for r in own)
    assert source_mix.mix(odd).count() == len(ODD) and source_mix.mix(none).count() == 0


def test_groups_of_odd_documents(odd, none):
    got = [tuple(r) for r in ngram_join.similarity_groups(odd).collect()]
    assert len(got) == len(ODD) and got.count((1, 4, 1)) == 2 and (None, 4, 1) in got
    assert {(2, 0, 2), (3, 0, 3), (4, 0, 4)} <= set(got)
    assert ngram_join.similarity_groups(none).count() == 0


@pytest.mark.parametrize("block", [2, 7])
def test_small_units_find_the_same_groups(spark, duck, block):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = sorted(duck.execute(llm.oracle_sql()["op7_ngram_join"]).fetchall())
    assert sorted(tuple(r) for r in ngram_join.similarity_groups(docs, block=block).collect()) == want


def test_language_of_held_out_documents(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = ppm_language.predict(docs, ppm_language.train(docs)).where(ppm_language.held_out() & F.col("lang").isNotNull() & (F.col("lang_pred") != "und"))
    right, all_ = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.95 * all_
    odds = {r["doc_id"]: r["lang_pred"] for r in ppm_language.predict(odd, ppm_language.train(docs)).collect()}
    assert odds[2] == odds[3] == odds[4] == "und" and odds[6] != "und"
    assert ppm_language.predict(odd, ppm_language.train(none)).where("lang_pred <> 'und'").count() == 0


def test_ppm_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, "abracadabra alakazam", "x") for i in range(8)], "doc_id long, text string, lang string")
    model = ppm_language.train(docs)
    for context in (b"abr", b"zzz", b"aka"):
        keys = (np.uint32(int.from_bytes(context, "big")) << np.uint32(8)) | np.arange(256, dtype=np.uint32)
        assert abs(np.exp2(-model.bits(keys)).sum() - 1) < 1e-6


@pytest.mark.parametrize("hot", [1, 4])
def test_repeats_by_narrowing_equal_sql(spark, duck, same, hot):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    done = suffix_dedup.remove_repeats(docs, hot=hot)
    size, spans = F.length("kept"), F.size("spans").cast("long").alias("n_spans")
    got = done.select("doc_id", "n_bytes", (F.col("n_bytes") - size).cast("long").alias("n_removed"), spans, F.sha2("kept", 256).alias("kept_sha256"))
    same(got, duck, llm.oracle_sql()["op9_suffix_dedup"])


def test_repeats_of_odd_documents(odd, none):
    got = {r["doc_id"]: (r["n_bytes"], len(r["kept"])) for r in suffix_dedup.remove_repeats(odd).collect()}
    assert got[2] == (0, 0) and got[3] == (0, 0) and got[6] == (300_000, 0) and got[5][0] == got[5][1]
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_deep_shallow_sorts():
    rng = np.random.default_rng(2)
    strings = [bytes(rng.integers(97, 99, int(n)).tolist()) for n in rng.integers(0, 90, 300)] + [b"a" * 150] * 3 + [b"a" * 149]
    group = np.zeros(len(strings), np.int64)
    order, same = suffix_dedup.deep_shallow(group, strings)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    common = [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(ordered, ordered[1:], strict=False)]
    assert same[1:].tolist() == common


def test_nearest_neighbours_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 24))[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 24)) * 0.4
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = posting_ann.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert abs(r["score"] - float(x[r["query_id"]] @ x[r["vec_id"]])) < 1e-9
    hit = 0
    for q in range(0, 6000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    assert hit >= 0.9 * 20 * 300
    assert posting_ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_pipeline_keeps_what_its_stages_keep(spark, tmp_path):
    import corpus_pipeline as pipeline

    copy = "the quick brown fox jumps over the lazy dog and then it runs away into the wood where it lives with others"
    rows = [(1, copy, "en", "a", 1), (2, copy + " today", "en", "b", 1), (3, None, "en", "a", 0), (4, "123 456", "en", "a", 0), (5, "un petit chat mange du pain dans la maison avec ses amis", "fr", "b", 1)]
    rows += [(10 + i, f"this is text number {i} in the english language of the house and the garden", "en", "a", 1) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = pipeline.language(spark, docs, str(tmp_path))
    assert kept.columns == pipeline.COLUMNS and {3, 4}.isdisjoint(r["doc_id"] for r in kept.collect())
    unique = {r["doc_id"] for r in pipeline.near_copies(spark, docs, "").collect()}
    assert 1 in unique and 2 not in unique and 5 in unique
    assert pipeline.mix(spark, docs, "").columns == pipeline.COLUMNS
    packed = pipeline.run(spark, str(tmp_path)).collect()
    assert packed and max(r["length"] for r in packed) <= 1024
