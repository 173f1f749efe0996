"""Importance resampling, decontamination and hard negatives against plain Python on odd tables and large groups."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import hard_negatives, importance_resampling, winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENT = "doc_id long, text string, weight string, score string, words long, key string, item string, batch long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def docs_of(spark, texts):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "w", "s", 1, "k", "i", 2) for i, t in texts], DOCUMENT)


def random_texts(seed, n, most=60):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gämma", "d4", "É", "漢字", "zeta-eta", "the", "THE", "of"] + [f"w{i}" for i in range(30)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(most))) for _ in range(n)]


def odd_texts():
    texts = list(enumerate(random_texts(1, 60)))
    copy = " ".join(f"same{i}" for i in range(25))
    texts += [(100 + i, copy) for i in range(200)] + [(100, copy), (None, copy), (500, None), (501, ""), (502, " \t.\n"), (503, "Ünï-cödé \U0001f600 " * 30)]
    return texts + [(504, "long " * 60_000 + "end"), (505, "x" * 3_000_000), (506, "a." * 300)]


# --- op11 ---------------------------------------------------------------------------------------


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resampling(texts, items):
    docs = [(i, len(words(t)), buckets(t)) for i, t in texts]
    s, t = np.zeros(10000), np.zeros(10000)
    for _, _, b in docs:
        s += np.bincount(b, minlength=10000) if b else 0
    for text in items:
        t += np.bincount(buckets(text), minlength=10000) if buckets(text) else 0
    gain = np.floor(1000 * np.log((t + 1) * (s.sum() + 10000) / ((s + 1) * (t.sum() + 10000)))).astype(int)
    rows = []
    for i, n, b in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = int(gain[b].sum()) if b else 0
        rows.append((i, n, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(*r, k + 1) for k, r in enumerate(able[: 5 * len(able) // 100])]
    return sorted(map(repr, drawn + [(*r, None) for r in able[len(drawn) :]] + [(*r, None) for r in rows if r[1] < 20]))


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


@pytest.mark.parametrize("items", [random_texts(2, 20) + [None, ""], []])
def test_resampling_equals_plain_python(spark, items):
    got = importance_resampling.resample(docs_of(spark, odd_texts()), items_of(spark, items))
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_resampling(odd_texts(), items)


def test_resampling_of_an_empty_table(spark):
    assert importance_resampling.resample(docs_of(spark, []), items_of(spark, ["a b"])).count() == 0


def test_gains_are_copied_where_there_are_many_batches(spark, monkeypatch):
    monkeypatch.setattr(importance_resampling, "BATCHES", 1)
    texts = odd_texts()[:80]
    got = importance_resampling.resample(docs_of(spark, texts).repartition(5), items_of(spark, ["w1 w2 the"]))
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_resampling(texts, ["w1 w2 the"])


def test_postings_are_read_in_small_groups(spark, monkeypatch):
    """Readers hold up to 4096 rows of a row group at once, and a row of postings is large."""
    from pathlib import Path

    import pyarrow.parquet as pq

    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(root.glob("resample-postings-*"))
    monkeypatch.setattr(importance_resampling, "SLICE", 1 << 12)
    monkeypatch.setattr(importance_resampling._index, "__defaults__", (1 << 12,))
    monkeypatch.setattr(importance_resampling, "READ", 1 << 16)
    docs = docs_of(spark, enumerate(random_texts(11, 6000))).coalesce(1)
    sent = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert importance_resampling.resample(docs, spark.createDataFrame([(1, "b")], "item_id long, text string")).count() == 6000
    (written,) = set(root.glob("resample-postings-*")) - before
    groups = [g for f in written.glob("*.parquet") for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(i).total_byte_size for i in range(m.num_row_groups))]
    assert len(groups) > 1 and max(groups) < 1 << 20
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) >= min(int(sent), 2000)


def test_checksums_of_runs_and_pieces():
    texts = random_texts(5, 40) + ["y" * 70 + " " + "z" * 9000 + " q", "", "A", "ab cd"]
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        for piece in (3, 50, 100_000):
            n_words, n_features, counts = importance_resampling._long_text(data, 10000, 3, piece)
            want = buckets(text)
            assert (n_words, n_features) == (len(words(text)), len(want))
            assert (counts == np.bincount(want, minlength=10000)).all() if want else not counts.any()


# --- op12 ---------------------------------------------------------------------------------------


def plain_contamination(texts, items, window=10):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in known}
    out = set()
    for _, text in texts:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                at = known.get(tuple(w[i : i + n]))
                if at:
                    hit |= set(range(i, i + n))
                    found |= at
        if hit:
            out.add((hashlib.sha256((text or "").encode()).digest(), len(hit), tuple(sorted(found))))
    return out


def planted():
    """Documents with whole items, parts of them at both ends, near misses and short items; and the items."""
    rng = random.Random(8)
    items = [(i, " ".join(f"t{rng.randrange(60)}" for _ in range(rng.randrange(10, 40)))) for i in range(20)]
    common = " ".join(f"c{i}" for i in range(14))
    items += [(100 + i, f"own{i} words {common} then{i}") for i in range(30)]
    items += [(200, "Only FIVE words are here"), (201, "one"), (202, "two words"), (203, ""), (204, None), (None, items[3][1]), (5, "another text of item five with words enough for it all"), (5, items[5][1])]
    items += [(300, "again " * 30)]
    texts = odd_texts()[:40] + [(500, None), (501, "")]
    for k, (_, text) in enumerate(items[:20]):
        w = text.split()
        texts += [(1000 + k, "pre fix " + text + " tail"), (1100 + k, " ".join(w[:10])), (1200 + k, "x " + " ".join(w[-10:])), (1300 + k, " ".join(w[:9]) + " stop")]
    texts += [(1400 + i, f"start {common} end") for i in range(60)] + [(1401, f"start {common} end")]
    texts += [(1500, "say only five, words: are here!"), (1501, "there is one here"), (1502, "two  words"), (1503, "again " * 50), (1504, "again " * 9)]
    return texts, items


@pytest.mark.parametrize("most", [500_000, 0])
def test_contamination_equals_all_windows(spark, most):
    texts, items = planted()
    listed = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.contamination(docs_of(spark, texts), listed, most_broadcast=most)
    assert {(bytes(r["key"]), r["n_hit"], tuple(r["items"])) for r in got.collect()} == plain_contamination(texts, items)


def test_contamination_of_random_texts_by_every_window_length(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(40)))) for i in range(80)]
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 16)))) for i in range(12)]
    listed = spark.createDataFrame(items, "item_id long, text string")
    for window in (10, 5, 1):
        got = winnowing.contamination(docs_of(spark, texts), listed, window=window)
        assert {(bytes(r["key"]), r["n_hit"], tuple(r["items"])) for r in got.collect()} == plain_contamination(texts, items, window)
    with pytest.raises(ValueError):
        winnowing.contamination(docs_of(spark, texts), listed, window=16)


def test_clean_documents_stay(spark):
    texts, items = planted()
    listed = spark.createDataFrame(items[:20], "item_id long, text string")
    docs = docs_of(spark, texts)
    dirty = {k for k, _, _ in plain_contamination(texts, items[:20])}
    want = sorted(repr(i) for i, t in texts if hashlib.sha256((t or "").encode()).digest() not in dirty)
    kept = winnowing.decontaminate(docs, listed)
    assert kept.columns == docs.columns and sorted(repr(r["doc_id"]) for r in kept.collect()) == want
    assert winnowing.decontaminate(docs, listed.limit(0)).count() == len(texts)
    assert winnowing.decontaminate(docs.limit(0), listed).count() == 0


# --- op13 ---------------------------------------------------------------------------------------

VECTOR = "vec_id long, embedding array<float>, label int, w long, digit long, n long, score long"


def plain_negatives(rows, every):
    usable = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, v in usable:
        if i % every:
            continue
        near = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, k) for j, k, w in usable if len(w) == len(v)]
        for minus, j in sorted((s, j) for s, j, k in near if k == label and j != i)[:5]:
            fits = sorted((s, m) for s, m, k in near if k != label and 80 * -minus <= 100 * -s <= 100 * -minus)[:5]
            out += [(i, j, r + 1, m, -minus, -s) for r, (s, m) in enumerate(fits)]
    return sorted(out)


def vectors(kind):
    rng = np.random.default_rng(3)
    if kind == "random":
        return [(i, rng.normal(size=8).tolist(), int(rng.integers(3))) for i in range(400)]
    if kind == "equal":  # more than half of the rows are one vector, under both labels
        same = [0.5, 0.25, -0.125, 0.0]
        return [(i, same if i % 3 else rng.normal(size=4).tolist(), i % 2) for i in range(3000)]
    nan, inf = float("nan"), float("inf")
    odd = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.5, 1.0], 2), (10, None, 1), (20, [nan, 1.0], 1), (30, [1.0, None], 1), (40, [inf, 1.0], 1), (50, [1.0, 1.0], None), (60, [], 1)]
    odd += [(70, [], 2), (80, [0.0, 0.0], 1), (81, [0.0, 0.0], 2), (82, [0.0, 0.0], 1), (None, [1.0, 0.5], 2), (-10, [0.9, 0.5], 1), (-11, [0.8, 0.5], 2), (5, [0.7, 0.5], 2), (5, [0.7, 0.6], 1), (90, [1.0, 2.0, 3.0], 1)]
    return odd + [(2**62, [0.9, 0.4], 2), (100, [1e5, 1.0], 1), (101, [9e4, 1.0], 1), (102, [8.5e4, 1.0], 2)]


@pytest.mark.parametrize("kind", ["random", "equal", "odd"])
def test_negatives_equal_all_pairs(spark, kind):
    rows = vectors(kind)
    every = 500 if kind == "equal" else 10
    df = spark.createDataFrame([(i, v, label, 1, 2, 3, 4) for i, v, label in rows], VECTOR).repartition(6)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, every)


def test_negatives_in_many_rounds_and_of_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "SCORES", 500)
    monkeypatch.setattr(hard_negatives, "DIGIT", 3)
    rows = vectors("random")
    df = spark.createDataFrame([(i, v, label, 1, 2, 3, 4) for i, v, label in rows], VECTOR)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 10)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.col("vec_id") < 0).count() == 0
