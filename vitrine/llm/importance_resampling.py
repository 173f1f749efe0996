"""Importance resampling towards a target corpus over hashed word runs, by inverted postings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import binary_views, bounded_batches, lean, slices, text_bytes, write_table
from vitrine.sources.tables import table

#: Buckets of features, longest run of words, least words of a document that may be drawn, part drawn.
BUCKETS, RUN, LEAST_WORDS, SHARE, SEED = 10_000, 3, 20, (5, 100), 42
#: Buckets of one group of postings (a code of one byte), bytes of text indexed at once, batches of
#: documents that one copy of the gains serves; bytes of postings read at once, postings sent to a Python worker at once.
GROUP, SLICE, BATCHES = 256, 1 << 21, 64
READ, SENT = 8 << 20, 64

_SENT = "spark.sql.execution.arrow.maxRecordsPerBatch"
_POSTINGS = (
    "batch long, grp int, per_doc binary, codes binary, counts binary, totals array<long>, "
    "docs array<struct<doc_id:long,n_words:long,n_features:long>>"
)
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64())]))
_ARROW = pa.schema(
    [("batch", pa.int64()), ("grp", pa.int32()), ("per_doc", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())]
    + [("totals", pa.list_(pa.int64())), ("docs", _DOCS)]
)


# --- crc32 of many words and runs of words at once ---------------------------------------------


@lru_cache
def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The byte table of crc32, and what appending 0..64 and 2**k zero bytes does to each byte of a crc."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    places = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    by_length = [places]
    for _ in range(64):
        last = by_length[-1]
        by_length.append(step[last & 255] ^ (last >> np.uint32(8)))
    powers = [by_length[64]]
    for _ in range(26):
        powers.append(_apply(powers[-1].ravel(), 0, powers[-1]))
    return step, np.stack(by_length).ravel(), np.stack(powers).ravel()


def _apply(tables: np.ndarray, base: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    out = tables[base + (crc & 255)]
    for k in (1, 2, 3):
        out = out ^ tables[base + 256 * k + ((crc >> np.uint32(8 * k)) & 255)]
    return out


def _shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The share of a prefix of checksum ``crc`` in the checksum of itself and ``length`` more bytes."""
    _, by_length, powers = _crc_tables()
    out = _apply(by_length, (length & 63) * 1024, crc)
    high, k = length >> 6, 0
    while high.any():
        at = np.flatnonzero(high & 1)
        out[at] = _apply(powers, k * 1024, out[at])
        high, k = high >> 1, k + 1
    return out


def _word_crc(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    step = _crc_tables()[0]
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    live, j = np.flatnonzero(lengths <= 64), 0
    while len(live):
        now = crc[live]
        crc[live] = step[(now ^ data[starts[live] + j]) & 255] ^ (now >> np.uint32(8))
        j += 1
        live = live[lengths[live] > j]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > 64):
        crc[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]])
    return crc


@lru_cache
def _word_bytes() -> np.ndarray:
    """For each byte whether it lies in words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text."""
    is_word = np.zeros(256, bool)
    is_word[0x30:0x3A] = is_word[0x61:0x7B] = is_word[0x80:] = True
    return is_word


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of lower-cased bytes, whose texts end at ``ends``."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _word_bytes()[data]
    change = np.diff(inside)
    starts, stops = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    cuts = ends[(ends > 0) & (ends < len(data))]
    cuts = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)])  # a word must not run on into the next text
    if len(cuts):
        starts, stops = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([stops, cuts]))
    return starts, stops - starts


def _features(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray, run: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2.. words: the index of the last word of each, and its crc32."""
    crc = _word_crc(data, starts, lengths)
    spaced = _shifted(np.full(len(crc), zlib.crc32(b" "), np.uint32), lengths) ^ crc
    last = np.arange(len(crc))
    yield last, crc
    for _ in range(1, run):
        last = last + 1
        keep = last < len(doc)
        last, crc = last[keep], crc[keep]
        keep = doc[last] == doc[last - 1]
        last, crc = last[keep], crc[keep]
        crc = _shifted(crc, lengths[last] + 1) ^ spaced[last]
        yield last, crc


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def _long_text(data: np.ndarray, buckets: int, run: int, piece: int) -> tuple[int, int, np.ndarray]:
    """Words, features and bucket counts of one long text, by pieces that repeat the last run - 1 words."""
    counts, n_words, n_features = np.zeros(buckets, np.int64), 0, 0
    begin, carried, is_word = 0, 0, _word_bytes()
    while begin < len(data):
        end = begin + piece
        while end < len(data) and is_word[_lowered(data[end : end + 1])[0]]:
            end += 1
        part = _lowered(data[begin:end])
        starts, lengths = _words(part, np.zeros(0, np.int64))
        for last, crc in _features(part, starts, lengths, np.zeros(len(starts), np.int64), run):
            new = crc[last >= carried]
            counts += np.bincount(new % np.uint32(buckets), minlength=buckets)
            n_features += len(new)
        n_words += len(starts) - carried
        if end >= len(data):
            break
        back = min(run - 1, len(starts))
        # the words repeated must leave room for new text in the next piece
        begin, carried = (begin + int(starts[-back]), back) if back else (end, 0)
        piece = max(piece, 2 * (end - begin))
    return n_words, n_features, counts


# --- postings ------------------------------------------------------------------------------------


def _index(buckets: int, run: int, with_postings: bool, slice_bytes: int = SLICE):
    groups = -(-buckets // GROUP)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        totals = np.zeros(groups * GROUP, np.int64)

        def rows(docs: list[dict], keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            """keys = (group * documents + document) * GROUP + code, sorted."""
            n, out = len(docs), []
            cell, code = keys // GROUP, (keys % GROUP).astype(np.uint8)
            per_doc = np.bincount(cell, minlength=groups * n).astype(np.uint32)
            ends = np.concatenate([[0], np.cumsum(per_doc.reshape(groups, n).sum(axis=1))]).astype(np.int64)
            for g in range(groups):
                a, b = ends[g], ends[g + 1]
                if b > a:
                    mine = per_doc[g * n : (g + 1) * n].astype("<u2")
                    out.append((number, g, mine.tobytes(), code[a:b].tobytes(), counts[a:b].astype("<u4").tobytes(), None, None))
            out.append((number, -1, None, None, None, None, docs))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

        for batch in batches:
            data, offsets = binary_views(batch.column(1))
            ids = batch.column(0)
            for a, b in slices(offsets, slice_bytes):
                doc_ids = ids.slice(a, b - a).to_pylist()
                if b - a == 1 and offsets[b] - offsets[a] > slice_bytes:
                    n_words, n_features, found = _long_text(data[offsets[a] : offsets[b]], buckets, run, slice_bytes)
                    totals[:buckets] += found
                    keys = np.flatnonzero(found)
                    docs = [{"doc_id": doc_ids[0], "n_words": n_words, "n_features": n_features}]
                    counts = found[keys]
                else:
                    text = _lowered(data[offsets[a] : offsets[b]])
                    ends = offsets[a : b + 1] - offsets[a]
                    starts, lengths = _words(text, ends)
                    doc = np.searchsorted(ends, starts, side="right") - 1
                    n_words = np.bincount(doc, minlength=b - a)
                    n_features, keys = np.zeros(b - a, np.int64), []
                    for last, crc in _features(text, starts, lengths, doc, run):
                        bucket = (crc % np.uint32(buckets)).astype(np.int64)
                        totals += np.bincount(bucket, minlength=len(totals))
                        n_features += np.bincount(doc[last], minlength=b - a)
                        if with_postings:
                            keys.append(((bucket // GROUP) * (b - a) + doc[last]) * GROUP + bucket % GROUP)
                    docs = [{"doc_id": i, "n_words": w, "n_features": f} for i, w, f in zip(doc_ids, n_words.tolist(), n_features.tolist(), strict=True)]
                    if with_postings:
                        keys, counts = _counted(np.concatenate(keys))
                if with_postings:
                    yield rows(docs, keys, counts)
                number += 1
        out = [(number, -2, None, None, None, totals[:buckets].tolist(), None)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return lean(go)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, grp, per_doc, codes, counts, gains) -> (batch, doc, weight), a row per document of the batch that the group knows."""
    for batch in batches:
        for row in range(batch.num_rows):
            r = {c: batch.column(c)[row] for c in ("batch", "per_doc", "codes", "counts", "gains")}
            per_doc = np.frombuffer(r["per_doc"].as_py(), "<u2")
            code, count = np.frombuffer(r["codes"].as_py(), np.uint8), np.frombuffer(r["counts"].as_py(), "<u4")
            gains, known = np.zeros(GROUP, np.int64), r["gains"].values
            gains[known.field("code").to_numpy()] = known.field("gain").to_numpy()
            ends = np.cumsum(np.concatenate([[0], per_doc.astype(np.int64)]))
            doc = np.flatnonzero(per_doc)
            weight = np.add.reduceat(gains[code] * count.astype(np.int64), ends[doc]) if len(doc) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(doc), r["batch"].as_py(), np.int64)), pa.array(doc.astype(np.int32)), pa.array(weight)], names=["batch", "doc", "weight"]
            )


def _indexed(texts: DataFrame, id_column: str, buckets: int, run: int, with_postings: bool) -> DataFrame:
    read = texts.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes().alias("text"))
    return read.mapInArrow(_index(buckets, run, with_postings), _POSTINGS)


def _totals(indexed: DataFrame, name: str) -> DataFrame:
    return indexed.where("grp = -2").select(F.posexplode("totals").alias("bucket", name)).where(F.col(name) > 0)


def bucket_gains(docs_index: DataFrame, target_index: DataFrame, buckets: int) -> DataFrame:
    """(bucket, s, t, gain) of every bucket with features: both corpora's counts meet by bucket."""
    none = F.lit(0).cast("long")
    both = _totals(docs_index, "s").withColumn("t", none).unionByName(_totals(target_index, "t").withColumn("s", none))
    per = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    total = per.agg(F.coalesce(F.sum("s"), none), F.coalesce(F.sum("t"), none)).first()  # two numbers
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1.0) * F.lit(float(total[0] + buckets)) / ((s + 1.0) * F.lit(float(total[1] + buckets)))
    return per.withColumn("gain", F.floor(1000.0 * F.log(ratio)).cast("long"))


def gumbel(seed: int, doc_id: str = "doc_id") -> Column:
    """floor(-1000 ln(-ln u)) of a u in (0, 1) hashed from seed and id (a null id counts as an empty string)."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    target_id: str = "item_id",
    buckets: int = BUCKETS,
    run: int = RUN,
    least_words: int = LEAST_WORDS,
    share: tuple[int, int] = SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Draw ``share`` of the documents towards ``target``: doc_id, n_words, n_features, weight, score, rank.

    Features are the runs of up to ``run`` words, hashed into ``buckets``. Tasks index about 2 MB of
    texts at a time into postings (group of 256 buckets, document, code, count), counted per document
    before anything moves, and their own totals per bucket, which are summed over both corpora to the
    gain of each bucket. Postings then meet the gains of their group, in as many copies of a group as
    the table has runs of 64 batches, so no task's input grows with the table; what every group adds to a document
    is summed by document. Scores (weight and Gumbel noise of the id) are ranked over a range
    partitioning with a table of counts per partition.

    Null text has no words; a null id hashes as an empty string and ranks after others of its score;
    repeated rows are documents of their own with equal scores; documents with fewer than
    ``least_words`` words are scored but never drawn; an empty table gives no rows, an empty target
    leaves t at 0; other columns are ignored. Texts of any length are read whole, by pieces.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    index = write_table(_indexed(docs, "doc_id", buckets, run, True), "resample-postings", READ)
    other = write_table(_indexed(target, target_id, buckets, run, False), "resample-target")
    code = F.struct((F.col("bucket") % GROUP).cast("int").alias("code"), "gain")
    gains = bucket_gains(index, other, buckets).groupBy(F.floor(F.col("bucket") / GROUP).cast("int").alias("grp"))
    gains = gains.agg(F.collect_list(code).alias("gains"))  # at most GROUP entries
    copies = max(1, index.where("grp = -1").count() // BATCHES)
    salt = F.pmod(F.xxhash64("batch"), F.lit(copies)).cast("int")
    gains = gains.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    postings = index.where("grp >= 0").select("batch", "grp", salt.alias("salt"), "per_doc", "codes", "counts")
    met = postings.hint("merge").join(gains, ["grp", "salt"]).select("batch", "per_doc", "codes", "counts", "gains")
    parts = met.mapInArrow(lean(_contributions), "batch long, doc int, weight long")
    weights = parts.groupBy("batch", "doc").agg(F.sum("weight").alias("weight"))
    known = index.where("grp = -1").select("batch", F.posexplode("docs").alias("doc", "d")).select("batch", "doc", "d.*")
    weighed = known.join(weights, ["batch", "doc"], "left").withColumn("weight", F.coalesce("weight", F.lit(0).cast("long")))
    scored = weighed.withColumn("score", F.col("weight") + gumbel(seed)).withColumn("late", F.col("n_words") < least_words)
    order = ["late", F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "batch", "doc"]
    most = spark.conf.get(_SENT)
    spark.conf.set(_SENT, str(min(SENT, int(most))))  # a row of postings is up to 0.15 MB
    try:
        scored = write_table(scored, "resample-scored")
    finally:
        spark.conf.set(_SENT, most)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = write_table(scored.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "resample-placed")
    drawn = placed.where("not late").count() * share[0] // share[1]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    base = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.col("base") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = placed.join(base, "part").withColumn("rank", rank.cast("long"))
    chosen = F.when(~F.col("late") & (F.col("rank") <= drawn), F.col("rank"))
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", chosen.alias("rank"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards ``benchmark``: doc_id, n_features, weight, score, rank (null: not drawn)."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {"op11_importance_resampling": op11_importance_resampling}

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RUNS = " UNION ALL ".join(
    f"SELECT id, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS f FROM {{0}}" for k in range(1, RUN + 1)
)
#: crc32 over the bytes of a feature, by the table of its polynomial.
_CRC = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
ORACLE_SQL = {
    "op11_importance_resampling": f"""WITH RECURSIVE step(i, b, c) AS (SELECT 0, b, b FROM range(256) r(b)
      UNION ALL SELECT i + 1, b, {_CRC} FROM step WHERE i < 8),
    crc AS (SELECT list(c ORDER BY b) AS steps FROM step WHERE i = 8),
    dw AS (SELECT doc_id, row_number() OVER () AS id, regexp_extract_all(coalesce(translate(text, {_LETTERS}), ''), '{_WORD}') AS w FROM documents),
    bw AS (SELECT row_number() OVER () AS id, regexp_extract_all(coalesce(translate(text, {_LETTERS}), ''), '{_WORD}') AS w FROM benchmark),
    df AS (SELECT id, f, count(*) AS n FROM ({_RUNS.format("dw")}) GROUP BY ALL),
    bf AS (SELECT id, f, count(*) AS n FROM ({_RUNS.format("bw")}) GROUP BY ALL),
    h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)),
    k AS (SELECT f, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket FROM h, crc),
    s AS (SELECT bucket, sum(n) AS s FROM df JOIN k USING (f) GROUP BY 1),
    t AS (SELECT bucket, sum(n) AS t FROM bf JOIN k USING (f) GROUP BY 1),
    g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (SELECT coalesce(sum(s), 0)::DOUBLE + {BUCKETS} FROM s)
      / ((s::DOUBLE + 1) * (SELECT coalesce(sum(t), 0)::DOUBLE + {BUCKETS} FROM t))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
    m AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM df JOIN k USING (f) JOIN g USING (bucket) GROUP BY 1),
    a AS (SELECT doc_id, id, len(w) < {LEAST_WORDS} AS late, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
      ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM dw LEFT JOIN m USING (id)),
    z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM a),
    r AS (SELECT *, row_number() OVER (ORDER BY late, score DESC, doc_id NULLS LAST, id) AS rank FROM z)
    SELECT doc_id, n_features, weight, score, CASE WHEN NOT late AND rank <= (SELECT count(*) FROM z WHERE NOT late) * {SHARE[0]} // {SHARE[1]}
      THEN rank END AS rank FROM r"""
}
