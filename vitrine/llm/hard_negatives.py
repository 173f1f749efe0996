"""Hard negatives for contrastive training, by distributed radix selection over integer scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import bounded_batches, lean, shared_dir, write_table
from vitrine.sources.tables import table

#: Positives of an anchor, negatives of an anchor and positive, least and greatest score of a negative in percent of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Bits of a digit, anchors of one round and bytes of their vectors (what tasks get with their code), scores at once.
DIGIT, ANCHORS, ROUND_BYTES, SCORES = 10, 8192, 1 << 25, 1 << 21


def integer_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector): components floor(256 x), without rows that take no part, equal rows once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    vector = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(vector, finite)
    floors = F.transform(vector, lambda x: F.floor(x * 256.0).cast("long"))
    kept = rows.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), floors.alias("vector"))
    return kept.distinct()


class _Windows:
    """The windows of one round. A window belongs to an anchor and asks for the first ``want`` rows by score distance
    below ``top`` (0 to ``depth``), then by id. Its prefix holds the leading bits of the last wanted row's distance, and,
    once all of them are settled, of its id; ``known`` counts the settled bits of both."""

    def __init__(self, anchor: np.ndarray, top: np.ndarray, depth: np.ndarray, want: int, same: bool, least_id: int, id_bits: int):
        n = len(anchor)
        self.anchor, self.top, self.depth, self.same = anchor, top, depth, same
        self.score_bits, self.id_bits, self.least_id = max(1, int(depth.max()).bit_length()), id_bits, np.array(least_id, np.int64)
        self.prefix, self.id_prefix = np.zeros(n, np.int64), np.zeros(n, np.uint64)
        self.want, self.known = np.full(n, want, np.int64), np.zeros(n, np.int64)
        self.open, self.empty = depth >= 0, depth < 0

    def reach(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and most distance that the prefixes allow."""
        rest = self.score_bits - np.minimum(self.known, self.score_bits)
        least = self.prefix << rest
        return least, np.minimum(self.depth, least + (np.int64(1) << rest) - 1)

    def id_lead(self, ids: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
        """The first bits of the ids, counted from the least one."""
        offset = ids.astype(np.int64).view(np.uint64) - self.least_id.view(np.uint64)
        return offset >> (np.uint64(self.id_bits) - np.asarray(bits).astype(np.uint64))


def _scored(anchors: dict, windows: _Windows, use: np.ndarray, low: np.ndarray, high: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Windows ``use`` against all rows, in blocks: (window, distance, id) where the distance lies from low to high, flat."""
    order = use[np.argsort(windows.anchor[use], kind="stable")]
    for batch in batches:
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy()
        dims, flat = np.diff(offsets), lists.values.to_numpy(zero_copy_only=False)
        all_ids, all_labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            mine = order[anchors["dims"][windows.anchor[order]] == d]
            if not len(mine):
                continue
            ids, labels = all_ids[at], all_labels[at]
            matrix = flat[offsets[at][:, None] + np.arange(d)]
            length = float((matrix.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
            exact = length * anchors["most"] < 2.0**104  # scores and their parts below 2**52: doubles add them exactly
            who, first, many = np.unique(windows.anchor[mine], return_index=True, return_counts=True)
            best, worst = windows.top[mine] - low[mine], windows.top[mine] - high[mine]
            best, worst = np.maximum.reduceat(best, first), np.minimum.reduceat(worst, first)
            step = max(1, SCORES // len(at))
            for a in range(0, len(who), step):
                part = who[a : a + step]
                left = np.stack([anchors["vectors"][i] for i in part])
                scores = left.astype(np.float64) @ matrix.T.astype(np.float64) if exact else left @ matrix.T
                fits = (scores >= worst[a : a + step, None]) & (scores <= best[a : a + step, None])
                equal = anchors["labels"][part][:, None] == labels[None, :]
                fits &= equal & (anchors["ids"][part][:, None] != ids[None, :]) if windows.same else ~equal
                i, j = np.nonzero(fits)
                score = scores[i, j].astype(np.int64)
                for turn in range(many.max()):
                    has = many[a + i] > turn
                    w = mine[first[a + i[has]] + turn]
                    distance = windows.top[w] - score[has]
                    inside = (distance >= low[w]) & (distance <= high[w])
                    yield w[inside], distance[inside], ids[j[has][inside]]


def _histogram(anchors: dict, windows: _Windows, done: int, bits: int):
    """Histograms of the digit from bit ``done`` to ``bits``, kept per task and cut behind the bucket that reaches ``want``."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = np.flatnonzero(windows.open)
        slot = np.full(len(windows.open), -1, np.int64)
        slot[use] = np.arange(len(use))
        size = 1 << (bits - done)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for w, distance, ids in _scored(anchors, windows, use, *windows.reach(), batches):
            if bits <= windows.score_bits:
                digit = (distance >> (windows.score_bits - bits)) & (size - 1)
            else:
                lead = windows.id_lead(ids, bits - windows.score_bits)
                keep = (lead >> np.uint64(bits - done)) == windows.id_prefix[w]
                w, digit = w[keep], (lead[keep] & np.uint64(size - 1)).astype(np.int64)
            new, n = np.unique(slot[w] * size + digit, return_counts=True)
            keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
            if len(keys):
                of = keys // size
                before = np.cumsum(counts) - counts
                first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                before -= before[first][np.searchsorted(of[first], of)]
                keep = before < windows.want[use[of]]
                keys, counts = keys[keep], counts[keep]
        yield pa.RecordBatch.from_arrays([pa.array(use[keys // size]), pa.array(keys % size), pa.array(counts)], names=["w", "digit", "n"])

    return lean(go)


def _gathered(anchors: dict, windows: _Windows, most: int):
    """The rows within the settled prefixes; of rows equal in score and id, which give equal results, a
    task sends ``most`` at most."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, int, int], int] = {}
        low, high = np.zeros(len(windows.top), np.int64), windows.reach()[1]
        tied = windows.known > windows.score_bits
        for w, distance, ids in _scored(anchors, windows, np.flatnonzero(~windows.empty), low, high, batches):
            late = np.flatnonzero(tied[w] & (distance == windows.prefix[w]))
            lead = windows.id_lead(ids[late], windows.known[w[late]] - windows.score_bits)
            keep = np.ones(len(w), bool)
            keep[late] = lead <= windows.id_prefix[w[late]]
            w, distance, ids = w[keep], distance[keep], ids[keep]
            fresh = np.zeros(len(w), bool)
            for k, key in enumerate(zip(w.tolist(), distance.tolist(), ids.tolist(), strict=True)):
                sent[key] = sent.get(key, 0) + 1
                fresh[k] = sent[key] <= most
            w, distance, ids = w[fresh], distance[fresh], ids[fresh]
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(windows.top[w] - distance), pa.array(ids)], names=["w", "score", "vec_id"])

    return lean(go)


def _select(vectors: DataFrame, anchors: dict, windows: _Windows, want: int) -> DataFrame:
    """(w, rank, vec_id, score): the first ``want`` rows of each window by score, then id.

    Each pass settles one digit: tasks send histograms of the distances (later of the ids) that begin
    with the settled prefix, a sum per window and bucket finds the bucket of the last wanted row, and a window
    whose bucket ends with exactly that row, or that has no more rows, is done.
    """
    done, all_bits = 0, windows.score_bits + windows.id_bits
    while done < all_bits and windows.open.any():
        bits = min(done + DIGIT, windows.score_bits if done < windows.score_bits else all_bits)
        parts = vectors.mapInArrow(_histogram(anchors, windows, done, bits), "w long, digit long, n long")
        per = parts.groupBy("w", "digit").agg(F.sum("n").alias("n")).groupBy("w")
        # at most 2**DIGIT buckets, of which none is empty: the last wanted row is in the first ``want``
        buckets = F.slice(F.array_sort(F.collect_list(F.struct("digit", "n"))), 1, want)
        seen = np.zeros(len(windows.open), bool)
        for row in per.agg(buckets.alias("buckets")).collect():  # windows of one round
            w, left = row["w"], int(windows.want[row["w"]])
            seen[w] = True
            for digit, n in row["buckets"]:
                if n >= left:
                    break
                left -= n
            else:
                left, n = 0, 0  # fewer rows than wanted: all
            if bits <= windows.score_bits:
                windows.prefix[w] = (int(windows.prefix[w]) << (bits - done)) | digit
            else:
                windows.id_prefix[w] = (int(windows.id_prefix[w]) << (bits - done)) | digit
            windows.known[w], windows.want[w] = bits, left
            windows.open[w] = n > left
        none = windows.open & ~seen
        windows.open[none], windows.empty[none] = False, True
        done = bits
    rows = vectors.mapInArrow(_gathered(anchors, windows, want), "w long, score long, vec_id long")
    near = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    per = rows.groupBy("w").agg(F.slice(near, 1, want).alias("best")).select("w", F.posexplode("best").alias("at", "b"))
    return per.select("w", (F.col("at") + 1).alias("rank"), "b.vec_id", (-F.col("b.minus")).alias("score"))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """Negatives close below each positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` (vec_id, embedding, label); anchors are the rows where ``is_anchor`` holds. An anchor's positives are
    the ``positives`` nearest other rows of its label; for each, the ``negatives`` nearest rows of another label
    with low * positive <= 100 * score <= high * positive are returned. Nearest is the largest integer inner product,
    ties by smaller vec_id.

    Anchors go in rounds of at most 8192 (less for long vectors), whose vectors and prefixes go to the tasks with their
    code, so nothing shipped grows with the table. Every block of rows is scored against the round's anchors, but only
    histograms leave the tasks, and rows only once they are known to belong to the result. A group of equal
    vectors is refined by the digits of its ids. Vectors of different lengths never compare.

    Rows with a null id, label or vector or a null or non-finite component take no part; equal rows count once, and different rows
    of one id are rows of their own, but never positives of each other; an empty vector scores 0; scores are exact in
    64 bits (components to about 2**28), beyond which they wrap; empty tables give no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    bounded_batches(spark, 8192)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    known = write_table(integer_vectors(rows), "negatives-vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    least, most, longest, dims = known.agg(F.min("vec_id"), F.max("vec_id"), F.max(square), F.max(F.size("vector"))).first()
    if least is None:
        return spark.createDataFrame([], schema)
    id_bits = (most - least).bit_length()
    out = shared_dir(spark, "negatives-found")
    chosen = known.where(is_anchor)
    rounds = -(-chosen.count() // max(1, min(ANCHORS, ROUND_BYTES // (8 * max(1, dims)))))
    dealt = write_table(chosen.withColumn("turn", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(max(1, rounds)))), "negatives-anchors")
    for turn in range(rounds):
        mine = dealt.where(F.col("turn") == turn).collect()  # one round
        if not mine:
            continue
        vectors = [np.array(r["vector"], np.int64) for r in mine]
        anchors = {
            "ids": np.array([r["vec_id"] for r in mine]),
            "labels": np.array([r["label"] for r in mine]),
            "dims": np.array([len(v) for v in vectors]),
            "vectors": vectors,
            "most": max(float((v.astype(np.float64) ** 2).sum()) for v in vectors),
        }
        # no score passes the product of the longest vectors
        limit, n = min(int(np.sqrt(anchors["most"]) * np.sqrt(longest)) + 2, (1 << 61) - 1), len(mine)
        windows = _Windows(np.arange(n), np.full(n, limit), np.full(n, 2 * limit), positives, True, least, id_bits)
        best = _select(known, anchors, windows, positives).collect()  # ``positives`` rows for each anchor of the round
        if not best:
            continue
        anchor, score = np.array([r["w"] for r in best]), np.array([r["score"] for r in best])
        top = score * high // 100
        windows = _Windows(anchor, top, top + (-score * low) // 100, negatives, False, least, id_bits)
        named = [(i, int(anchors["ids"][r["w"]]), r["vec_id"], r["score"]) for i, r in enumerate(best)]
        named = spark.createDataFrame(named, "w long, anchor_id long, positive_id long, positive_score long")
        found = _select(known, anchors, windows, negatives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        found = found.join(named, "w").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
        found.write.mode("append").parquet(out)
    spark.createDataFrame([], schema).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector of ``embeddings``, with the labels of every seventh moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE_SQL = {
    "op13_hard_negatives": f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
    p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
      other AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score QUALIFY rank <= {NEGATIVES}"""
}
