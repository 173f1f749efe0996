"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors are lifted by one component so that the largest inner product is the smallest distance.
Centroids of balanced clusters of a bounded sample form a small graph that is searched in memory.
Every vector enters the list of its nearest centroid, and boundary vectors those of other centroids
almost as near; a query reads the lists whose centroids are within a distance ratio of its nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import lean, write_table
from vitrine.llm.lattice_dedup import _per_unit, clean_vectors, matrix
from vitrine.sources.tables import table

NEIGHBOURS, EVERY = 20, 20
#: Vectors that the index of one vector length is fitted on. Lists are the square root of the number of
#: vectors, at most one for SAMPLE_PER_LIST of the sample.
SAMPLE, SAMPLE_PER_LIST = 8192, 16
#: Lists a vector may enter, and the distance ratio to its nearest centroid within which it does.
COPIES, COPY_RATIO = 3, 1.03
#: Share of the sample's own nearest neighbours that lists within the query's distance ratio must hold
#: (the ratio is set by it), sample queries that are tried, and lists that a query reads anyway.
AIM, TRIALS, LEAST_LISTS = 0.96, 512, 3
GRAPH_DEGREE, BEAM = 8, 12
#: Vectors of a list that one task holds; longer lists are cut by a hash of the vector's id.
CHUNK = 4096


@dataclass
class Index:
    """Centroids, their neighbour graph, the largest norm (that the lift refers to), and the distance
    ratio and number of lists within which a query reads lists."""

    centroids: np.ndarray
    graph: np.ndarray
    norm: float
    ratio: float = np.inf
    most: int = 1 << 30


def lift(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors on a sphere of radius ``norm``, one dimension up."""
    x = x / norm
    return np.concatenate([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)


def as_queries(x: np.ndarray) -> np.ndarray:
    """Queries as unit vectors without lift; their length changes no ranking."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.concatenate([x, np.zeros((len(x), 1))], axis=1)


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means whose assignment charges every list for its size, so that lists stay alike."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), lists, replace=False)].copy()
    charge = np.zeros(lists)
    for _ in range(rounds):
        distance = ((x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1)) + charge
        near = distance.argmin(axis=1)
        sizes = np.bincount(near, minlength=lists)
        charge += 0.05 * distance.std() * (sizes / sizes.mean() - 1)
        for k in np.flatnonzero(sizes):
            centroids[k] = x[near == k].mean(axis=0)
    return centroids


def neighbour_graph(centroids: np.ndarray, degree: int) -> np.ndarray:
    """For every centroid its nearest others and, so that all are reached, the next in number."""
    n = len(centroids)
    distance = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2)
    np.fill_diagonal(distance, np.inf)
    near = np.argsort(distance, axis=1)[:, : max(1, min(degree - 1, n - 1))]
    onward = (np.arange(n) + 1) % n
    onward = np.where((near == onward[:, None]).any(axis=1), np.arange(n), onward)  # itself where that is near already
    return np.concatenate([near, onward[:, None]], axis=1)


def search_graph(index: Index, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of the centroid graph for all rows of ``x`` together: the ``beam`` nearest
    centroids found and their distances, nearest first (inf where fewer were found)."""
    c, graph = index.centroids, index.graph
    n, lists = len(x), len(c)
    beam = min(beam, lists)
    rows = np.arange(n)
    seen = np.zeros((n, lists), bool)
    best = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf)
    open_ = np.zeros((n, beam), bool)
    start = np.zeros(n, np.int64)
    best[:, 0], far[:, 0], open_[:, 0] = start, ((x - c[0]) ** 2).sum(axis=1), True
    seen[:, 0] = True
    while True:
        score = np.where(open_, far, np.inf)
        at = score.argmin(axis=1)
        live = np.flatnonzero(np.isfinite(score[rows, at]))
        if not len(live):
            break
        node = best[live, at[live]]
        open_[live, at[live]] = False
        around = graph[node]
        fresh = ~seen[live[:, None], around]
        seen[live[:, None], around] = True
        distance = ((x[live][:, None, :] - c[around]) ** 2).sum(axis=2)
        distance = np.where(fresh, distance, np.inf)
        all_far = np.concatenate([far[live], distance], axis=1)
        take = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[live] = np.take_along_axis(all_far, take, axis=1)
        best[live] = np.take_along_axis(np.concatenate([best[live], around], axis=1), take, axis=1)
        flags = np.concatenate([open_[live], fresh], axis=1)
        open_[live] = np.take_along_axis(flags, take, axis=1) & np.isfinite(far[live])
    return best, np.sqrt(np.maximum(far, 0))


def near_lists(index: Index, x: np.ndarray, ratio: float, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: for each row the ``least`` nearest lists and those within ``ratio`` of its
    nearest centroid, at most ``most``."""
    rows, lists = [], []
    for i in range(0, len(x), 512):
        best, far = search_graph(index, x[i : i + 512], max(BEAM, min(most, len(index.centroids))))
        keep = far <= ratio * far[:, :1] + 1e-12
        keep[:, :least] |= np.isfinite(far[:, :least])
        keep[:, most:] = False
        r, k = np.nonzero(keep)
        rows.append(r + i)
        lists.append(best[r, k])
    return np.concatenate(rows), np.concatenate(lists)


def tuned(index: Index, sample: np.ndarray, k: int, copies: int, copy_ratio: float, aim: float = AIM) -> Index:
    """``index`` with the distance ratio, and the number of lists, that find ``aim`` of the ``k`` nearest
    of sample vectors among the sample."""
    lifted = lift(sample, index.norm)
    trial = np.flatnonzero(np.abs(sample).max(axis=1) > 0)[:TRIALS]
    score = sample[trial] @ sample.T
    score[np.arange(len(trial)), trial] = -np.inf
    k = min(k, len(sample) - 1)
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    row, list_ = near_lists(index, lifted, copy_ratio, 1, copies)
    holds = np.zeros((len(sample), len(index.centroids)), bool)
    holds[row, list_] = True
    x = as_queries(sample[trial])
    far = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ index.centroids.T + (index.centroids**2).sum(axis=1), 0))
    order = np.argsort(far, axis=1)
    rank = np.argsort(order, axis=1)
    first = np.where(holds[near], rank[:, None, :], len(index.centroids)).min(axis=2)  # of the nearest list that holds it
    ratio = np.take_along_axis(far, np.take_along_axis(order, first, axis=1), axis=1) / np.maximum(far.min(axis=1), 1e-300)[:, None]
    return Index(index.centroids, index.graph, index.norm, float(np.quantile(ratio, aim)), int(np.quantile(first, (1 + aim) / 2)) + 1)


def fit(vectors: DataFrame, k: int = NEIGHBOURS, copies: int = COPIES, copy_ratio: float = COPY_RATIO) -> Index | None:
    """Fit the index on at most SAMPLE vectors, those of the smallest hashed ids."""
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    total = vectors.agg(F.max(norm2).alias("m"), F.count("*").alias("n")).first()
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    if not len(sample):
        return None
    sample = matrix(sample)
    norm = float(np.sqrt(total["m"])) if np.isfinite(total["m"]) else float("inf")
    x = lift(sample, norm)
    lists = max(1, min(int(np.sqrt(total["n"])), len(x) // SAMPLE_PER_LIST))
    if lists == 1:
        return Index(x.mean(axis=0, keepdims=True), np.zeros((1, 1), np.int64), norm)
    centroids = balanced_centroids(x, lists)
    index = Index(centroids, neighbour_graph(centroids, GRAPH_DEGREE), norm)
    # so many of the sample are as near as k of the table
    return tuned(index, sample, max(1, -(-k * len(sample) // total["n"])), copies, copy_ratio)


def nearest(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    query_ratio: float | None = None,
    copies: int = COPIES,
    copy_ratio: float = COPY_RATIO,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` (a part of ``embeddings``) its ``k``
    nearest found among the other rows of equal length, by inner product of the original vectors.

    Lists are read within ``query_ratio``, or within what ``tuned`` sets. Vectors that are null,
    empty, zero or hold null or non-finite components and rows without a vec_id take no part. Each
    length of vectors has its own index. Of rows that repeat a vec_id the first by length and
    components counts. Ties go to the smaller vec_id. Other columns are ignored; an empty table gives
    no rows.
    """
    spark = embeddings.sparkSession
    clean = clean_vectors(embeddings).groupBy("vec_id").agg(F.min(F.struct("dim", "embedding")).alias("v"))
    vectors = write_table(clean.select("vec_id", "v.dim", "v.embedding"), "ann-vectors")
    dims = [r["dim"] for r in vectors.select("dim").distinct().orderBy("dim").collect()]
    found = [_nearest_of(vectors.where(F.col("dim") == d).select("vec_id", "embedding"), queries, k, query_ratio, copies, copy_ratio) for d in dims]
    if not found:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    return reduce(DataFrame.unionAll, found)


def _nearest_of(vectors: DataFrame, queries: DataFrame, k: int, query_ratio: float | None, copies: int, copy_ratio: float) -> DataFrame:
    """``nearest`` among vectors of one length."""
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = fit(vectors, k, copies, copy_ratio)
    ratio = query_ratio or index.ratio
    most = min(len(index.centroids), index.most if query_ratio is None else len(index.centroids))
    shared = spark.sparkContext.broadcast(index)

    def lists_of(ratio: float, least: int, most: int, query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column(1))
                    x = as_queries(x) if query else lift(x, shared.value.norm)
                    row, list_ = near_lists(shared.value, x, ratio, least, most)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list_, pa.int32()), *(c.take(pa.array(row)) for c in batch.columns)], names=["list", "vec_id", "embedding"]
                    )

        return run

    entry = "list int, vec_id long, embedding array<double>"
    posted = vectors.mapInArrow(lean(lists_of(copy_ratio, 1, copies, False)), entry)
    posted = write_table(posted, "ann-postings")
    chunks = posted.groupBy("list").agg(F.count("*").alias("m")).select("list", F.ceil(F.col("m") / CHUNK).cast("int").alias("cut"))
    asked = vectors.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    asked = asked.mapInArrow(lists_of(ratio, LEAST_LISTS, max(most, LEAST_LISTS), True), entry).join(chunks, "list")
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    posted = posted.join(chunks, "list").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("cut")).cast("int"))
    both = posted.select("list", "chunk", F.lit(False).alias("query"), "vec_id", "embedding").unionByName(
        asked.select("list", "chunk", F.lit(True).alias("query"), "vec_id", "embedding")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _per_unit(batches, 2):
            query, names = np.asarray(unit.column(2)), np.asarray(unit.column(3))
            x = matrix(unit.column(4))
            cand, cand_names = x[~query], names[~query]
            if not len(cand) or not query.any():
                continue
            ids, who = names[query], x[query]
            for i in range(0, len(ids), 256):
                rough = who[i : i + 256] @ cand.T
                rough[ids[i : i + 256, None] == cand_names[None, :]] = -np.inf
                m = min(k, len(cand))
                least = -np.partition(-rough, m - 1, axis=1)[:, m - 1]
                slack = 1e-9 * np.abs(rough, where=np.isfinite(rough), out=np.zeros_like(rough)).max(axis=1)
                r, c = np.nonzero((rough >= (least - slack)[:, None]) & np.isfinite(rough))
                score = (who[i + r] * cand[c]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i + r]), pa.array(cand_names[c]), pa.array(score)], names=["query_id", "vec_id", "score"])

    found = both.repartition(n, "list", "chunk").sortWithinPartitions("list", "chunk").mapInArrow(lean(scan), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_posting_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose id is divisible by 20."""
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest(embeddings, embeddings.where(F.col("vec_id") % EVERY == 0))


QUERIES = {"op10_posting_ann": op10_posting_ann}
