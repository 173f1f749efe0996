"""Near-duplicate embeddings by lattice hashing: E8 cells of random projections, probed and verified.

In every table a vector is projected at random to BLOCKS times eight dimensions and each eight are
decoded to the nearest point of the E8 lattice; the points together name a cell. A vector also
enters the neighbouring cells whose lattice points are next nearest. What meets in a cell is
verified by cosine; the links give components, and links are counted exactly within them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import components, lean, mix64, write_table
from vitrine.sources.tables import table

LEAST = 0.9
#: Tables, E8 blocks per table, cells entered per table (its own included) and the lattice scale in
#: units of a projected unit vector's length per eight dimensions.
TABLES, BLOCKS, CELLS, SCALE, SEED = 10, 3, 6, 0.95, 5
#: Vectors of a cell or component that one task multiplies at once; larger ones go in pairs of chunks.
CHUNK = 1024


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out)


_MINIMAL = _minimal_vectors()


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of each row (n x 8): the better of D8 and D8 + 1/2."""

    def d8(y: np.ndarray) -> np.ndarray:
        r = np.rint(y)
        odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
        gap = y[odd] - r[odd]
        k = np.abs(gap).argmax(axis=1)
        r[odd, k] += np.where(gap[np.arange(len(odd)), k] >= 0, 1, -1)
        return r

    a, b = d8(x), d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def _point_key(points: np.ndarray, block: int) -> np.ndarray:
    """64-bit key of lattice points (twice their coordinates are integers)."""
    h = np.full(len(points), np.uint64(block + 1))
    for k in range(8):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + np.rint(points[:, k] * 2).astype(np.int64).astype(np.uint64))
    return h


def cells(unit: np.ndarray, tables: int, blocks: int, count: int, scale: float, seed: int = SEED) -> np.ndarray:
    """Keys of the cells that unit vectors enter: n x tables x count, the own cell first.

    The other cells change one block to a neighbouring lattice point; those that lie nearest to the
    projection are taken."""
    n, d = unit.shape
    out = np.zeros((n, tables, count), np.uint64)
    for t in range(tables):
        project = np.random.default_rng([seed, t, d]).standard_normal((d, 8 * blocks)) / np.sqrt(8)
        x = (unit @ project) / scale
        own, moved, extra = [], [], []
        for b in range(blocks):
            y = x[:, 8 * b : 8 * b + 8]
            p = nearest_e8(y)
            gain = (y - p) @ _MINIMAL.T  # the larger, the nearer the neighbour
            best = np.argpartition(-gain, count - 1, axis=1)[:, : count - 1] if count > 1 else np.zeros((n, 0), int)
            own.append(_point_key(p, b))
            moved.append(np.stack([_point_key(p + _MINIMAL[best[:, k]], b) for k in range(best.shape[1])], axis=1) if count > 1 else None)
            extra.append(np.take_along_axis(gain, best, axis=1))
        total = sum(own)
        out[:, t, 0] = total
        if count > 1:
            keys = np.concatenate([total[:, None] - own[b][:, None] + moved[b] for b in range(blocks)], axis=1)
            take = np.argsort(-np.concatenate(extra, axis=1), axis=1)[:, : count - 1]
            out[:, t, 1:] = np.take_along_axis(keys, take, axis=1)
        out[:, t] = mix64(out[:, t] ^ mix64(np.array([t + 1], np.uint64)))
    return out


def usable(vectors: list) -> np.ndarray:
    """Which vectors take part: not null, not empty, all components finite numbers, not zero."""
    good = np.zeros(len(vectors), bool)
    for i, v in enumerate(vectors):
        if v is not None and len(v) and None not in v:
            a = np.asarray(v, np.float64)
            good[i] = np.isfinite(a).all() and bool(a.any())
    return good


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of lists of equal length without nulls as a double matrix."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return values.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def clean_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding (array of double), dim of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            good = np.flatnonzero(usable(vectors))
            kept = [vectors[i] for i in good]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(good)), pa.array(kept, pa.list_(pa.float64())), pa.array([len(v) for v in kept], pa.int32())],
                names=["vec_id", "embedding", "dim"],
            )

    sent = embeddings.where("vec_id is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return sent.mapInArrow(lean(run), "vec_id long, embedding array<double>, dim int")


def _cell_rows(vectors: DataFrame, tables: int, blocks: int, count: int, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column(2))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for i in range(0, len(rows), 1000):
                    some = pa.array(rows[i : i + 1000])
                    keys = cells(_unit(matrix(batch.column(1).take(some))), tables, blocks, count, scale).reshape(len(some), -1)
                    again = pa.array(np.repeat(rows[i : i + 1000], keys.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.reshape(-1).astype(np.int64)), batch.column(0).take(again)], names=["cell", "vec_id"]
                    )

    return vectors.mapInArrow(lean(run), "cell long, vec_id long")


def _forest(close: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest member, member) of the groups of a symmetric boolean matrix."""
    label = np.arange(len(close))
    while True:
        lower = np.where(close, label[None, :], len(close)).min(axis=1)
        lower = np.minimum(label, lower)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    apart = np.flatnonzero(label != np.arange(len(close)))
    return names[label[apart]], names[apart]


def _units(df: DataFrame, key: str, chunk: int) -> DataFrame:
    """``df`` with its rows placed in units: (key, i, j) holds chunks i and j of a group."""
    sizes = df.groupBy(key).agg(F.count("*").alias("m")).where("m >= 2")
    cut = F.ceil(F.col("m") / chunk).cast("int")
    mine = F.when(cut > 1, F.pmod(F.xxhash64("vec_id"), cut)).otherwise(0).cast("int")
    units = F.transform(
        F.sequence(F.lit(0), cut - 1), lambda o: F.struct(F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j"))
    )
    return df.join(sizes, key).withColumn("chunk", mine).withColumn("unit", F.explode(units))


def _per_unit(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows of one unit at a time, from batches sorted by their first ``keys`` columns."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            part = batch.slice(a, b - a)
            if held and any(held[0].column(k)[0] != part.column(k)[0] for k in range(keys)):
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()


def near_links(vectors: DataFrame, least: float, tables: int, blocks: int, count: int, scale: float) -> DataFrame:
    """Verified links (a, b), enough of them to hold together what links within the cells hold together."""
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = write_table(_cell_rows(vectors, tables, blocks, count, scale).distinct(), "lattice-cells")
    shared = rows.groupBy("cell").agg(F.count("*").alias("c")).where("c >= 2").select("cell")
    placed = _units(rows.join(shared, "cell"), "cell", CHUNK).select("cell", "unit.i", "unit.j", "chunk", "vec_id")
    sent = placed.join(vectors, "vec_id").select("cell", "i", "j", "chunk", "vec_id", "dim", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for unit in _per_unit(batches, 3):
            names, dims = np.asarray(unit.column(4)), np.asarray(unit.column(5))
            for dim in np.unique(dims):
                some = np.flatnonzero(dims == dim)
                if len(some) >= 2:
                    x = _unit(matrix(unit.column(6).take(pa.array(some))))
                    found.append(_forest(x @ x.T >= least, names[some]))
            if len(found) > 1000:
                yield _edges(found)
                found = []
        yield _edges(found)

    return sent.repartition(n, "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "vec_id").mapInArrow(lean(run), "a long, b long")


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _count_links(vectors: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """vec_id, n_links within the components ``groups`` (node, component), where a vector counts ``m``
    times.

    A component's vectors within half the linking angle of its first vector all link with each
    other and are counted by their number; only pairs with one of the others are multiplied."""
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = vectors.join(groups, F.col("vec_id") == F.col("node")).drop("node")
    hubs = members.where("vec_id = component").select(F.col("component").alias("hub"), F.col("embedding").alias("hub_embedding"))
    half = np.cos(np.arccos(least) / 2 - 1e-7)

    def shell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.zeros(batch.num_rows, bool)
                dims = np.asarray(batch.column(2))
                for dim in np.unique(dims):
                    some = pa.array(np.flatnonzero(dims == dim))
                    x, h = (_unit(matrix(batch.column(k).take(some))) for k in (1, 4))
                    near[np.asarray(some)] = (x * h).sum(axis=1) >= half
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(5), pa.array(~near)], names=["vec_id", "embedding", "dim", "component", "m", "outer"])

    placed = members.join(hubs, F.col("component") == F.col("hub")).select("vec_id", "embedding", "dim", "component", "hub_embedding", "m")
    placed = write_table(
        placed.mapInArrow(lean(shell), "vec_id long, embedding array<double>, dim int, component long, m long, outer boolean"), "lattice-members"
    )
    counts = placed.groupBy("component").agg(F.sum(F.when(~F.col("outer"), F.col("m"))).alias("inner"), F.count_if("outer").alias("others"))
    inside = placed.where(~F.col("outer")).join(counts, "component").select("vec_id", (F.col("inner") - F.col("m")).alias("k"))
    open_ = placed.join(counts.where("others > 0").select("component"), "component", "left_semi")
    units = _units(open_.withColumnRenamed("m", "weight"), "component", CHUNK)
    units = units.select("component", "unit.i", "unit.j", "chunk", "vec_id", "outer", "embedding", "weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _per_unit(batches, 3):
            i, j = unit.column(1)[0].as_py(), unit.column(2)[0].as_py()
            chunk, names, outer = (np.asarray(unit.column(k)) for k in (3, 4, 5))
            x = _unit(matrix(unit.column(6)))
            close = x @ x.T >= least
            close &= outer[:, None] | outer[None, :]
            np.fill_diagonal(close, False)
            if i != j:
                close &= chunk[:, None] != chunk[None, :]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(close @ np.asarray(unit.column(7)))], names=["vec_id", "k"])

    key = ["component", "i", "j"]
    across = units.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(lean(run), "vec_id long, k long")
    return inside.unionByName(across).groupBy("vec_id").agg(F.sum("k").alias("n_links"))


def near_duplicates(
    embeddings: DataFrame,
    least: float = LEAST,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    count: int = CELLS,
    scale: float = SCALE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a
    vec_id, link with nothing; vectors of different length never link. Equal vectors are one, which
    counts as often as it occurs. Rows of equal vec_id are one vector, whose links add up if they
    differ; n_links then counts the links of its first vector by length and components. Other columns
    are ignored; an empty table gives no rows.
    """
    clean = clean_vectors(embeddings).withColumn("x", F.xxhash64("embedding")).withColumn("y", F.xxhash64(F.lit(1), "embedding"))
    clean = write_table(clean.dropDuplicates(["vec_id", "x", "y"]), "lattice-clean")
    same = clean.groupBy("x", "y").agg(F.min(F.struct("vec_id", "embedding", "dim")).alias("v"), F.count("*").alias("m"))
    same = write_table(same.select("x", "y", "v.vec_id", "v.embedding", "v.dim", "m"), "lattice-vectors")
    # one number for each different vector; a vec_id may have several
    vectors = same.select(F.xxhash64("x", "y").alias("vec_id"), "embedding", "dim", "m")
    links = near_links(vectors.drop("m"), least, tables, blocks, count, scale)
    groups = write_table(components(links, "lattice-groups"), "lattice-components")
    counted = _count_links(vectors, groups, least).withColumnRenamed("vec_id", "u")
    named = same.select("x", "y", "vec_id", "m", F.xxhash64("x", "y").alias("u")).join(groups, F.col("u") == F.col("node"), "left").drop("node")
    leasts = named.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("least"))
    named = named.join(leasts, "component", "left").join(counted, "u", "left")
    named = named.select("x", "y", (F.coalesce("n_links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("least", "vec_id").alias("component"))
    found = clean.select("vec_id", "dim", "embedding", "x", "y").join(named, ["x", "y"])
    found = write_table(found.groupBy("vec_id").agg(
        F.min(F.struct("dim", "embedding", "n_links")).alias("first"), F.min("component").alias("a"), F.max("component").alias("z")
    ).select("vec_id", F.col("first.n_links").alias("n_links"), "a", "z"), "lattice-found")
    ties = components(found.where("a <> z").select("a", F.col("z").alias("b")), "lattice-ties")
    out = embeddings.select("vec_id").join(found, "vec_id", "left").join(ties, F.col("a") == F.col("node"), "left")
    component = F.coalesce("component", "a", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op2_lattice_dedup": op2_lattice_dedup}
ORACLE_SQL = {
    "op2_lattice_dedup": f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {LEAST}),
    reach(x, y) AS (SELECT a, b FROM link UNION SELECT x, b FROM reach JOIN link ON y = a),
    c AS (SELECT x, min(y) AS least FROM reach GROUP BY 1), n AS (SELECT a, count(*) AS n FROM link GROUP BY 1)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id, vec_id = coalesce(least, vec_id) AS kept
      FROM embeddings LEFT JOIN c ON vec_id = x LEFT JOIN n ON vec_id = a"""
}
