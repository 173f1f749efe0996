"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import write_table
from vitrine.sources.tables import table

#: Weights of the sources in code-point order, repeated over them.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CAP, SEED = 1.5, 2.0, 20240607
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of words (runs other than blank and \\t..\\r) of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Per source: source_size and target.

    The targets share ``share`` of all sizes by weight. A source at ``cap`` times its own size
    stops there and the excess goes to the others by weight, until none is above: target =
    min(level * weight, cap * size), with the one level that spends the whole share. The level
    is read from prefix sums over the sources in the order in which they fill up.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (at + 1).cast("int")))
    most = cap * F.col("source_size")
    fills = Window.orderBy(most / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.select(
        "*",
        (share * F.sum("source_size").over(everything)).alias("pool"),
        F.coalesce(F.sum(most).over(before), F.lit(0.0)).alias("spent"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
        F.row_number().over(fills).alias("turn"),
    )
    level = (F.col("pool") - F.col("spent")) / F.col("open")
    first = F.when(level * F.col("weight") <= most, F.col("turn"))
    per = per.withColumn("level", F.min_by(level, first).over(everything))
    target = F.when(F.col("level").isNull(), most).otherwise(F.least(F.col("level") * F.col("weight"), most))
    return per.select("source", F.col("source_size").cast("long"), target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
    partitions: int | None = None,
) -> DataFrame:
    """Copies that each document gets: doc_id, source, size, source_size, target, copies.

    Within a source every document expects target / source_size copies (at most ``cap``).
    Documents stand in descending order of size, so that the words taken follow the target within
    about one document; expected copies are summed along that order, one offset hashed from seed
    and source is added, and a document is emitted once per integer boundary that its stretch
    crosses. The running rank is a range partitioning plus a small table of counts by partition
    and source, so a source with most of the rows is spread over all tasks.

    Null text has size 0; a null source is a source of its own, apart from the empty name; sizes
    of 0 only give target 0 and no copies; ties go by doc_id; repeated rows are rows of their own;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = write_table(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last()]
    placed = sized.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    placed = write_table(placed, "mix-placed")
    by_source = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = placed.groupBy("source", "part").agg(F.count("*").alias("n"))
    base = base.select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(by_source), F.lit(0)).alias("base")
    )
    targets = source_targets(sized, weights, share, cap).withColumnRenamed("source", "s")
    base = base.join(targets.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    local = F.row_number().over(Window.partitionBy("part", "source").orderBy(*order[1:]))
    ranked = placed.withColumn("local", local)
    on = (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    ranked = ranked.join(base, on).drop("s", "p")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed} "), key)), 1, 10)
    offset = F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 40))
    rank = F.col("base") + F.col("local")
    copies = F.floor(offset + rate * rank) - F.floor(offset + rate * (rank - 1))
    return ranked.select(
        "doc_id", "source", "size", "source_size", "target", F.least(copies, F.lit(int(cap))).cast("long").alias("copies")
    )


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: doc_id, size, source_size, target, taken (words, repeats counted)."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {"op6_source_mix": op6_source_mix}
ORACLE_SQL = {
    "op6_source_mix": f"""WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
    w AS (SELECT source, sum(size) AS source_size, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS weight FROM s GROUP BY 1),
    m AS (SELECT *, {CAP}::DOUBLE * source_size AS most, {SHARE}::DOUBLE * sum(source_size) OVER () AS pool FROM w),
    o AS (SELECT *, row_number() OVER f AS turn, coalesce(sum(most) OVER b, 0.0) AS spent, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0) AS rest FROM m
      WINDOW f AS (ORDER BY most / weight, source NULLS LAST), b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT arg_min((pool - spent) / rest, turn) FILTER (WHERE (pool - spent) / rest * weight <= most) AS level FROM o),
    t AS (SELECT source, source_size::BIGINT AS source_size, CASE WHEN level IS NULL THEN most ELSE least(level * weight, most) END AS target,
      ('0x' || substr(md5('{SEED} ' || coalesce('s' || source, 'n')), 1, 10))::BIGINT / {1 << 40}::DOUBLE AS start FROM o, l),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS LAST) AS rank FROM s),
    e AS (SELECT doc_id, size, source_size, target, start, rank, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, size * least(floor(start + rate * rank) - floor(start + rate * (rank - 1)), {int(CAP)})::BIGINT AS taken FROM e"""
}
