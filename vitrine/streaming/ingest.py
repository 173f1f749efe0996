"""Incremental ingest with Structured Streaming: micro-batches, checkpoints, idempotent merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.sources.shared import shared_dir


def running_totals(events: DataFrame, most: int = 4) -> DataFrame:
    """event_type, n, total of ``events``, ingested in micro-batches as a stream.

    The events are laid out in the shared folder in as many files as their partitions make, of which each trigger
    takes a quarter (at least one file) until all are done; each micro-batch writes its partial totals under its own number: a batch that is
    run again after a failure overwrites what it wrote and counts once."""
    spark = events.sparkSession
    source, out, checkpoint = (shared_dir(spark, f"ingest-{x}") for x in ("source", "totals", "checkpoint"))
    chosen = events.select("event_id", "event_type", "value")
    chosen.repartition("event_id").write.parquet(source)
    files = len(spark.read.parquet(source).inputFiles())

    def merge(batch: DataFrame, number: int) -> None:
        totals = batch.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
        totals.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema("event_id long, event_type string, value double").option("maxFilesPerTrigger", max(1, -(-files // most))).parquet(source)
    running = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    parts = spark.read.schema("event_type string, n long, total decimal(28,4), batch int").parquet(out)
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))


def windowed_counts(stream: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by window and type of a stream with (ts, event_type), late rows dropped by watermark."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
