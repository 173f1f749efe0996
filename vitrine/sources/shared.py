"""The folder that driver and executors share, and tables written there to cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only where the setting is missing on one machine (local mode, as in tests) a temporary folder stands in;
    a cluster without it raises, as its executors would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.split("[")[0] == "local":
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors of {master} share")
        root = "file://" + tempfile.mkdtemp(prefix="vitrine-")
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, tag: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    ``group_bytes`` bounds the row groups of tables with large rows: readers take up to 4096 rows of a group at once."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    rows = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    rows.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_table(df: DataFrame, tag: str, buckets: int, key: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets by ``key``: joins and aggregates by it then send only their other side.

    The name that buckets need is taken out of the catalogue again; the files stay, as those of ``write_table``."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    name = "vitrine_" + path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
