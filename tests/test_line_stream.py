"""A stream of separated text that is stopped inside a file and goes on."""

import random

import pytest
from pyspark.sql import functions as F

from vitrine.streaming.lines import _lines, _open, read_lines_stream

ROWS = [f'{i}|"name | {i}"|{i * 3}' if i % 7 else f"{i}|too|many|fields" for i in range(500)]
TEXT = "﻿id|name|value\r\n" + "\r\n".join(ROWS) + "\n"


def run(spark, source, out, checkpoint, **options):
    stream = read_lines_stream(spark, f"file://{source}", **options)
    query = stream.writeStream.format("parquet").option("path", f"file://{out}").option("checkpointLocation", f"file://{checkpoint}").trigger(availableNow=True).start()
    query.awaitTermination()


def found(spark, out):
    rows = spark.read.parquet(f"file://{out}").select("id", "name", "value", "_malformed", "_offset").collect()
    return sorted((r["_offset"], r["id"], r["name"], r["value"], r["_malformed"]) for r in rows)


def test_a_stopped_stream_goes_on_inside_the_file(spark, tmp_path):
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    whole.mkdir()
    parts.mkdir()
    data = TEXT.encode()
    (whole / "a.csv").write_bytes(data)
    run(spark, whole, tmp_path / "o1", tmp_path / "c1", pieceBytes="1000")
    for cut in (20, 3000, 3001, 7777, len(data)):  # in the header, within lines, at the end
        (parts / "a.csv").write_bytes(data[:cut])
        run(spark, parts, tmp_path / "o2", tmp_path / "c2", pieceBytes="700")
    (parts / "b.csv").write_bytes(b"id|name|value\n900|last|1\nwaits|for|its end")
    run(spark, parts, tmp_path / "o2", tmp_path / "c2")
    want = found(spark, tmp_path / "o1")
    got = found(spark, tmp_path / "o2")
    assert [r for r in got if r[1] != "900"] == want and [r[1:] for r in got if r[1] == "900"] == [("900", "last", "1", None)]
    assert [r[1:4] for r in want if r[4] is None] == [(str(i), f"name | {i}", str(i * 3)) for i in range(500) if i % 7]
    assert sum(r[4] is not None for r in want) == len(ROWS) - sum(bool(i % 7) for i in range(500))


@pytest.mark.parametrize("piece", [1, 5, 64, 10_000])
def test_pieces_give_every_line_once(tmp_path, piece):
    rng = random.Random(piece)
    lines = ["x" * rng.randrange(12) for _ in range(60)]
    for end in ("", "\n"):
        (tmp_path / "f").write_bytes(("\n".join(lines) + end).encode())
        system, path = _open(str(tmp_path / "f"))
        size = (tmp_path / "f").stat().st_size
        got = [x for a in range(0, size, piece) for x in _lines(system, path, a, min(a + piece, size))]
        want = ("\n".join(lines) + end).encode().split(b"\n")
        assert [line for _, line in got] == (want[:-1] if not want[-1] else want)
        assert all(b"\n" not in line and (tmp_path / "f").read_bytes()[o : o + len(line)] == line for o, line in got)


def test_windowed_counts_drop_late_rows(spark, tmp_path):
    from vitrine.streaming.ingest import windowed_counts

    source, out = tmp_path / "events", tmp_path / "out"
    schema = "ts string, event_type string"
    source.mkdir()
    stream = windowed_counts(spark.readStream.schema(schema).json(f"file://{source}"))

    def load(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"file://{source}")
        query = stream.select(F.col("window.start").alias("start"), "event_type", "n").writeStream.format("parquet").outputMode("append")
        query.option("path", f"file://{out}").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()

    load([("2024-01-01 00:10:00", "a"), ("2024-01-01 00:50:00", "a"), ("2024-01-01 01:10:00", "b")])
    load([("2024-01-01 03:00:00", "a")])
    load([("2024-01-01 00:20:00", "a"), ("2024-01-01 05:00:00", "b")])  # the first comes after its window was closed
    rows = spark.read.parquet(f"file://{out}").collect()
    assert sorted((r["start"].hour, r["event_type"], r["n"]) for r in rows) == [(0, "a", 2), (1, "b", 1), (3, "a", 1)]


def test_resumed_lines_of_large_files(spark):
    """Files longer than what one task reads: every one keeps its header, and none gets another."""
    from vitrine.plans.files import resumed_lines

    part = spark.range(0, 3000, 1, 3).selectExpr("id AS p_partkey", "'a name' AS p_name", "'a brand' AS p_brand")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        assert resumed_lines(lambda name: part).first().asDict() == {"first_run": 2000, "rows": 3000, "malformed": 300, "keys": 4498500}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
