"""Token ids in fixed-width bit-packed shard files with block offsets, and their readers.

A shard file is ``MAGIC``, the packed blocks, the index and a footer. Every block holds
``BLOCK`` ids (the last one fewer) of ``bits`` bits each, least significant bit first, and starts
on a byte. The index holds per document its id (and a null flag) and the number of ids up to its
end, then the byte offset of every block; the footer says how to find them. Any id is one
multiplication and one small read away, and a block unpacks in a few numpy operations.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.cached_encoder import encoder
from vitrine.llm.common import lean, shared_dir, text_bytes, write_table
from vitrine.sources.tables import table

MAGIC = b"VIDS0001"
BLOCK = 8192
VOCABULARY, END_ID = 49_408, 1
_FOOTER = struct.Struct("<QQQQII8s")


def bits_for(vocabulary: int) -> int:
    """Bits that the largest id of a vocabulary needs."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    shown = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(shown.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    shown = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return (shown.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class ShardWriter:
    """Writes one shard; ``close`` moves it to its name, so a retried task never leaves half a file."""

    def __init__(self, uri: str, bits: int, block: int = BLOCK) -> None:
        self.bits, self.block = bits, block
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(uri)
        context = TaskContext.get()
        self.part = f"{self.path}.{context.taskAttemptId() if context else 0}.part"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part)
        self.out.write(MAGIC)
        self.at, self.tokens = len(MAGIC), 0
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        self.blocks: list[int] = []

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        cut = len(ids) if last else len(ids) - len(ids) % self.block
        for i in range(0, cut, self.block):
            packed = pack(ids[i : min(i + self.block, cut)], self.bits)
            self.blocks.append(self.at)
            self.out.write(packed)
            self.at += len(packed)
        self.waiting, self.held = [ids[cut:]], len(ids) - cut

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        self.doc_ids.append(doc_id)
        self.ends.append(self.tokens)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 32 * self.block:
            self._flush(last=False)

    def close(self) -> None:
        self._flush(last=True)
        index = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        index += np.array([d is None for d in self.doc_ids], np.uint8).tobytes()
        index += np.array(self.ends, "<i8").tobytes() + np.array([*self.blocks, self.at], "<i8").tobytes()
        self.out.write(index)
        self.out.write(_FOOTER.pack(len(self.doc_ids), self.tokens, len(self.blocks), self.at, self.bits, self.block, MAGIC))
        self.out.close()
        self.fs.move(self.part, self.path)


class ShardReader:
    """Random access to one shard."""

    def __init__(self, uri: str) -> None:
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, self.n_tokens, blocks, at, self.bits, self.block, magic = _FOOTER.unpack(
            self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        )
        if magic != MAGIC:
            raise ValueError(f"not a shard of packed ids: {uri}")
        index = self.file.read_at(size - _FOOTER.size - at, at)
        ids = np.frombuffer(index, "<i8", n)
        null = np.frombuffer(index, np.uint8, n, 8 * n)
        self.doc_ids = [None if gone else d for d, gone in zip(ids.tolist(), null.tolist(), strict=True)]
        self.ends = np.frombuffer(index, "<i8", n, 9 * n)
        self.blocks = np.frombuffer(index, "<i8", blocks + 1, 17 * n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from position ``start`` up to ``stop``."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        low = int(self.blocks[first])
        data = self.file.read_at(int(self.blocks[last + 1]) - low, low)
        out = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_tokens - b * self.block)
            out.append(unpack(data[int(self.blocks[b]) - low : int(self.blocks[b + 1]) - low], n, self.bits))
        joined = out[0] if len(out) == 1 else np.concatenate(out)
        return joined[start - first * self.block : stop - first * self.block]


def write_shards(
    docs: DataFrame,
    directory: str,
    tokenizer: str,
    drops_space: bool,
    vocabulary: int = VOCABULARY,
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Encode whole texts and write them, one shard per partition of the doc_id order.

    Null and empty texts hold the end id alone; rows of equal doc_id stand beside each other; null
    doc_ids come first; other columns are ignored; an empty table writes no shard. Returns the
    manifest (shard int, uri string, n_docs long, n_tokens long), already written to the shared
    folder. Shards are numbered in ascending doc_id order.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = bits_for(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        uri = f"{directory}/{shard:06d}.ids"
        writer, code = None, encoder(tokenizer, drops_space)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
                for doc_id, got in zip(part.column(0).to_pylist(), code.encode(texts), strict=True):
                    writer = writer or ShardWriter(uri, bits)
                    writer.add(doc_id, np.append(np.frombuffer(got, "<u2"), np.uint16(end_id)))
        if writer:
            writer.close()
            row = [[shard], [uri], [len(writer.doc_ids)], [writer.tokens]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["shard", "uri", "n_docs", "n_tokens"],
            )

    ordered = docs.select("doc_id", text_bytes().alias("text")).repartitionByRange(n, "doc_id")
    manifest = ordered.sortWithinPartitions("doc_id").mapInArrow(
        write, "shard int, uri string, n_docs long, n_tokens long"
    )
    return write_table(manifest, "ids-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    The first position of a shard is the sum of the ids of the shards before it, one row each.
    """
    spark = manifest.sparkSession
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("uri", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = ShardReader(uri)
                ends = shard.ends.tolist()
                starts = [0, *ends[:-1]]
                crcs, i = [], 0
                while i < len(ends):  # about a million ids at a time, documents whole
                    j = max(i + 1, int(np.searchsorted(shard.ends, starts[i] + 1_000_000, side="right")))
                    ids = shard.ids(starts[i], ends[j - 1]).astype("<u4")
                    crcs += [zlib.crc32(ids[s - starts[i] : e - starts[i]]) for s, e in zip(starts[i:j], ends[i:j], strict=True)]
                    i = j
                s = np.array(starts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(s + base), pa.array(shard.ends - s), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    tasks = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return based.repartition(tasks).mapInArrow(lean(read), schema)


def op3_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as shards and read back: doc_id, start, n_tokens, ids_crc32."""
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_shards(table(spark, sf_dir, "documents"), shared_dir(spark, "packed-ids"), path, drops_space=True)
    return read_shards(manifest)


QUERIES = {"op3_packed_ids": op3_packed_ids}
