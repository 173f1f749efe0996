"""Packing documents into fixed sequences along a Hilbert curve through hashed document vectors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.cached_encoder import CACHE_ENTRIES, encoder, forget_encoders
from vitrine.llm.common import binary_views, lean, mix64, slices, text_bytes
from vitrine.sources.tables import table

SEQUENCE, END_ID = 1024, 0
DIMENSIONS, CURVE_BITS, FEATURE_BITS = 3, 10, 14
#: Low bits of a key that do not count for the cells in which the curve is weighed (2 ** 18 cells).
CELL_SHIFT = 12
#: Bytes of texts that are encoded together (a longer text alone).
ENCODED_BYTES = 4 << 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of cell coordinates (n x d, ``bits`` bits each) along the Hilbert curve.

    Skilling's transform: undo the excess rotations from the top bit down, Gray-encode, interleave.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


#: Random letters, and random projection of hashed words: one array of directions per dimension.
_LETTERS = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
_DIRECTIONS = np.random.default_rng(7).standard_normal((DIMENSIONS, 1 << FEATURE_BITS))


def curve_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hilbert key of each text: every word is hashed to a feature, the features' random directions
    averaged over the text, and the mean put on a grid around zero."""
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    n = len(begin)
    body = data[offsets[0] : offsets[-1]]
    inside = body > 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[begin[begin < end]] = inside[begin[begin < end]]  # a text begins a word, whatever stands before it
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, np.append(begin, len(body)))
    count = np.diff(bounds)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[end[begin < end] - 1] = inside[end[begin < end] - 1]
    ends = np.flatnonzero(last) + 1
    room = np.minimum(ends - starts, 8).astype(np.uint64)
    head = np.ndarray(len(body), "<u8", np.concatenate([body, np.zeros(8, np.uint8)]), strides=(1,))[starts]
    head = head & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - room) * np.uint64(8)))
    sums = np.append(np.uint64(0), np.cumsum(_LETTERS[body], dtype=np.uint64))
    word = mix64(head + sums[ends] - sums[starts])  # its first eight bytes and, in any order, all of them
    feature = (word >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    sums = np.zeros((n, DIMENSIONS))
    some = count > 0
    for d, direction in enumerate(_DIRECTIONS):
        if some.any():
            sums[some, d] = np.add.reduceat(direction[feature], bounds[:-1][some])
    mean = sums / np.maximum(count, 1)[:, None]
    side = 1 << CURVE_BITS
    cells = np.clip(np.floor((mean * 1.5 + 0.5) * side), 0, side - 1)
    return hilbert_keys(cells, CURVE_BITS)


def _stretches(keys: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts the curve into ``n`` stretches of about equal bytes: for every cell (of a fixed number of
    cells) its first stretch, and the number of stretches that its documents are dealt to."""
    bytes_ = F.octet_length("text").cast("long") + 16  # what a document weighs at least
    cells = keys.groupBy(F.shiftright("curve_key", CELL_SHIFT).alias("cell")).agg(F.sum(bytes_).alias("w")).toArrow()
    weight = np.zeros(1 << (DIMENSIONS * CURVE_BITS - CELL_SHIFT))
    weight[np.asarray(cells.column("cell")).astype(np.int64)] = np.asarray(cells.column("w"))
    share = max(weight.sum(), 1) / n
    before = np.cumsum(weight) - weight
    first = np.minimum((before / share).astype(np.int64), n - 1)
    last = np.minimum(np.ceil((before + weight) / share).astype(np.int64), n)
    # a cell of less than half a share is not cut
    cut = np.where(weight > share / 2, np.maximum(last - first, 1), 1)
    return first, cut


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    drops_space: bool = False,
    length: int = SEQUENCE,
    end_id: int = END_ID,
    partitions: int | None = None,
    remember: int = CACHE_ENTRIES,
    live_on: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of ``length``: doc_id, start, length, ids (binary, unsigned
    16-bit), ids_crc32, doc_tokens, sequence_id, offset.

    The curve is cut into ranges of about equal bytes, one for each task; a cell of the curve that
    weighs more than a range, such as many documents with one key, is dealt to several by doc_id. A
    task sorts its range by (Hilbert key, doc_id) and cuts it every ``length`` ids; only its last
    sequence is shorter and would be padded. A worker remembers up to ``remember`` chunks, for
    its next tasks too where ``live_on``. Null and empty texts are the end id alone;
    repeated rows and null doc_ids are packed like any other; an empty table gives no pieces; other
    columns are ignored.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_views(batch.column(1))
            keys = [curve_keys(data, offsets[i : j + 1]) for i, j in slices(offsets, 4 << 20)]
            joined = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(joined)], names=["doc_id", "text", "curve_key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, drops_space, remember)
        sequence, filled = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            _, offsets = binary_views(batch.column(1))
            for i, j in slices(offsets, ENCODED_BYTES):
                part = batch.slice(i, j - i)
                texts = [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
                rows: list[tuple] = []
                for doc_id, got in zip(part.column(0).to_pylist(), code.encode(texts), strict=True):
                    ids = np.append(np.frombuffer(got, "<u2"), np.uint16(end_id))
                    at, total = 0, len(ids)
                    while at < total:
                        take = min(length - filled, total - at)
                        piece = ids[at : at + take]
                        crc = zlib.crc32(piece.astype("<u4"))
                        rows.append((doc_id, at, take, piece.tobytes(), crc, total, sequence, filled))
                        at, filled = at + take, filled + take
                        if filled == length:
                            sequence, filled = sequence + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.binary() if k == 3 else pa.int64()) for k, x in enumerate(zip(*rows, strict=True))],
                    names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )
        if not live_on:
            del code
            forget_encoders()

    sent = docs.select("doc_id", text_bytes().alias("text"))
    keys = sent.mapInArrow(lean(keyed), "doc_id long, text binary, curve_key long")
    first, cut = _stretches(keys, n)
    table_ = spark.sparkContext.broadcast((first, cut))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, cut = table_.value
        for batch in keyed(batches):
            key = np.asarray(batch.column(2))
            cell = key >> CELL_SHIFT
            ids = np.asarray(batch.column(0).fill_null(0)).astype(np.uint64)
            place = first[cell] + (mix64(ids ^ mix64(key.astype(np.uint64))) % cut[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place.astype(np.int32))], names=[*batch.schema.names, "place"])

    placed = sent.mapInArrow(lean(dealt), "doc_id long, text binary, curve_key long, place int")
    ordered = placed.repartitionById(n, "place").sortWithinPartitions("curve_key", "doc_id").select("doc_id", "text")
    schema = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ordered.mapInArrow(lean(pack), schema)


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed: one row per piece, without the ids themselves."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path).drop("ids")


QUERIES = {"op5_curve_packing": op5_curve_packing}
