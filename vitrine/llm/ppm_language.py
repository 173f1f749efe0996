"""Language identification by prediction by partial matching over bytes.

Per language a context tree of order ORDER holds how often each byte followed each context in the
training text. A document's code length in a language is the exact sum of what PPM (escape method
C, with exclusion) pays for its bytes under these frozen counts; the language that codes it in the
fewest bits is predicted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import binary_views, lean, slices
from vitrine.sources.tables import table

#: Longest context in bytes; n-grams of ORDER + 1 = 4 bytes make one unsigned 32-bit key.
ORDER = 3
#: Bound of the training sample: expected bytes of text per language, and of all languages together,
#: which share it alike but get LEAST_BYTES at least. Larger languages are sampled by pieces of texts.
TRAIN_BYTES, ALL_BYTES, LEAST_BYTES, PIECE = 3_000_000, 192_000_000, 65_536, 4096
#: Languages whose trees stand in one table, and cells of the tables that find keys, of all groups.
GROUP, CELLS = 64, 6000 * 6000
UNDETERMINED = "und"
_PAD = 10  # the byte that stands before a text's first
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, ORDER pad bytes before each, and where each (padded) starts."""
    n, size = len(offsets) - 1, int(offsets[-1] - offsets[0])
    out = np.full(size + ORDER * n, _PAD, np.uint8)
    starts = (offsets[:-1] - offsets[0]) + ORDER * np.arange(n)
    for at, a, b in zip((starts + ORDER).tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        out[at : at + b - a] = data[a:b]
    return out, starts


def grams(body: np.ndarray) -> np.ndarray:
    """Key of the four bytes that end at each byte from the fourth on."""
    w = body.astype(np.uint32)
    return (w[:-3] << np.uint32(24)) | (w[1:-2] << np.uint32(16)) | (w[2:-1] << np.uint32(8)) | w[3:]


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            data, offsets = binary_views(batch.column(1))
            for lang in dict.fromkeys(langs):
                keys = []
                for i in np.flatnonzero(langs == lang):
                    body, _ = padded(data, offsets[i : i + 2])
                    if len(body) > ORDER:
                        keys.append(grams(body))
                if keys:
                    gram, n = np.unique(np.concatenate(keys), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                    )

    found = docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(lean(count), "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class PpmModel:
    """Frozen context trees of several languages, as sorted key arrays for each order."""

    def __init__(self, counts: pd.DataFrame, cells: int = CELLS) -> None:
        self.cells = cells
        self.languages = sorted(counts["lang"].unique())
        keys = np.unique(counts["gram"].to_numpy().astype(np.uint32))
        n = np.zeros((len(keys), len(self.languages)), np.int64)
        at = np.searchsorted(keys, counts["gram"].to_numpy().astype(np.uint32))
        np.add.at(n, (at, np.searchsorted(self.languages, counts["lang"].to_numpy())), counts["n"].to_numpy())
        self.keys, self.counts, self.contexts, self.total, self.seen, self.below = {}, {}, {}, {}, {}, {}
        for order in range(ORDER, -1, -1):  # the grams of a shorter context are sums over longer ones
            self.keys[order], self.counts[order] = keys, n
            context = keys >> np.uint32(8)
            names, inverse = np.unique(context, return_inverse=True)
            self.contexts[order] = names
            self.total[order] = self._sum(inverse, n, len(names))
            self.seen[order] = self._sum(inverse, (n > 0).astype(np.int64), len(names))
            if order:
                shorter, back = np.unique(keys & np.uint32((1 << (8 * order)) - 1), return_inverse=True)
                fewer = self._sum(back, n, len(shorter))
                #: what the shorter context holds of the symbols seen in this one
                self.below[order] = self._sum(inverse, np.where(n > 0, fewer[back], 0), len(names))
                keys, n = shorter, fewer
        self._index()

    @staticmethod
    def _sum(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        columns = [np.bincount(rows, weights=values[:, j], minlength=size) for j in range(values.shape[1])]
        return np.stack(columns, axis=1).astype(np.int64)

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted)[:, None], values[at], 0)

    def bits(self, wanted: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each 4-byte key after its first three, per language."""
        shape = (len(wanted), len(self.languages))
        cost, done = np.zeros(shape), np.zeros(shape, bool)
        gone, gone_symbols = np.zeros(shape, np.int64), np.zeros(shape, np.int64)  # excluded
        for order in range(ORDER, -1, -1):
            gram = wanted & np.uint32((1 << (8 * (order + 1))) - 1) if order < ORDER else wanted
            context = gram >> np.uint32(8)
            total = self._find(self.contexts[order], self.total[order], context)
            seen = self._find(self.contexts[order], self.seen[order], context)
            n = self._find(self.keys[order], self.counts[order], gram)
            mass, symbols = total - gone, seen - gone_symbols
            here = ~done & (total > 0)
            hit = here & (n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = np.where(hit, cost + np.log2(mass + symbols) - np.log2(n), cost)
                miss = here & (n == 0) & (symbols > 0)
                cost = np.where(miss, cost + np.log2(mass + symbols) - np.log2(symbols), cost)
            done |= hit
            if order:
                gone = np.where(total > 0, self._find(self.contexts[order], self.below[order], context), gone)
                gone_symbols = np.where(total > 0, seen, gone_symbols)
            else:
                gone_symbols = np.where(total > 0, seen, 0)
        return np.where(done, cost, cost + np.log2(np.maximum(256 - gone_symbols, 1)))

    def _index(self) -> None:
        """Rows of known keys by the numbers of their two byte pairs, -1 for unknown keys."""
        keys = self.keys[ORDER]
        pairs = np.unique(np.concatenate([keys >> np.uint32(16), keys & np.uint32(0xFFFF)]))
        self.pair = np.full(1 << 16, len(pairs), np.int32)
        self.pair[pairs] = np.arange(len(pairs))
        self.side = len(pairs) + 1
        self._place()
        self.known = np.ascontiguousarray(self.bits(keys).T.astype(np.float32))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "row"}  # most of it empty: made anew where it is needed

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._place()

    def _place(self) -> None:
        keys = self.keys[ORDER]
        self.row = None
        if self.side * self.side <= self.cells:
            self.row = np.full(self.side * self.side, -1, np.int32)
            self.row[self.pair[keys >> np.uint32(16)] * self.side + self.pair[keys & np.uint32(0xFFFF)]] = np.arange(len(keys))

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (n x languages)."""
        body, starts = padded(data, offsets)
        out = np.zeros((len(starts), len(self.languages)))
        if len(body) <= ORDER:
            return out
        pair = (body[:-1].astype(np.int32) << 8) | body[1:]
        if self.row is not None:
            number = self.pair[pair]
            row = self.row[number[:-2] * self.side + number[2:]]
        else:
            key = grams(body)
            row = np.minimum(np.searchsorted(self.keys[ORDER], key), len(self.keys[ORDER]) - 1).astype(np.int32)
            row[self.keys[ORDER][row] != key] = -1
        new = np.flatnonzero(row < 0)
        # a window that ends in the padding of the next text belongs to no text
        ends = np.append(starts[1:], len(body)) - ORDER
        owner = np.searchsorted(starts, new, side="right") - 1
        mine = new < ends[owner]
        new, owner = new[mine], owner[mine]
        fresh = ((pair[new].astype(np.uint32) << np.uint32(16)) | pair[new + 2].astype(np.uint32)) if len(new) else new
        names, back = np.unique(fresh, return_inverse=True)
        costs = self.bits(names.astype(np.uint32)) if len(names) else np.zeros((0, len(self.languages)))
        limits = np.stack([starts, ends], axis=1).reshape(-1)
        empty = ends <= starts
        row = np.append(np.maximum(row, -1), -1)
        for j in range(len(self.languages)):
            each = np.append(self.known[j], np.float32(0))[row]
            total = np.add.reduceat(each, np.minimum(limits, len(each) - 1), dtype=np.float64)[::2]
            out[:, j] = np.where(empty, 0, total) + np.bincount(owner, weights=costs[back, j], minlength=len(starts))
        return out


class PpmModels:
    """The trees of any number of languages, ``group`` to a table: what a language pays depends on its
    own counts alone, so the code lengths are those of one table."""

    def __init__(self, counts: pd.DataFrame, group: int = GROUP) -> None:
        self.languages = sorted(counts["lang"].unique())
        parts = [self.languages[i : i + group] for i in range(0, len(self.languages), group)]
        self.models = [PpmModel(counts[counts["lang"].isin(part)], CELLS // len(parts)) for part in parts]

    def bits(self, wanted: np.ndarray) -> np.ndarray:
        return np.concatenate([m.bits(wanted) for m in self.models], axis=1)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.concatenate([m.code_lengths(data, offsets) for m in self.models], axis=1)


def training_pieces(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """lang, text that are learned: the documents that are not held out and have text and language.

    A language of more than ``train_bytes`` (or of its share of ALL_BYTES) is learned from pieces of
    PIECE bytes, kept by a hash of document and place at the rate that makes so many bytes; the piece
    of the least hash is always kept, so that every language has text, also where it is few very long
    documents or one row many times."""
    usable = docs.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0) & ~held_out())
    usable = usable.select("lang", F.col("doc_id").cast("string").alias("d"), F.col("text").cast("binary").alias("text"))
    pieces = F.sequence(F.lit(0), F.floor((F.octet_length("text") - 1) / PIECE).cast("int"))
    place = lambda i: F.pmod(F.xxhash64("d", i), F.lit(1 << 30))
    first = F.array_min(F.transform(pieces, place))
    totals = usable.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.min(first).alias("first")).collect()
    share = min(train_bytes, max(ALL_BYTES // max(len(totals), 1), LEAST_BYTES))
    # as an Arrow table, which needs no Python worker of another kind
    rates = docs.sparkSession.createDataFrame(
        pa.table({
            "lang": pa.array([r["lang"] for r in totals], pa.string()),
            "below": pa.array([float(share / r["bytes"] * (1 << 30)) for r in totals], pa.float64()),
            "first": pa.array([r["first"] for r in totals], pa.int64()),
        })
    )
    placed = usable.join(F.broadcast(rates), "lang")
    kept = F.filter(pieces, lambda i: (place(i) < F.col("below")) | (place(i) == F.col("first")))
    cut = F.transform(kept, lambda i: F.substring(F.col("text"), i * PIECE + 1, F.lit(PIECE)))
    return placed.select("lang", F.explode(F.when(F.col("below") >= float(1 << 30), F.array("text")).otherwise(cut)).alias("text"))


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> PpmModel | PpmModels | None:
    """Learn every language of the documents that are not held out and have text and language.

    The sample is bounded (see ``training_pieces``), so what reaches the driver does not grow with the
    corpus, only with the number of languages. None where there is nothing to learn.
    """
    counts = gram_counts(training_pieces(docs, train_bytes)).toPandas()
    if not len(counts):
        return None
    return PpmModel(counts) if counts["lang"].nunique() <= GROUP else PpmModels(counts)


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(docs: DataFrame, model: PpmModel | None) -> DataFrame:
    """lang_pred, score and bits_per_byte beside every column of ``docs``.

    The score is the winner's share of the languages' probabilities 2^-bits. Null text, text
    without a letter, or an untrained model: ``und`` with score 0. Ties go to the language that
    comes first by code point; repeated rows are rows of their own. Any length of text is read
    whole, about a megabyte at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = shared.value
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            here = np.array([t is not None and has_letter(t) for t in text.to_pylist()], dtype=bool)
            best, score, rate = np.full(len(here), -1), np.zeros(len(here)), np.zeros(len(here))
            data, offsets = binary_views(text.fill_null(b""))
            for i, j in slices(offsets, 1 << 20) if ppm else ():
                bits = ppm.code_lengths(data, offsets[i : j + 1])
                best[i:j] = bits.argmin(axis=1)
                least = bits.min(axis=1)
                score[i:j] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                rate[i:j] = least / np.maximum(np.diff(offsets[i : j + 1]), 1)
            names = np.array([*(ppm.languages if ppm else []), UNDETERMINED], dtype=object)
            best = np.where(here, best, -1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(np.where(best < 0, 0, score)), pa.array(rate)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "bits_per_byte"],
            )

    return _classified(docs, classify)


def _classified(docs: DataFrame, classify) -> DataFrame:
    raw = "__text_bytes"
    sent = docs.withColumn(raw, F.col("text").cast("binary"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return sent.mapInArrow(lean(classify), f"{fields}, lang_pred string, score double, bits_per_byte double")


def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    found = predict(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op8_ppm_language": op8_ppm_language}
