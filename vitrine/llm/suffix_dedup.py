"""Repeated byte strings across documents, found by sparse suffix sorting.

Every string of LENGTH bytes has one anchor: the position in it whose GRAM-byte hash is smallest.
Equal strings have their anchor at the same place, so only suffixes that start at anchors (about
one byte in ninety) are candidates, and only anchors whose gram occurs twice go on. The anchors of
one gram are then ordered twice, by what follows and by what precedes them, with deep-shallow
sorting: multikey partitioning on 8-byte characters to a shallow depth, blind tries for the groups
that are still tied there. The longest common prefixes of both orders say exactly which strings
occur again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import binary_views, lean, mix64, slices, text_bytes, write_table
from vitrine.sources.tables import table

LENGTH, GRAM = 200, 32
#: Multikey depth in bytes before blind tries take over.
SHALLOW = 64
#: Distinct surroundings of one gram that one task sorts; larger groups are narrowed down.
HOT = 256
_rng = np.random.default_rng(11)
_LETTERS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTERS2 = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE, _BASE2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (a power of two) from each position, by doubling."""
    h, w, base = _LETTERS[data], 1, _BASE
    while w < width:
        h = h[:-w] * base + h[w:]
        base, w = np.uint64(int(base) ** 2 % (1 << 64)), 2 * w
    return h


def stretch_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for every pair, from one prefix sum."""
    power = _powers(_BASE2, len(data))
    inverse = _powers(np.uint64(pow(int(_BASE2), -1, 1 << 64)), len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTERS2[data] * power[:-1], dtype=np.uint64)])
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x)
    size = -(-n // width) * width
    blocks = np.concatenate([x, np.full(size - n, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _unwrapped(position: np.ndarray, start: np.ndarray, low: np.uint64) -> np.ndarray:
    """Whole positions from their low bits: at most a string's length after ``start``."""
    return (start + ((position - start) & low)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of the texts data[offsets[i]:offsets[i+1]]: row, first string start ``lo`` (within the
    text), ``span`` = last start - first start, ``off`` = anchor - lo, gram key and stretch hash."""
    body = data[offsets[0] : offsets[-1]]
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    none = {k: np.zeros(0, np.int64) for k in ("row", "lo", "span", "off", "kh", "sh")}
    long_ = np.flatnonzero(end - begin >= length)
    if not len(long_):
        return none
    h = rolling(body, gram)
    low = np.uint64((1 << 24) - 1)  # positions share a word with their hashes; both halves follow the text alone
    order = (mix64(h) & ~low) | (np.arange(len(h), dtype=np.uint64) & low)
    least = sliding_min(order, length - gram + 1) & low
    least = _unwrapped(least, np.arange(len(least), dtype=np.uint64), low)
    starts = np.concatenate([np.arange(begin[i], end[i] - length + 1) for i in long_])
    row = np.repeat(long_, end[long_] - begin[long_] - length + 1)
    at = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    lo, hi, at, row = starts[first], starts[last], at[first], row[first]
    kh = (mix64(h[at] ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(18)).astype(np.int64)
    sh = mix64(stretch_hash(body, lo, hi + length) + ((at - lo) * 1024 + (hi - lo)).astype(np.uint64)).astype(np.int64)
    return {"row": row, "lo": lo - begin[row], "span": hi - lo, "off": at - lo, "kh": kh, "sh": sh}


# --- deep-shallow sorting --------------------------------------------------------------------------


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """A blind trie: inner nodes know only their depth and branching bytes. A string is led down
    without looking at the bytes between branches, compared once with the leaf it reaches, and
    inserted where that comparison says."""

    def __init__(self) -> None:
        self.root = None

    def insert(self, name: int, s: bytes, strings: list[bytes]) -> None:
        if self.root is None:
            self.root = [-1, [name]]
            return
        node = self.root
        while node[0] >= 0:
            child = node[1].get(s[node[0]] if node[0] < len(s) else -1)
            node = child if child is not None else next(iter(node[1].values()))
        other = strings[node[1][0]]
        depth = _common(s, other)
        if depth == len(s) == len(other):
            node[1].append(name)
            return
        parent, key, node = None, None, self.root
        while 0 <= node[0] < depth:
            parent, key = node, s[node[0]] if node[0] < len(s) else -1
            node = node[1][key]
        mine = s[depth] if depth < len(s) else -1
        if node[0] == depth:
            node[1][mine] = [-1, [name]]
            return
        fork = [depth, {other[depth] if depth < len(other) else -1: node, mine: [-1, [name]]}]
        if parent is None:
            self.root = fork
        else:
            parent[1][key] = fork

    def ordered(self, strings: list[bytes]) -> Iterator[tuple[int, int]]:
        """(name, common prefix with the one before) in order; the first has 0."""
        waiting, common = [(self.root, 0)], 0
        while waiting:
            node, common = waiting.pop()
            if node[0] < 0:
                for k, name in enumerate(node[1]):
                    yield name, len(strings[name]) if k else common
            else:
                keys = sorted(node[1], reverse=True)
                for k, key in enumerate(keys):
                    waiting.append((node[1][key], common if k == len(keys) - 1 else node[0]))


def deep_shallow(group: np.ndarray, strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``strings`` within ascending groups, and each one's common prefix with its
    predecessor (-1 at the start of a group)."""
    n = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    head = b"".join([s[:shallow].ljust(shallow, b"\0") for s in strings])
    words = np.frombuffer(head, ">u8").reshape(n, shallow // 8)
    order = np.argsort(group, kind="stable")
    same = np.zeros(n, np.int64)  # position -> bytes known to be shared with the predecessor
    tied = np.zeros(n, bool)
    tied[1:] = group[order][1:] == group[order][:-1]
    same[~tied] = -1
    for k in range(shallow // 8):  # all groups that are still tied are split by the next character
        inside = tied.copy()
        inside[:-1] |= tied[1:]
        where = np.flatnonzero(inside)
        if not len(where):
            break
        block = np.cumsum(~tied)[where]
        by = np.lexsort((words[order[where], k], block))
        order[where] = order[where[by]]
        now = words[order, k]
        i = np.flatnonzero(tied)
        apart = i[now[i] != now[i - 1]]
        differ = now[apart] ^ now[apart - 1]
        shared = np.zeros(len(apart), np.int64)
        for b in range(1, 8):
            shared += (differ >> np.uint64(8 * (8 - b))) == 0
        same[apart] = 8 * k + shared
        tied[apart] = False
    same = np.where(same >= 0, np.minimum(same, np.minimum(lengths[order], np.append(0, lengths[order][:-1]))), same)
    starts = np.flatnonzero(~tied & np.append(tied[1:], False))
    for a in starts.tolist():
        b = a + 1
        while b < n and tied[b]:
            b += 1
        trie, members = BlindTrie(), order[a:b].tolist()
        for name in members:
            trie.insert(name, strings[name], strings)
        for k, (name, common) in enumerate(trie.ordered(strings)):
            order[a + k] = name
            if k:
                same[a + k] = common
    return order, same


def repeated_starts(
    group: np.ndarray, weight: np.ndarray, off: np.ndarray, span: np.ndarray, texts: list[bytes], length: int
) -> list[np.ndarray]:
    """For each stretch of text, the string starts (relative to the stretch) that occur again in
    another stretch of its group, or in a copy of its own (weight above 1)."""
    n = len(texts)
    offs = off.tolist()
    order, right = deep_shallow(group, [t[o:] for t, o in zip(texts, offs, strict=True)])
    order2, left = deep_shallow(group, [t[:o][::-1] for t, o in zip(texts, offs, strict=True)])
    hits = np.zeros((n, int(off.max()) + 1), bool)
    after, before = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d in range(int(off.max()) + 1):  # strings that start d bytes before their anchor
        live = np.flatnonzero((d <= off) & (d >= off - span))
        if not len(live):
            continue
        after[order] = np.cumsum(right < length - d)
        before[order2] = np.cumsum(left < d)
        _, back = np.unique(after[live] * (n + 1) + before[live], return_inverse=True)
        hits[live, d] = (np.bincount(back, weights=weight[live]) >= 2)[back]
    return [offs[i] - np.flatnonzero(hits[i])[::-1] for i in range(n)]


def _runs(starts: np.ndarray) -> list[int]:
    """Consecutive starts as first, last, first, last ..."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    firsts, lasts = starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]
    return np.stack([firsts, lasts], axis=1).reshape(-1).tolist()


# --- operator --------------------------------------------------------------------------------------


def _keyed(docs: DataFrame, squeezed: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, th (64-bit hash of the text; tells rows of equal doc_id apart), the text and the
    carried columns."""
    th = F.xxhash64(text_bytes()).alias("th")
    found = docs.select("doc_id", th, text_bytes().alias("text"), *(F.col(c) for c in carry))
    return found.mapInArrow(lean(_squeeze), found.schema) if squeezed else found


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        small = [press.compress(t) for t in batch.column(2).to_pylist()]
        columns = [*batch.columns[:2], pa.array(small, pa.binary()), *batch.columns[3:]]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _scan(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["kh", "sh", "doc_id", "th", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_views(batch.column(2))
            for i, j in slices(offsets, 1 << 20):
                found = anchors(data, offsets[i : j + 1], length, gram)
                row = pa.array(found["row"] + i)
                place = (found["lo"] << 20) | (found["span"] << 10) | found["off"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found["kh"]), pa.array(found["sh"]), batch.column(0).take(row), batch.column(1).take(row), pa.array(place)],
                    names=names,
                )

    return _keyed(docs).mapInArrow(lean(run), ", ".join(f"{n} long" for n in names))


def _same_row(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on (th, doc_id), where a null doc_id equals itself."""
    b = b.withColumnsRenamed({"doc_id": "d2", "th": "t2"})
    on = (F.col("th") == F.col("t2")) & F.col("doc_id").eqNullSafe(F.col("d2"))
    return a.join(b, on, how).drop("d2", "t2")


def _segments(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The text of each wanted stretch: kh, sh, n, nd, off, span, seg."""
    lists = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("kh", "sh", "n", "nd", "place")).alias("all"))
    joined = _same_row(_keyed(docs, squeezed=True), lists, "inner").select("text", "all")
    names = ["kh", "sh", "n", "nd", "off", "span", "seg"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for text, all_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = press.decompress(text)
                for x in all_:
                    lo, span, off = x["place"] >> 20, (x["place"] >> 10) & 1023, x["place"] & 1023
                    row = (x["kh"], x["sh"], x["n"], x["nd"], off, span, text[lo : lo + span + length])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if k == "seg" else pa.int64()) for k, c in zip(names, out, strict=True)], names=names
            )

    return joined.mapInArrow(lean(run), ", ".join(f"{k} {'binary' if k == 'seg' else 'long'}" for k in names))


def _sorted_groups(segments: DataFrame, length: int, partitions: int) -> DataFrame:
    """kh, sh, runs of the groups that one task sorts whole."""
    out = "kh long, sh long, runs array<int>"

    def solve(rows: dict[str, list]) -> pa.RecordBatch:
        seen, keep = set(), []
        for i, key in enumerate(zip(rows["kh"], rows["sh"], strict=True)):
            if key not in seen:  # a repeated row of the table brings its stretches again
                seen.add(key)
                keep.append(i)
        col = {k: [rows[k][i] for i in keep] for k in rows}
        array = {k: np.array(col[k], np.int64) for k in ("kh", "n", "off", "span")}
        found = repeated_starts(array["kh"], array["n"], array["off"], array["span"], col["seg"], length)
        runs = [_runs(x) for x in found]
        hit = [i for i, r in enumerate(runs) if r]
        return pa.RecordBatch.from_arrays(
            [pa.array([col["kh"][i] for i in hit], pa.int64()), pa.array([col["sh"][i] for i in hit], pa.int64()), pa.array([runs[i] for i in hit], pa.list_(pa.int32()))],
            names=["kh", "sh", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            rows = batch.to_pydict()
            held = {k: held.get(k, []) + v for k, v in rows.items()}
            if len(held["kh"]) >= 20_000:  # all whole groups so far
                last = held["kh"][-1]
                cut = len(held["kh"])
                while cut and held["kh"][cut - 1] == last:
                    cut -= 1
                if cut:
                    yield solve({k: v[:cut] for k, v in held.items()})
                    held = {k: v[cut:] for k, v in held.items()}
        if held and held["kh"]:
            yield solve(held)

    placed = segments.repartition(partitions, "kh").sortWithinPartitions("kh", "sh")
    return placed.select("kh", "sh", "n", "off", "span", "seg").mapInArrow(lean(run), out)


def _offset_keys(blocks: DataFrame, width: int, length: int) -> DataFrame:
    """Beside each block of string offsets: a key of the bytes that all its strings share (w1, w2)
    and one of the bytes that they cover together (s1, s2)."""
    names = [*blocks.columns, "w1", "w2", "s1", "s2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kh, off, span, k = (np.asarray(batch.column(i)) for i in (0, 2, 3, 4))
            data, offsets = binary_views(batch.column(5))
            data, at = data[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0] + off
            least, most = k * width, k * width + width - 1
            low, high = np.maximum(least, off - span), np.minimum(most, off)
            keys = []
            for start, end, salt in ((at - least, at + length - most, k), (at - high, at + length - low, low * 1024 + high)):
                mark = mix64(kh.astype(np.uint64)) + salt.astype(np.uint64)
                keys.append(stretch_hash(data, start, end) + mark)
                keys.append(stretch_hash(data[::-1], len(data) - end, len(data) - start) + mark)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.astype(np.int64)) for x in keys)], names=names)

    return blocks.mapInArrow(lean(run), f"{blocks.schema.simpleString()[7:-1]},w1:long,w2:long,s1:long,s2:long".replace(":", " "))


def _by_narrowing(segments: DataFrame, length: int) -> DataFrame:
    """kh, sh, runs of groups too large for one task, by narrowing blocks of string offsets.

    Strings whose anchor lies d bytes after their start are told by d. Stretches that repeat a
    string with d in a block share the bytes that all strings of the block have; blocks that share
    them with nobody are done, as are blocks that share everything they cover (all their strings
    repeat) but one of them, which stands for these in what follows. The rest is cut in four, down to
    single offsets. Every step is a partial aggregate of a few rows per stretch, so no group meets in
    one task."""
    width = 1
    while 4 * width <= length // 3:
        width *= 4
    first, last = F.floor((F.col("off") - F.col("span")) / width), F.floor(F.col("off") / width)
    blocks = segments.dropDuplicates(["kh", "sh"]).withColumn("k", F.explode(F.sequence(first, last)))
    found = []
    while True:
        keyed = _offset_keys(blocks.select("kh", "sh", "off", "span", "k", "seg"), width, length)
        keyed = write_table(keyed, "suffix-blocks")
        twice = F.count("*").alias("c")
        weak = keyed.groupBy("w1", "w2").agg(twice).where("c >= 2").select("w1", "w2")
        strong = keyed.groupBy("s1", "s2").agg(twice, F.min("sh").alias("one")).where("c >= 2").select("s1", "s2", "one")
        met = keyed.join(weak, ["w1", "w2"], "left_semi").join(strong, ["s1", "s2"], "left")
        met = write_table(met.select("kh", "sh", "off", "span", "k", "seg", "one"), "suffix-met")
        high = F.least(F.col("k") * width + width - 1, "off")
        low = F.greatest(F.col("k") * width, F.col("off") - F.col("span"))
        found.append(met.where("one is not null").select("kh", "sh", F.array(F.col("off") - high, F.col("off") - low).alias("run")))
        left = met.where("one is null or sh = one")
        if width == 1 or left.isEmpty():
            break
        width //= 4
        first = F.greatest(F.col("k") * 4, F.floor((F.col("off") - F.col("span")) / width))
        last = F.least(F.col("k") * 4 + 3, F.floor(F.col("off") / width))
        blocks = left.withColumn("k", F.explode(F.sequence(first, last)))
    runs = F.flatten(F.collect_list("run")).cast("array<int>").alias("runs")
    return reduce(DataFrame.unionAll, found).groupBy("kh", "sh").agg(runs)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Ranges of bytes covered by strings of ``length`` bytes that start anywhere else too:
    doc_id, th, ranges (array of struct start, end; they may overlap)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = _scan(docs, length, gram)
    # written, so that the join reads both sides from shuffles and a hot gram can be dealt to many tasks
    twice = write_table(found.select("kh").groupBy("kh").count().where("count >= 2").select("kh"), "suffix-grams")
    found = write_table(found.join(twice, "kh", "left_semi"), "suffix-anchors")
    kinds = found.groupBy("kh", "sh").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "place")).alias("rep"))
    kinds = write_table(kinds, "suffix-kinds")
    several = kinds.groupBy("kh").agg(F.count("*").alias("nd")).where("nd >= 2")
    wanted = kinds.join(several, "kh").select("kh", "sh", "n", "nd", "rep.doc_id", "rep.th", "rep.place")
    segments = write_table(_segments(docs, wanted, length), "suffix-segments")
    sorted_ = _sorted_groups(segments.where(F.col("nd") <= hot), length, n)
    narrowed = _by_narrowing(segments.where(F.col("nd") > hot), length)
    span = F.shiftright("rep.place", 10).bitwiseAND(F.lit(1023)).cast("int")
    copies = kinds.where("n >= 2").select("kh", "sh", F.array(F.lit(0), span).alias("runs"))
    runs = copies.unionByName(sorted_).unionByName(narrowed)
    lo = F.shiftright("place", 20)
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)),
        lambda i: F.struct(
            (lo + F.element_at("runs", i + 1)).alias("start"), (lo + F.element_at("runs", i + 2) + length).alias("end")
        ),
    )
    ranged = found.join(runs, ["kh", "sh"]).select("doc_id", "th", pairs.alias("ranges"))
    return ranged.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def merge(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that ranges cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["end"]) for r in ranges or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, carry: Sequence[str] = (), whole_characters: bool = False
) -> DataFrame:
    """doc_id, spans (removed runs of bytes: array of struct start, end), kept (remaining bytes),
    n_bytes, and the columns named by ``carry`` as they are. With ``whole_characters`` the bytes of
    characters that a cut went through are no longer in ``kept``.

    Null text is empty and, like any text below ``length`` bytes, loses nothing. A string that
    overlaps itself counts, as does a repeated row, which loses every string it has. Rows of equal
    or null doc_id are told apart by their text. Very long texts are scanned whole; an empty table
    gives no rows; other columns are ignored.
    """
    spans_ = repeated_spans(docs, length, gram, hot)
    joined = _same_row(_keyed(docs, squeezed=True, carry=carry), spans_, "left")
    joined = joined.select("doc_id", "text", "ranges", *carry)
    schema = T.StructType.fromDDL("doc_id long, spans array<struct<start:long,end:long>>, kept binary, n_bytes long")
    schema = T.StructType([*schema.fields, *(joined.schema[c] for c in carry)])
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            spans, kept, sizes = [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = press.decompress(text)
                gone = merge(ranges)
                edges = [0, *[x for pair in gone for x in pair], len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                kept.append(left.decode("utf-8", "ignore").encode() if whole_characters else left)
                spans.append([{"start": a, "end": b} for a, b in gone])
                sizes.append(len(text))
            made = [pa.array(spans, pairs), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *batch.columns[3:]], names=schema.names)

    return joined.mapInArrow(lean(run), schema)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 200 bytes that occur elsewhere."""
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLE_SQL = {
    "op9_suffix_dedup": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    p AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, {2 * LENGTH})) AS k FROM d, unnest(range(0, n - {LENGTH - 1})) u(i)),
    s AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM p) WHERE c > 1),
    t AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 0) AS gap FROM s),
    u AS (SELECT r, i, count_if(gap > {LENGTH}) OVER (PARTITION BY r ORDER BY i) AS part FROM t),
    g AS (SELECT r, part, min(i) AS a, max(i) + {LENGTH} AS b FROM u GROUP BY 1, 2),
    e AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM g),
    k AS (SELECT r, sum(b - a) AS gone, count(*) AS spans, max(b) AS last, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
      FROM e JOIN d USING (r) GROUP BY 1)
    SELECT doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
      sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN k USING (r)"""
}
