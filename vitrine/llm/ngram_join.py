"""Similarity join on word n-gram sets: T-occurrence search with DivideSkip, and link groups.

Documents are searched in the same unit only if a part of their n-gram sets agrees: the universe is
hashed into parts, for short sets into one more than two linked sets can differ in n-grams, so two
linked sets always agree on a part; for longer sets into PARTS, of which the few smallest n-grams
count, so that a linked pair agrees on none with a chance below ODDS. Inside a unit the inverted
n-gram lists are searched: a heap merges the short lists and skips what cannot occur often enough,
the longest lists are only probed (by binary search) for the documents that the short ones leave
possible, and those reaching the required overlap are linked.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import binary_views, components, lean, mix64, slices, text_bytes, write_table
from vitrine.llm.suffix_dedup import stretch_hash
from vitrine.sources.tables import table

#: The contract of op7: words per n-gram, and the least Jaccard similarity as a fraction.
WORDS, LEAST = 3, (90, 100)
#: Sets and n-grams of a unit that one task searches at once; larger units are cut into pairs of chunks.
BLOCK, GRAMS = 2048, 1 << 19
#: Parts of a long set, and the chance that two long sets that just link agree on none of them.
PARTS, ODDS = 48, 1e-11
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending within the text, and each text's end."""
    body = _LOWER[data[offsets[0] : offsets[-1]]]
    begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    n = len(begin)
    inside = ~_SPACE[body]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = begin[begin < end]  # a text begins a word and ends one, whatever stands beside it
    starts[edges] = inside[edges]
    stops[end[begin < end] - 1] = inside[end[begin < end] - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    word = stretch_hash(body, first, last)
    row = np.searchsorted(end, first, side="right")
    count = np.bincount(row, minlength=n)
    gram = word * _ODD[0]
    whole = np.ones(len(word), bool)
    for k in range(1, words):
        gram[:-k] += word[k:] * _ODD[k % len(_ODD)] + np.uint64(k)
    whole[: len(row)] = np.arange(len(row)) + words <= np.cumsum(count)[row]
    gram, owner = mix64(gram[whole]), row[whole]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        at = np.cumsum(count)[short] - count[short]
        few = mix64(word[at] + count[short].astype(np.uint64) * _ODD[3])
        for k in range(1, words - 1):
            more = count[short] > k
            few[more] = mix64(few[more] * _ODD[4] + word[at[more] + k])
        gram, owner = np.concatenate([gram, few]), np.concatenate([owner, short])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    return gram, np.searchsorted(owner, np.arange(n), side="right")


def size_levels(least: tuple[int, int], upto: int) -> np.ndarray:
    """Smallest size of each level: a set links only with sets of its own or a neighbouring level."""
    firsts = [1]
    while firsts[-1] <= upto:
        firsts.append(firsts[-1] * least[1] // least[0] + 1)
    return np.array(firsts, np.int64)


def smallest_that_count(least: tuple[int, int]) -> int:
    """N-grams of a part that count in long sets: as many as ODDS allow with PARTS parts."""
    count = 1
    while (1 - (least[0] / least[1]) ** (count + 1)) ** PARTS <= ODDS:
        count += 1
    return count


def part_keys(gram: np.ndarray, ends: np.ndarray, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of every set (n-grams ascending within a set), and the set of each key.

    A set has keys at its own level of sizes and the next, so two linked sets meet at one level. At a
    level whose largest size is U they differ in at most D = 2U(1-s)/(1+s) n-grams, so of
    D + 1 + spare parts more than ``spare`` are the same in both. A set with no more than ``spare``
    empty parts then shares one with n-grams in it and needs no key for empty ones; only two sets
    with more empty parts could meet there alone, so such sets keep the keys of all. All levels that
    would take more than PARTS parts are one, where a part's key is that of its smallest n-grams:
    those agree with the similarity of the sets to the power of their number."""
    starts = np.append(0, ends[:-1])
    sizes = ends - starts
    live = np.flatnonzero(sizes)
    firsts = size_levels(least, int(sizes.max(initial=1)) * 2)
    largest = firsts[1:] - 1
    differ = 2 * largest * (least[1] - least[0]) // (least[1] + least[0])
    spare = np.where(differ > 0, 1 + differ // 8, 0)
    parts = differ + 1 + spare
    long_level = int(np.searchsorted(parts, PARTS, side="right"))  # the first that would take more
    own = np.minimum(np.searchsorted(firsts, sizes[live], side="right") - 1, long_level)
    spread, content = mix64(gram ^ _ODD[1]), mix64(gram + _ODD[2])
    row = np.repeat(np.arange(len(live)), sizes[live])
    out, sets = [], []
    for level in (own, own + 1):
        exact = level < long_level
        some = exact[row]
        count = np.where(exact, parts[np.minimum(level, len(parts) - 1)], 0)
        base = np.append(0, np.cumsum(count))
        at = base[row[some]] + (spread[some] % count[row[some]].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(base[-1], np.uint64)
        np.add.at(sums, at, content[some])
        full = np.bincount(at, minlength=base[-1]) > 0
        owner = np.repeat(np.arange(len(live)), count)
        number = np.arange(base[-1]) - base[owner]
        empty = count - np.bincount(owner[full], minlength=len(live))
        sent = full | (empty > spare[np.minimum(level, len(spare) - 1)])[owner]
        owner, number, sums = owner[sent], number[sent], sums[sent]
        out.append(mix64(sums + mix64((level[owner] * (1 << 32) + number).astype(np.uint64))))
        sets.append(live[owner])
    some = (own + 1 >= long_level)[row]
    place = row[some] * PARTS + (spread[some] % np.uint64(PARTS)).astype(np.int64)
    order = np.argsort(place, kind="stable")  # n-grams stay ascending within a part
    place, value = place[order], content[some][order]
    new = np.append(True, place[1:] != place[:-1]) if len(place) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    rank = np.arange(len(place)) - np.repeat(begin, np.diff(np.append(begin, len(place))))
    value[rank >= smallest_that_count(least)] = 0
    sums = np.add.reduceat(value, begin) if len(begin) else np.zeros(0, np.uint64)
    out.append(mix64(sums + mix64((place[begin] % PARTS).astype(np.uint64) + np.uint64(1 << 52))))
    sets.append(live[place[begin] // PARTS])
    return np.concatenate(out).astype(np.int64), np.concatenate(sets)


# --- T-occurrence search -------------------------------------------------------------------------


def merge_skip(lists: list[list[int]], need: int) -> tuple[list[int], list[int]]:
    """Numbers that occur in at least ``need`` of the ascending lists, and in how many.

    The heads of the lists stand in a heap. Where the smallest occurs too seldom, as many lists as
    could not make ``need`` by themselves jump to the next head that is left."""
    heap = [(one[0], k) for k, one in enumerate(lists) if one]
    heapify(heap)
    at = [0] * len(lists)
    found, counts = [], []
    while len(heap) >= need:
        top, hit = heap[0][0], []
        while heap and heap[0][0] == top:
            hit.append(heappop(heap)[1])
        if len(hit) >= need:
            found.append(top)
            counts.append(len(hit))
            target = top + 1
        else:
            while heap and len(hit) < need - 1:
                hit.append(heappop(heap)[1])
            if not heap:
                break
            target = max(heap[0][0], top + 1)
        for k in hit:
            one = lists[k]
            at[k] = j = bisect_left(one, target, at[k])
            if j < len(one):
                heappush(heap, (one[j], k))
    return found, counts


class InvertedLists:
    """Inverted n-gram lists of some sets, and the T-occurrence search over them."""

    def __init__(self, sets: list[np.ndarray], least: tuple[int, int]) -> None:
        self.least = least
        self.sizes = np.array([len(s) for s in sets])
        gram = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(gram, kind="stable")  # sets stay ascending within a list
        gram, self.owner = gram[order], owner[order]
        self.grams, self.at = np.unique(gram, return_index=True)
        self.ends = np.append(self.at[1:], len(gram))
        rank = np.repeat(np.arange(len(self.grams)), self.ends - self.at)
        self.probe = rank * len(sets) + self.owner  # ascending: one binary search probes any list

    def search(self, query: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """Sets among ``open_`` (a mask) that link with ``query``."""
        num, den = self.least
        n = len(query)
        need = -(-num * n // den)  # a union is no smaller than the query
        able = open_ & (den * self.sizes >= num * n) & (num * self.sizes <= den * n)
        if not able.any():
            return np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(self.grams, query), len(self.grams) - 1)
        i = i[self.grams[i] == query]
        if len(i) < need:
            return i[:0]
        size = self.ends[i] - self.at[i]
        i, size = (x[np.argsort(size, kind="stable")] for x in (i, size))
        # DivideSkip: so many of the longest lists are left out of the merge
        skip = min(need - 1, int(need / (0.0085 * np.log2(max(int(size[-1]), 2)) + 1)))
        short, long_ = i[: len(i) - skip], i[len(i) - skip :]
        cut = zip(self.at[short].tolist(), self.ends[short].tolist(), strict=True)
        lists = [one[able[one]].tolist() for one in (self.owner[a:b] for a, b in cut)]
        found, counts = merge_skip(lists, need - skip)
        possible, overlap = np.array(found, np.int64), np.array(counts, np.int64)
        if len(long_) and len(possible):
            key = long_[:, None] * len(self.sizes) + possible[None, :]
            where = np.minimum(np.searchsorted(self.probe, key), len(self.probe) - 1)
            overlap = overlap + (self.probe[where] == key).sum(axis=0)
        return possible[den * overlap >= num * (n + self.sizes[possible] - overlap)]


def link_forest(
    left: list[np.ndarray], right: list[np.ndarray] | None, least: tuple[int, int], joined: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that join what links join: among ``left``, or between ``left`` and ``right``.

    Sets of ``right`` are numbered after those of ``left``; ``joined`` marks sets that are one group
    from the start. Sets already joined with the query are no candidates. A set that shares much with
    many is searched first, and among ``left`` alone the group with most sets still to be searched is
    left to the searches of all others, so a group of near copies costs about one search."""
    both = left + (right or [])
    index = InvertedLists(both, least)
    across = np.zeros(len(both), bool)
    across[len(left) :] = True
    weight = np.array([int((index.ends - index.at)[np.searchsorted(index.grams, s)].sum()) for s in left])
    edges = []
    group = np.arange(len(both))
    if joined is not None and joined.any():
        group[joined] = np.flatnonzero(joined)[0]
    waiting = np.argsort(-weight, kind="stable")
    while len(waiting):
        at = 0
        if right is None:
            names = group[waiting]
            others = np.flatnonzero(names != np.bincount(names).argmax())
            if not len(others):
                break
            at = int(others[0])
        q = int(waiting[at])
        waiting = np.delete(waiting, at)
        open_ = group != group[q]
        if right is not None:
            open_ &= across
        for x in index.search(both[q], open_).tolist():
            if group[x] != group[q]:
                group[group == group[x]] = group[q]
                edges.append((q, x))
    return edges


# --- operator --------------------------------------------------------------------------------------


def _print(gram: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit fingerprint of each set."""
    sums = np.append(np.uint64(0), np.cumsum(mix64(gram), dtype=np.uint64))
    starts = np.append(0, ends[:-1])
    return ends - starts, mix64(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64)).astype(np.int64)


def set_summary(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles and a fingerprint of the set (null for no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_views(batch.column(1))
            found = [_print(*ngram_sets(data, offsets[i : j + 1], words)) for i, j in slices(offsets, 1 << 20)]
            n, p = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(p, mask=n == 0)], names=["doc_id", "n_shingles", "fp"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(lean(run), "doc_id long, n_shingles long, fp long")


def part_rows(docs: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """key, fp of every part of every set; of equal sets in one task only the first is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            data, offsets = binary_views(batch.column(0))
            for i, j in slices(offsets, 1 << 20):
                gram, ends = ngram_sets(data, offsets[i : j + 1], words)
                n, prints = _print(gram, ends)
                fresh = np.zeros(len(n), bool)
                for k, p in enumerate(prints.tolist()):
                    if n[k] and p not in sent:
                        sent.add(p)
                        fresh[k] = True
                keys, sets = part_keys(gram[np.repeat(fresh, n)], np.cumsum(np.where(fresh, n, 0)), least)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[sets])], names=["key", "fp"])

    return docs.where("doc_id is not null").select(text_bytes().alias("text")).mapInArrow(lean(run), "key long, fp long")


def _squeezed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            small = [press.compress(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], names=["doc_id", "text"])

    known = docs.where("doc_id is not null").select("doc_id", text_bytes().alias("text"))
    return known.mapInArrow(lean(run), "doc_id long, text binary")


def _set_of(text: bytes, words: int, press: zstandard.ZstdDecompressor) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(press.decompress(text), np.uint8)
    gram, ends = ngram_sets(raw, np.array([0, len(raw)]), words)
    return int(_print(gram, ends)[1][0]), gram


def _chunked(units: DataFrame, block: int, grams: int) -> DataFrame:
    """unit, i, j, chunk, doc_id, fp, inner of units (unit, doc_id, fp, n_shingles, inner), each cut
    into pairs (i, j) of chunks where it exceeds ``block`` sets or ``grams`` n-grams.

    Sets that are ``inner`` are one group already: their chunks meet those of the others only."""
    outer = F.col("inner") == F.lit(False)

    def cut(m, w):
        return F.greatest(F.ceil(F.coalesce(m, F.lit(0)) / block), F.ceil(F.coalesce(w, F.lit(0)) / grams)).cast("int")

    sizes = units.groupBy("unit").agg(
        F.count("*").alias("m"), F.sum("n_shingles").alias("w"), F.count_if(outer).alias("mo"), F.sum(F.when(outer, F.col("n_shingles"))).alias("wo")
    )
    whole = cut(F.col("m"), F.col("w")) <= 1
    sizes = sizes.where("m >= 2 and mo >= 1").select(
        "unit",
        F.when(whole, 1).otherwise(cut(F.col("mo"), F.col("wo"))).alias("outers"),
        F.when(whole, 0).otherwise(cut(F.col("m") - F.col("mo"), F.col("w") - F.col("wo"))).alias("inners"),
    )
    inside = F.col("inner") & (F.col("inners") > 0)
    mine = F.when(inside, F.col("outers") + F.pmod(F.xxhash64("fp"), F.col("inners")))
    mine = mine.otherwise(F.pmod(F.xxhash64("fp"), F.col("outers"))).cast("int")
    last = F.when(inside, F.col("outers")).otherwise(F.col("outers") + F.col("inners")) - 1
    pairs = F.transform(
        F.sequence(F.lit(0), last.cast("int")),
        lambda o: F.struct(F.least(o, F.col("chunk")).alias("i"), F.greatest(o, F.col("chunk")).alias("j")),
    )
    placed = units.join(sizes, "unit").withColumn("chunk", mine).withColumn("pair", F.explode(pairs))
    return placed.select("unit", "pair.i", "pair.j", "chunk", "doc_id", "fp", "inner")


def _to_pivots(large: DataFrame, score: DataFrame, texts: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """Links (a, b) of the sets of each component with its pivot, the set that meets most others (``score``: fp, s)."""
    pivots = score.join(large.select("fp", "component"), "fp").groupBy("component").agg(F.max(F.struct("s", "fp")).alias("top")).select("component", F.col("top.fp").alias("pivot"))
    rows = texts.join(large, "doc_id").select("component", "fp", "text")
    chosen = rows.join(pivots, "component").where("fp = pivot").select("component", "pivot", F.col("text").alias("pivot_text"))
    num, den = least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, name, centre = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for fp, text, pivot, pivot_text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pivot != name:
                    read, gram = _set_of(pivot_text, words, press)
                    name, centre = (pivot, gram) if read == pivot else (None, None)
                read, gram = _set_of(text, words, press)
                if read != fp or fp == pivot or centre is None or num * max(len(gram), len(centre)) > den * min(len(gram), len(centre)):
                    continue
                same = len(np.intersect1d(gram, centre, assume_unique=True))
                if den * same >= num * (len(gram) + len(centre) - same):
                    out.append((pivot, fp))
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    both = rows.join(chosen, "component").select("fp", "text", "pivot", "pivot_text")
    return both.mapInArrow(lean(run), "a long, b long").distinct()


def _placed(
    kept: DataFrame, members: DataFrame, texts: DataFrame, words: int, least: tuple[int, int], block: int, grams: int
) -> tuple[DataFrame, DataFrame | None]:
    """Members (doc_id, fp, n_shingles, component) in units of work (see ``_chunked``) that hold every
    pair that shares a key and is not joined yet, and links found on the way.

    A component of at most ``block`` sets and ``grams`` n-grams is one unit. In a larger one all sets
    are first compared with one pivot, which joins a group of near copies at once; keys whose sets
    are all joined go. Of the others, all sets that meet the same first one under any key are a unit;
    those that meet under keys of more than ``block`` sets are a unit of chunks, in which joined sets
    meet only those that are not."""
    sizes = members.groupBy("component").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w")).where("m >= 2")
    sized = write_table(members.join(sizes, "component"), "join-members")
    fits = (F.col("m") <= block) & (F.col("w") <= grams)
    sets = ["doc_id", "fp", "n_shingles"]
    small = sized.where(fits).select(F.col("component").alias("unit"), *sets, F.lit(False).alias("inner"))
    large = sized.where(~fits).select(*sets, "component")
    if large.isEmpty():
        return _chunked(small, block, grams), None
    pivoted = write_table(_to_pivots(large, kept.groupBy("fp").agg(F.sum("n").alias("s")), texts, words, least), "join-pivots")
    centre = F.col("a").alias("pivot")
    group = pivoted.select(F.col("b").alias("fp"), centre).unionByName(pivoted.select(F.col("a").alias("fp"), centre).distinct())
    named = write_table(large.join(group, "fp", "left").select(*sets, "pivot"), "join-named")
    # only keys that a set which is not joined has, and one of those that hold the same sets
    outer = named.where("pivot is null").select("fp")
    touched = kept.join(outer, "fp").groupBy("who", "n").agg(F.min("key").alias("key")).select("key")
    mine = kept.select("key", "fp", "n", "a").join(touched, "key", "left_semi").join(named, "fp", "left")
    mine = write_table(mine.withColumn("group", F.coalesce("pivot", "fp")), "join-large")
    keys = mine.groupBy("key").agg(F.first("n").alias("n"), F.min("group").alias("x"), F.max("group").alias("y"), F.first("a").alias("first"))
    keys = write_table(keys.where("x <> y").select("n", "key", "first"), "join-units")
    met = mine.select("key", *sets, F.col("pivot").isNotNull().alias("inner")).join(keys, "key")
    cool = met.where(F.col("n") <= block).select(F.xxhash64(F.lit("first"), "first").alias("unit"), *sets, "inner").distinct()
    hot = met.where(F.col("n") > block)
    groups = components(hot.where("fp <> first").select(F.col("first").alias("a"), F.col("fp").alias("b")), "join-hot")
    dense = groups.join(named, F.col("node") == F.col("fp"))
    dense = dense.select(F.xxhash64(F.lit("dense"), "component").alias("unit"), *sets, F.col("pivot").isNotNull().alias("inner"))
    units = write_table(cool.unionByName(dense), "join-placed")
    return _chunked(small.unionByName(units), block, grams), pivoted


def _links(placed: DataFrame, texts: DataFrame, words: int, least: tuple[int, int], partitions: int) -> DataFrame:
    """Links (a, b) of the placed sets that hold every group together; every pair of chunks of a unit
    is searched by itself."""
    # both sides grow with the table: the same join at every size
    rows = texts.join(placed.hint("merge"), "doc_id").select("unit", "i", "j", "chunk", "fp", "inner", "text")
    key = ["unit", "i", "j"]

    def solve(unit: list[tuple]) -> list[tuple[int, int]]:
        ids: list[list[int]] = [[], []]
        sets: list[list[np.ndarray]] = [[], []]
        inner: list[list[bool]] = [[], []]
        seen = set()
        i, j = unit[0][1], unit[0][2]
        press = zstandard.ZstdDecompressor()
        for _, _, _, chunk_, fp, inner_, text in unit:
            if fp in seen:
                continue
            read, gram = _set_of(text, words, press)
            if read != fp:  # another row of this doc_id has the set that counts
                continue
            seen.add(fp)
            side = int(i != j and chunk_ == j)
            ids[side].append(fp)
            sets[side].append(gram)
            inner[side].append(inner_)
        if len(seen) < 2 or i != j and not (sets[0] and sets[1]):
            return []
        names = ids[0] + ids[1]
        found = link_forest(sets[0], sets[1] if i != j else None, least, np.array(inner[0] + inner[1]))
        return [(names[a], names[b]) for a, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    out += solve(held)
                    held = []
                held.append(row)
        if held:
            out += solve(held)
        a, b = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition(partitions, *key).sortWithinPartitions(*key).mapInArrow(lean(run), "a long, b long")


def similarity_groups(
    docs: DataFrame, words: int = WORDS, least: tuple[int, int] = LEAST, block: int = BLOCK, grams: int = GRAMS
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Words are runs other than blank and \\t..\\r, A-Z lower-cased; a text of fewer than ``words``
    words is one n-gram. Null texts and texts without words have an empty set and stand alone. Equal
    sets are one set from the start. A null doc_id takes part through the rows that share its set
    only, and has a null component where there are none; rows of equal doc_id are one document whose
    links add up. Other columns are ignored; an empty table gives no rows. Very long texts are read
    whole. Sets are compared by 64-bit hashes of their n-grams, equal sets by one 64-bit hash (of N
    different sets two share it with a chance of N * N / 2**65).
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = write_table(set_summary(docs, words), "join-sets")
    known = sets.where("fp is not null and doc_id is not null")
    reps = known.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n_shingles"))
    same_key = Window.partitionBy("key")
    parts = part_rows(docs, words, least).repartition(n, "key").dropDuplicates(["key", "fp"])
    kept = parts.withColumn("n", F.count("*").over(same_key)).where("n >= 2").withColumn("a", F.min("fp").over(same_key))
    kept = kept.withColumn("who", F.bit_xor(F.xxhash64("fp")).over(same_key))  # with n: which sets have the key
    kept = write_table(kept, "join-parts")
    blocks = components(kept.where("a <> fp").select("a", F.col("fp").alias("b")), "join-blocks")
    members = reps.join(blocks, F.col("fp") == F.col("node")).select(F.col("rep").alias("doc_id"), "fp", "n_shingles", "component")
    texts = _squeezed(docs)
    placed, pivoted = _placed(kept, members, texts, words, least, block, grams)
    links = _links(placed, texts, words, least, n)
    if pivoted is not None:
        links = links.unionByName(pivoted)
    several = known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z")  # a doc_id with several sets
    ties = known.join(several, "doc_id").where("fp <> a").select("a", F.col("fp").alias("b"))
    groups = components(links.unionByName(ties), "join-links")
    named = groups.join(reps, F.col("fp") == F.col("node")).select("fp", "rep", "component")
    names = named.groupBy("component").agg(F.min("rep").alias("least"))
    named = named.join(names, "component").select("fp", "least")
    named = reps.join(named, "fp", "left").select("fp", F.coalesce("least", "rep").alias("least"))
    out = sets.join(named, "fp", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link groups of all documents at 3 words and a Jaccard similarity of 0.9."""
    return similarity_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op7_ngram_join": op7_ngram_join}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL = {
    "op7_ngram_join": f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(generate_series(1, len(w) - {WORDS - 1}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) END AS s FROM w),
    g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    link AS (SELECT a, b FROM both_ WHERE {LEAST[1]} * k >= {LEAST[0]} * (na + nb - k)),
    reach(x, y) AS (SELECT a, b FROM link UNION SELECT x, b FROM reach JOIN link ON y = a),
    c AS (SELECT x, min(y) AS least FROM reach GROUP BY 1)
    SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id FROM s LEFT JOIN c ON doc_id = x"""
}
