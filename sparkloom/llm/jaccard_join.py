"""Similarity join of texts by Jaccard over word shingles: a size-aware join of heavy and light sets.

Every set has its shingles in one order. A pair with Jaccard >= t shares at least k shingles among the first
``n - ceil(t n) + k`` of each set. Light (small) sets enumerate the 2-subsets of that prefix for k = 2 and meet on equal
subsets; heavy (large) sets put the prefix for k = 1 in inverted lists, which are scanned. The boundary is where the
cost of enumerating passes the cost of scanning, from the measured lengths of lists. Light sets that could match a
heavy one are in the lists too.

The order puts shingles that are frequent in prefixes last, so passages that many texts share don't lead to long lists.
Only components are asked for, not all pairs: a list first links each set to a representative; after those links are
verified, lists are scanned again only between sets that are still apart, where a parity bitmap of each set gives an
upper bound of the overlap and drops hopeless pairs. Every link that counts is verified on the exact sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, components, id_filter, in_filter, lean, mix, partitions, shingle_sets, written

#: Threshold as a fraction of integers, shingle length in words.
NUM, DEN, WORDS = 80, 100, 5
#: A shingle in the prefixes of more texts than this counts as frequent and goes last in the order; if more than
#: MOST_FREQUENT are, only the most frequent of them do. Cells of the map of frequent shingles: 4 MB of bits.
FREQUENT, MOST_FREQUENT, MAP = 64, 1 << 21, 1 << 25
#: A class with more than one in so many rows is hot; there are fewer than HOT such classes, so they can be broadcast.
HOT = 1000
#: Entries of the inverted lists that one task holds, about: 32 MB. A bucket gives each pair once, however many lists the
#: pair shares in it, so few large buckets repeat fewer pairs than many small ones.
BUCKET = 1 << 21
#: Entries that a worker holds before it sends them.
HELD = 500_000
#: Cells of the sketch that measures the lengths of lists, for each power of two of the set size.
SKETCH = 4096
#: Cells of a bitmap for each shingle, about; representatives with which a list links each of its sets.
CELLS, HEADS = 4, 4
#: Cost of scanning past an entry of a list, relative to writing one.
SCAN = 0.02


def needed(n: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """ceil(t n): shingles that a set of n shares with any partner."""
    return (num * n + den - 1) // den


def _prefix(shingles: np.ndarray, frequent: np.ndarray | None, num: int, den: int) -> np.ndarray:
    """The first n - ceil(t n) + 2 shingles (all, if fewer) in the order: frequent last, then by hash."""
    n = len(shingles)
    size = min(n, n - int(needed(n, num, den)) + 2)
    if frequent is not None and n:
        bit = shingles & np.uint64(MAP - 1)
        often = (frequent[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
        if often.any():
            light = shingles[often == 0]
            if len(light) < size:
                return np.concatenate((light, shingles[often == 1][: size - len(light)]))
            return light[:size]
    return shingles[:size]


def parity_bits(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of b cells, b CELLS times the power of two from n up. Two sets that differ in d
    shingles differ in at most d cells, and hardly in fewer."""
    b = CELLS << max(4, (len(shingles) - 1).bit_length())
    counts = np.bincount((mix(shingles) & np.uint64(b - 1)).astype(np.int64), minlength=b)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def bitmap_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in which two sets differ."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # folding halves keeps parities: the cell is hash mod b, and bits are packed in order
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum())


def can_link(na, nb, distance, num: int = NUM, den: int = DEN):
    """Whether sets of these sizes that differ in ``distance`` shingles or more can reach the threshold."""
    overlap2 = na + nb - distance  # twice the overlap, at most
    return den * overlap2 >= num * (2 * (na + nb) - overlap2)


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), WORDS)


class Ids:
    """Ids of classes of equal sets: 64 bits of a digest of the set, or 64 other ones for those of ``taken`` that two sets
    share. Which these are is found with 128 bits; of 10^11 sets some hundreds are expected, and TAKEN at the most."""

    TAKEN = 100_000

    def __init__(self, taken: frozenset[int] = frozenset()) -> None:
        self.taken = taken

    @staticmethod
    def both(shingles: np.ndarray) -> tuple[int, int]:
        digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
        return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)

    def __call__(self, shingles: np.ndarray) -> int:
        one, two = self.both(shingles)
        return two if one in self.taken else one


def features(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n (set size), cid and other (64 bits each of the set), bits (parity; null if the
    task has given the class's before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            n, cids, others, bits = [], [], [], []
            for s in _sets(batch):
                key = Ids.both(s)
                n.append(len(s))
                cids.append(key[0])
                others.append(key[1])
                bits.append(None if key in seen else parity_bits(s) if len(s) else b"")
                seen.add(key)
                if len(seen) > 1_000_000:
                    seen.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cids, pa.int64()), pa.array(others, pa.int64()), pa.array(bits, pa.binary())], names=["doc_id", "n", "cid", "other", "bits"])

    return docs.mapInArrow(lean(run), "doc_id long, n long, cid long, other long, bits binary")


class _Buckets:
    """Entries (key, n, id) collected by bucket and given out as packed rows, so that a shuffle moves few rows."""

    def __init__(self, count: int) -> None:
        self.count, self.keys, self.n, self.ids, self.held = count, [], [], [], 0

    def add(self, keys: np.ndarray, n: int, i: int) -> None:
        self.keys.append(keys)
        self.n.append(np.full(len(keys), n, np.uint32))
        self.ids.append(np.full(len(keys), i, np.int64))
        self.held += len(keys)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            keys, n, ids = np.concatenate(self.keys), np.concatenate(self.n), np.concatenate(self.ids)
            bucket = (keys % np.uint64(self.count)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            keys, n, ids, bucket = (keys[order] >> np.uint64(32)).astype(np.uint32), n[order], ids[order], bucket[order]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            ends = np.append(cut[1:], len(bucket))
            blobs = [[x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)] for x in (keys, n, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)], names=["bucket", "keys", "n", "ids"])
        self.keys, self.n, self.ids, self.held = [], [], [], 0


def _subsets(prefix: np.ndarray) -> np.ndarray:
    """One key for each 2-subset."""
    i, j = np.triu_indices(len(prefix), 1)
    with np.errstate(over="ignore"):
        return mix(prefix[i] * np.uint64(0x9E3779B97F4A7C15) + mix(prefix[j]))


def signatures(shingles: np.ndarray, prefix: np.ndarray, boundary: int, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Keys of a set: subsets if it is light, single shingles if it is heavy or can match a heavy set."""
    n, keys = len(shingles), []
    if n <= boundary:
        keys.append(_subsets(prefix))
    if n > boundary or den * n >= num * (boundary + 1):
        keys.append(prefix[: len(prefix) - 1] if len(prefix) > 1 else prefix)
    return np.concatenate(keys)


def size_boundary(sketch: dict[int, np.ndarray], num: int = NUM, den: int = DEN) -> int:
    """The largest set size that is light. For each power of two of the size: a set costs its number of 2-subsets
    if light, and if heavy its prefix, each entry costing SCAN times the mean length of its list more."""
    boundary = 1
    for level in sorted(sketch):
        n = 1 << level
        p = n - int(needed(n, num, den)) + 1
        cells = sketch[level].astype(float)
        total = cells.sum()
        # the mean length: second moment over first, without what chance puts together in a cell
        mean = max(1.0, (cells**2).sum() / total - total / SKETCH) if total else 1.0
        if (p + 1) * p / 2 > p * (1 + SCAN * mean):
            break
        boundary = n
    return boundary


def frequent_bits(docs: DataFrame, entries: int, num: int, den: int) -> tuple[np.ndarray, int]:
    """A map of the most frequent shingles of those in more than FREQUENT prefixes, and the boundary of light sets.

    Prefixes of all sets, of ``entries`` shingles in all, are counted by exact hash, in parts of a fixed size. The map has
    a fixed size too; a shingle that shares a cell with a frequent one only goes later in the order, which is as right
    as any other order.
    """
    spark = docs.sparkSession
    count = max(partitions(spark), entries // BUCKET)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        sketch: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            got, n = np.unique(np.concatenate(held), return_counts=True)
            part = (got % np.uint64(count)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            got, n, part = got[order], n[order].astype(np.uint32), part[order]
            cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            ends = np.append(cut[1:], len(part))
            blobs = [[x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)] for x in (got, n)]
            return pa.RecordBatch.from_arrays([pa.array(part[cut], pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)], names=["part", "cells", "counts"])

        for batch in batches:
            for s in _sets(batch):
                if not len(s):
                    continue
                p = _prefix(s, None, num, den)
                held.append(p)
                size += len(p)
                got = sketch.setdefault(len(s).bit_length() - 1, np.zeros(SKETCH, np.int64))
                got += np.bincount((mix(p) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                if size > HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        for level, x in sketch.items():
            yield pa.RecordBatch.from_arrays([pa.array([-1 - level], pa.int32()), pa.array([x.tobytes()], pa.binary()), pa.array([b""], pa.binary())], names=["part", "cells", "counts"])

    def total(key, table):
        part = key[0].as_py()
        if part < 0:
            return pa.table({"level": pa.array([part], pa.int32()), "cells": pa.array([np.sum([np.frombuffer(x.as_py(), np.int64) for x in table["cells"]], axis=0).tobytes()], pa.binary())})
        got = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["cells"]])
        n = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["counts"]])
        order = np.argsort(got, kind="stable")
        got, n = got[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], got[1:] != got[:-1])))
        sums = np.add.reduceat(n, first)
        often, level = got[first][sums > FREQUENT], np.log2(sums[sums > FREQUENT]).astype(np.int32)
        levels = np.unique(level)
        cells = [np.unique(often[level == x] & np.uint64(MAP - 1)).astype(np.uint32).tobytes() for x in levels]
        return pa.table({"level": pa.array(levels, pa.int32()), "cells": pa.array(cells, pa.binary())})

    rows = docs.mapInArrow(lean(cells), "part int, cells binary, counts binary").groupBy("part").applyInArrow(total, "level int, cells binary")
    counted = Table(rows, "jaccard-frequent")
    least, total_ = 64, 0
    sizes = {r["level"]: r["cells"] for r in counted.df.where("level >= 0").groupBy("level").agg(F.sum(F.octet_length("cells") / 4).alias("cells")).collect()}
    for level in sorted(sizes, reverse=True):  # powers of two of the counts
        total_ += sizes[level]
        if total_ > MOST_FREQUENT:
            break
        least = level
    bits = np.zeros(MAP // 8, np.uint8)
    sketch = {}
    for r in counted.df.where((F.col("level") < 0) | (F.col("level") >= least)).collect():  # 4 bytes for each of MOST_FREQUENT, and 64 sketches
        if r["level"] < 0:
            sketch[-1 - r["level"]] = np.frombuffer(bytes(r["cells"]), np.int64)
        else:
            hot = np.frombuffer(bytes(r["cells"]), np.uint32)
            np.bitwise_or.at(bits, hot >> 3, (1 << (hot & 7)).astype(np.uint8))
    counted.drop()
    return bits, size_boundary(sketch, num, den)


def _gather(table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a bucket sorted by key, size and id, those alone on their key left out; first of each list."""
    keys = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["keys"]])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    same = np.concatenate(([False], keys[1:] == keys[:-1], [False]))
    many = np.flatnonzero(same[:-1] | same[1:])
    keys, order = keys[many], order[many]
    n = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["n"]])[order]
    ids = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table["ids"]])[order]
    order = np.lexsort((ids, n, keys))
    keys, n, ids = keys[order], n[order], ids[order]
    fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))) if len(keys) else np.zeros(0, bool)
    keys, n, ids = keys[fresh], n[fresh], ids[fresh]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys, n.astype(np.int64), ids, first


def _star(num: int, den: int):
    """Of each list: each set with the one before it in size, and with HEADS others of its band of sizes: those with the smallest
    hashes of their ids, by several hashes, so that few sets meet only such that they don't link with.
    Ids of lists of three and more are given back too, with the bucket: their other pairs may still count."""

    def run(key, table):
        keys, n, ids, first = _gather(table)
        if not len(keys):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32())})
        near = (keys[1:] == keys[:-1]) & (den * n[:-1] >= num * n[1:])
        band = np.floor(np.log(np.maximum(n, 1)) / np.log(den / num)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (band[1:] != band[:-1]))))
        sizes = np.diff(np.append(cut, len(ids)))
        heads = []
        for r in range(HEADS):
            h = mix(ids.view(np.uint64) ^ np.uint64(r))
            heads.append(np.repeat(ids[h == np.repeat(np.minimum.reduceat(h, cut), sizes)], sizes))
        a, b = _pairs(np.concatenate((ids[:-1][near], *heads)), np.concatenate((ids[1:][near], *[ids] * HEADS)))
        length = np.diff(np.append(first, len(ids)))
        crowd = np.unique(ids[np.repeat(length > 2, length)])
        return pa.table({
            "a": pa.array(np.concatenate((a, crowd)), pa.int64()),
            "b": pa.array(np.concatenate((b, np.zeros(len(crowd), np.int64))), pa.int64(), mask=np.arange(len(a) + len(crowd)) >= len(a)),
            "bucket": pa.array(np.full(len(a) + len(crowd), key[0].as_py()), pa.int32()),
        })

    return run


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unordered pairs of different ids."""
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    keep = lo != hi
    lo, hi = lo[keep], hi[keep]
    order = np.lexsort((hi, lo))
    lo, hi = lo[order], hi[order]
    fresh = np.ones(len(lo), bool)
    fresh[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return lo[fresh], hi[fresh]


def _apart(num: int, den: int):
    """Of each list: the pairs of different components that sizes and bitmaps don't rule out. ``beside`` has the
    component and the bitmap of each id of the bucket's lists of three and more; other ids are in none of them."""

    def run(key, table, beside):
        a = b = np.zeros(0, np.int64)
        if len(table) and len(beside):
            owner = beside["owner"].to_numpy()
            order = np.argsort(owner)
            owner, comp, bits = owner[order], beside["comp"].to_numpy()[order], beside["bits"].take(pa.array(order))
            keys, n, ids, _ = _gather(table)
            at = np.minimum(np.searchsorted(owner, ids), len(owner) - 1)
            known = owner[at] == ids
            keys, at = keys[known], at[known]
            size = np.zeros(len(owner), np.int64)
            size[at] = n[known]
            i, j = _across(keys, at, size, comp, bits, num, den)
            a, b = _pairs(owner[i], owner[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _across(keys: np.ndarray, at: np.ndarray, size: np.ndarray, comp: np.ndarray, bits, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets that share a list, are in different components, and can reach the threshold by size and bitmap.

    ``at`` are the sets of the lists, sorted by key. In each list only the sets outside its largest component are held
    against the rest, and each such set once against the union of its lists.
    """
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(keys))
    lists: dict[int, list[int]] = {}
    for k, (lo, hi) in enumerate(zip(first.tolist(), ends.tolist(), strict=True)):
        own = comp[at[lo:hi]]
        if (own == own[0]).all():
            continue
        values, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
        for x in at[lo:hi][inverse != np.argmax(counts)].tolist():
            lists.setdefault(x, []).append(k)
    raw = bits.to_pylist()
    width = np.array([len(x) for x in raw])
    maps, row = {}, np.zeros(len(width), np.int64)
    for w in np.unique(width).tolist():
        here = np.flatnonzero(width == w)
        row[here] = np.arange(len(here))
        maps[w] = np.frombuffer(b"".join(raw[x] for x in here.tolist()), np.uint8).reshape(len(here), w)
    del raw
    mark = np.zeros(len(size), bool)
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, own in lists.items():
        for k in own:
            mark[at[first[k] : ends[k]]] = True
        j = np.flatnonzero(mark)
        mark[j] = False
        j = j[(comp[j] != comp[x]) & (den * size[j] >= num * size[x]) & (den * size[x] >= num * size[j])]
        for w in np.unique(width[j]).tolist():
            jj = j[width[j] == w]
            theirs, mine = maps[w][row[jj]], maps[int(width[x])][row[x]][None, :]
            while theirs.shape[1] > mine.shape[1]:
                theirs = theirs[:, : theirs.shape[1] // 2] ^ theirs[:, theirs.shape[1] // 2 :]
            while mine.shape[1] > theirs.shape[1]:
                mine = mine[:, : mine.shape[1] // 2] ^ mine[:, mine.shape[1] // 2 :]
            d = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
            jj = jj[can_link(size[x], size[jj], d, num, den)]
            out_i.append(np.full(len(jj), x, np.int64))
            out_j.append(jj)
    return np.concatenate(out_i), np.concatenate(out_j)


def _entries(docs: DataFrame, count: int, shared, boundary: int, ids: Ids, num: int, den: int, only=None) -> DataFrame:
    """Packed entries of the inverted lists; ``only``: a broadcast filter of class ids. A task gives out each class once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, out, seen = shared.value, _Buckets(count), set()
        for batch in batches:
            for s in _sets(batch):
                if len(s) < 2:  # a set of one shingle links only with its equals
                    continue
                c = ids(s)
                if c in seen or (only is not None and not in_filter(only.value, c)):
                    continue
                seen.add(c)
                if len(seen) > 1_000_000:
                    seen.clear()
                out.add(signatures(s, _prefix(s, frequent, num, den), boundary, num, den), len(s), c)
                if out.held > HELD:
                    yield from out.rows()
        yield from out.rows()

    return docs.mapInArrow(lean(run), "bucket int, keys binary, n binary, ids binary")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, ids: Ids, num: int, den: int) -> DataFrame:
    """Those of ``pairs(a, b)`` of class ids whose sets reach the threshold, exactly. Bitmaps drop most others first."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            d = np.array([bitmap_distance(x.as_py(), y.as_py()) for x, y in zip(t.column(3), t.column(5), strict=True)], np.int64)
            yield t.select([0, 1]).filter(pa.array(can_link(t.column(2).to_numpy(), t.column(4).to_numpy(), d, num, den)))

    left = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "bitsa", "nb", "bitsb").mapInArrow(lean(hopeful), "a long, b long")
    pairs_ = Table(left, "jaccard-pairs")
    left = pairs_.df
    only = docs.sparkSession.sparkContext.broadcast(id_filter(left.select(F.explode(F.array("a", "b")).alias("id")).distinct()))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            cids, out = [], []
            for s in _sets(batch):
                if len(s) and (c := ids(s)) not in seen and in_filter(only.value, c):
                    cids.append(c)
                    out.append(s.tobytes())
                    seen.add(c)
                    if len(seen) > 1_000_000:
                        seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(out, pa.binary())], names=["cid", "s"])

    wanted = left.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    found = docs.mapInArrow(lean(sets), "cid long, s binary").join(wanted, "cid", "left_semi").groupBy("cid").agg(F.first("s").alias("s"))
    sets_ = Table(found, "jaccard-sets")
    found = sets_.df

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t.column(2), t.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                ok.append(den * same >= num * (len(x) + len(y) - same))
            yield t.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    named = lambda x: found.select(F.col("cid").alias(x), F.col("s").alias(f"s{x}"))
    out = written(left.join(named("a"), "a").join(named("b"), "b").select("a", "b", "sa", "sb").mapInArrow(lean(exact), "a long, b long"), "jaccard-links")
    pairs_.drop()
    sets_.drop()
    return out


def jaccard_components(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_shingles, component_id: one row for each row.

    Two texts link when their sets of shingles have den * intersection >= num * union; component_id is the smallest
    doc_id reachable by links. Words: A-Z lower-cased, split at ASCII white space; a set has the distinct runs of WORDS
    words; a text with fewer words is one run; a text without words, or null, has an empty set and links with nothing.
    A null doc_id can't be reached or name a component: its rows get the
    component of their text's class if others are in it, else null. Other columns are ignored. Shingles are
    compared by 64-bit hashes.
    """
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    feats = written(features(docs), "jaccard-features")
    two = feats.where("n > 0").groupBy("cid").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo != hi").select("cid").take(Ids.TAKEN + 1)
    if len(two) > Ids.TAKEN:
        raise ValueError("too many sets share 64 bits of their digests")
    ids = Ids(frozenset(r["cid"] for r in two))
    if two:
        feats = feats.withColumn("cid", F.when(F.col("cid").isin([r["cid"] for r in two]), F.col("other")).otherwise(F.col("cid")))
        if not feats.where("n > 0").groupBy("cid").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo != hi").isEmpty():
            raise ValueError("two sets share all bits of their ids")
    sets = feats.where("n > 0")
    named = Table(sets.groupBy("cid").agg(F.first("n").alias("n"), F.max("bits").alias("bits"), F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "jaccard-classes")
    classes = named.df
    p = f"(n - ({num} * n + {den - 1}) div {den} + 1)"
    prefixes = sets.agg(F.sum(F.expr(f"{p} + 1"))).first()[0] or 0
    frequent, boundary = frequent_bits(docs, int(prefixes), num, den)
    shared = sc.broadcast(frequent)
    entries = f"if(n <= {boundary}, {p} * ({p} + 1) div 2, 0) + if(n > {boundary} or {den} * n >= {num * (boundary + 1)}, {p}, 0)"
    keys = sets.where("n > 1").agg(F.sum(F.expr(entries))).first()[0] or 0
    count = max(1, -(-int(keys) // BUCKET))
    star = _entries(docs, count, shared, boundary, ids, num, den).groupBy("bucket").applyInArrow(_star(num, den), "a long, b long, bucket int")
    stars = Table(star, "jaccard-stars")
    links = verified(stars.df.where("b is not null").select("a", "b").distinct(), docs, classes, ids, num, den)
    comps = Table(components(links), "jaccard-components")
    crowd = stars.df.where("b is null").select(F.col("a").alias("owner"), "bucket")
    alone = comps.df.select(F.col("node").alias("owner"), F.col("component").alias("found"))
    beside = crowd.join(alone, "owner", "left").select("owner", "bucket", F.coalesce("found", "owner").alias("comp"))
    beside = beside.join(classes.select(F.col("cid").alias("owner"), "bits"), "owner")
    only = sc.broadcast(id_filter(crowd.select(F.col("owner").alias("id")).distinct()))
    again = _entries(docs, count, shared, boundary, ids, num, den, only)
    apart = Table(again.groupBy("bucket").cogroup(beside.groupBy("bucket")).applyInArrow(_apart(num, den), "a long, b long"), "jaccard-apart")
    more = verified(apart.df.distinct(), docs, classes, ids, num, den)
    joined = components(comps.df.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)).select(F.col("node").alias("cid"), "component")
    placed = classes.select("cid", "rep", "copies").join(joined, "cid", "left").select("cid", "rep", "copies", F.coalesce("component", "cid").alias("component"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = written(placed.join(least, "component").select("cid", "copies", "component_id"), "jaccard-results")
    for t in (stars, comps, apart, named):
        t.drop()
    # hot classes are few and travel to their rows
    hot_from = sets.count() // HOT
    hot, rest = F.broadcast(of_class.where(F.col("copies") > hot_from).drop("copies")), of_class.where(F.col("copies") <= hot_from)
    result = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    rows = sets.select("doc_id", "n", "cid")
    full = rows.join(hot, "cid").select(*result).union(rows.join(hot.select("cid"), "cid", "left_anti").join(rest, "cid").select(*result))
    return full.union(feats.where("n = 0").select("doc_id", "n", "doc_id"))
