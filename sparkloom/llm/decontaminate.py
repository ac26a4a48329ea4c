"""Search for benchmark items in documents, up to edits.

The CGK embedding walks over a string of words and, step by step, writes the current word and moves on or stays by a
random bit of the step and the word. An item is divided into one piece more than the edits that a match may have, so
every match has a piece as it is, and the walk over that piece writes the same words in the document as in the item.
Each piece is searched in the repetition of random bits whose walk sees most of its words. Candidates are verified by the
exact edit distance between the item and the best-matching stretch of the document, so no match is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEPT, lean, mix, text_words, word_pieces, written

#: Word edits a word of the item that a match may have: similarity 0.8.
EDITS_NUM, EDITS_DEN = 1, 5
#: Repetitions: sets of random bits, of which each piece takes one. Recall doesn't depend on them.
REPEATS = 16
#: Words of the longest piece: n words in n // 5 + 1 pieces.
REACH = -(-EDITS_DEN // EDITS_NUM)
#: Characters of items that are searched in one pass; more items take more passes.
BLOCK_CHARS = 16_000_000


def walk_bit(step: int, repeat: int, words: np.ndarray) -> np.ndarray:
    """The random bit of a step and a word."""
    odd = np.uint64((2 * (repeat * 1000 + step) + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((words ^ (words >> np.uint64(29))) * odd >> np.uint64(63)).astype(np.int64)


def _chain(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(key * np.uint64(0xD6E8FEB86659FD93) + symbol)


def pieces(words: int) -> list[tuple[int, int]]:
    """(first word, words) of the pieces of an item: one more than its edits, so that a match has one unchanged."""
    n = min(words, allowed_edits(words) + 1)
    cuts = [words * p // n for p in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


class Index:
    """Embeddings of the pieces of items, by repetition."""

    def __init__(self, items: list[tuple[int, np.ndarray]]) -> None:
        self.items = items
        self.words = [set(w.tolist()) for _, w in items]
        keys: list[list[set[int]]] = [[set() for _ in range(REACH)] for _ in range(REPEATS)]
        ends: list[list[dict[int, list[tuple[int, int]]]]] = [[{} for _ in range(REACH)] for _ in range(REPEATS)]
        self.first = np.zeros(1 << 16, np.uint32)
        for x, (_, w) in enumerate(items):
            for a, size in pieces(len(w)):
                t, got = self._walk(w[a : a + size])
                key = np.zeros(1, np.uint64)
                for k in range(size):
                    key = _chain(key, got[k : k + 1])
                    keys[t][k].add(int(key[0]))
                ends[t][size - 1].setdefault(int(key[0]), []).append((x, a))
                self.first[int(w[a]) & 0xFFFF] |= np.uint32(1 << t)
        #: for each repetition and step: sorted keys so far; sorted keys of whole pieces; item and anchor of these
        self.keys = [[np.array(sorted(k), np.uint64) for k in of] for of in keys]
        self.whole = [[np.array(sorted(e), np.uint64) for e in of] for of in ends]
        self.ends = ends

    @staticmethod
    def _walk(piece: np.ndarray) -> tuple[int, np.ndarray]:
        """The repetition (the first of the best) whose walk sees most words of a piece, and what it writes."""
        best = None
        for t in range(REPEATS):
            at, got = 0, []
            for j in range(len(piece)):
                got.append(piece[at])
                seen = at + 1
                at += int(walk_bit(j, t, piece[at : at + 1])[0])
            if best is None or seen > best[0]:
                best = (seen, t, got)
            if seen == len(piece):
                break
        return best[1], np.array(best[2], np.uint64)

    def candidates(self, words: np.ndarray) -> set[tuple[int, int, int]]:
        """(item, word where it would begin, first word of the piece found) over an array of words that ends with REACH zeros."""
        mask = self.first[(words & np.uint64(0xFFFF)).astype(np.int64)]
        hopeful = np.flatnonzero(mask)
        bits = mask[hopeful]
        found: set[tuple[int, int, int]] = set()
        for t in range(REPEATS):
            begin = hopeful[(bits >> np.uint32(t)) & 1 == 1]
            at, key = begin, np.zeros(len(begin), np.uint64)
            for j in range(REACH):
                if not len(begin):
                    break
                symbol = words[at]
                key = _chain(key, symbol)
                ok = _among(self.keys[t][j], key)
                begin, at, key, symbol = begin[ok], at[ok], key[ok], symbol[ok]
                whole, ends = _among(self.whole[t][j], key), self.ends[t][j]
                for b, x in zip(begin[whole].tolist(), key[whole].tolist(), strict=True):
                    for item, anchor in ends[x]:
                        found.add((item, b - anchor, b))
                at = at + walk_bit(j, t, symbol)
        return found


def _among(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted known ones."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance between the item and a stretch of ``text``, and where such a stretch ends (the first).
    Bit-parallel: one big integer holds a column of the table of distances."""
    m = len(item)
    ones = (1 << m) - 1
    equal: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        equal[w] = equal.get(w, 0) | 1 << i
    plus, minus, score = ones, 0, m
    best, end = m, 0
    top = 1 << (m - 1)
    for j, w in enumerate(text.tolist()):
        eq = equal.get(w, 0)
        d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & ones
        hp = (minus | ~(d0 | plus)) & ones
        hm = plus & d0
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp, hm = hp << 1 & ones, hm << 1 & ones
        plus = (hm | ~(d0 | hp)) & ones
        minus = hp & d0
        if score < best:
            best, end = score, j + 1
    return best, end


def allowed_edits(words: int) -> int:
    return EDITS_NUM * words // EDITS_DEN


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` x ``benchmark(item_id, text)`` -> doc_id, item_id, edits, end_word: a row for each
    document and item of which the document has a stretch within len(item) / 5 word edits, with the fewest edits.

    Words have A-Z lower-cased and are split at ASCII white space. Whole texts are searched. Null or empty texts and
    items, and null ids, match nothing; repeated rows give repeated rows. Items of fewer than five words match only as
    they are. Other columns are ignored. Items travel to the workers in passes of BLOCK_CHARS characters at the most.
    """
    sc = docs.sparkSession.sparkContext
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-int(chars) // BLOCK_CHARS))
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for p in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p) if passes > 1 else items
        words = [(r["item_id"], text_words(r["text"])) for r in part.orderBy("item_id", "text").toLocalIterator()]
        shared = sc.broadcast([(i, w) for i, w in words if len(w)])
        found = rows.mapInArrow(lean(_search(shared), "decontamination"), "doc_id long, item_id long, edits long, end_word long")
        if passes > 1:  # one pass after the other, each with its items only
            found = written(found, "benchmark-matches")
            shared.destroy()
        out = found if out is None else out.union(found)
    return out


def _index(shared) -> Index:
    """One index for each worker process and benchmark, until another operator's task begins there."""
    if "decontamination" not in KEPT or KEPT["decontamination"][0] is not shared:
        KEPT.pop("decontamination", None)
        KEPT["decontamination"] = shared, Index(shared.value)
    return KEPT["decontamination"][1]


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared)
        gap = np.zeros(REACH + 1, np.uint64)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, words, start in word_pieces(batch.column(1).cast(pa.binary()).to_pylist()):
                parts = ((ids[begin + k], words[a:b]) for k, (a, b) in enumerate(zip(start[:-1].tolist(), start[1:].tolist(), strict=True)))
                yield _matches(index, [(i, w) for i, w in parts if len(w)], gap)

    return run


def _matches(index: Index, held: list[tuple[int, np.ndarray]], gap: np.ndarray) -> pa.RecordBatch:
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if held and index.items:
        sizes = np.array([len(w) + len(gap) for _, w in held])
        starts = np.cumsum(sizes) - sizes
        words = np.concatenate([x for _, w in held for x in (w, gap)])
        tried: set[tuple[int, int, int]] = set()
        for x, b, piece in sorted(index.candidates(words)):
            item = index.items[x][1]
            k = allowed_edits(len(item))
            # the piece tells the document: the item may begin before its text
            doc = int(np.searchsorted(starts, piece, side="right")) - 1
            w = held[doc][1]
            lo = b - int(starts[doc]) - k
            near = (x, doc, lo // (k + 1))
            if near in tried:
                continue
            tried.add(near)
            lo -= k + 1  # covers all beginnings that share ``near``
            stretch = w[max(0, lo) : max(0, lo + len(item) + 4 * k + 3)]
            if sum(map(index.words[x].__contains__, stretch.tolist())) < len(item) - k:
                continue  # too few of its words are the item's
            edits, end = best_match(item, stretch)
            if edits <= k and len(stretch):
                got = best.get((doc, x))
                now = (edits, max(0, lo) + end)
                best[doc, x] = min(got, now) if got else now
    keys = list(best)
    return pa.RecordBatch.from_arrays(
        [pa.array([held[d][0] for d, _ in keys], pa.int64()), pa.array([index.items[x][0] for _, x in keys], pa.int64()), pa.array([best[k][0] for k in keys], pa.int64()), pa.array([best[k][1] for k in keys], pa.int64())],
        names=["doc_id", "item_id", "edits", "end_word"],
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay. Rows with a null doc_id stay."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
