"""Removal of passages that other documents have already, by content-defined chunking.

A gear hash rolls over the bytes of a text's words. A chunk ends after a word whose hash is the smallest of some window of
words, so cuts depend on the bytes nearby only and an insertion moves none but those beside it. Chunks are deduplicated
by digest. A passage of ``min_words`` words holds a cut in its first window and one in its last, whatever is around
it, and the chunks between these are the same wherever the passage occurs; so only where such chunks are all repeated
may a stretch of ``min_words`` words be a repeat. These stretches are compared by digest in turn: one that a document
with a smaller doc_id has is cut out, and overlapping ones make up the longer passages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _IS_SPACE, _LOWER, _POWERS, PIECE, Table, filtered, id_filter, in_filter_rows, lean, mix, partitions, word_hashes, written

#: Words of the shortest passage that is cut out.
MIN_WORDS = 50
#: Bytes that the gear hash looks back, and words of the windows whose smallest hash ends a chunk, at most.
LOOK_BACK, WINDOW = 8, 16
#: Entries of the digest index that one task holds, about.
BUCKET = 1 << 20
#: Entries that a worker holds before it sends them.
HELD = 300_000

_GEAR = np.random.Generator(np.random.PCG64(77)).integers(1, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_GEAR[0] = 0  # what lies before a text


def _solo(data: np.ndarray) -> np.ndarray:
    """For each byte, and the one past the last, whether it begins or follows a character that is a word by itself: of
    the scripts written without blanks between words (Thai to Lao, Myanmar, Khmer, U+2E80 to U+9FFF, their
    compatibility and full-width forms, U+20000 to U+3FFFF)."""
    turn = np.zeros(len(data) + 1, bool)
    lead = np.flatnonzero(data >= 0xE0)
    if len(lead):
        a, b = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
        three = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB) | (a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b >= 0x9E) & (b <= 0x9F))
        three |= (a == 0xE2) & (b >= 0xBA) | (a >= 0xE3) & (a <= 0xE9) | (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b >= 0xBC))
        four = (a == 0xF0) & (b >= 0xA0)
        turn[lead[three | four]] = True
        turn[np.minimum(lead[three] + 3, len(data))] = True
        turn[np.minimum(lead[four] + 4, len(data))] = True
    return turn


class Words:
    """The words of some texts, all in one array: hash, bytes [first, last) of ``data``, and the text of each."""

    def __init__(self, texts: list[bytes]) -> None:
        gap = bytes(LOOK_BACK)
        self.data = data = np.frombuffer(gap + gap.join(texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        #: first byte of each text
        self.begin = np.cumsum(size + LOOK_BACK) - size
        between = np.zeros(len(data), bool)
        for k in range(1, LOOK_BACK + 1):
            between[self.begin - k] = True
        inside = ~(_IS_SPACE[data] | between)
        turn = _solo(data)
        padded = np.concatenate(([False], inside, [False]))
        self.first = np.flatnonzero(inside & (~padded[:-2] | turn[:-1]))
        self.last = np.flatnonzero(inside & (~padded[2:] | turn[1:])) + 1
        self.hashes = word_hashes(data, self.first, self.last)
        self.text = np.searchsorted(self.begin, self.first, side="right") - 1
        #: first word of each text, and one past the last word of all
        self.start = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.stream = inside | between

    def gear(self) -> np.ndarray:
        """The gear hash of the last LOOK_BACK bytes of words at the end of each word."""
        h = _GEAR[_LOWER[self.data[self.stream]]]
        k = 1
        while k < LOOK_BACK:
            h[k:] += h[:-k] << np.uint32(k)
            k *= 2
        return h[np.cumsum(self.stream)[self.last - 1] - 1]


def _digests(words: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64 bits for each stretch [lo, hi) of words."""
    up, down = _POWERS.get(len(words) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)))
        return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))


class Chunks:
    """Chunks [lo, hi) of words between the cuts of the texts that have ``min_words`` words."""

    def __init__(self, words: Words, min_words: int) -> None:
        self.words, self.min_words = words, min_words
        self.window = min(WINDOW, (min_words - LOOK_BACK + 1) // 2)
        n, width = len(words.hashes), self.window
        if n < min_words:
            self.lo = self.hi = self.chosen = np.zeros(0, np.int64)
            return
        low = np.uint64(0xFFFFFFFF)
        # the smallest hash of each window, of equals the last
        least = (words.gear().astype(np.uint64) << np.uint64(32)) | (low - np.arange(n, dtype=np.uint64))
        done = 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        #: by first word of a window: the word after the chosen cut
        self.chosen = (low - (least & low)).astype(np.int64) + 1
        cut = np.zeros(n + 1, bool)
        cut[self.chosen[words.text[: n - width + 1] == words.text[width - 1 :]]] = True
        cuts = np.flatnonzero(cut)
        same = words.text[cuts[1:] - 1] == words.text[cuts[:-1] - 1]
        self.lo, self.hi = cuts[:-1][same], cuts[1:][same]

    def digests(self) -> np.ndarray:
        return _digests(self.words.hashes, self.lo, self.hi)

    def stretches(self, repeated: np.ndarray) -> np.ndarray:
        """First words of the stretches of ``min_words`` words of which the chunks from the cut of the first window, behind
        LOOK_BACK - 1 words, to the cut of the last window are all ``repeated``. A stretch that occurs twice is among them."""
        n = len(self.words.hashes)
        if n < self.min_words:
            return np.zeros(0, np.int64)
        turn = np.zeros(n + 1, np.int64)
        np.add.at(turn, self.lo[repeated], 1)
        np.add.at(turn, self.hi[repeated], -1)
        other = np.concatenate(([0], np.cumsum(np.cumsum(turn)[:-1] <= 0)))
        i = np.flatnonzero(self.words.text[: n - self.min_words + 1] == self.words.text[self.min_words - 1 :])
        return i[other[self.chosen[i + LOOK_BACK - 1]] == other[self.chosen[i + self.min_words - self.window]]]


#: A stretch of words, by digest, of a row: its doc_id and a check of its text.
_ENTRY = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("check", "<u4"), ("start", "<u4"), ("size", "<u4"), ("open", "<u4")])
_MARK = np.dtype([("doc", "<i8"), ("check", "<u4"), ("start", "<u4"), ("size", "<u4")])


def _groups(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by digest and doc, where digests begin, and the number of the digest of each."""
    e = e[np.lexsort((e["doc"], e["digest"]))]
    first = np.concatenate(([True], e["digest"][1:] != e["digest"][:-1]))
    return e, np.flatnonzero(first), np.cumsum(first) - 1


def shared_by_two(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries whose digest another document has, entries that must still look elsewhere). Of a digest that is shared, one
    entry goes on, without ``open``: it says so."""
    e, first, group = _groups(e)
    last = np.append(first[1:], len(e)) - 1
    known = np.zeros(len(first), bool)
    np.logical_or.at(known, group, e["open"] == 0)
    shared = known | (e["doc"][first] != e["doc"][last])
    told = e[first[shared]]
    told["open"] = 0
    return e[shared[group] & (e["open"] == 1)], np.concatenate((e[~shared[group]], told))


def seen_before(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries whose digest a document with a smaller doc_id has, those of the smallest)."""
    e, first, group = _groups(e)
    mine = e["doc"] == e["doc"][first][group]
    return e[~mine], e[mine]


def _rows(rows: np.ndarray, part: np.ndarray, kind: int) -> pa.RecordBatch:
    """A packed row for each part."""
    order = np.argsort(part, kind="stable")
    rows, part = rows[order], part[order]
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
    blobs = [rows[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(part))[: len(cut)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(part[cut].astype(np.int32), pa.int32()), pa.array([kind] * len(cut), pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "kind", "blob"])


def _marks(e: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Marks of entries, packed by a bucket of their documents."""
    m = np.empty(len(e), _MARK)
    for f in _MARK.names or ():
        m[f] = e[f]
    return _rows(m, mix(e["doc"].astype(np.uint64)) % np.uint64(buckets), 1)


def _decided(rows: DataFrame, entries: Callable, decide: Callable, buckets: int) -> DataFrame:
    """(bucket of documents, blob of marks) of the entries that ``decide`` picks by digest.

    A task decides what it can on its own, and only what must look elsewhere goes on to the digest's bucket. So a passage
    in a third of all documents sends a few entries of each task to its bucket, never all of them."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            marked, rest = decide(np.concatenate(held))
            yield _marks(marked, buckets)
            yield _rows(rest, mix(rest["digest"]) % np.uint64(buckets), 0)

        for batch in batches:
            for e in entries(batch):
                held.append(e)
                size += len(e)
                if size > HELD:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def settle(key, table):
        kinds, blobs = table["kind"].to_pylist(), table["blob"].to_pylist()
        bucket = [key[0].as_py()] * kinds.count(1)
        out = [b for k, b in zip(kinds, blobs, strict=True) if k == 1]
        if packed := [np.frombuffer(b, _ENTRY) for k, b in zip(kinds, blobs, strict=True) if k == 0]:
            batch = _marks(decide(np.concatenate(packed))[0], buckets)
            bucket += batch["bucket"].to_pylist()
            out += batch["blob"].to_pylist()
        return pa.table({"bucket": pa.array(bucket, pa.int32()), "blob": pa.array(out, pa.binary())})

    return rows.mapInArrow(lean(spread), "bucket int, kind int, blob binary").groupBy("bucket").applyInArrow(settle, "bucket int, blob binary")


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[list[int], Words]]:
    """Numbers of the texts that aren't null or empty, and their words, some texts at a time."""
    rows, some, size = [], [], 0
    for i, t in enumerate(texts):
        if t:
            rows.append(i)
            some.append(t)
            size += len(t)
            if size > PIECE:
                yield rows, Words(some)
                rows, some, size = [], [], 0
    if rows:
        yield rows, Words(some)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _entries(digest: np.ndarray, words: Words, lo: np.ndarray, size, doc: np.ndarray, check: np.ndarray) -> np.ndarray:
    e = np.empty(len(digest), _ENTRY)
    text = words.text[lo]
    e["digest"], e["doc"], e["check"], e["start"], e["size"], e["open"] = digest, doc[text], check[text], lo - words.start[text], size, 1
    return e


def repeated_chunks(texts: DataFrame, buckets: int, min_words: int) -> DataFrame:
    """``texts(doc_id, text, check)`` -> doc_id, chunks: the first words (packed u4) of the chunks that other documents have
    too, of documents in which such chunks follow each other for as many words as a passage needs."""

    def entries(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        ids, checks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for rows, words in _pieces(_texts(batch, 1)):
            c = Chunks(words, min_words)
            if len(c.lo):
                yield _entries(c.digests(), words, c.lo, c.hi - c.lo, np.array([ids[i] for i in rows], np.int64), np.array([checks[i] for i in rows], np.uint32))

    # the two cuts are in the first and the last window, behind the bytes that the first one looks back on
    needed = max(1, min_words - (LOOK_BACK - 1) - 2 * min(WINDOW, (min_words - LOOK_BACK + 1) // 2) + 1)

    def chains(key, table):
        m = np.unique(np.concatenate([np.frombuffer(b, _MARK) for b in table["blob"].to_pylist()]))
        lo, hi = m["start"].astype(np.int64), m["start"].astype(np.int64) + m["size"]
        begins = np.concatenate(([True], (m["doc"][1:] != m["doc"][:-1]) | (m["check"][1:] != m["check"][:-1]) | (lo[1:] != hi[:-1])))
        chain = np.cumsum(begins) - 1
        long = np.bincount(chain, hi - lo) >= needed
        m = m[long[chain]]
        cut = np.flatnonzero(np.concatenate(([True], m["doc"][1:] != m["doc"][:-1]))) if len(m) else np.zeros(0, np.int64)
        blobs = [m["start"][a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(m))[: len(cut)], strict=True)]
        return pa.table({"doc": pa.array(m["doc"][cut], pa.int64()), "chunks": pa.array(blobs, pa.binary())})

    return _decided(texts, entries, shared_by_two, buckets).groupBy("bucket").applyInArrow(chains, "doc long, chunks binary")


def repeated_passages(texts: DataFrame, chunks: DataFrame, buckets: int, min_words: int) -> DataFrame:
    """(doc, check, passages): the words [lo, hi), packed u4 pairs, of the passages of a row that a document with a smaller
    doc_id has."""
    only = texts.sparkSession.sparkContext.broadcast(id_filter(chunks.select(F.col("doc").alias("id"))))
    # both sides grow with the corpus: never a broadcast
    rows = filtered(texts, "doc_id", only).join(chunks.hint("merge"), F.col("doc_id") == F.col("doc")).select("doc_id", "text", "check", "chunks")

    def entries(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        ids, checks, found = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for rows, words in _pieces(_texts(batch, 1)):
            c = Chunks(words, min_words)
            known = np.zeros(len(words.hashes) + 1, bool)
            for k, i in enumerate(rows):
                at = words.start[k] + np.frombuffer(found[i], np.uint32)
                known[at[at < words.start[k + 1]]] = True
            at = c.stretches(known[c.lo])
            if len(at):
                yield _entries(_digests(words.hashes, at, at + min_words), words, at, min_words, np.array([ids[i] for i in rows], np.int64), np.array([checks[i] for i in rows], np.uint32))

    def join(key, table):
        m = np.concatenate([np.frombuffer(b, _MARK) for b in table["blob"].to_pylist()])
        m = m[np.lexsort((m["start"], m["check"], m["doc"]))]
        lo, hi = m["start"], m["start"] + m["size"]  # all are of one size, so ends are in order too
        row = np.concatenate(([True], (m["doc"][1:] != m["doc"][:-1]) | (m["check"][1:] != m["check"][:-1])))
        begins = row.copy()
        begins[1:] |= lo[1:] > hi[:-1]
        a = np.flatnonzero(begins)
        both = np.stack((lo[a], hi[np.append(a[1:], len(m)) - 1]), axis=1).astype(np.uint32)
        of = np.flatnonzero(row[a])
        blobs = [both[x:y].tobytes() for x, y in zip(of, np.append(of[1:], len(a)), strict=True)]
        return pa.table({"doc": pa.array(m["doc"][a][of], pa.int64()), "mark": pa.array(m["check"][a][of].astype(np.int64), pa.int64()), "passages": pa.array(blobs, pa.binary())})

    return _decided(rows, entries, seen_before, buckets).groupBy("bucket").applyInArrow(join, "doc long, mark long, passages binary")


def cut_out(raw: bytes, first: np.ndarray, found: np.ndarray) -> tuple[bytes, list[dict]]:
    """A text without the passages ``found`` and the white space after each, and their byte ranges; ``first``: the first
    byte of each word."""
    kept, spans, at = [], [], 0
    for a, b in found.tolist():
        start, end = int(first[a]), int(first[b]) if b < len(first) else len(raw)
        kept.append(raw[at:start])
        spans.append({"start": start, "end": end})
        at = end
    kept.append(raw[at:])
    return b"".join(kept), spans


def dedup_substrings(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs(doc_id, text)`` with each passage of ``min_words`` words or more that one document with a smaller doc_id has
    cut out of ``text``; added: n_words, removed_words long, removed array<struct<start, end>> (UTF-8 bytes of the
    old text). One row for each row; other columns stay, but columns of the added names are replaced.

    Words are runs of bytes other than ASCII white space, and each character of scripts written without blanks is one;
    they are compared by 64-bit hashes with A-Z lower-cased and without the white space between them. Shorter passages
    stay, also where two of them from different documents stand side by side. Rows that share a doc_id are one document
    and don't repeat each other; rows with a null doc_id or text are neither compared nor changed (n_words 0 for a null
    text). A text that is repeated as a whole becomes empty.
    """
    if min_words < LOOK_BACK + 1:
        raise ValueError(f"passages must have {LOOK_BACK + 1} words at least")
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("n_words", "removed_words", "removed")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    check = F.crc32(F.col("text").cast("binary"))
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", check.alias("check"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(spark), int(size) // 25 // BUCKET)  # a chunk, and on the whole a stretch, takes 25 bytes of text or more
    chunks = Table(repeated_chunks(texts, buckets, min_words), "substring-chunks")
    found = written(repeated_passages(texts, chunks.df, buckets, min_words), "substring-passages")
    chunks.drop()
    found = found.toDF("__found_doc", "__found_mark", "__found")
    only = spark.sparkContext.broadcast(id_filter(found.select(F.col("__found_doc").alias("id"))))
    some = filtered(docs, "doc_id", only).join(found.hint("merge"), (F.col("doc_id").cast("long") == F.col("__found_doc")) & (check == F.col("__found_mark")), "left").drop("__found_doc", "__found_mark")
    at, id_at = keep.index("text"), keep.index("doc_id")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            joined = batch.num_columns > len(keep)
            if not joined:  # rows of documents without passages stay where they are
                batch = in_filter_rows(batch, id_at, only.value, False)
            texts = _texts(batch, at)
            found = batch.column(len(keep)).to_pylist() if joined else [None] * len(texts)
            n_words, n_cut, spans = [0] * len(texts), [0] * len(texts), [[] for _ in texts]
            for numbers, words in _pieces(list(texts)):
                for k, i in enumerate(numbers):
                    n_words[i] = int(words.start[k + 1] - words.start[k])
                    if found[i]:
                        ranges = np.frombuffer(found[i], np.uint32).reshape(-1, 2)
                        n_cut[i] = int((ranges[:, 1] - ranges[:, 0]).sum())
                        texts[i], spans[i] = cut_out(texts[i], words.first[words.start[k] : words.start[k + 1]] - words.begin[k], ranges)
            columns = batch.columns[: len(keep)]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_cut, pa.int64()), pa.array(spans, kind)], names=[*keep, "n_words", "removed_words", "removed"])

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    added = [T.StructField("n_words", T.LongType()), T.StructField("removed_words", T.LongType()), T.StructField("removed", spans)]
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(lean(rewrite), schema).union(some.mapInArrow(lean(rewrite), schema))
