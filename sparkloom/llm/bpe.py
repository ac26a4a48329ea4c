"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split into pre-tokens. A minimal perfect hash over the vocabulary resolves those that are tokens as a whole;
the others are merged from single bytes, the lowest rank first, with a heap over a linked list. Both are exact: the
ids are those of the reference library for the same ranks and pattern.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .common import KEPT, lean

#: Distinct pre-tokens that a worker remembers before it starts afresh.
CACHE = 400_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class PerfectHash:
    """Minimal perfect hash by hash and displace: as many slots as keys, one displacement for each bucket.

    A key's two hashes are the halves of its 64-bit xxHash; bucket = high mod buckets; the slot is made of low and the
    bucket's displacement d, found by trial, largest buckets first. Where keys share all 64 bits or a bucket takes too
    many trials, another seed is taken. ``find`` compares the key in the slot, so strangers are never mistaken for members.
    """

    #: Seeds and displacements that are tried.
    SEEDS, TRIALS = 16, 1 << 32

    def __init__(self, keys: list[bytes], load: int = 4) -> None:
        if len(set(keys)) != len(keys):
            raise ValueError("keys are repeated")
        for self.seed in range(self.SEEDS):
            if self._build(keys, load):
                return
        raise ValueError("no seed gives a perfect hash")

    def _build(self, keys: list[bytes], load: int) -> bool:
        self.keys, self.n = keys, max(1, len(keys))
        self.buckets = max(1, len(keys) // load)
        n = self.n
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh64_intdigest(k, self.seed) for k in keys]
        for i, h in enumerate(hashes):
            groups[(h >> 32) % self.buckets].append(i)
        self.shift = np.zeros(self.buckets, np.uint32)
        self.slots = np.full(n, -1, np.int32)
        free = np.ones(n, bool)
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[b]
            if not members:
                break
            h = np.array([hashes[i] & 0xFFFFFFFF for i in members], np.uint64)
            if len(members) == 1:  # any free slot will do
                slot = int(np.argmax(free))
                d, at = (slot - int(h[0])) % n, np.array([slot])
            else:
                first = 0
                while True:  # try displacements in blocks
                    tried = np.arange(first, first + 256, dtype=np.uint64)[:, None]
                    slots = self._slot(h[None, :], tried)
                    ok = free[slots].all(axis=1)
                    ordered = np.sort(slots[ok], axis=1)
                    ok[ok] = (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                    if ok.any():
                        d = int(np.argmax(ok))
                        at, d = slots[d], first + d
                        break
                    first += 256
                    if first >= self.TRIALS:
                        return False
                d |= 1 << 31
            self.shift[b] = d
            self.slots[at] = members
            free[at] = False
        return True

    def _slot(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Slots of the hashes of a bucket of several keys: scrambled by the displacement."""
        low = np.uint64(0xFFFFFFFF)
        x = ((h ^ (d * np.uint64(0x9E3779B1) & low)) * np.uint64(0x85EBCA6B)) & low
        return ((x ^ (x >> np.uint64(15))) % np.uint64(self.n)).astype(np.int64)

    def find(self, key: bytes) -> int:
        """The key's position, or -1."""
        h = xxhash.xxh64_intdigest(key, self.seed)
        d, h = int(self.shift[(h >> 32) % self.buckets]), h & 0xFFFFFFFF
        if d >> 31:
            x = ((h ^ ((d & 0x7FFFFFFF) * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B) & 0xFFFFFFFF
            slot = (x ^ (x >> 15)) % self.n
        else:
            slot = (h + d) % self.n
        i = int(self.slots[slot])
        return i if i >= 0 and self.keys[i] == key else -1


def pair_ranks(tokens: list[bytes]) -> dict[int, int]:
    """left id << 32 | right id -> id of the joined token, for every split of every token into two tokens."""
    ids = {t: i for i, t in enumerate(tokens)}
    return {a << 32 | b: i for i, t in enumerate(tokens) for k in range(1, len(t)) if (a := ids.get(t[:k])) is not None and (b := ids.get(t[k:])) is not None}


def merge_bytes(data: bytes, byte_ids: list[int], pairs: dict[int, int]) -> list[int]:
    """Ids of a pre-token: merge the adjacent pair of lowest rank, leftmost first, until none has a rank.

    ``ids`` is a linked list over the bytes; the heap holds rank << 32 | position. An entry counts only while
    ``rank_at`` still has that rank for the position.
    """
    n = len(data)
    ids = [byte_ids[b] for b in data]
    get = pairs.get
    rank_at = [get(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
    rank_at.append(-1)
    heap = [r << 32 | i for i, r in enumerate(rank_at) if r >= 0]
    heapq.heapify(heap)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    push, pop = heapq.heappush, heapq.heappop
    while heap:
        entry = pop(heap)
        i, r = entry & 0xFFFFFFFF, entry >> 32
        if rank_at[i] != r:
            continue
        j = right[i]
        k = right[i] = right[j]
        ids[i], ids[j], rank_at[j] = r, -1, -1
        if k < n:
            left[k] = i
            q = rank_at[i] = get(r << 32 | ids[k], -1)
            if q >= 0:
                push(heap, q << 32 | i)
        else:
            rank_at[i] = -1
        h = left[i]
        if h >= 0:
            q = rank_at[h] = get(ids[h] << 32 | r, -1)
            if q >= 0:
                push(heap, q << 32 | h)
    return [x for x in ids if x >= 0]


# ---- splitting by the pattern 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+ ----

#: The pattern that ``split_points`` computes with arrays; any other pattern goes through the regex module.
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
_KINDS: np.ndarray | None = None


def _kinds() -> np.ndarray:
    """The class of each code point, by the regex module's own tables."""
    global _KINDS
    if _KINDS is None:
        table = np.full(0x110000, _OTHER, np.uint8)
        chars = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pattern, chars):
                a, b = m.span()
                table[ord(chars[a]) : ord(chars[b - 1]) + 1] = kind
        _KINDS = table
    return _KINDS


def split_points(text: str) -> np.ndarray:
    """Where the pre-tokens of a text without apostrophes begin.

    Runs of one class are pre-tokens. A blank before a run that isn't space joins it; before a run that isn't space,
    the last character of a longer space run stands alone unless it is that blank.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[points]
    begins = np.empty(len(points), bool)
    begins[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])  # last of a space run before something else
    blank = points[last] == 0x20
    begins[last] = True
    begins[last[blank] + 1] = False
    return np.flatnonzero(begins)


def pretokens(text: str, pattern) -> list[str]:
    if not text:
        return []
    if pattern.pattern != KNOWN_PATTERN or "'" in text:
        return pattern.findall(text)
    at = split_points(text).tolist()
    return [text[a:b] for a, b in zip(at, at[1:] + [len(text)], strict=True)]


class Coder(dict):
    """Pre-token -> its ids as decimal text; computes what it lacks."""

    def __init__(self, tokens: list[bytes], table: PerfectHash, pattern: str) -> None:
        self.tokens, self.table = tokens, table
        self.pairs = pair_ranks(tokens)
        self.byte_ids = [table.find(bytes([b])) for b in range(256)]
        self.by_text = {str(i): t for i, t in enumerate(tokens)}
        self.pattern = regex.compile(pattern)

    def __missing__(self, pretoken: str) -> str:
        data = pretoken.encode("utf-8", "surrogatepass")
        i = self.table.find(data)
        out = str(i) if i >= 0 else ",".join(map(str, merge_bytes(data, self.byte_ids, self.pairs)))
        self[pretoken] = out
        return out

    def encode(self, text: str) -> str:
        """The ids joined by commas."""
        if len(self) > CACHE:
            self.clear()
        return ",".join(map(self.__getitem__, pretokens(text, self.pattern)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.by_text.__getitem__, ids.split(","))) if ids else b""


def _coder(shared) -> Coder:
    """One coder for each worker process and vocabulary, until another operator's task begins there."""
    if "bpe" not in KEPT or KEPT["bpe"][0] is not shared:
        KEPT.pop("bpe", None)
        KEPT["bpe"] = shared, Coder(*shared.value)
    return KEPT["bpe"][1]


def load_vocabulary(spark: SparkSession, path: str, pattern: str):
    """Broadcast the vocabulary and its perfect hash. Their size is that of the vocabulary file, whatever the corpus.
    Raises if a single byte isn't a token, as byte-level vocabularies have them all."""
    tokens = read_ranks(path)
    have = set(tokens)
    if any(bytes([b]) not in have for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    return spark.sparkContext.broadcast((tokens, PerfectHash(tokens), pattern))


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` the array ids.

    Whole texts; a null text is an empty one. ids_sha256 hashes the decimal ids joined by commas, decoded_sha256 the
    bytes that the ids decode to, taken from the ids alone. One row for each row, nulls and repeats included; other
    columns are ignored. No shuffle; a worker holds the vocabulary, a bounded cache and one batch of texts.
    """
    shared = load_vocabulary(docs.sparkSession, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            n, ids_sha, out_sha, lists = [], [], [], []
            for value in batch.column(1):
                got = coder.encode(value.as_py() or "")
                n.append(got.count(",") + 1 if got else 0)
                ids_sha.append(hashlib.sha256(got.encode()).hexdigest())
                out_sha.append(hashlib.sha256(coder.decode(got)).hexdigest())
                if ids:
                    lists.append(np.array(got.split(","), np.int32) if got else np.zeros(0, np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select("doc_id", "text").mapInArrow(lean(run, "bpe"), schema)


