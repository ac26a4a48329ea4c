"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises every substring of it. A text is parsed greedily into
the longest pieces that a language's automaton has; the language that needs the fewest phrases, normalised by its
amount of training text, wins. The automata are one hash table of transitions over all letters as they are, and a worker
walks thousands of text segments in step, in all languages at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean

#: Bounds of the training sample: texts and characters of a language, characters taken from the start of one text.
SAMPLE_TEXTS, SAMPLE_CHARS, TEXT_CHARS = 64, 40_000, 2_000
#: A text is parsed in segments of so many characters; each begins a phrase.
SEGMENT = 2048
#: Symbols of the texts that are parsed at once, longer texts excepted: 32 MB, however many rows a batch has.
PIECE = 1 << 22
#: Segments times languages that are walked in step.
LANES = 1 << 16

_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _LETTERS


_SYMBOLS: np.ndarray | None = None


def symbols_of_points() -> np.ndarray:
    """For each code point its symbol: itself for a letter, 1 for all that isn't one."""
    global _SYMBOLS
    if _SYMBOLS is None:
        _SYMBOLS = np.where(letters(), np.arange(sys.maxunicode + 1), 1).astype(np.uint32)
    return _SYMBOLS


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions by state and symbol of the minimal automaton of all substrings; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


class Table:
    """The transitions of the automata of all languages, hashed with linear probing: three a symbol at the most, whatever
    the alphabet. State 0 is where a parse begins and where a symbol that the language lacks leads: it has no transitions."""

    def __init__(self, languages: list[list[int]]) -> None:
        keys, tos, starts, base = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [], 1
        for symbols in languages:
            nexts = suffix_automaton(symbols)
            keys.append(np.fromiter((base + s << 21 | c for s, d in enumerate(nexts) for c in d), np.int64))
            tos.append(np.fromiter((base + t for d in nexts for t in d.values()), np.int32))
            starts.append(base)
            base += len(nexts)
        self.starts = np.array(starts, np.int64)
        key, to = np.concatenate(keys), np.concatenate(tos)
        bits = max(4, (2 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int32)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.to[slot[placed]] = to[placed]
            key, to, slot = key[~placed], to[~placed], slot[~placed] + 1 & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The next state of each state << 21 | symbol; -1: none."""
        slot = self._slot(key)
        got = self.keys[slot]
        out = np.where(got == key, self.to[slot], np.int32(-1))
        open_ = np.flatnonzero((got != key) & (got != 0))
        while len(open_):
            slot[open_] = slot[open_] + 1 & self.mask
            got = self.keys[slot[open_]]
            hit = got == key[open_]
            out[open_[hit]] = self.to[slot[open_[hit]]]
            open_ = open_[~hit & (got != 0)]
        return out

    def step(self, state: np.ndarray, start: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and which of the symbols begin a new phrase, from their ``start``: those without a transition."""
        to = self.find(state.astype(np.int64) << 21 | symbol)
        fresh = np.flatnonzero(to < 0)
        to[fresh] = np.maximum(self.find(start[fresh] << 21 | symbol[fresh]), 0)
        return to, fresh


@dataclass
class Model:
    languages: list[str]
    symbols: list[list[int]]
    bits: list[float]  # log2 of the training length: the price of a phrase

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    @property
    def symbol_of(self) -> np.ndarray:
        return symbols_of_points()

    @cached_property
    def table(self) -> Table:
        """Built where it is used, once for each worker; only the symbols travel."""
        return Table(self.symbols)


def fit(texts: dict[str, list[str]]) -> Model:
    """A model of the given texts by language. Languages without any letter are left out."""
    joined = {}
    for lang in sorted(texts):
        got, room = [], SAMPLE_CHARS
        for t in texts[lang]:
            got.append(points(t[:TEXT_CHARS])[:room])
            room -= len(got[-1])
            if room <= 0:
                break
        all_points = np.concatenate([np.append(x, np.uint32(0x20)) for x in got]) if got else np.zeros(0, np.uint32)
        if letters()[all_points].any():
            joined[lang] = all_points
    languages = list(joined)
    symbols = []
    for lang in languages:
        x = symbols_of_points()[joined[lang]]
        x = x[np.concatenate(([True], (x[1:] != 1) | (x[:-1] != 1)))]  # runs of non-letters count once
        symbols.append(x.tolist())
    return Model(languages, symbols, [float(np.log2(max(2, len(joined[x])))) for x in languages])


def _phrases(codes: list[np.ndarray], model: Model) -> np.ndarray:
    """Phrases [texts, languages] of texts given as symbols."""
    counts = np.zeros((len(codes), len(model.languages)), np.int64)
    length = np.fromiter(map(len, codes), np.int64, len(codes))
    if not length.sum() or not model.languages:
        return counts
    flat = np.concatenate(codes)
    codes.clear()
    segments = -(-length // SEGMENT)
    owner = np.repeat(np.arange(len(length)), segments)
    begin = (np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments)) * SEGMENT
    size = np.minimum(SEGMENT, length[owner] - begin)
    start = (np.cumsum(length) - length)[owner] + begin
    order = np.argsort(-size, kind="stable")
    m = len(model.languages)
    width = max(1, LANES // m)
    for here in (order[x : x + width] for x in range(0, len(order), width)):
        first, most = start[here], int(size[here[0]])
        lanes = np.searchsorted(-size[here], -np.arange(1, most + 1), side="right")  # how many segments have a j-th symbol
        states, phrases = np.zeros(m * len(here), np.int32), np.zeros(m * len(here), np.int32)  # the languages of a segment side by side
        starts = np.tile(model.table.starts, len(here))
        for j in range(most):
            k = int(lanes[j])
            states[: m * k], fresh = model.table.step(states[: m * k], starts[: m * k], np.repeat(flat[first[:k] + j].astype(np.int64), m))
            phrases[fresh] += 1
        np.add.at(counts, owner[here], phrases.reshape(-1, m))
    return counts


def cross_parse(texts: Iterable[str | None], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: phrases by language [texts, languages], symbols, whether it has a letter. Whole texts, about PIECE
    symbols at a time."""
    counts, n_symbols, has = [], [], []
    codes, held = [], 0
    for t in texts:
        x = points(t or "")
        has.append(bool(letters()[x].any()))
        x = model.symbol_of[x if has[-1] else x[:0]]
        x = x[np.concatenate(([True], (x[1:] != 1) | (x[:-1] != 1)))[: len(x)]]
        n_symbols.append(len(x))
        codes.append(x)
        held += len(x)
        if held >= PIECE:
            counts.append(_phrases(codes, model))
            codes, held = [], 0
    counts.append(_phrases(codes, model))
    return np.concatenate(counts), np.array(n_symbols, np.int64), np.array(has, bool)


def predict(texts: Iterable[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. Score: how much cheaper the best language's parse is than the second's,
    (second - best) / second, 1 with one language; ties go to the language first by name; ``und`` scores 0."""
    counts, _, has = cross_parse(texts, model)
    if not model.languages:
        return ["und"] * len(has), np.zeros(len(has))
    cost = counts * np.array(model.bits)[None, :]
    best = np.argmin(cost, axis=1)
    low = cost[np.arange(len(has)), best]
    if cost.shape[1] > 1:
        second = np.partition(cost, 1, axis=1)[:, 1]
        score = np.where(second > 0, (second - low) / np.maximum(second, 1e-300), 0.0)
    else:
        score = np.ones(len(has))
    return [model.languages[b] if h else "und" for b, h in zip(best, has, strict=True)], np.where(has, score, 0.0)


def held_out(doc_id: str) -> Column:
    """Whether a document is never learnt from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """Fit on documents that aren't held out and have lang and text: of each language the SAMPLE_TEXTS first doc_ids in the
    order of a hash. The driver gets this sample only, bounded for each language. Rows that share doc_id and lang count
    once, with the first of their texts."""
    known = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ranked = known.select("doc_id", "lang").distinct().select("*", F.md5(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    first = ranked.select("*", F.expr("row_number() OVER (PARTITION BY lang ORDER BY h, doc_id)").alias("r")).where(F.col("r") <= SAMPLE_TEXTS).select("doc_id", "lang", "r")
    found = known.select("doc_id", "lang", F.substring("text", 1, TEXT_CHARS).alias("text")).join(F.broadcast(first), ["doc_id", "lang"])
    rows = found.groupBy("lang", "r").agg(F.min("text").alias("text")).orderBy("lang", "r").collect()
    texts: dict[str, list[str]] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append(r["text"])
    return fit(texts)


def identify(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """``docs(doc_id, text)`` with lang_pred and score added; all other columns stay, but columns of these two names
    are replaced. ``train(doc_id, lang, text)``, ``docs`` itself by default, is what the model is learnt from.

    Every whole text is parsed. Null texts and texts without a letter are ``und``; so are all texts if nothing could be
    learnt. One row for each row. No shuffle; the model is a fixed bound of memory in each worker.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(learn(docs if train is None else train))
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict((x.as_py() for x in batch.column(at)), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(lean(run), schema)
