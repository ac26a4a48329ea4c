"""Shared pieces: the job's folder, written tables, connected components and byte hashing."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where driver and executors are one process and the session names no shared folder.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Without that setting a local folder if
    there is only one process, else an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (found or LOCAL_CHECKPOINTS).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sparkloom-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends, and lost executors lose nothing."""
    TABLES.append(Table(df, name))
    return TABLES[-1].df


#: Tables of ``written`` that results may still be read from, in the order they were written.
TABLES: list[Table] = []


def drop_written(since: int, but: Table | None = None) -> None:
    """Drop the tables that were written after the first ``since``, once nothing is read from them any more."""
    for t in TABLES[since:]:
        if t is not but:
            t.drop()
    del TABLES[since:]


class Table:
    """A written table that can be dropped once what is made from it is written too."""

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark, schema = df.sparkSession, df.schema
        self.path = new_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that it belongs to."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, component)``, component being the smallest node.

    Alternates large-star and small-star steps. Each step rewires a node's neighbours to its smallest one, so the
    number of edges never grows, and every minimum is pre-aggregated before its shuffle: a hub with a third of all
    edges costs one row per task. Each round is a written table, so lineage stays short. Self-loops and null ends are
    ignored; nodes without an edge to another node don't appear.
    """
    spark = edges.sparkSession
    e = (
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    last, path = None, None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours point to the smallest of the neighbourhood.
        large = (
            e.select(F.col("v").alias("u"), F.col("u").alias("x"))
            .join(low, "u")
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        # Small star: smaller neighbours, and the node itself, point to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v")
            .where("u != v")
            .distinct()
        )
        new_path_ = new_path(spark, "components")
        small.write.parquet(new_path_)
        e = spark.read.schema("u long, v long").parquet(new_path_)
        state = e.agg(F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if path:
            delete_path(spark, path)
        path = new_path_
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.col("m").alias("component")).union(e.select("v", "v").distinct())


#: Bits of a filter of ids for each id, and of the largest filter: 32 MB. Fuller filters let more through and lose nothing.
BITS_A_KEY, MOST_BITS = 16, 1 << 28


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap that has a bit for each of ``ids(id)``: a filter that lets all of them through. Its size, a power of two,
    follows their number up to MOST_BITS, so it can be broadcast."""
    n = BITS_A_KEY * ids.count()
    bits = min(MOST_BITS, max(1 << 16, 1 << n.bit_length()))
    cells = ids.select(F.expr(f"(id & {bits - 1}) div 64").alias("w"), F.expr("shiftleft(1L, cast(id & 63 as int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(bits // 64, np.int64)
    for batch in cells.toArrow().to_batches():  # at most MOST_BITS / 64 rows
        out[batch["w"].to_numpy()] = batch["bits"].to_numpy()
    return out


def in_filter(bits: np.ndarray, i: int) -> bool:
    return bool(int(bits[(i & (64 * len(bits) - 1)) // 64]) >> (i & 63) & 1)


def in_filter_rows(batch: pa.RecordBatch, at: int, bits: np.ndarray, inside: bool) -> pa.RecordBatch:
    """The rows of a batch whose column ``at`` is in the filter, or those that aren't; null isn't."""
    ids = batch.column(at).cast(pa.int64())
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    i = ids.fill_null(0).to_numpy()
    hit = known & ((bits[(i & (64 * len(bits) - 1)) // 64] >> (i & 63)) & 1).astype(bool)
    return batch.filter(pa.array(hit == inside))


def filtered(rows: DataFrame, column: str, shared) -> DataFrame:
    """The rows whose ``column`` is in a broadcast filter."""
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield in_filter_rows(batch, at, shared.value, True)

    return rows.mapInArrow(lean(run), rows.schema)


# ---- memory of Python workers, which live on from stage to stage ----

#: What operators keep in a worker from one task to the next, by the operator's name.
KEPT: dict[str, tuple] = {}


def give_back() -> None:
    """Memory that is free goes back to the system: allocators keep the most that any stage has needed so far."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def begin_task(keeps: str) -> None:
    """Drop what operators other than ``keeps`` hold in this worker."""
    for name in [x for x in KEPT if x != keeps]:
        del KEPT[name]
    give_back()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a mapInArrow, for a worker that other stages use before and after it: a task finds only what operator
    ``keeps`` holds, and leaves nothing else."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(keeps)
        yield from run(batches)
        give_back()

    return task


# ---- hashing of bytes, words and shingles with numpy (64 bits, wrapping) ----

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

#: A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage return.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]


class _Powers:
    """Powers of the base and of its inverse, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 14)
            with np.errstate(over="ignore"):
                for name, base in (("up", _R), ("down", _R_INV)):
                    x = np.full(size, base, np.uint64)
                    x[0] = 1
                    setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last byte of each word of UTF-8 bytes."""
    space = np.empty(len(data) + 2, np.int8)
    space[0] = space[-1] = 1
    space[1:-1] = _IS_SPACE[data]
    turns = np.flatnonzero(np.diff(space))
    return turns[::2], turns[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word, A-Z lower-cased: a polynomial over random byte values from prefix sums, mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.get(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_LOWER[data] * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Distinct sorted hashes of the runs of ``size`` words; a shorter text is one run; no words, no runs."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - k + 1, np.uint64(k), np.uint64)
        for i in range(k):
            total += words[i : n - k + 1 + i] * _ODD[i]
    found = mix(total)
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


#: Bytes of the texts whose words are found at once, longer texts excepted.
PIECE = 1 << 19


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, all in one array, and the first word of each text, one past the last at the end."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first, last = word_spans(data)
    return word_hashes(data, first, last), np.searchsorted(first, np.concatenate(([0], np.cumsum(size))))


def word_pieces(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes, first words) of all texts, some at a time; null texts have no words."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size > PIECE or i + 1 == len(texts):
            yield begin, *words_of([t or b"" for t in texts[begin : i + 1]])
            begin, size = i + 1, 0


def shingle_sets(texts: list[bytes | None], size: int = 5) -> Iterator[np.ndarray]:
    """``shingle_hashes`` of the words of each text."""
    for _, words, start in word_pieces(texts):
        n = max(0, len(words) - size + 1)
        with np.errstate(over="ignore"):
            total = np.full(n, np.uint64(size), np.uint64)
            for k in range(size):
                total += words[k : k + n] * _ODD[k]
        total = mix(total)
        for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            if b - a < size:
                yield shingle_hashes(words[a:b], size)
            else:
                found = total[a : b - size + 1]
                found.sort()
                yield found[np.concatenate(([True], found[1:] != found[:-1]))]


def text_words(text: str | None) -> np.ndarray:
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return word_hashes(data, *word_spans(data))
