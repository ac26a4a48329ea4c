"""Streaming over result logs: a tail that keeps the latest row of each record, monitoring, and states."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.merge import latest


#: Bytes of a log that one task reads; buckets of a table of latest rows.
CHUNK, BUCKETS = 64 << 20, 64


class LogTail(DataSource):
    """Whole lines as they are appended to files, each once: path, position (of the line's first byte), value.

    Options: ``path``, a file or a folder; ``suffix``, the ending of the files of a folder. A half-written last line waits until
    it is whole. The offset of a stream is a position for each file; a file that has become shorter is read anew.
    """

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "path string, position long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TailReader(self.options["path"], self.options.get("suffix", ""))


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


class _TailReader(DataSourceStreamReader):
    def __init__(self, path: str, suffix: str) -> None:
        self.path, self.suffix = path, suffix

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        fs, root = _open(self.path)
        info = fs.get_file_info(root)
        files = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        out = {}
        for f in files:
            if f.type == pafs.FileType.File and f.path.endswith(self.suffix):
                with fs.open_input_file(f.path) as stream:
                    out[f.path] = self._whole(stream, f.size)
        return out

    @staticmethod
    def _whole(stream, size: int) -> int:
        """One past the last line end."""
        end = size
        while end > 0:
            start = max(0, end - (1 << 16))
            stream.seek(start)
            at = stream.read(end - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts = []
        for path, stop in sorted(end.items()):
            begin = start.get(path, 0)
            begin = begin if begin <= stop else 0
            parts += [InputPartition((path, begin, a, min(a + CHUNK, stop))) for a in range(begin, stop, CHUNK)]
        return parts

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path, begin, start, stop = partition.value
        fs, _ = _open(self.path)
        with fs.open_input_file(path) as raw:
            raw.seek(start - 1 if start > begin else start)
            stream = io.BufferedReader(raw, 1 << 20)
            at = start
            if start > begin:  # the line that was begun before belongs to the task before
                at = start - 1 + len(stream.readline())
            while at < stop:
                line = stream.readline()
                if not line:
                    return
                yield path, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)


def log_stream(spark: SparkSession, path: str, key: str = "record_id", suffix: str = "") -> DataFrame:
    """JSON lines as they are appended: key, status, kept, ts, path, position; lines that aren't JSON or have no key are left out."""
    spark.dataSource.register(LogTail)
    raw = spark.readStream.format("log_tail").option("path", path).option("suffix", suffix).load()
    lines = raw.select(F.try_parse_json("value").alias("line"), "path", "position")
    get = lambda p, kind: F.try_variant_get("line", p, kind)
    rows = lines.select(get(f"$.{key}", "string").alias(key), get("$.status", "string").alias("status"), get("$.kept", "boolean").alias("kept"), get("$.ts", "timestamp").alias("ts"), "path", "position")
    return rows.where(f"`{key}` is not null")


def keep_latest(stream: DataFrame, table: str, checkpoint: str, key: str = "record_id", order: tuple[str, ...] = ("path", "position"), buckets: int = BUCKETS):
    """Run a stream that keeps, in Parquet folder ``table``, the last row of each key in ``order``, by default that of the lines.

    Keys are dealt into buckets. A batch writes new versions of the buckets that it touches, in a folder of its own number, so
    a batch that runs again does no harm; versions that a finished later one has replaced are deleted.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("bucket", bucket).persist()
        touched = {r["bucket"] for r in batch.select("bucket").distinct().collect()}  # at most ``buckets``
        before = _folders(spark, table, n)
        old = [before[b] for b in sorted(touched & before.keys())]
        now = batch
        if old:
            now = spark.read.schema(batch.drop("bucket").schema).parquet(*old).withColumn("bucket", bucket).unionByName(batch)
        latest(now, [key], list(order)).repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/v={n}")
        batch.unpersist()
        _prune(spark, table, n)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, table: str) -> dict[int, dict[int, str]]:
    """Folders of the buckets of each finished version."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[int, dict[int, str]] = {}
    for v in fs.listStatus(root) if fs.exists(root) else []:
        name = v.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(v.getPath(), "_SUCCESS")):
            out[int(name[2:])] = {int(b.getPath().getName()[7:]): b.getPath().toString() for b in fs.listStatus(v.getPath()) if b.getPath().getName().startswith("bucket=")}
    return out


def _folders(spark: SparkSession, table: str, below: int) -> dict[int, str]:
    """The newest folder of each bucket, of versions below a number."""
    found = _versions(spark, table)
    return {b: folder for v in sorted(found) if v < below for b, folder in found[v].items()}


def _prune(spark: SparkSession, table: str, n: int) -> None:
    """Delete folders that a version before ``n`` has replaced: batch ``n`` may still run again on what was before it."""
    found = _versions(spark, table)
    newest = _folders(spark, table, n)
    jvm = spark.sparkContext._jvm
    for v, folders in found.items():
        for b, folder in folders.items():
            if v < n and newest[b] != folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_latest(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows; raises if there is none."""
    folders = _folders(spark, table, 1 << 62)
    if not folders:
        raise FileNotFoundError(table)
    return spark.read.parquet(*folders.values())


def finished_rate(stream: DataFrame, window: str = "1 hour", slide: str = "5 minutes", late: str = "2 hours") -> DataFrame:
    """Rows by status in sliding windows of event time; later lines than ``late`` are left out."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window, slide), "status").agg(F.count("*").alias("n"))


def monitor(snapshot: DataFrame, total: int, unfinished: tuple[str, ...]) -> DataFrame:
    """One row: done, left and counts by status of the latest rows."""
    done = F.count_if(~F.col("status").isin(*unfinished))
    counts = snapshot.groupBy("status").agg(F.count("*").alias("n"))
    by = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("by_status"))
    return snapshot.agg(done.alias("done")).crossJoin(by).select("done", F.greatest(F.lit(total) - F.col("done"), F.lit(0)).alias("left"), "by_status")  # one row each


def run_once(make: Callable[[], object]) -> None:
    """Start a query, wait until what there is has been worked on."""
    q = make()
    q.awaitTermination()
