"""Sinks: redacted appends, id lists by mode, tables of a workbook, placement of files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def redacted(df: DataFrame, secrets: list[str], mask: str = "[redacted]") -> DataFrame:
    """All string columns with the secrets masked."""
    real = [s for s in secrets if s]
    hide = lambda c: reduce(lambda x, s: F.replace(x, F.lit(s), F.lit(mask)), real, F.col(c))
    return df.withColumns({c: hide(c) for c, kind in df.dtypes if kind == "string"}) if real else df


def append_log(df: DataFrame, path: str, secrets: list[str] | None = None) -> None:
    """Append rows as JSON lines; the job's commit makes them appear together."""
    redacted(df, secrets or []).write.mode("append").json(path)


def predictions(df: DataFrame, path: str) -> None:
    """Predictions as gzipped JSON by record."""
    df.write.mode("overwrite").partitionBy("record_id").option("compression", "gzip").json(path)


def id_lists(modes: DataFrame, path: str) -> DataFrame:
    """Write the ids of each mode as text below mode=<mode>; the counts."""
    modes.select("mode", F.col("record_id").cast("string").alias("value")).write.mode("overwrite").partitionBy("mode").text(path)
    return modes.groupBy("mode").agg(F.count("*").alias("n"))


def workbook(tables: dict[str, DataFrame], path: str, formats: tuple[str, ...] = ("parquet",)) -> None:
    """A table for each sheet, as Parquet and, on demand, as CSV with nested columns in JSON."""
    for name, df in tables.items():
        for kind in formats:
            if kind == "csv":
                flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
                flat.write.mode("overwrite").csv(f"{path}/{name}.csv", header=True)
            else:
                df.write.mode("overwrite").format(kind).save(f"{path}/{name}.{kind}")


def documents(df: DataFrame, record: str, doc: str, path: str, name: str) -> None:
    """A JSON document for each record."""
    df.select(F.col(record).alias("record"), F.to_json(doc).alias("value")).write.mode("overwrite").partitionBy("record").option("fileNamePrefix", name).text(path)


def place_files(plan: DataFrame, source_root: str, target_root: str) -> DataFrame:
    """Carry out a placement plan (path, target): link, else copy; existing files stay. -> path, target, action, error.
    Both roots are folders that all executors share."""
    import pandas as pd

    def run(batches):
        import os
        import shutil

        for pdf in batches:
            out = []
            for path, target in zip(pdf["path"], pdf["target"], strict=True):
                src, dst = os.path.join(source_root, path), os.path.join(target_root, target, path)
                action, error = "exists", None
                try:
                    if not os.path.exists(dst):
                        os.makedirs(os.path.dirname(dst), exist_ok=True)
                        try:
                            os.link(src, dst)
                            action = "linked"
                        except OSError:
                            shutil.copy2(src, dst)
                            action = "copied"
                except OSError as e:
                    action, error = "failed", str(e)
                out.append((path, target, action, error))
            yield pd.DataFrame(out, columns=["path", "target", "action", "error"])

    return plan.select("path", "target").mapInPandas(run, "path string, target string, action string, error string")
