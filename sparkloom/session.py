"""Session settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "sparkloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, skew joins and UTC. Sizes of partitions are left to AQE and to the caller."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return b.config(map=settings).getOrCreate()
