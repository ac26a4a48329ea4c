"""Every query runs on empty tables and on tables whose rows are null in every column."""

import pytest

from sparkloom.plans import queries as Q
from sparkloom.plans import records  # noqa: F401  registers its queries

from .test_queries import TABLES


@pytest.fixture(scope="module", params=["empty", "null"])
def odd(request, spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp(request.param)
    for t in TABLES:
        schema = spark.read.parquet(f"{sf}/{t}.parquet").schema
        rows = [] if request.param == "empty" else [tuple(None for _ in schema)] * 2
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_odd(name, spark, odd):
    rows = Q.QUERIES[name](spark, odd).collect()
    assert len(rows) <= 20
