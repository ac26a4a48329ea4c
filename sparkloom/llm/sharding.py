"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard. At each level every child draws ``-ln(u) / weight`` with ``u`` from a hash of
the key and the child's name; the smallest draw wins. A child's draw depends on nothing but the key, its own name and
its own weight, so a changed weight moves keys only into or out of that child's subtree. Growing opens a region of its
own for each added shard: no present node's weight changes, so rows move only into the added shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def balanced_tree(shards: int, regions: int = 4, racks: int = 2) -> list[Shard]:
    """``regions`` x ``racks`` with equally many shards each; the shards that are left over, or that are added later
    with ``grow``, have a region of their own each."""
    per = shards // (regions * racks)
    tree = [Shard(f"r{i // (racks * per)}", f"r{i // (racks * per)}k{i // per % racks}", i) for i in range(per * regions * racks)] if per else []
    return grow(tree, shards - len(tree))


def grow(tree: list[Shard], added: int = 1, weight: float = 1.0) -> list[Shard]:
    """The tree with ``added`` shards more, each under a region that is new."""
    first = max((s.shard for s in tree), default=-1) + 1
    return tree + [Shard(f"g{i}", f"g{i}k0", i, weight) for i in range(first, first + added)]


def _winner(key: Column, children: Column) -> Column:
    """The name of the child with the smallest draw; u has the first 52 bits of md5(key ':' name)."""

    def draw(c: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), c["name"]).cast("binary")), 1, 13), 16, 10).cast("long")
        return F.struct((-F.ln((bits + F.lit(0.5)) / F.lit(float(2**52))) / c["weight"]).alias("draw"), c["name"].alias("name"))

    return F.array_min(F.transform(children, draw))["name"]


def _children(nodes: list[tuple[str, float]]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(w)).alias("weight")) for name, w in nodes])


def place(df: DataFrame, key: str, tree: list[Shard], out: str = "shard") -> DataFrame:
    """Add the int column ``out``: the shard of each row's ``key`` (a null key counts as empty text).

    Three levels of native expressions and no shuffle. Only the children of the nodes that a key passes through draw.
    Repeated keys get the same shard. An existing column ``out`` is replaced.
    """
    tree = [s for s in tree if s.weight > 0]
    if not tree:
        raise ValueError("the tree has no shard with weight")
    regions: dict[str, dict[str, list[Shard]]] = {}
    for s in tree:
        regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    total = lambda shards: sum(s.weight for s in shards)
    top = _children([(r, sum(map(total, racks.values()))) for r, racks in regions.items()])
    racks_of = F.create_map(*[x for r, racks in regions.items() for x in (F.lit(r), _children([(k, total(v)) for k, v in racks.items()]))])
    shards_of = F.create_map(*[x for racks in regions.values() for k, v in racks.items() for x in (F.lit(k), _children([(f"s{s.shard}", s.weight) for s in v]))])
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    df = df.withColumn("__region", _winner(k, top))
    df = df.withColumn("__rack", _winner(k, F.element_at(racks_of, F.col("__region"))))
    df = df.withColumn("__leaf", _winner(k, F.element_at(shards_of, F.col("__rack"))))
    return df.withColumn(out, F.substring("__leaf", 2, 12).cast("int")).drop("__region", "__rack", "__leaf")


def slots(df: DataFrame, shard: str, order: list[str], out: str = "slot", cells: int = 64) -> DataFrame:
    """Add the long column ``out``, gapless from 0 within each shard.

    Each shard is split by a hash of the columns ``order`` into ``cells`` cells (256 at the most), numbered on their own and
    offset by the sizes of the cells before, so that no task sorts a whole shard. The table of offsets has at most shards x ``cells`` rows. Rows that tie in
    ``order`` are numbered in any order. Nulls are a value of their own.
    """
    digest = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in order]).cast("binary"))
    df = df.withColumn("__cell", F.conv(F.substring(digest, 1, 2), 16, 10).cast("int") % cells)
    sizes = df.groupBy(shard, "__cell").agg(F.count("*").alias("__n"))
    w = "sum(__n) OVER (PARTITION BY {0} ORDER BY __cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - __n".format(f"`{shard}`")
    offsets = sizes.select(F.col(shard).alias("__s"), F.col("__cell").alias("__c"), F.expr(w).alias("__base"))
    numbered = df.withColumn("__r", F.expr("row_number() OVER (PARTITION BY `{}`, __cell ORDER BY {})".format(shard, ", ".join(f"`{c}`" for c in order))))
    return (
        numbered.join(F.broadcast(offsets), F.col(shard).eqNullSafe(F.col("__s")) & F.col("__cell").eqNullSafe(F.col("__c")))
        .withColumn(out, (F.col("__base") + F.col("__r") - 1).cast("long"))
        .drop("__cell", "__r", "__s", "__c", "__base")
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``docs(doc_id, text)`` by law ``key``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text (null: none) plus 16. text_crc32: null for a null text. Documents with a null doc_id
    share the shard of the empty key. Other columns are ignored.
    """
    tree = balanced_tree(shards)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(place(rows, "doc_id", tree), "doc_id", grow(tree), "grown_shard")
    return slots(rows, "shard", ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
