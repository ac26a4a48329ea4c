"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Equal vectors of a label are one class, quantised once to int8 with the norm of what quantisation lost. The classes of a
label are dealt into blocks, and each two blocks make a tile, to which only codes travel. The integer products and the
two vectors' own errors bound the cosine from above; a tile names the vectors that have a pair possibly above the
threshold. Full vectors travel for these only, and their pairs are computed in double precision where the bound allows.
A tile gives out counts and one spanning link for each vector, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, components, written

THRESHOLD = 0.98
#: Vectors of a block, and components of the vectors that are held in double precision at once.
TILE, HELD = 2048, 1 << 22
#: A class with more than one in so many rows is hot; there are fewer than HOT such classes, so they can be broadcast.
HOT = 1000


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that their largest components are near 1: no square over- or underflows, and a
    cosine is what it was to the last bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scale, norm of scale * codes, and norm of what quantisation lost, of unit vectors in rows.
    The norms are rounded up by more than double precision can be wrong."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None])
    back = codes * scale[:, None]
    up = 1.0 + 1e-9
    return codes.astype(np.int8), scale, np.linalg.norm(back, axis=1) * up, np.linalg.norm(unit - back, axis=1) * up + 1e-12


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows: float32 holds sums of 1024 products of at most 127 * 127 exactly."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1024):
        out += a[:, k : k + 1024].astype(np.float32) @ b[:, k : k + 1024].astype(np.float32).T
    return out


def possible(a: tuple, b: tuple, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of quantised vectors whose cosine may reach the threshold; with ``same``, a is b and each pair comes once."""
    (qa, sa, na, ea), (qb, sb, nb, eb) = a, b
    high = int8_products(qa, qb) * sa[:, None] * sb[None, :]
    high += na[:, None] * eb[None, :] + ea[:, None] * (nb + eb)[None, :]
    i, j = np.nonzero(high >= threshold - 1e-9)
    return (i[i < j], j[i < j]) if same else (i, j)


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs with cosine >= threshold; with ``same``, a is b and each pair comes once."""
    a = scaled(a)
    b = a if same else scaled(b)
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    qa = quantise(a / norm_a[:, None])
    i, j = possible(qa, qa if same else quantise(b / norm_b[:, None]), same, threshold)
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, HELD // a.shape[1])
    for k in range(0, len(i), step):
        x, y = i[k : k + step], j[k : k + step]
        ok = np.einsum("ij,ij->i", a[x], b[y]) / (norm_a[x] * norm_b[y]) >= threshold
        out_i.append(x[ok])
        out_j.append(y[ok])
    return np.concatenate(out_i), np.concatenate(out_j)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that links lead to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid, embedding -> cid, codes, scale, norm, lost."""
    names = ["cid", "codes", "scale", "norm", "lost"]
    for batch in batches:
        cid, vectors = batch.column(0).to_numpy(), batch.column(1)
        size = np.diff(vectors.offsets.to_numpy())
        flat, at = np.asarray(vectors.flatten(), np.float64), np.concatenate(([0], np.cumsum(size)))
        for d in np.unique(size).tolist():
            rows = np.flatnonzero(size == d)
            step = max(1, HELD // d)
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                x = scaled(flat[at[some][:, None] + np.arange(d)])
                codes, scale, norm, lost = quantise(x / np.linalg.norm(x, axis=1)[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(norm), pa.array(lost)], names=names)


def _hopeful(threshold: float):
    """Of a tile of codes: the vectors that have a pair possibly above the threshold."""

    def run(key, table):
        part, cid = table["part"].to_numpy(), table["cid"].to_numpy()
        codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.int8).reshape(len(table), -1)
        q = [codes, *(table[c].to_numpy() for c in ("scale", "norm", "lost"))]
        one, two = np.flatnonzero(part == 0), np.flatnonzero(part == 1)
        same = not len(two)
        i, j = possible([x[one] for x in q], [x[one if same else two] for x in q], same, threshold)
        rows = np.union1d(one[i], (one if same else two)[j])
        keys = [pa.array(np.full(len(rows), k.as_py()), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
        return pa.table([*keys, pa.array(part[rows], pa.int32()), pa.array(cid[rows], pa.int64())], names=["gid", "i", "j", "part", "cid"])

    return run


def _links(threshold: float):
    """Of a tile of full vectors: for each that links, how many rows it links with and the smallest class linked within the tile."""

    def run(key, table):
        part = table["part"].to_numpy()
        order = np.lexsort((table["cid"].to_numpy(), part))
        table, part = table.take(pa.array(order)), part[order]
        cid, count = table["cid"].to_numpy(), table["copies"].to_numpy()
        x = table["embedding"].combine_chunks()
        x = np.asarray(x.flatten(), np.float64).reshape(len(table), -1)
        first = int((part == 0).sum())
        if (part == 1).any():
            i, j = tile_links(x[:first], x[first:], False, threshold)
            j = j + first
        else:
            i, j = tile_links(x, x, True, threshold)
        links = np.bincount(i, count[j], len(cid)) + np.bincount(j, count[i], len(cid))
        root = local_roots(len(cid), i, j)
        low = np.full(len(cid), np.iinfo(np.int64).max)
        np.minimum.at(low, root, cid)
        has = links > 0
        return pa.table({"cid": pa.array(cid[has], pa.int64()), "links": pa.array(links[has].astype(np.int64), pa.int64()), "root": pa.array(low[root][has], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vectors(vec_id, embedding array<float or double>, label)`` -> vec_id, n_links, component_id, kept; one row for each row.

    Two vectors link when their labels are equal and not null, they have equally many components, and their cosine in
    double precision is >= threshold, whatever their lengths. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. n_links counts the other rows linked directly, copies among them;
    component_id is the smallest vec_id reachable by links, the row's own included; kept: vec_id is component_id. Rows
    with a null vec_id link as all others do, but name no component (null where no other row is reached) and aren't
    kept. Rows that share a vec_id are vectors of their own. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), F.col("label"))
    e = F.col("embedding")
    finite = ~F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    ok = F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda c: c != 0)
    good = rows.where(ok)
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # the number is fixed by being written
    classes = written(classes.select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("cid")), "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("blocks"))
    sizes = Table(sizes.select("*", F.monotonically_increasing_id().alias("gid")), "vector-groups")
    codes = classes.select("cid", "embedding").mapInArrow(_codes, "cid long, codes binary, scale double, norm double, lost double")
    dealt = classes.select("cid", "label", "dim").join(sizes.df, ["label", "dim"]).select("cid", "gid", "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("block"))
    tiles = dealt.join(codes, "cid").select("gid", "cid", "codes", "scale", "norm", "lost", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # block b is part 0 of the tiles (b, other >= b) and part 1 of (other < b, b)
    tiles = tiles.select("gid", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("part"), "cid", "codes", "scale", "norm", "lost")
    hopeful = tiles.groupBy("gid", "i", "j").applyInArrow(_hopeful(threshold), "gid long, i int, j int, part int, cid long")
    hopeful = Table(hopeful, "vector-candidates")
    full = hopeful.df.join(classes.select("cid", "copies", "embedding"), "cid").select("gid", "i", "j", "part", "cid", "copies", "embedding")
    found = Table(full.groupBy("gid", "i", "j").applyInArrow(_links(threshold), "cid long, links long, root long"), "vector-links")
    links = found.df.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = components(found.df.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cid")
    named = classes.select("cid", "rep", "copies").join(links, "cid", "left").join(comps, "cid", "left")
    named = Table(named.select("cid", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component")), "vector-named")
    least = named.df.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = classes.select("cid", "label", "embedding", "copies").join(named.df.join(least, "component").select("cid", "n_links", "component_id"), "cid").drop("cid")
    of_class = written(of_class, "vector-results")
    for t in (sizes, hopeful, found, named):
        t.drop()
    # hot classes are few and travel to their rows; rows of the others meet them by value
    hot_from = (classes.agg(F.sum("copies")).first()[0] or 0) // HOT
    hot, rest = of_class.where(F.col("copies") > hot_from), of_class.where(F.col("copies") <= hot_from)
    keys, result = ["label", "embedding"], ["vec_id", "n_links", "component_id"]
    linked = good.join(F.broadcast(hot), keys).select(*result).union(good.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys).select(*result))
    alone = rows.where(~F.coalesce(ok, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
