"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Each vector is scaled to length one and written as s * q + e with q in int8.
For two vectors the dot product differs from s * s' * (q . q') by at most
|s q| |e'| + |e| |s' q'| + |e| |e'|, numbers kept per vector. A tile product of the
integers (exact in float32 up to 1,000 dimensions) and these bounds rule out
almost every pair; the others are computed in double precision from the
original vectors. Equal vectors are one class with a weight before that. The
classes are dealt to tiles of at most ``TILE_BYTES`` and every pair of
tiles meets in one task, which returns link counts and a spanning
forest of the links it found, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.components import components

TILE_BYTES = 16 << 20  # of a tile's vectors in double precision
LEAST_TILES = 10  # so that small tables use several tasks; from this on, tiles are full
BLOCK = 64  # rows of a tile multiplied at a time


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row of ``x``: int8 values, scale, length of the quantised vector, length of the error."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None]).astype(np.int8)
    back = q * s[:, None]
    return q, s, np.linalg.norm(back, axis=1), np.linalg.norm(u - back, axis=1) + 1e-12


def tile_links(x: np.ndarray, y: np.ndarray | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with cosine >= ``least``, block by block; of ``x`` with itself (i < j) if ``y`` is None."""
    own = y is None
    y = x if own else y
    kind = np.float32 if x.shape[1] <= 1000 else np.float64  # sums of integer products stay exact
    qx, sx, nx, ex = quantise(x)
    qy, sy, ny, ey = (qx, sx, nx, ex) if own else quantise(y)
    right = qy.T.astype(kind)
    lx, ly = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    # the least integer product that could do for any vector of the other tile
    short = (least - 1e-12 - (nx + ex) * ey.max() - ex * ny.max()) / sx
    short = np.floor(short / np.where(short > 0, sy.max(), sy.min()) - 1e-6).astype(kind)
    for a in range(0, len(x), BLOCK):
        product = qx[a:a + BLOCK].astype(kind) @ right
        i, j = np.nonzero(product >= short[a:a + BLOCK, None])
        near = product[i, j].astype(np.float64)
        i += a
        if own:
            i, j, near = i[i < j], j[i < j], near[i < j]
        may = near * sx[i] * sy[j] + (nx[i] + ex[i]) * ey[j] + ex[i] * ny[j] >= least - 1e-12
        i, j = i[may], j[may]
        for k in range(0, len(i), 100_000):
            p, q = i[k:k + 100_000], j[k:k + 100_000]
            ok = np.einsum("ij,ij->i", x[p], y[q]) / (lx[p] * ly[q]) >= least
            yield p[ok], q[ok]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` by the links."""
    low = np.arange(n)
    while len(i):
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            break
        low = new
    return low


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    least: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths. Repeated rows are
    vectors of their own. Null ids stay null, are no component's smallest id
    and are not kept. An empty table gives an empty result.
    """
    v = F.col(f"`{vec_col}`")
    if dict(vectors.dtypes)[vec_col] != "array<float>":
        v = v.cast("array<double>")
    fine = F.coalesce(
        F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0),
        F.lit(False))
    rows = written(vectors.select(F.monotonically_increasing_id().alias("rid"),
                                  F.col(id_col).cast("long").alias("vec_id"), F.when(fine, v).alias("x")), "vectors")
    classes = written(rows.filter("x IS NOT NULL").groupBy("x").agg(F.min("rid").alias("rep"), F.count("*").alias("w")),
                      "classes")
    n, dim = classes.agg(F.count("*"), F.max(F.size("x"))).first()
    tiles = max(LEAST_TILES, math.ceil((n or 0) * 8 * (dim or 1) / TILE_BYTES))
    met = (classes.withColumn("own", F.pmod(F.xxhash64("rep"), F.lit(tiles)).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
           .select(F.size("x").alias("dim"), F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                   (F.col("own") > F.col("other")).alias("second"), F.col("rep"), "w", "x")
           .repartition("dim", "a", "b").sortWithinPartitions("dim", "a", "b"))

    def linked(key: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        dim, a, b = key
        t = pa.Table.from_batches(parts)
        rep, second, w = (t[c].to_numpy() for c in ("rep", "second", "w"))
        order = np.argsort(second, kind="stable")
        x = t["x"].combine_chunks().flatten().to_numpy().reshape(-1, dim)[order].astype(np.float64)
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # exact, and squares stay finite
        rep, w, n = rep[order], w[order], int((~second).sum())
        if a == b:
            found, n = tile_links(x, None, least), 0
        else:
            found = tile_links(x[:n], x[n:], least) if 0 < n < len(x) else ()
        links, low = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
        for i, j in found:
            j = j + n
            np.add.at(links, i, w[j])
            np.add.at(links, j, w[i])
            apart = low[i] != low[j]
            if apart.any():
                low = _forest(len(rep), low[i[apart]], low[j[apart]])[low]
        has = np.flatnonzero(links)
        return pa.record_batch({"u": rep[has], "v": rep[low[has]], "n": links[has]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if s == e:
                    continue
                here = tuple(keys[:, s].tolist())
                if here != key:
                    if parts:
                        yield linked(key, parts)
                    key, parts = here, []
                parts.append(batch.slice(s, e - s))
        if parts:
            yield linked(key, parts)

    found = written(met.mapInArrow(run, "u long, v long, n long"), "links")
    counts = found.groupBy("u").agg(F.sum("n").alias("others")).withColumnRenamed("u", "rep")
    roots = components(found.select("u", "v")).withColumnRenamed("node", "rep")
    known = classes.join(counts, "rep", "left").join(roots, "rep", "left").select(
        "x", (F.col("w") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    placed = written(rows.join(known, "x", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rid").alias("root")), "placed")
    lowest = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return placed.join(lowest, "root").select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b
        ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.w, r.c FROM r JOIN l ON l.u = r.vec_id WHERE r.c < l.w),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN m ON m.vec_id = v.vec_id LEFT JOIN n ON n.u = v.vec_id
"""
