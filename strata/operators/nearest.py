"""The exact nearest rows of any number of requests, by cells in a tree of cuts.

The space is cut at medians, always along the feature that varies most, into cells of about ``TILE`` history rows, so
the cells grow in number with the history and not in size. The cuts come from a bounded sample; every row is placed.
A request first meets its own cell, which bounds the distance of its k-th neighbour by u; after that only cells whose
box (the least and greatest values of their rows) comes within u can hold a nearer row. They are found from the root down.
Rows and requests meet in blocks, as tables: hot cells are cut into tiles, requests for a cell into blocks, and
each pair of both is a row of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ranks import materialize

PIVOTS, RINGS = 64, 8  # their product is the least number of cells aimed at
TILE, BLOCK = 2048, 512  # history rows and requests that meet at once
SLACK = 1e-9  # relative, against rounding in the bounds
PER_CELL = 32  # sampled rows for each cell
SAMPLED = 4_000_000  # numbers in the sample at most
PAIRS = 2_000_000  # bounds that a task holds at once


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(rows of x, rows of y); the squares are added feature by feature."""
    acc = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = y[None, :, j] - x[:, j][:, None]
        acc += d * d
    return np.sqrt(acc)


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & (F.size(v) > 0) & fine)


def _top(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class _Cuts:
    """A tree of cuts, its root is node 0: rows at or below ``cut`` in feature ``dim`` go left; children come after parents."""

    def __init__(self, x: np.ndarray, most: int):
        self.dim, self.cut, self.left, self.right, self.cell = [], [], [], [], []
        waiting, self.cells = [(x, None, None)], 0
        while waiting:
            rows, parent, side = waiting.pop()
            node = len(self.dim)
            if parent is not None:
                side[parent] = node
            for column, value in ((self.dim, 0), (self.cut, 0.0), (self.left, node), (self.right, node), (self.cell, -1)):
                column.append(value)
            j = int(np.ptp(rows, axis=0).argmax() if len(rows) < 3 else rows.std(axis=0).argmax())
            values = rows[:, j]
            if len(rows) <= most or values.min() == values.max():
                self.cell[node], self.cells = self.cells, self.cells + 1
                continue
            cut = np.partition(values, (len(rows) - 1) // 2)[(len(rows) - 1) // 2]
            if cut == values.max():
                cut = values[values < cut].max()
            self.dim[node], self.cut[node] = j, cut
            waiting += [(rows[values <= cut], node, self.left), (rows[values > cut], node, self.right)]
        self.dim, self.cut, self.left, self.right, self.cell = map(np.array, (self.dim, self.cut, self.left, self.right, self.cell))

    def place(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while (self.cell[node] < 0).any():  # a leaf leads to itself
            node = np.where(x[rows, self.dim[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.cell[node]

    def boxes(self, cell: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Boxes of all nodes from those of the cells; an empty cell's box is infinitely far."""
        width = lo.shape[1]
        self.lo, self.hi = np.full((len(self.dim), width), np.inf), np.full((len(self.dim), width), -np.inf)
        leaf = np.flatnonzero(self.cell >= 0)
        at = np.empty(self.cells, np.int64)
        at[self.cell[leaf]] = leaf
        self.lo[at[cell]], self.hi[at[cell]] = lo, hi
        for node in np.flatnonzero(self.cell < 0)[::-1]:
            both = [self.left[node], self.right[node]]
            self.lo[node], self.hi[node] = self.lo[both].min(axis=0), self.hi[both].max(axis=0)

    def gap(self, x: np.ndarray, row: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Distance from ``x[row]`` to the box of ``node``, a little less against rounding."""
        acc, size = np.zeros(len(row)), np.zeros(len(row))
        for j in range(x.shape[1]):
            v, lo, hi = x[row, j], self.lo[node, j], self.hi[node, j]
            d = np.maximum(np.maximum(lo - v, v - hi), 0.0)
            acc += d * d
            size = np.maximum(size, np.abs(v))
        return np.sqrt(acc) * (1 - SLACK) - SLACK * size

    def within(self, x: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row of x, cell)`` of all cells with rows whose box comes within ``u`` of the row."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        step = max(1, PAIRS // self.cells)
        for i in range(0, len(x), step):
            row = np.arange(i, min(i + step, len(x)))
            node = np.zeros(len(row), np.int64)
            while len(row):
                keep = (self.gap(x, row, node) <= u[row]) & (self.lo[node, 0] <= self.hi[node, 0])
                row, node = row[keep], node[keep]
                leaf = self.cell[node] >= 0
                found.append((row[leaf], self.cell[node[leaf]]))
                row, node = row[~leaf], node[~leaf]
                row, node = np.concatenate([row, row]), np.concatenate([self.left[node], self.right[node]])
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def nearest_of(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The one of ``cells`` whose box is nearest to each row of ``x``."""
        leaf = np.flatnonzero(self.cell >= 0)
        nodes = leaf[np.isin(self.cell[leaf], cells)]
        out = np.empty(len(x), np.int64)
        step = max(1, PAIRS // len(nodes))
        for i in range(0, len(x), step):
            row = np.arange(i, min(i + step, len(x)))
            gaps = self.gap(x, np.repeat(row, len(nodes)), np.tile(nodes, len(row))).reshape(len(row), -1)
            out[row] = self.cell[nodes[gaps.argmin(axis=1)]]
        return out


def nearest(requests: DataFrame, history: DataFrame, key: str, vector: str, k: int = 3, pivots: int = PIVOTS,
            rings: int = RINGS, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``(query_id, neighbor_id, distance, rank)``: the ``k`` nearest history rows of every request (Euclidean).

    Exact; ties by the smaller key; a row of the request's own key is no neighbour. Request keys are unique;
    repeated history rows count each. Rows with a null key, a null or empty vector or components that are
    null or not finite take no part, nor do vectors of another length than the history's row of least hash.
    Without history the result is empty. ``pivots * rings`` cells are aimed at, more if they would hold over
    ``tile`` rows each.
    """
    spark = history.sparkSession
    rows, asked = _usable(history, key, vector), _usable(requests, key, vector)
    first = rows.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(1).collect()
    if not first:
        return spark.createDataFrame([], "query_id long, neighbor_id long, distance double, rank int")
    width = len(first[0]["v"])
    same = F.size("v") == width
    rows = materialize(rows.where(same))
    n = rows.count()
    cells = max(pivots * rings, -(-n // tile))
    every = max(1, -(-n // max(1, min(cells * PER_CELL, SAMPLED // width))))
    # the row's number in its file part is hashed too: copies of one key are not all in or out
    picked = (rows.where(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(every)) == 0).select("v").toArrow()
              .column(0).combine_chunks() if every > 1 else rows.select("v").toArrow().column(0).combine_chunks())
    sample = _matrix(picked) if len(picked) else np.array([first[0]["v"]])
    cuts = _Cuts(sample, max(4, -(-len(sample) // cells)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.record_batch({"id": b.column(0), "v": b.column(1),
                                       "cell": pa.array(cuts.place(_matrix(b.column(1))), pa.int32())})

    placed = materialize(rows.mapInArrow(place, "id long, v array<double>, cell int"))
    bounds = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.array(*[F.min(F.col("v")[j]) for j in range(width)]).alias("lo"),
        F.array(*[F.max(F.col("v")[j]) for j in range(width)]).alias("hi")).collect()  # a row for about `tile` of the history
    salts = {r["cell"]: -(-r["n"] // tile) for r in bounds}
    cuts.boxes(*(np.array([r[c] for r in bounds]) for c in ("cell", "lo", "hi")))
    filled = np.array([r["cell"] for r in bounds if r["n"] > k], np.int64)  # enough for k besides itself

    def sizes(blocks: dict[int, int]) -> DataFrame:
        return F.broadcast(spark.createDataFrame([(c, s, blocks.get(c, 0)) for c, s in salts.items()],
                                                 "cell int, salts long, blocks long"))

    tiles = materialize(placed.withColumn("_n", F.monotonically_increasing_id()).join(sizes({}), "cell")
                        .groupBy("cell", F.pmod("_n", "salts").alias("salt"))
                        .agg(F.collect_list(F.struct("id", "v")).alias("rows")))

    def home(x: np.ndarray) -> np.ndarray:
        if not len(filled):
            return np.full(len(x), -1)
        cell = cuts.place(x)
        poor = ~np.isin(cell, filled)
        if poor.any():
            cell[poor] = cuts.nearest_of(x[poor], filled)
        return cell

    def visits(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = _matrix(b.column(1))
                own = home(x)
                if first:
                    who, cell = np.flatnonzero(own >= 0), own[own >= 0]
                else:
                    u = b.column(2).to_numpy(zero_copy_only=False)  # null: not a number, no bound
                    who, cell = cuts.within(x, np.where(np.isnan(u), np.inf, u))
                    who, cell = who[cell != own[who]], cell[cell != own[who]]
                yield pa.record_batch({"id": b.column(0).take(pa.array(who)), "v": b.column(1).take(pa.array(who)),
                                       "cell": pa.array(cell, pa.int32())})
        return run

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for asks, held in zip(b.column(0), b.column(1), strict=True):
                (q_ids, q), (h_ids, h) = ((s.field("id").to_numpy(), _matrix(s.field("v"))) for s in (asks.values, held.values))
                d = _distances(q, h)
                d[q_ids[:, None] == h_ids[None, :]] = np.inf
                by = np.lexsort((np.broadcast_to(h_ids, d.shape), d), axis=1)[:, :k]
                near = np.take_along_axis(d, by, axis=1)
                found = np.isfinite(near)
                yield pa.record_batch({"query_id": np.broadcast_to(q_ids[:, None], by.shape)[found],
                                       "neighbor_id": h_ids[by][found], "distance": near[found]})

    def meet(going: DataFrame) -> DataFrame:
        going = materialize(going)
        blocks = {r["cell"]: -(-r["count"] // block) for r in going.groupBy("cell").count().collect()}
        size = sizes(blocks)
        asks = (going.join(size, "cell")
                .groupBy("cell", "salts", F.pmod(F.xxhash64("id"), "blocks").alias("block"))
                .agg(F.collect_list(F.struct("id", "v")).alias("asks"))
                .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts"))
        held = (tiles.join(size, "cell").where(F.col("blocks") > 0)
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
        return (asks.join(held, ["cell", "salt", "block"]).select("asks", "rows")
                .mapInArrow(best, "query_id long, neighbor_id long, distance double"))

    asked = asked.where(same)
    form = "id long, v array<double>, cell int"
    found = materialize(_top(meet(asked.mapInArrow(visits(True), form)), k))
    bound = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("u"))
    more = meet(asked.join(bound, "id", "left").select("id", "v", "u").mapInArrow(visits(False), form))
    return _top(found.drop("rank").unionByName(more), k)
