"""SimHash near-duplicates by the generalised pigeonhole principle.

``fingerprints`` hashes word shingles to 64-bit fingerprints. ``link`` finds
which fingerprints are within ``max_bits`` differing bits:

1. The 64 bits are grouped into m parts so that correlated bits share a part
   (correlations counted over all fingerprints).
2. Each part i gets a threshold t_i >= -1 with sum(t_i + 1) = max_bits + 1.
   Two fingerprints within max_bits then differ by at most t_i bits in some
   part. A dynamic programme picks the t_i of least estimated cost from the
   number of pairs that share the part's value, counted over all data; t_i = -1
   leaves the part out. m itself is the one of least expected cost at the
   number of fingerprints present, so the parts get wider as the data grow.
3. Every fingerprint sends its part values (and their variants within t_i
   bits) as probes; a probe value gathers its candidates, which are verified by
   the distance of the whole fingerprints.

Values that gather more than ``TILE`` fingerprints are cut into chunks that meet
pairwise in tiles, so no task holds an unbounded group and no pair is lost.
A task emits a spanning forest of what it verified, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, raw_texts, written
from strata.llm.components import components

BITS = 64
TILE = 2048  # most fingerprints of one chunk of a probe value
ROW_COST, PAIR_COST = 2.0, 0.01  # measured microseconds per probe row and per candidate pair


def fingerprint(data: bytes, words_per_shingle: int = 4) -> int:
    """64-bit SimHash of a UTF-8 text.

    A-Z become lower case; words are runs of bytes other than space and
    \\t-\\r; shingles (repeats count) are joined by one space and hashed with
    XXH64, seed 42. Fewer words than a shingle: the whole sequence is the only
    shingle. No word: 0. A bit is set when more than half the hashes set it.
    """
    words = data.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if n <= words_per_shingle:
        return h(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = n - words_per_shingle + 1
    hashes = np.array([h(joined[a:b], 42) for a, b in
                       zip(starts[:last].tolist(), ends[words_per_shingle - 1:].tolist(), strict=True)], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(bits, np.arange(0, last, 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """``rows(text, ...)`` with the text replaced by its fingerprint ``fp``; null text counts as empty."""
    rest = [c for c in rows.columns if c != "text"]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, words_per_shingle) for t in raw_texts(b, "text")], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [pa.array(fp.view(np.int64))], [*rest, "fp"])

    kinds = dict(rows.dtypes)
    return map_batches(rows, batch, ", ".join([f"{c} {kinds[c]}" for c in rest] + ["fp long"]))


def probes(width: int, t: int) -> int:
    """How many values lie within ``t`` bits of a part of ``width`` bits."""
    n, c = 0, 1
    for j in range(t + 1):
        n += c
        c = c * (width - j) // (j + 1)
    return n


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds t_i >= -1 of least summed cost with sum(t_i + 1) == total.

    ``costs[i][t + 1]`` is the cost of threshold t in part i.
    """
    best: list[dict[int, tuple[float, tuple[int, ...]]]] = [{0: (0.0, ())}]
    for row in costs:
        new: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (cost, chosen) in best[-1].items():
            for units, c in enumerate(row):
                if spent + units <= total:
                    cand = (cost + c, (*chosen, units - 1))
                    if spent + units not in new or cand < new[spent + units]:
                        new[spent + units] = cand
        best.append(new)
    return list(best[-1][total][1])


def _costs(n: int, widths: list[int], pairs: list[float], total: int) -> list[list[float]]:
    """Estimated cost of thresholds -1 .. total - 1 per part: probe rows plus candidate pairs.

    Pairs at a threshold: pairs that share the value, times the number of probe values.
    """
    return [[0.0] + [probes(w, t) * (ROW_COST * n + PAIR_COST * p) if t <= w else float("inf")
                     for t in range(total)] for w, p in zip(widths, pairs, strict=True)]


def _widths(m: int) -> list[int]:
    return [BITS // m + (i < BITS % m) for i in range(m)]


def choose_parts(n: int, max_bits: int) -> int:
    """Number of parts of least expected cost for ``n`` evenly spread fingerprints."""
    def cost(m: int) -> float:
        w = _widths(m)
        c = _costs(n, w, [n * n / 2 / 2.0 ** x for x in w], max_bits + 1)
        return sum(c[i][t + 1] for i, t in enumerate(allocate(c, max_bits + 1)))
    return min(range(1, max_bits + 3), key=lambda m: (cost(m), m))


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Bits in m parts of near-equal width; each part takes the bits most correlated with those it has.

    ``together[i, j]`` counts the fingerprints that have bits i and j set.
    """
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(BITS)), []
    for w in _widths(m):
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < w:
            part.append(max(left, key=lambda b: (corr[b, part].sum(), -b)))
            left.remove(part[-1])
        parts.append(sorted(part))
    return parts


def _part_values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), dtype=np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _bit_counts(fps: DataFrame) -> np.ndarray:
    """64 x 64 counts of jointly set bits over all fingerprints, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
        i, j = np.indices((BITS, BITS))
        yield pa.record_batch({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32),
                               "c": total.ravel().astype(np.int64)})

    out = np.zeros((BITS, BITS))
    for i, j, c in fps.select("fp").mapInArrow(run, "i int, j int, c long").groupBy("i", "j").agg(F.sum("c")).collect():
        out[i, j] = c
    return out


def _probe_rows(fps: DataFrame, parts: list[list[int]], t: list[int]) -> DataFrame:
    """``(part, value, fp)``: every part value in use and its variants within the part's threshold.

    Of two values that differ, only the one that has the highest differing
    bit set sends the variant, which is enough to meet the other.
    """
    jobs = [(i, bits, [sum(1 << b for b in c) for r in range(t[i] + 1) for c in combinations(range(len(bits)), r)])
            for i, bits in enumerate(parts) if t[i] >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            signed = b.column(0).to_numpy()
            for i, bits, masks in jobs:
                value = _part_values(signed.view(np.uint64), bits)
                for mask in masks:
                    top = 1 << (mask.bit_length() - 1) if mask else 0
                    own = (value & np.uint64(top)) == top
                    yield pa.record_batch({
                        "part": np.full(int(own.sum()), i, dtype=np.int32),
                        "value": (value[own] ^ np.uint64(mask)).view(np.int64), "fp": signed[own]})

    return fps.select("fp").mapInArrow(run, "part int, value long, fp long")


def forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the distance graph of some fingerprints.

    Breadth first: each reached fingerprint is compared with those not yet
    reached, so a dense group costs little more than one pass.
    """
    left, edges = np.unique(fp), []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                hit = left[near]
                edges += [(int(x), int(y)) for y in hit]
                front += list(hit)
                left = left[~near]
    return edges


class _Union:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (p := self.up.setdefault(x, x)) != x:
            self.up[x] = x = self.up.setdefault(p, p)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


SPREAD = 1024  # parts that the rows of one component are dealt over where its smallest id is joined
SHORT = 48  # runs up to this length are compared by shifting the whole batch


def _verify(key: np.ndarray, fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Forest edges of all runs of equal ``key`` (run numbers, ascending)."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    length = np.diff(np.append(first, len(key)))
    edges: list[tuple[int, int]] = []
    for s, n in zip(first[length > SHORT], length[length > SHORT], strict=True):
        edges += forest(fp[s:s + n], max_bits)
    own = np.repeat((length > 1) & (length <= SHORT), length)
    k, x, seen = key[own], fp[own], _Union()
    for d in range(1, min(SHORT, len(x))):
        near = np.flatnonzero((k[d:] == k[:-d]) & (np.bitwise_count(x[d:] ^ x[:-d]) <= max_bits))
        if not len(near) and not (k[d:] == k[:-d]).any():
            break
        for a, b in zip(x[near].tolist(), x[near + d].tolist(), strict=True):
            if a != b and seen.join(a, b):
                edges.append((a, b))
    return edges


def link(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Distinct ``fps(fp)`` -> edges ``(u, v)`` that connect exactly what distances <= max_bits connect."""
    n = fps.count()
    m = choose_parts(n, max_bits)
    parts = group_bits(_bit_counts(fps), n, m)
    shared = (_probe_rows(fps, parts, [0] * m).groupBy("part", "value").agg(F.count("*").cast("double").alias("c"))
              .groupBy("part").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")))
    pairs = {r["part"]: r["pairs"] for r in shared.collect()}
    t = allocate(_costs(n, [len(p) for p in parts], [pairs.get(i, 0.0) for i in range(m)], max_bits + 1), max_bits + 1)

    rows = _probe_rows(fps, parts, t)
    heavy = written(rows.groupBy("part", "value").agg(F.count("*").alias("c")).filter(F.col("c") > TILE)
                    .select("part", "value", F.ceil(F.col("c") / TILE).cast("int").alias("chunks")), "heavy")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = (rows.join(heavy, ["part", "value"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("own", chunk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("part", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp"))
    tiles = (tiles.repartition("part", "value", "a", "b")
             .sortWithinPartitions("part", "value", "a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            same = np.ones(len(cols[0]), dtype=bool)
            for c in cols[:4]:
                same[1:] &= c[1:] == c[:-1]
            same[:1] = False
            key = np.cumsum(~same)
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = [c[last:] for c in cols]
            yield _edge_batch(_verify(key[:last], cols[4][:last].view(np.uint64), max_bits))
        if rest is not None and len(rest[0]):
            yield _edge_batch(_verify(np.zeros(len(rest[0]), dtype=np.int64), rest[4].view(np.uint64), max_bits))

    return tiles.mapInArrow(run, "u long, v long")


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    e = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.record_batch({"u": np.ascontiguousarray(e[:, 0]), "v": np.ascontiguousarray(e[:, 1])})


def _placed(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows(id, fp, ...)`` with ``root``, the smallest fingerprint of the component, and ``low``, its smallest id."""
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct")
    roots = components(link(fps, max_bits)).withColumnRenamed("node", "fp")
    known = written(fps.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "roots")
    # a component's rows lie in up to SPREAD parts; the parts, not the rows, meet its smallest id
    known = known.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(SPREAD)))
    parts = known.groupBy("root", "part").agg(F.min("low").alias("low"))
    lowest = parts.drop("low").join(parts.groupBy("root").agg(F.min("low").alias("low")), "root")
    return rows.join(known.drop("low").join(lowest, ["root", "part"]).drop("part"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    ``fingerprint``: 16 lower-case hex digits. ``component_id``: smallest
    doc_id reachable by links of at most ``max_bits`` differing bits, itself
    included. Null or empty texts have fingerprint 0 and link like any other;
    null ids stay null and are no component's smallest id (a component of
    null ids only has a null one); repeated rows stay repeated; an empty table
    gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = written(fingerprints(src, words_per_shingle), "fingerprints")
    return _placed(rows, max_bits).select(F.col("id").alias("doc_id"),
                                          F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          F.col("low").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The input without all but one row of each near-duplicate component; same columns.

    The row of the smallest (id, row hashes) stays, null ids last; of identical
    rows one stays. Only ids, fingerprints and row hashes (96 bits) are
    grouped; the texts meet the list of rows to leave out in one anti join.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    keys = ["__row_a", "__row_b"]
    marked = docs.withColumns({keys[0]: F.xxhash64(*cols), keys[1]: F.hash(*cols)})
    src = marked.select(*keys, F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = written(fingerprints(src, words_per_shingle), "fingerprints")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", *keys)
    placed = written(_placed(rows.groupBy(*keys, "id", "fp").agg(F.count("*").alias("copies")), max_bits)
                     .select(*keys, "root", "copies", place.alias("place")), "placed")
    first = placed.groupBy("root").agg(F.min("place").alias("place")).withColumn("first", F.lit(True))
    # joined by the row's place too, so that the rows of a large component lie in many tasks
    judged = written(placed.join(first, ["root", "place"], "left")
                     .select(*keys, "copies", F.col("first").isNotNull().alias("stays")), "judged")
    kept = marked.join(judged.filter(~F.col("stays")).select(*keys), keys, "left_anti")
    again = judged.filter(F.col("stays") & (F.col("copies") > 1)).select(*keys)
    if not again.isEmpty():
        kept = (kept.join(again, keys, "left_anti")
                .unionByName(kept.join(again, keys, "left_semi").dropDuplicates(keys)))
    return kept.select(*docs.columns)
