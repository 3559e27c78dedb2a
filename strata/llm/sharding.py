"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by (hash of the text, id, row): equal texts lie side by
side. Keys are drawn with a chance that grows with their size, quantiles of
the draw split the order into many small ranges, and the records are counted
per range. A range with too many bytes or rows (a hot text) is split again by
fresh draws from it, until none is left. The records of a range then get
their place in the order by a window over that range alone and the totals of
the ranges before, so bytes up to each record are known exactly, and a shard
is an equal share of them.

A cut inside a small group of equal texts moves to the nearer end of the
group, so only groups larger than ``GROUP_SHARE`` of a shard are divided.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

SHARDS = 16
RANGES_A_SHARD = 32  # ranges to each shard at least
ROWS_A_RANGE = 1_000_000  # more ranges where they would hold more rows than this
DRAWS_A_RANGE = 4
GROUP_SHARE = 0.05  # of a shard's bytes: equal texts up to this size stay together
KEY = "array<struct<h:long,i:string,t:long>>"
_RECORD = "record"


def _literal(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)  # folded to one literal by the optimizer


def _count_up_to(cuts: list, kind: str, key: Column) -> Column:
    """How many of the ascending ``cuts`` are at most ``key``, by binary search."""
    if not cuts:
        return F.lit(0)
    held = _literal(cuts, kind)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(held, at + step - 1) <= key, at + step).otherwise(at))


def _drawn(rows: DataFrame, rate_bytes: float, rate_rows: float, seed: int) -> DataFrame:
    """Keys drawn with chance ``size * rate_bytes + rate_rows``; the same rows on every evaluation."""
    unit = F.pmod(F.xxhash64("h", "i", "t", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    return rows.filter(unit < F.col("size") * rate_bytes + rate_rows).select("h", "i", "t")


def _splitters(rows: DataFrame, n_rows: int, n_bytes: int, n_ranges: int) -> tuple[list, list[tuple[int, int]]]:
    """Ascending cut keys and (rows, bytes) of each range between them; no range is overfull."""
    most_rows, most_bytes = -(-2 * n_rows // n_ranges), -(-2 * n_bytes // n_ranges)
    rate = DRAWS_A_RANGE * n_ranges / 2
    order = [F.asc_nulls_first(c) for c in ("h", "i", "t")]

    def keys(sample: DataFrame) -> list[dict]:
        return [r.asDict() for r in sample.orderBy(*order).collect()]

    drawn = keys(_drawn(rows, rate / n_bytes, rate / n_rows, 0))
    cuts = drawn[DRAWS_A_RANGE - 1::DRAWS_A_RANGE] if len(drawn) > n_ranges else drawn
    seed, key = 0, F.struct("h", "i", "t")
    while True:
        found = {r["range"]: r for r in rows.groupBy(_count_up_to(cuts, KEY, key).alias("range")).agg(
            F.count("*").alias("n"), F.sum("size").alias("b"), F.max("size").alias("top")).collect()}
        over = [k for k, r in found.items() if r["n"] > 1 and (r["n"] > most_rows or r["b"] - r["top"] > most_bytes)]
        if not over:
            return cuts, [(found[k]["n"], found[k]["b"]) if k in found else (0, 0) for k in range(len(cuts) + 1)]
        seed += 1
        inside = rows.filter(_count_up_to(cuts, KEY, key).isin(over))
        more = keys(_drawn(inside, rate / n_bytes, rate / n_rows, seed))
        cuts = sorted({(k["h"], k["i"] is not None, k["i"] or "", k["t"]): k for k in [*cuts, *more]}.items(),
                      key=lambda kv: (kv[0][0], kv[0][1], kv[0][2].encode(), kv[0][3]))
        cuts = [k for _, k in cuts]


def assign(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           records: bool = False) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    ``size`` is the UTF-8 bytes of the text plus 1 (null text: 1; null and
    empty texts are two groups). Law ``bytes``: a shard holds an equal share
    of the bytes but for one record (or a small group of equal texts) at each
    end. ``slot`` numbers a shard's rows from 0. Null ids sort first; repeated
    rows keep a slot each; an empty table gives an empty result; with fewer
    rows than shards some shards stay empty. Other columns are ignored, or
    with ``records`` carried as the struct ``record``.
    """
    text, row_id = F.col(text_col).cast("string"), F.col(id_col)
    spark, kept = docs.sparkSession, [F.struct("*").alias(_RECORD)] if records else []
    rows = written(docs.select(
        row_id.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"),
        F.format_string("%020d", row_id.cast("long")).alias("i"), *kept)
        .withColumn("i", F.when(F.col("doc_id").isNotNull(), F.col("i")))
        .withColumn("t", F.monotonically_increasing_id()), "sizes")
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    out = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law")]
    if not total["n"]:
        return rows.select(*out, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"), *[_RECORD] * records)
    n_ranges = min(total["n"], max(n_shards * RANGES_A_SHARD, total["n"] // ROWS_A_RANGE))
    cuts, held = _splitters(rows, total["n"], total["b"], n_ranges)
    before_rows, before_bytes = [0], [0]
    for n, b in held:
        before_rows.append(before_rows[-1] + n)
        before_bytes.append(before_bytes[-1] + b)
    ordered = Window.partitionBy("range").orderBy(*[F.asc_nulls_first(c) for c in ("h", "i", "t")])
    upto = F.coalesce(F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = written(
        rows.withColumn("range", _count_up_to(cuts, KEY, F.struct("h", "i", "t")))
        .withColumns({"row": F.row_number().over(ordered) - 1 + F.get(_literal(before_rows, "array<long>"), F.col("range")),
                      "bytes": upto + F.get(_literal(before_bytes, "array<long>"), F.col("range"))})
        .drop("range", "i", "t"), "placed")
    starts = _starts(placed, n_shards, total["n"], total["b"])
    shard = _count_up_to(starts[1:], "array<long>", F.col("row")).cast("int")
    return placed.withColumn("shard", shard).select(
        *out, "shard", (F.col("row") - F.get(_literal(starts, "array<long>"), F.col("shard"))).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *[_RECORD] * records)


def _starts(placed: DataFrame, n_shards: int, n_rows: int, n_bytes: int) -> list[int]:
    """The first row of each shard; cuts inside small groups of equal texts moved to an end of the group."""
    share = F.expr(f"(cast({n_shards} as decimal(10)) * (2 * bytes + size)) div (2 * {n_bytes})").cast("int")
    first = {r["s"]: r["row"] for r in placed.groupBy(F.least(share, F.lit(n_shards - 1)).alias("s"))
             .agg(F.min("row").alias("row")).collect()}
    starts = [n_rows] * n_shards
    for s in reversed(range(n_shards)):
        starts[s] = first.get(s, starts[s + 1] if s + 1 < n_shards else n_rows)
    starts[0] = 0
    near = {r["row"]: r for r in placed.filter(F.col("row").isin([x + d for x in starts for d in (-1, 0)]))
            .select("row", "h", "bytes").collect()}
    inside = [s for s in range(1, n_shards) if starts[s] in near and starts[s] - 1 in near
              and near[starts[s]]["h"] == near[starts[s] - 1]["h"]]
    groups = {r["h"]: r for r in placed.filter(F.col("h").isin([near[starts[s]]["h"] for s in inside])).groupBy("h").agg(
        F.min("row").alias("first"), F.max("row").alias("last"), F.min("bytes").alias("at"),
        F.sum("size").alias("b")).collect()} if inside else {}
    for s in inside:
        here, group = near[starts[s]], groups[near[starts[s]]["h"]]
        if group["b"] <= GROUP_SHARE * n_bytes / n_shards:
            nearer_start = 2 * (here["bytes"] - group["at"]) <= group["b"]
            starts[s] = group["first"] if nearer_start else group["last"] + 1
    return starts


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, rows_a_file: int = 1_000_000,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write all records, with every column, under ``path/shard=<n>``, in slot order within each file."""
    made = assign(docs, n_shards, id_col, text_col, records=True)
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    (made.withColumn("_file", F.floor(F.col("slot") / rows_a_file))
     .repartition("shard", "_file").sortWithinPartitions("shard", "slot")
     .select(*[F.col(_RECORD)[c].alias(c) for c in names], "shard", "slot").write.partitionBy("shard").parquet(path))
