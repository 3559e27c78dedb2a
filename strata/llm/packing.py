"""Vector best-fit packing of token sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared lengths, what block-diagonal attention costs). An item of n tokens
takes the vector (n, 1, n * n) of them. Items are placed from long to short; an
item goes to the open sequence that the rule likes best among those with room
in all three, and opens a new one only if there is none:

``norm``: least weighted norm of what stays free (tight fits first).
``dot``: largest weighted dot product of the item and what is free.

The vector depends on the length only, so the plan is made from the counts of
the lengths (at most as many numbers as a sequence has tokens): equal open
sequences are kept as one run and equal items are placed run by run, with the
result that item-by-item placing would have. The tokens, pieces and positions
are all computed by Spark tasks; the driver sees the counts alone.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, raw_texts, written
from strata.llm.tokens import tokenizer_encoder

TOKENS = 2048


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence; ``docs`` and ``cost`` default to what ``tokens`` allows at most."""

    tokens: int = TOKENS
    docs: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def caps(self) -> tuple[int, int, int]:
        return self.tokens, self.docs or self.tokens, self.cost or self.tokens ** 2


def plan(counts: dict[int, int], limits: Limits) -> list[tuple[int, int, int, int, int]]:
    """Where the items of each length go.

    Rows (length, first item, items per sequence, first sequence, offset): the
    items of a length are numbered from 0; those from ``first item`` on fill
    consecutive sequences from ``first sequence`` on, from ``offset`` on.
    """
    caps = np.array(limits.caps(), dtype=np.float64)
    weight = np.array(limits.weights) / caps ** 2
    free = np.empty((0, 3))  # what is free in each sequence of a run
    size, seq = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)  # sequences in the run, the first of them
    rows, opened = [], 0

    def score(room: np.ndarray, item: np.ndarray) -> np.ndarray:
        """The less, the better."""
        if limits.rule == "dot":
            return -(weight * room) @ item
        return ((room - item) ** 2) @ weight

    for length in sorted(counts, reverse=True):
        item = np.array([length, 1, length * length], dtype=np.float64)
        if (item > caps).any():
            raise ValueError(f"an item of {length} tokens fits no sequence of {limits}")
        done, total = 0, counts[length]
        while done < total:
            left = total - done
            fits = np.flatnonzero((free >= item).all(axis=1))
            if not len(fits):
                each = int((caps // item).min())  # nothing else has room, so a new sequence is filled
                runs = [(left // each, each)] if left >= each else [(1, left)]
                n, each = runs[0]
                rows.append((length, done, each, opened, 0))
                free = np.vstack([free, caps - each * item])
                size, seq = np.append(size, n), np.append(seq, opened)
                opened, done = opened + n, done + n * each
            else:
                s = score(free[fits], item)
                best = int(np.argmin(s))
                run = fits[best]
                rival = np.min(np.delete(s, best), initial=np.inf)
                if size[run] > 1:
                    rival = min(rival, s[best])
                each, room = 1, free[run] - item
                while each < left and (room >= item).all() and score(room[None], item)[0] < rival:
                    each, room = each + 1, room - item
                n = min(int(size[run]), left // each)
                rows.append((length, done, each, int(seq[run]), int(caps[0] - free[run][0])))
                free = np.vstack([free, room])
                size, seq = np.append(size, n), np.append(seq, seq[run])
                size[run] -= n
                seq[run] += n
                done += n * each
            open_ = (size > 0) & (free[:, :2] >= 1).all(axis=1)
            free, size, seq = free[open_], size[open_], seq[open_]
    return rows


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
           limit: int = TOKENS, with_ids: bool = False) -> DataFrame:
    """The token pieces of every document.

    ``(doc_id, piece, start, length, ids_crc32, task, place)``, and ``ids`` if
    wanted. A document is its ids and ``end_id``; only one longer than
    ``limit`` is cut, its first piece taking what the full ones leave.
    ``(task, length, place)`` numbers the pieces of a length that a task made.
    Null text counts as empty: one piece of the end id alone.
    """
    from pyspark import TaskContext

    def run(batches):
        enc = tokenizer_encoder(path).encode
        end = int(end_id).to_bytes(4, "little")
        task = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, dtype=np.int64)
        for b in batches:
            at, out, ids = [], [], []
            for r, text in enumerate(raw_texts(b, "text")):
                raw = enc(text) + end
                n = len(raw) // 4
                first = 0 if n <= limit else n % limit
                cuts = [0, *range(first or limit, n, limit), n]
                for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    at.append(r)
                    out.append((k, x, y - x, zlib.crc32(raw[4 * x:4 * y]), seen[y - x]))
                    seen[y - x] += 1
                    if with_ids:
                        ids.append(np.frombuffer(raw[4 * x:4 * y], dtype="<i4"))
            a = np.array(out, dtype=np.int64).reshape(-1, 5)
            cols = {"doc_id": b.column(0).take(pa.array(at, pa.int64())), "piece": a[:, 0].astype(np.int32),
                    "start": a[:, 1].copy(), "length": a[:, 2].copy(), "ids_crc32": a[:, 3].copy(),
                    "task": np.full(len(a), task, dtype=np.int32), "place": a[:, 4].copy()}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.record_batch(cols)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
    return src.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def pack(items: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Give every row of ``items(length, task, place, ...)`` its ``sequence_id`` and ``offset``.

    ``items`` must be a written table; (task, length, place) numbers its rows as
    ``pieces`` does. Lengths are positive. The rows stay in place but
    for a join with the counts per (task, length).
    """
    from pyspark.sql import Window

    per_task = items.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = written(per_task.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "task", F.coalesce("before", F.lit(0)).alias("before"), "n"), "before")
    counts = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = np.array(plan(counts, limits), dtype=np.int64).reshape(-1, 5)
    code = rows[:, 0] << 44 | rows[:, 1]  # ascending within a length
    order = np.argsort(code)
    rows, code = rows[order], code[order]
    names = [c for c in items.columns if c not in ("task", "place")]
    numbered = items.join(before.drop("n"), ["length", "task"]).withColumn("item", F.col("before") + F.col("place"))
    numbered = numbered.select(*names, "item")

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        length, item = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "item"))
        _, first, each, seq, off = rows[np.searchsorted(code, length << 44 | item, side="right") - 1].T
        k = item - first
        return pa.RecordBatch.from_arrays(
            [b.column(i) for i in range(len(names))] + [pa.array(seq + k // each), pa.array(off + k % each * length)],
            [*names, "sequence_id", "offset"])

    kinds = dict(items.dtypes)
    return map_batches(numbered, batch, ", ".join(f"`{c}` {kinds[c]}" for c in names)
                       + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                   limits: Limits = Limits(), with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and offset each is packed at.

    Null texts count as empty (one piece, the end id); null ids and repeated
    rows are packed like others; an empty table gives an empty result. Other
    columns are ignored.
    """
    made = written(pieces(docs, path, id_col, text_col, end_id, limits.tokens, with_ids), "pieces")
    return pack(made, limits)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences: ``(sequence_id, ids)`` from pieces made with their ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
