"""Token-count rollups kept by signed deltas.

A store holds one folder of signed rows per batch, already summed by (source, lang,
version). A batch is written once under its id; giving the same id again
changes nothing, so a batch may be replayed after a failure. Inserts add, deletes subtract,
revised counts subtract the old and add the new row.

``fold`` adds the batches committed since the last snapshot to its totals and writes a new snapshot beside the
ids of all batches in it. ``totals`` reads the last snapshot and the batches not in it, so a read costs one row
for each group and what is new, however many batches came before. Their folders stay as marks
that keep replays out, and are read no more. One writer folds at a time; commits may run beside it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_batches, raw_texts
from strata.llm.tokens import tokenizer_encoder

KEYS = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, docs long, tokens long"


def counted(docs: DataFrame, paths: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, source, lang, version, n_tokens)``: a row per document and tokenizer version.

    ``paths``: tokenizer file of each version. Null text counts as empty (0
    tokens); null source or language is a group of its own.
    """
    names = list(paths)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw_texts(b, "text")
        per = [[len(tokenizer_encoder(p).encode(t)) // 4 for t in texts] for p in paths.values()]
        n = len(texts)
        at = pa.array([i for _ in names for i in range(n)], pa.int64())
        return pa.record_batch({
            "doc_id": b.column(0).take(at), "source": b.column(1).take(at), "lang": b.column(2).take(at),
            "version": pa.array([v for v in names for _ in range(n)], pa.string()),
            "n_tokens": pa.array([x for p in per for x in p], pa.int64())})

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, batch, "doc_id long, source string, lang string, version string, n_tokens long")


def signed(rows: DataFrame, sign: int | Column) -> DataFrame:
    """Deltas of ``counted`` rows: +1 for inserted, -1 for deleted ones."""
    s = F.lit(sign) if isinstance(sign, int) else sign
    return rows.select(*KEYS, s.cast("long").alias("docs"), (s * F.col("n_tokens")).cast("long").alias("tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Deltas of rows whose count, source, language or version changed from ``old`` to ``new``."""
    return signed(old, -1).unionByName(signed(new, 1))


class Rollup:
    """A store under ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def committed(self, batch: str) -> bool:
        return self._exists(f"{self.path}/batch={batch}/_SUCCESS")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add the summed deltas as ``batch``; False if that batch was committed before.

        A write that failed half way left no ``_SUCCESS`` mark and is overwritten.
        """
        if self.committed(batch):
            return False
        (deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.mode("overwrite").parquet(f"{self.path}/batch={batch}"))
        return True

    def _numbers(self, prefix: str) -> list[str]:
        if not self._exists(self.path):
            return []
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        names = sorted(f.getPath().getName() for f in found)
        return [n[len(prefix):] for n in names if n.startswith(prefix)]

    def batches(self) -> list[str]:
        return [n for n in self._numbers("batch=") if self.committed(n)]

    def _snapshot(self) -> tuple[int, set[str]]:
        """Number of the last whole snapshot (0: none) and the batches in it; its ids are written last."""
        for n in sorted(map(int, self._numbers("snapshot=")), reverse=True):
            at = f"{self.path}/snapshot={n}"
            if self._exists(f"{at}/ids/_SUCCESS"):
                return n, {r["id"] for r in self.spark.read.schema("id string").parquet(f"{at}/ids").collect()}
        return 0, set()

    def _sum(self, snapshot: int, new: list[str]) -> DataFrame:
        paths = [f"{self.path}/snapshot={snapshot}/totals"] * (snapshot > 0) + [f"{self.path}/batch={b}" for b in new]
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return (rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter((F.col("docs") != 0) | (F.col("tokens") != 0)))

    def _new(self, folded: set[str]) -> list[str]:
        return [b for b in self._numbers("batch=") if b not in folded and self.committed(b)]

    def fold(self) -> bool:
        """Add the new batches to the snapshot; False if there are none.

        A fold that failed half way left no mark beside its ids, is not read and is overwritten by the next.
        """
        last, folded = self._snapshot()
        new = self._new(folded)
        if not new:
            return False
        at = f"{self.path}/snapshot={last + 1}"
        self._sum(last, new).write.mode("overwrite").parquet(f"{at}/totals")
        ids = self.spark.createDataFrame([(b,) for b in sorted(folded | set(new))], "id string")
        ids.write.mode("overwrite").parquet(f"{at}/ids")
        return True

    def totals(self) -> DataFrame:
        """``(source, lang, version, docs, tokens)``; groups whose documents are all gone are left out."""
        last, folded = self._snapshot()
        return self._sum(last, self._new(folded))
