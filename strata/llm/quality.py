"""Document quality by positive-unlabelled learning.

The model learns from trusted positives (label 1) and unlabelled web text and
minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss of a linear function of text statistics. When the second
term falls below zero the step goes against it, as the non-negative estimator
prescribes. The class prior is the share of label 1 among the labelled rows
the model may learn from.

Fitting reads at most ``FIT_ROWS`` positives and ``FIT_ROWS`` unlabelled rows (those of the least
hash), whose statistics reach the driver; scoring covers every row in Spark tasks.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_share, map_batches, raw_texts

FIT_ROWS = 8_000
THRESHOLD = 0.3
N_STATS = 18
_SYMBOLS = bytes(b"#*$%&|<>")
_DROP_BUT = {
    "symbol": bytes(c for c in range(256) if c not in _SYMBOLS),
    "upper": bytes(c for c in range(256) if not 65 <= c <= 90),
    "lower": bytes(c for c in range(256) if not 97 <= c <= 122),
    "digit": bytes(c for c in range(256) if not 48 <= c <= 57),
    "stop": bytes(c for c in range(256) if c not in b".,;:"),
    "bang": bytes(c for c in range(256) if c not in b"!?"),
    "odd": bytes(c for c in range(256) if c not in b"@\\^_~`=+{}[]()/\"-"),
}


def statistics(text: bytes) -> list[float]:
    """What a text looks like, whatever its language; an empty text gives zeros but for its marker."""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if not n:
        return [1.0] + [0.0] * (N_STATS - 1)
    distinct = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    count = {k: len(text.translate(None, drop)) for k, drop in _DROP_BUT.items()}
    pairs = len(set(zip(words[1:], words[:-1], strict=True)))
    chars = sum(map(len, words))
    return [
        0.0, np.log1p(n), min(count["symbol"] / n, 3), min(count["bang"] / n, 3), min(count["odd"] / n, 3),
        min(count["stop"] / n, 2), count["upper"] / size, count["lower"] / size, count["digit"] / size,
        len(distinct) / n, np.log(len(distinct) + 1) / np.log(n + 2), distinct.most_common(1)[0][1] / n,
        same / n, pairs / max(n - 1, 1) if n > 1 else 1.0, 1 - len(set(lines)) / len(lines),
        min(chars / n, 30) / 10, np.log1p(n / len(lines)), (size - chars) / size,
    ]


@dataclass(frozen=True)
class Model:
    """Standardised statistics, weights and bias; ``prior`` and the row counts are for the record."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float
    positives: int
    unlabelled: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_pu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 800, rate: float = 0.03,
           decay: float = 1e-4, pos_n: np.ndarray | None = None, unl_n: np.ndarray | None = None) -> Model:
    """Non-negative risk minimisation by Adam over all given rows, each as often as ``pos_n`` and ``unl_n`` say (once if None)."""
    np_, nu = (np.ones(len(x)) if n is None else n for x, n in ((pos, pos_n), (unl, unl_n)))
    if not len(pos) or not len(unl):
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(N_STATS), 0.0, prior, int(np_.sum()), int(nu.sum()))
    wp, wu = np_ / np_.sum(), nu / nu.sum()
    mean = wu @ unl
    scale = np.maximum(np.sqrt(wu @ (unl - mean) ** 2), 1e-3)
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (pos, unl))
    w, b = np.zeros(N_STATS), np.log(prior / (1 - prior))
    m, v = np.zeros(N_STATS + 1), np.zeros(N_STATS + 1)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for k in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        negative = wu @ np.logaddexp(0, zu) - prior * (wp @ np.logaddexp(0, zp))
        # derivatives of the loss by the margin, averaged
        up = prior * (sig(zp) - 1) * wp
        un_u, un_p = sig(zu) * wu, -prior * sig(zp) * wp
        if negative >= 0:
            gp, gu = up + un_p, un_u
        else:
            gp, gu = -un_p, -un_u
        g = np.append(p.T @ gp + u.T @ gu + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, float(b), prior, int(np_.sum()), int(nu.sum()))


def _sample(rows: DataFrame, n: int) -> list[int]:
    """At most ``n`` ids, those of the least hash (a top-n by partition, then of those)."""
    return [r["id"] for r in rows.select("id").distinct().orderBy(F.xxhash64("id", F.lit(7)), "id").limit(n).collect()]


def _stats_of(docs: DataFrame, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of the rows with these ids, equal ones of an id as one, and how many rows each stands for."""
    if not ids:
        return np.empty((0, N_STATS)), np.empty(0)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch({"id": b.column(0), "x": pa.array([statistics(t) for t in raw_texts(b, "text")], pa.list_(pa.float64()))})

    own = docs.sparkSession.createDataFrame([(i,) for i in ids], "id long")  # at most FIT_ROWS ids
    rows = (map_batches(docs.join(F.broadcast(own), "id").select("id", "text"), batch, "id long, x array<double>")
            .groupBy("id", "x").agg(F.count("*").alias("n")).collect())
    return np.array([r["x"] for r in rows]).reshape(-1, N_STATS), np.array([r["n"] for r in rows], dtype=np.float64)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", folds: int = 5, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from rows whose id's crc32 modulo ``folds`` is not 0.

    Rows without id or label are not learnt from. Without a positive or
    without text the model gives every document the score 0.5.
    """
    learn = id_share(F.col("id"), folds) != 0
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & learn))
    n, ones = marks.agg(F.count("*"), F.sum(F.when(F.col("y") == 1, 1).otherwise(0))).first()
    prior = min(max((ones or 0) / n, 0.01), 0.99) if n else 0.5
    pos = _sample(marks.filter("y = 1"), fit_rows)
    unl = _sample(rows.select("id").filter(F.col("id").isNotNull() & learn), fit_rows)
    (p, pos_n), (u, unl_n) = _stats_of(rows, pos), _stats_of(rows, unl)
    return fit_pu(p, u, prior, pos_n=pos_n, unl_n=unl_n)


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: probability that the label is 1. Null text counts as empty."""

    @F.pandas_udf("double")
    def score(t):
        x = np.array([statistics((s or "").encode("utf-8", "replace")) for s in t]).reshape(-1, N_STATS)
        import pandas as pd

        return pd.Series(model.score(x))

    return docs.withColumn(name, score(F.col(f"`{text_col}`").cast("string")))


def filter_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, with the same columns."""
    own = "__quality_score"
    return scored(docs, model, text_col, own).filter(F.col(own) >= threshold).select(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    A null id counts as the empty text in the fold rule and is never learnt
    from; null text is scored as empty; repeated rows are scored apart; an
    empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = scored(src, train(docs, labels, id_col, text_col, folds=folds))
    return out.select("doc_id", (id_share(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
