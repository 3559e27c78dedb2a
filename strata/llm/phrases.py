"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut at punctuation into pieces and these into words. The edges of
the graph are grams of ``longest`` words, its nodes grams of one word less:
an edge leads from its first words to its last. Only edges are counted from
the texts, and how each piece ends (its last words, fewer than an edge has).

An occurrence of a node is either followed by a word, which makes an edge, or
ends its piece: its count is the weight of the edges out of it plus its piece
ends. In the same way every shorter gram's count is the sum of the counts of
the grams one word longer that it begins, plus its piece ends.

A node whose count equals the weight of one edge in and of one edge out is
unary: nothing else passes it. Edges joined by such nodes are compacted into
paths (by pointer doubling, all paths at once). Its nodes never occur outside
the path, so none of them is a phrase of its own.

A word, or a pair of neighbours, with fewer than ``least`` occurrences is in
no phrase of ``least`` occurrences, so pieces are also cut at such words and
between such neighbours, which loses no phrase. Which ones are frequent is
told to the tasks by bitmaps of fixed size over 64-bit hashes: a rare one that
shares a bit with a frequent one is kept and only costs time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ranks import bounded_broadcast
from strata.llm.common import raw_texts, written

LONGEST = 5
LEAST = 100
TOP = 2000
BITS = 24  # a bitmap of frequent words or pairs has 2**BITS bits
TEXT_BYTES = 1 << 20  # text of a language taken at a time
HELD = 200_000  # distinct grams that a task counts before it hands them on
PAIRS = 4_000_000  # hashes of pairs that a task counts at a time
ROWS_A_SALT = 100_000  # candidates ranked in one window
#: floor(1000 * a * total / (l * r)) in 38 digits
SCORE = ("(cast(a as decimal(18, 0)) * cast(total as decimal(18, 0)) * 1000) div "
         "(cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")

_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


def _flat(texts: list[bytes]) -> list[bytes | None]:
    """The words of all pieces in a row, A-Z in lower case; None after each piece."""
    out: list[bytes | None] = []
    for piece in b"\n".join(texts).lower().translate(_ENDS).split(b"\n"):
        out += piece.split()
        out.append(None)
    return out


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time, ``TEXT_BYTES`` of them or one longer text."""
    held: dict[str, list] = {}
    for lang, text in zip(batch.column(0).to_pylist(), raw_texts(batch, "text"), strict=True):
        own = held.setdefault(lang, [0])
        own[0] += len(text)
        own.append(text)
        if own[0] >= TEXT_BYTES:
            yield lang, own[1:]
            del held[lang]
    for lang, own in held.items():
        yield lang, own[1:]


def _langs(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))


class _Counts:
    """Counts of grams by language, handed on as Arrow batches when many are held."""

    def __init__(self) -> None:
        self.of: dict[str, defaultdict[bytes, int]] = {}

    def batches(self, at_least: int) -> Iterator[pa.RecordBatch]:
        if sum(map(len, self.of.values())) < at_least:
            return
        for lang, counts in self.of.items():
            yield pa.record_batch({
                "lang": pa.array([lang] * len(counts), pa.string()),
                "gram": pa.array(list(counts), pa.binary()).cast(pa.string()),
                "n": pa.array(list(counts.values()), pa.int64())})
        self.of = {}


def _counted(docs: DataFrame, adder) -> DataFrame:
    """``(lang, gram, n)``, every gram once; ``adder()(lang, texts, counts)`` adds the grams of texts."""

    def run(batches):
        add, held = adder(), _Counts()
        for b in batches:
            for lang, texts in _by_lang(b):
                add(lang, texts, held.of.setdefault(lang, defaultdict(int)))
                yield from held.batches(HELD)
        yield from held.batches(1)

    return docs.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` of single words."""

    def adder():
        def add(lang, texts, counts):
            for w in _flat(texts):
                counts[w] += 1
            del counts[None]
        return add

    return _counted(_langs(docs, text_col, lang_col), adder)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits at the upper ``BITS`` bits of ``h``; at most 2**BITS / 64 rows come to the driver."""
    got = (hashes.select(F.shiftrightunsigned("h", 64 - BITS).alias("at")).select(
        F.shiftright("at", 6).alias("cell"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("mask"))
        .groupBy("cell").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    bits = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    bits[got["cell"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return bits


def _is_set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


class _Hashes(dict):
    """Hash of each word of a language, 0 for a rare one and for the end of a piece."""

    def __init__(self, lang: str, bits: np.ndarray) -> None:
        super().__init__()
        self.seed, self.bits = xxhash.xxh64_intdigest(lang.encode(), 42), bits

    def __missing__(self, word: bytes | None) -> int:
        h = 0 if word is None else xxhash.xxh64_intdigest(word, self.seed)
        at = h >> 64 - BITS
        if word is None or not int(self.bits[at >> 6]) >> (at & 63) & 1:
            h = 0
        if len(self) >= HELD:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes | None]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _pair_hashes(h: np.ndarray) -> np.ndarray:
    x = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _pairs(docs: DataFrame, words) -> DataFrame:
    """``(h, n)`` of neighbouring frequent words; ``words``: the broadcast bitmap of those."""

    def run(batches):
        langs: dict[str, _Hashes] = {}
        held: list[np.ndarray] = []

        def out():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch({"h": h.view(np.int64), "n": n.astype(np.int64)})

        for b in batches:
            for lang, texts in _by_lang(b):
                h = langs.setdefault(lang, _Hashes(lang, words.value)).of(_flat(texts))
                held.append(_pair_hashes(h)[(h[:-1] != 0) & (h[1:] != 0)])
                if sum(map(len, held)) >= PAIRS:
                    yield out()
        if held:
            yield out()

    return docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def graph(docs: DataFrame, words: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """``(lang, gram, n)``: the edges (grams of ``longest`` words) and the piece ends (the shorter grams)."""
    sc, src = docs.sparkSession.sparkContext, _langs(docs, text_col, lang_col)
    many = F.col("n") >= least
    frequent = sc.broadcast(_bitmap(words.filter(many).select(F.xxhash64("lang", "gram").alias("h"))))
    pairs = sc.broadcast(_bitmap(_pairs(src, frequent).filter(many)))

    def adder():
        langs: dict[str, _Hashes] = {}
        join = b" ".join

        def add(lang, texts, counts):
            flat = _flat(texts)
            h = langs.setdefault(lang, _Hashes(lang, frequent.value)).of(flat)
            word = h != 0
            link = np.zeros(len(h) + 1, dtype=bool)  # of a word to the one after it
            link[1:-1] = word[:-1] & word[1:] & _is_set(pairs.value, _pair_hashes(h))
            first, last = np.flatnonzero(word & ~link[:-1]), np.flatnonzero(word & ~link[1:])
            for at in first[first == last].tolist():
                counts[flat[at]] += 1
            more = first < last
            for start, end in zip(first[more].tolist(), (last[more] + 1).tolist(), strict=True):
                for i in range(start, end - longest + 1):
                    counts[join(flat[i:i + longest])] += 1
                counts[join(flat[max(start, end - longest + 1):end])] += 1

        return add

    return _counted(src, adder)


def _first(k: int) -> Column:
    return F.substring_index("gram", " ", k)


def _last(k: int) -> Column:
    return F.substring_index("gram", " ", -k)


def _words(gram: Column | str = "gram") -> Column:
    gram = F.col(gram) if isinstance(gram, str) else gram
    return F.length(gram) - F.length(F.replace(gram, F.lit(" "), F.lit(""))) + 1


def gram_counts(made: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``(lang, gram, k, n)`` of all grams of 1 to ``longest`` words with ``least`` occurrences, from node flow.

    ``made``: the written rows of ``graph``.
    """
    made = made.withColumn("k", _words())
    flow = made.filter(F.col("k") == longest).select("lang", "gram", "n")
    heavy = [flow.filter(F.col("n") >= least).withColumn("k", F.lit(longest))]
    for k in range(longest - 1, 0, -1):
        ends = made.filter((F.col("k") >= k) & (F.col("k") < longest))
        flow = written(flow.select("lang", _first(k).alias("gram"), "n").unionByName(
            ends.select("lang", _last(k).alias("gram"), "n")).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "flow")
        heavy.append(flow.filter(F.col("n") >= least).withColumn("k", F.lit(k)))
    rows = heavy[0]
    for h in heavy[1:]:
        rows = rows.unionByName(h)
    return written(rows.select("lang", "gram", "k", "n"), "grams")


def paths(grams: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Edges on compacted paths: ``(lang, gram, n, head, place)``, the edge's path by its first edge and its place in it.

    ``grams``: rows of ``gram_counts``. A path's edges all have the path's
    weight; an edge that nothing continues is a path of its own.
    """
    edges = grams.filter(F.col("k") == longest).select("lang", "gram", "n")
    nodes = grams.filter(F.col("k") == longest - 1).select("lang", F.col("gram").alias("node"), "n")
    into = edges.select("lang", _last(longest - 1).alias("node"), "n", F.col("gram").alias("before"))
    unary = nodes.join(into, ["lang", "node", "n"])
    at = written(edges.withColumn("node", _first(longest - 1)).join(unary, ["lang", "node", "n"], "left").select(
        "lang", "gram", "n", F.coalesce("before", "gram").alias("head"),
        F.col("before").isNotNull().cast("long").alias("place")), "paths")
    reach = at.agg(F.sum("place")).first()[0]
    while reach:
        there = at.select("lang", F.col("gram").alias("head"), F.col("head").alias("far"), F.col("place").alias("more"))
        at = written(at.join(there, ["lang", "head"]).select(
            "lang", "gram", "n", F.col("far").alias("head"), (F.col("place") + F.col("more")).alias("place")), "paths")
        now = at.agg(F.sum("place")).first()[0]
        if now == reach:
            break
        reach = now
    return at


def long_phrases(at: DataFrame) -> DataFrame:
    """``(lang, phrase, n, edges)``: each path as one phrase; it is no longer than the longest piece."""
    return at.groupBy("lang", "head").agg(
        F.first("n").alias("n"), F.count("*").alias("edges"),
        F.array_sort(F.collect_list(F.struct("place", F.substring_index("gram", " ", -1).alias("word")))).alias("w")
    ).select("lang", F.concat_ws(" ", "head", F.expr("transform(slice(w, 2, size(w)), x -> x.word)")).alias("phrase"),
             "n", "edges")


def _phrases(grams: DataFrame, at: DataFrame, longest: int) -> DataFrame:
    """Grams of two words or more that no longer one holds with the same count.

    Counts do not grow with length, so it is enough to look one word further.
    A node inside a path is held by its edges; for one at the end of a path
    and for shorter grams the counts are compared.
    """
    inner = at.filter(F.col("place") > 0).select("lang", _first(longest - 1).alias("gram"))
    last = F.max_by("gram", "place")
    ends = at.groupBy("lang", "head").agg(F.first("n").alias("n"), last.alias("tail")).select(
        "lang", "n", F.explode(F.array(F.substring_index("head", " ", longest - 1),
                                       F.substring_index("tail", " ", 1 - longest))).alias("gram"))
    longer = grams.filter((F.col("k") > 2) & (F.col("k") < longest))
    cut = F.array(F.expr("substring_index(gram, ' ', k - 1)"), F.expr("substring_index(gram, ' ', 1 - k)"))
    held = ends.unionByName(longer.select("lang", "n", F.explode(cut).alias("gram"))).distinct()
    return (grams.filter(F.col("k") > 1).join(inner.distinct(), ["lang", "gram"], "left_anti")
            .join(held, ["lang", "gram", "n"], "left_anti"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language.

    ``a``: occurrences of the phrase; ``l``, ``r``: those of the two parts it
    is cut into where ``score = floor(1000 * a * n / (l * r))`` is least
    (ties: the shortest first part); ``n``: words of the language. Ordered by
    score and ``a``, both descending, then by the phrase's bytes. A null text
    counts as empty, a null language as ``und``; repeated rows count as often
    as they occur; an empty table, or one without a frequent phrase, gives an
    empty result; other columns are ignored.
    """
    words = written(word_counts(docs, text_col, lang_col), "words")
    grams = gram_counts(written(graph(docs, words, longest, least, text_col, lang_col), "graph"), longest, least)
    found = _phrases(grams, paths(grams, longest), longest)
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    cuts = found.select("lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), "k",
                        F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j")).select(
        "*", F.expr("substring_index(phrase, ' ', j)").alias("left"),
        F.expr("substring_index(phrase, ' ', j - k)").alias("right"))
    part = grams.select("lang", "gram", "n")
    both = (cuts.join(part.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"])
            .join(part.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"])
            .join(bounded_broadcast(totals, known_rows=totals.count()), "lang"))
    best = written(both.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("total").alias("n"),
        F.min(F.struct(F.expr(SCORE).alias("score"), "j", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(1 + best.count() // ROWS_A_SALT))
    some = best.withColumn("salt", salt).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
  FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM t),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, gram, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram
        FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
  GROUP BY lang, k, gram HAVING count(*) >= 100),
c AS (SELECT lang, k, gram, f, string_split(gram, ' ') AS w FROM g WHERE k > 1),
held AS (
  SELECT DISTINCT lang, f, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS gram FROM c),
cand AS (SELECT c.* FROM c ANTI JOIN held USING (lang, gram, f)),
cuts AS (SELECT lang, gram, f, unnest(range(1, k)) AS j, w, k FROM cand),
s AS (
  SELECT x.lang, x.gram, x.f AS a, x.j, l.f AS l, r.f AS r, total.n,
         CAST((1000::HUGEINT * x.f * total.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts x JOIN g l ON l.lang = x.lang AND l.gram = array_to_string(x.w[1:x.j], ' ')
       JOIN g r ON r.lang = x.lang AND r.gram = array_to_string(x.w[x.j + 1:x.k], ' ')
       JOIN total ON total.lang = x.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) = 1)
SELECT lang, CAST(row_number() OVER o AS BIGINT) AS rank, gram AS phrase, a, l, r, n, score
FROM b WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram))
QUALIFY row_number() OVER o <= 2000
"""
