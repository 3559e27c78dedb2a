"""Runs (maximal periodic stretches) of words, by online dyadic square catching.

The words of a text are appended to a ``Catchers``. Every completed block of
2**k words, at places that are multiples of its size B, has a catcher: it
waits for the block to come again p words later, with 2B - 1 <= p <= 4B - 2.
So each appended word makes two comparisons per block size: of the last B
words with the two blocks whose distance lies in that range, by 64-bit
fingerprints. A square of period p has p equal pairs of words p apart in a
row, and any 2B - 1 words in a row contain a whole block, so no square escapes.

A catch is widened to both sides by comparing words; the stretch of equal
pairs is one run if it is long enough and its root is not itself a power.
Stretches that reach the last word stay open and go on with the next ones.

Fingerprints older than a catcher can reach are dropped; the words are kept.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, raw_texts

LEAST = 12  # words of a run at least
WORDS_A_STEP = 60_000  # words whose documents are searched together
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _equal_right(w: np.ndarray, i: int, j: int) -> int:
    """Equal words from places i < j on."""
    n, done, width = len(w) - j, 0, 32
    while done < n:
        m = min(width, n - done)
        other = w[i + done:i + done + m] != w[j + done:j + done + m]
        at = int(other.argmax())
        if other[at]:
            return done + at
        done, width = done + m, 2 * width
    return n


def _equal_left(w: np.ndarray, i: int, j: int) -> int:
    """Equal words before places i < j."""
    done, width = 0, 32
    while done < i:
        m = min(width, i - done)
        other = (w[i - done - m:i - done] != w[j - done - m:j - done])[::-1]
        at = int(other.argmax())
        if other[at]:
            return done + at
        done, width = done + m, 2 * width
    return i


def _is_power(root: np.ndarray) -> bool:
    n, rest, r = len(root), len(root), 2
    while rest > 1:
        if r * r > rest:
            r = rest
        if rest % r == 0:
            q = n // r
            if (root[q:] == root[:-q]).all():
                return True
            while rest % r == 0:
                rest //= r
        r += 1
    return False


class Catchers:
    """Online detector of the runs of one growing sequence of word numbers (int64).

    ``longest``: no run is longer than this, if that is known (larger blocks are then left out).
    """

    def __init__(self, least: int = LEAST, longest: int | None = None) -> None:
        self.least, self.longest = least, longest
        self._words, self.n = np.empty(1024, dtype=np.int64), 0
        self._print: list[np.ndarray] = []  # fingerprints of windows of 1, 2, 4, ... words
        self._from: list[int] = []  # place of the first fingerprint kept
        self._open: dict[int, int] = {}  # period: first word of a stretch that reaches the last word
        self._done: list[tuple[int, int, int]] = []

    def _level_of(self, p: np.ndarray) -> np.ndarray:
        """Block size (its power of two) that catches period p: a run has max(least - p, p) equal pairs in a row."""
        return np.frexp((np.maximum(self.least - p, p) + 1) / 2)[1] - 1

    def _periods(self, level: int) -> tuple[int, int]:
        """Least and greatest period of a level; (1, 0) if it has none."""
        p = np.concatenate([np.arange(1, self.least + 1), [2 << level, (4 << level) - 2]])
        p = p[self._level_of(p) == level]
        least = min(p, default=1)
        if (2 << level) - 1 >= self.least:
            least = (2 << level) - 1
        return int(least), int(max(p, default=0))

    def append(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """Take the next words; ``(start, period, last word)`` of the first square of each run that they complete."""
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self._words):
            grown = np.empty(max(2 * len(self._words), self.n), dtype=np.int64)
            grown[:old] = self._words[:old]
            self._words = grown
        self._words[old:self.n] = words
        w, squares = self._words[:self.n], []
        for p, start in sorted(self._open.items()):
            reach = old - p + _equal_right(w, old - p, old)
            if reach + p < self.n:
                del self._open[p]
            self._grown(w, start, p, old, reach + p, squares)
        level = 0
        while (1 << level) <= self.n and (self.longest is None or 2 * self._periods(level)[0] <= self.longest):
            self._advance(w, level, old, squares)
            level += 1
        for k, prints in enumerate(self._print):
            drop = len(prints) - (6 << k)  # no catcher looks further back
            if drop > 0:
                self._print[k], self._from[k] = prints[drop:].copy(), self._from[k] + drop
        return sorted(squares, key=lambda x: (x[2], x[1]))

    def runs(self) -> list[tuple[int, int, int]]:
        """``(start, length, period)`` of all runs so far, by start, then period."""
        w = self._words[:self.n]
        still = [(a, self.n - a, p) for p, a in self._open.items()
                 if self.n - a >= max(self.least, 2 * p) and not _is_power(w[a:a + p])]
        return sorted(self._done + still, key=lambda x: (x[0], x[2]))

    def _grown(self, w: np.ndarray, start: int, p: int, old: int, end: int, squares: list) -> None:
        """A stretch of period p reaches ``end`` now that there are more than ``old`` words."""
        need = max(self.least, 2 * p)
        if end - start < need:
            return
        if _is_power(w[start:start + p]):
            self._open.pop(p, None)
            return
        if end < self.n:
            self._done.append((start, end - start, p))
        if start + need > old:
            squares.append((start, p, start + need - 1))

    def _advance(self, w: np.ndarray, level: int, old: int, squares: list) -> None:
        block = 1 << level
        first = max(0, old - block + 1)  # first window that the new words complete
        if level == 0:
            new = _mixed(w[old:].astype(np.uint64), np.uint64(1))
        else:
            half, base = self._print[level - 1], self._from[level - 1]
            lo, m = first - base, self.n - block + 1 - first
            new = _mixed(half[lo:lo + m], half[lo + block // 2:lo + block // 2 + m])
        if level == len(self._print):
            self._print.append(new)
            self._from.append(first)
        else:
            self._print[level] = np.concatenate([self._print[level], new])
        least, most = self._periods(level)
        if most < least:
            return
        prints, base = self._print[level], self._from[level]
        blocks, lead = prints[-base % block::block], -(-base // block)  # the first block kept is number ``lead``
        found = []
        for k in range(-(-(most - least + block) // block)):
            i = max(first, least + (lead + k) * block)  # the first window whose k-th block is kept
            if i > self.n - block:
                continue
            b = (i - least) // block - k
            caught = np.repeat(blocks[b - lead:(self.n - block - least) // block - k - lead + 1], block)
            caught = caught[i - least - (b + k) * block:][:self.n - block + 1 - i]
            near = i + np.flatnonzero(caught == prints[i - base:])
            s = ((near - least) // block - k) * block
            p = near - s
            found.append(np.stack([s, p])[:, self._level_of(p) == level])
        if not found:
            return
        s, p = np.concatenate(found, axis=1)
        if not len(s):
            return
        earlier = s - block - base  # the block before matched too: that catcher has the stretch
        first_of = (earlier < 0) | (prints[np.maximum(earlier, 0)] != prints[np.maximum(earlier, 0) + p])
        s, p = s[first_of], p[first_of]
        for x, y in zip(*self._not_inside(s, p, block), strict=True):
            start = x - _equal_left(w, x, x + y)
            end = x + y + block + _equal_right(w, x + block, x + y + block)
            if end == self.n:
                self._open[y] = start
            self._grown(w, start, y, old, end, squares)

    def _not_inside(self, s: np.ndarray, p: np.ndarray, block: int) -> tuple[list[int], list[int]]:
        """Catches without those inside a longer stretch of a period that divides theirs.

        Two stretches of different roots share less than the sum of their periods, so at most one is asked.
        """
        known = self._done + [(a, self.n - a, q) for q, a in self._open.items()]
        known = sorted((a, a + m, q) for a, m, q in known if m >= int(p.min()) + block) if len(p) else []
        if known:
            a, e, q = np.array(known, dtype=np.int64).T
            far = np.maximum.accumulate(e)
            of = np.maximum.accumulate(np.where(e == far, np.arange(len(e)), 0))
            j = np.searchsorted(a, s, side="right") - 1
            held = of[np.maximum(j, 0)]
            free = (j < 0) | (e[held] < s + p + block) | (p % q[held] != 0) | (p == q[held])
            s, p = s[free], p[free]
        order = np.lexsort((s, p))
        return s[order].tolist(), p[order].tolist()


def runs_of(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each list of words, by start, then period."""
    words = [x for t in texts for x in t]
    code = {x: i for i, x in enumerate(dict.fromkeys(words))}
    flat = np.fromiter(map(code.__getitem__, words), dtype=np.int64, count=len(words))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    marked = np.full(len(words) + len(texts), -1, dtype=np.int64)
    marked[first + sizes] -= np.arange(len(texts))  # ends that equal nothing
    inside = np.ones(len(marked), dtype=bool)
    inside[first + sizes] = False
    marked[inside] = flat
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    catchers = Catchers(least, int(sizes.max(initial=0)))
    for at in range(0, len(marked), 4 * WORDS_A_STEP):
        catchers.append(marked[at:at + 4 * WORDS_A_STEP])
    for start, length, period in catchers.runs():
        t = int(np.searchsorted(first, start, side="right")) - 1
        found[t].append((start - int(first[t]), length, period))
    return found


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a text; a tenth of the documents, by the hash of the id, are made periodic from some word on."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a:a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[:n - a]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those that a run repeats."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
           change=planted, texts: bool = False) -> DataFrame:
    """Runs of the words of every text.

    ``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256)``: the numbers are those of the longest run (ties: the
    first, then the shortest period), null where there is none; the digests
    are of all runs and of the text without repeats. With ``texts`` also the
    ``runs`` and the ``collapsed`` text. ``change(words, id)`` is applied to
    the words first; None takes them as they are. Words are what ASCII white
    space separates. A null or empty text has no words and no runs; a null id
    counts as the empty text in ``change``; repeated rows give repeated
    results; other columns are ignored. Whole texts are searched, whatever
    their length.
    """

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        raw, ids = raw_texts(b, "text"), b.column(0).to_pylist()
        order = sorted(range(len(raw)), key=lambda r: len(raw[r]))  # texts of like length need like block sizes
        out: list[tuple | None] = [None] * len(raw)
        at = 0
        while at < len(order):
            group, words, held = [], [], 0
            while at < len(order) and held < WORDS_A_STEP:
                r = order[at]
                group.append(r)
                w = raw[r].split()  # ASCII white space
                words.append(change(w, ids[r]) if change else w)
                held, at = held + len(w), at + 1
            for r, w, runs in zip(group, words, runs_of(words, least), strict=True):
                top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
                short = collapsed(w, runs)
                lines = "".join(f"{x},{y},{z}\n" for x, y, z in runs).encode()
                out[r] = (ids[r], len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
                          hashlib.sha256(lines).hexdigest(), hashlib.sha256(short).hexdigest(),
                          *(([dict(zip(("start", "length", "period"), x, strict=True)) for x in runs],
                             short.decode()) if texts else ()))
        cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    run = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["runs", "collapsed"] * texts
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(run), pa.string()] * texts
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, batch, SCHEMA + ", runs array<struct<start:long,length:long,period:long>>, collapsed string" * texts)
