"""Log-bilinear language model on two levels, with noise-contrastive estimation.

Vocabulary counts come from every training document. The most frequent words, as many as
``GROWTH`` times the square root of the distinct words counted, are modelled with vectors of their own;
the others fall into six tail classes by their shape, in which a word has the probability
(c + 1) / (N_t + V_t + 1) (c, N_t, V_t: counts of the word, of the class's tokens and words; the one left
over is for all unseen words). The modelled words, in order of frequency, are cut into classes of
about as many members as there are classes. Both levels are log-bilinear in the two tokens before:

    h = c1 * Q[a] + c2 * Q[b]
    p(w | a, b) = softmax(h . R + r)[class of w] * softmax(h . S + s, over the members of that class)[w]

so a token costs about the square root of the modelled words, and no table of pairs is needed.

Training passes once over all training documents: Spark tasks run minibatch
steps in numpy on their own rows. A token's class is told from noise drawn from the class
frequencies, its word from noise drawn evenly from the class's members. The parameters of all tasks are
averaged by their token counts after each of ``ROUNDS`` disjoint shares of the documents. Scores
are normalised on both levels.

The known words (the modelled ones, at least the ``KNOWN_WORDS`` most frequent, none longer than ``KNOWN_BYTES``
bytes) are sent to the tasks; all other words of a document meet their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_share, raw_texts, written

END = b""  # the end token; words are never empty
GROWTH = 4  # modelled words: this times the square root of the distinct words
KNOWN_WORDS, KNOWN_BYTES = 50_000, 48
TAILS = 6
DIM, NOISE, INNER_NOISE, BATCH, ROUNDS, RATE = 15, 32, 8, 4096, 2, 0.08
CHUNK = 100_000  # tokens scored at once
FLUSH = 150_000  # distinct words a task holds before it hands on their counts


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def tail_class(word: bytes) -> int:
    """0 to ``TAILS`` - 1, by the last character and whether there is a non-ASCII one."""
    last = word[-1:]
    return (0 if last.isalnum() or last >= b"\x80" else 1 if last in (b".", b"!", b"?") else 2) + 3 * (not word.isascii())


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over all rows of ``docs(text)``, the end token included; words as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.record_batch({"word": pa.array(list(held), pa.binary()),
                                 "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return b

        for batch in batches:
            for t in raw_texts(batch, "text"):
                held.update(tokens(t))
                if len(held) > FLUSH:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Vocabulary:
    """What training and scoring need besides the rare words: known words and counts, classes, tail totals.

    A token has one number: the rank of a modelled word (0: the end), or their number plus its tail class.
    """

    def __init__(self, words: list[tuple[bytes, int]], total: int, distinct: int,
                 tail: dict[int, tuple[int, int]], model_words: int) -> None:
        end = sum(c for w, c in words if w == END)
        words = [(END, end), *sorted(((w, c) for w, c in words if w != END), key=lambda w: (-w[1], w[0]))]
        self.total, self.distinct = total, distinct
        self.modelled = m = min(model_words + 1, len(words))
        self.width = math.isqrt(m - 1) + 1  # members of a class; the last may have fewer
        self.classes = -(-m // self.width)
        self.index = {w: i for i, (w, _) in enumerate(words)}
        self.counts = np.array([c for _, c in words] + [0], dtype=np.float64)  # the last: not among them
        self.number = np.array([i if i < m else m + tail_class(w) for i, (w, _) in enumerate(words)] + [-1], dtype=np.int32)
        self.room = np.ones(TAILS)
        mass = np.zeros(TAILS)
        for t, (n, v) in tail.items():
            mass[t], self.room[t] = n, n + v + 1
        own = self.counts[:m] + 1
        first = np.arange(0, m, self.width)
        self.share = np.concatenate([np.add.reduceat(own, first), mass + 1])
        self.member_share = own / np.repeat(self.share[:len(first)], np.diff(np.append(first, m)))
        self.share /= self.share.sum()

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Number and index of each token, and where the words are that are not among the known."""
        missing = len(self.counts) - 1
        get = self.index.get
        at = np.array([get(w, missing) for w in words], dtype=np.int64)
        num = self.number[at]
        rare = np.flatnonzero(at == missing).tolist()
        for k in rare:
            num[k] = self.modelled + tail_class(words[k])
        return num, at, rare


def learn_vocabulary(counts: DataFrame, growth: float = GROWTH, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """From a written table ``(word, c)``; the driver gets the known words (``known_words``, or ``growth`` times
    the square root of the distinct words if that is more) and a few totals."""
    band = F.floor(8 * F.log2(F.col("c"))).cast("int")  # about 500 bands whatever the data
    short = F.octet_length("word") <= KNOWN_BYTES
    bands = counts.groupBy(band.alias("band")).agg(
        F.count("*").alias("v"), F.sum(F.when(short, 1).otherwise(0)).alias("short"), F.sum("c").alias("n")).collect()
    total, distinct = sum(r["n"] for r in bands), sum(r["v"] for r in bands)
    model_words = math.ceil(growth * math.sqrt(distinct))
    room, least = max(known_words, model_words), 1 << 20
    for r in sorted(bands, key=lambda r: -r["band"]):
        if r["short"] > room:
            break
        room, least = room - r["short"], r["band"]
    words = [(bytes(r["word"]), r["c"]) for r in counts.filter((band >= least) & short).collect()]
    plain = Vocabulary(words, total, distinct, {}, model_words)
    own = {END, *(w for w, i in plain.index.items() if i < plain.modelled)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(TAILS, dtype=np.int64), np.zeros(TAILS, dtype=np.int64)
        for b in batches:
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if w not in own:
                    t = tail_class(w)
                    n[t] += c
                    v[t] += 1
        yield pa.record_batch({"t": np.arange(TAILS), "n": n, "v": v})

    tail = counts.select("word", "c").mapInArrow(run, "t long, n long, v long").groupBy("t").agg(F.sum("n"), F.sum("v"))
    return Vocabulary(words, total, distinct, {t: (n, v) for t, n, v in tail.collect()}, model_words)


class Model:
    """Rows of ``DIM`` numbers and a bias: Q of every token number (bias 0), R of every class, S of every modelled word.

    ``c`` holds the two position vectors, a 0 for the bias behind each.
    """

    def __init__(self, vocab: Vocabulary, rows: np.ndarray, c: np.ndarray) -> None:
        self.words, self.width, self.classes = vocab.modelled, vocab.width, vocab.classes
        self.rows, self.c = rows.astype(np.float32), c.astype(np.float32)
        self.r_at = self.words + TAILS
        self.s_at = self.r_at + self.classes + TAILS

    @staticmethod
    def start(vocab: Vocabulary) -> Model:
        """Small random vectors; the biases are the counted shares."""
        n = 2 * vocab.modelled + TAILS + len(vocab.share)
        rows = np.random.default_rng(17).normal(0, 0.1, (n, DIM + 1))
        rows[:vocab.modelled + TAILS, DIM] = 0
        rows[vocab.modelled + TAILS:, DIM] = np.log(np.concatenate([vocab.share, vocab.member_share]))
        return Model(vocab, rows, np.ones((2, DIM + 1)) * (np.arange(DIM + 1) < DIM))

    def class_of(self, num: np.ndarray) -> np.ndarray:
        return np.where(num < self.words, num // self.width, self.classes + num - self.words)

    def members(self, cls: np.ndarray) -> np.ndarray:
        """How many words these classes of modelled words have."""
        return np.minimum(self.width, self.words - cls * self.width)

    def hidden(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """h of the tokens before, a 1 for the bias behind it."""
        h = self.rows.take(a, 0) * self.c[0] + self.rows.take(b, 0) * self.c[1]
        h[:, DIM] = 1
        return h

    def log_p(self, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Natural log probability of each token number after ``a`` and, before that, ``b``; tail words as their class."""
        r, s = self.rows[self.r_at:self.s_at], self.rows[self.s_at:]
        order = np.argsort(w)  # words of a class become neighbours
        w, h = w[order], self.hidden(a[order], b[order])
        out = np.empty(len(w))
        cls = self.class_of(w)
        for k in range(0, len(w), 2048):
            part = slice(k, k + 2048)
            out[part] = _log_softmax(h[part], r, cls[part])
        edges = np.searchsorted(w, np.append(np.arange(0, self.words, self.width), self.words))
        for k in np.flatnonzero(np.diff(edges)):
            first, lo, hi = k * self.width, edges[k], edges[k + 1]
            for at in range(lo, hi, 2048):
                part = slice(at, min(at + 2048, hi))
                out[part] += _log_softmax(h[part], s[first:first + self.width], w[part] - first)
        back = np.empty(len(w))
        back[order] = out
        return back


def _log_softmax(h: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    z = h @ rows.T
    if max(z.max(), -z.min()) > 60:  # else no sum of exponentials leaves single precision
        z -= z.max(axis=1, keepdims=True)
    own = z[np.arange(len(z)), at]
    return own - np.log(np.exp(z, out=z) @ np.ones(len(rows), dtype=np.float32))


def context(num: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens one and two before; before the text stands the end token."""
    return np.concatenate(([0], num[:-1])), np.concatenate(([0, 0], num[:-2]))[:len(num)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def train_steps(model: Model, seen: np.ndarray, seen_c: np.ndarray, w: np.ndarray, a: np.ndarray, b: np.ndarray,
                share: np.ndarray, rng: np.random.Generator) -> None:
    """Noise-contrastive minibatch steps (AdaGrad) over the tokens; ``model`` and ``seen`` change in place.

    A class is told from ``NOISE`` samples of the class frequencies, which its minibatch shares; a
    modelled word from ``INNER_NOISE`` even samples of its class, which the class's tokens in the
    minibatch share. Only the rows met are moved.
    """
    rows, c = model.rows, model.c
    edge, log_share = np.cumsum(share), (np.log(share) + np.log(NOISE)).astype(np.float32)
    for k in range(0, len(w), BATCH):
        x, ca, cb = (v[k:k + BATCH] for v in (w, a, b))
        by = np.argsort(x)
        x, ca, cb = x[by], ca[by], cb[by]
        h = model.hidden(ca, cb)
        # level of classes
        cls = model.class_of(x)
        noise = np.minimum(np.searchsorted(edge, rng.random(NOISE)), len(share) - 1)
        rx, rn = rows.take(model.r_at + cls, 0), rows.take(model.r_at + noise, 0)
        g = _sigmoid(np.einsum("ij,ij->i", h, rx) - log_share[cls]) - 1
        gn = _sigmoid(h @ rn.T - log_share[noise])
        dh = g[:, None] * rx + gn @ rn
        first = np.flatnonzero(np.diff(cls, prepend=-1))
        at = [ca, cb, model.r_at + cls[first], model.r_at + noise]
        grad = [np.add.reduceat(g[:, None] * h, first, axis=0), gn.T @ h]
        # level of words: the first ones in order, class by class
        n = int(np.searchsorted(x, model.words))
        if n:
            first = first[first < n]
            ends, met = np.append(first[1:], n), cls[first]
            size = model.members(met)
            drawn = met[:, None] * model.width + (rng.random((len(met), INNER_NOISE)) * size[:, None]).astype(np.int64)
            offset = np.repeat(np.log(INNER_NOISE / size).astype(np.float32), ends - first)
            sx, sn = rows.take(model.s_at + x[:n], 0), rows.take(model.s_at + drawn, 0)
            gw = _sigmoid(np.einsum("ij,ij->i", h[:n], sx) - offset) - 1
            gs, moved = np.empty((n, INNER_NOISE), dtype=np.float32), np.empty_like(sn)
            for lo, hi, s in zip(first.tolist(), ends.tolist(), sn, strict=True):
                np.matmul(h[lo:hi], s.T, out=gs[lo:hi])
            gs = _sigmoid(gs - offset[:, None])
            dh[:n] += gw[:, None] * sx
            for lo, hi, s, m in zip(first.tolist(), ends.tolist(), sn, moved, strict=True):
                dh[lo:hi] += gs[lo:hi] @ s
                np.matmul(gs[lo:hi].T, h[lo:hi], out=m)
            at += [model.s_at + x[:n], model.s_at + drawn.ravel()]
            grad += [gw[:, None] * h[:n], moved.reshape(-1, DIM + 1)]
        gc = np.stack([np.einsum("ij,ij->j", dh, rows.take(t, 0)) for t in (ca, cb)])
        grad, at = np.concatenate([dh * c[0], dh * c[1], *grad]), np.concatenate(at)
        order = np.argsort(at)
        at = at[order]
        start = np.flatnonzero(np.diff(at, prepend=-1))
        at, grad = at[start], np.add.reduceat(grad.take(order, 0), start, axis=0)
        past = seen.take(at, 0) + grad ** 2
        seen[at] = past
        rows[at] = rows.take(at, 0) - RATE * grad / np.sqrt(past + 1e-6)
        seen_c += gc ** 2
        c -= RATE * gc / np.sqrt(seen_c + 1e-6)


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Train on every row of ``docs(id, text)``.

    A task returns its rows of parameters, which Spark averages row by row.
    """
    model = Model.start(vocab)
    context_of = docs.sparkSession.sparkContext
    words = context_of.broadcast(vocab)
    names = [f"x{j}" for j in range(DIM + 1)]
    schema = "i long, n long, " + ", ".join(f"{x} double" for x in names)
    for k in range(rounds):
        sent = context_of.broadcast((model.rows, model.c))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            v = words.value
            own, n = Model(v, *sent.value), 0  # a copy
            seen, seen_c = np.ones_like(own.rows), np.ones_like(own.c)
            rng = np.random.default_rng(5)
            for batch in batches:
                parts = [v.numbers(tokens(t))[0] for t in raw_texts(batch, "text")]
                if not parts:
                    continue
                w = np.concatenate(parts)
                before = [context(p) for p in parts]
                mix = rng.permutation(len(w))
                train_steps(own, seen, seen_c, w[mix], np.concatenate([x for x, _ in before])[mix],
                            np.concatenate([x for _, x in before])[mix], v.share, rng)
                n += len(w)
            if n:
                flat = np.concatenate([own.rows, own.c]).astype(np.float64) * n
                for s in range(0, len(flat), 10_000):
                    part = flat[s:s + 10_000]
                    yield pa.record_batch({"i": np.arange(s, s + len(part)), "n": np.full(len(part), n),
                                           **{x: np.ascontiguousarray(part[:, j]) for j, x in enumerate(names)}})

        part = docs.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(rounds)) == k)
        mean = (part.select("text").mapInArrow(run, schema).groupBy("i")
                .agg(*[(F.sum(x) / F.sum("n")).alias(x) for x in names]).toArrow())
        if mean.num_rows:
            flat = np.empty((len(model.rows) + 2, DIM + 1))
            flat[mean["i"].to_numpy()] = np.stack([mean[x].to_numpy() for x in names], axis=1)
            model = Model(vocab, flat[:-2], flat[-2:])
        sent.unpersist()
    words.unpersist()
    return model


def _scored(docs: DataFrame, vocab: Vocabulary, model: Model) -> DataFrame:
    """Per row the sums over its known words, and its other words with their numbers."""
    sent = docs.sparkSession.sparkContext.broadcast((vocab, model.rows, model.c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, rows, c = sent.value
        own = Model(v, rows, c)
        log_c, log_room = np.log10(v.counts + 1), np.log10(v.room)

        def sums(ids: list, parts: list) -> pa.RecordBatch:
            num, at = (np.concatenate([p[j] for p in parts]) for j in (0, 1))
            before = [context(p[0]) for p in parts]
            score = own.log_p(num, np.concatenate([x for x, _ in before]), np.concatenate([x for _, x in before])) / np.log(10)
            tail = num >= v.modelled
            score[tail] += log_c[at[tail]] - log_room[num[tail] - v.modelled]
            lengths = np.array([len(p[0]) for p in parts])
            first = np.cumsum(lengths) - lengths  # a text has a token at least
            return pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()), "n_tokens": lengths,
                "n_known": lengths - np.array([sum(p[2].values()) for p in parts]),
                "base": np.add.reduceat(log_c[at], first), "model": np.add.reduceat(score, first),
                "words": pa.array([list(p[2]) for p in parts], pa.list_(pa.binary())),
                "times": pa.array([list(p[2].values()) for p in parts], pa.list_(pa.int64()))})

        for batch in batches:
            ids, parts, held = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), raw_texts(batch, "text"), strict=True):
                w = tokens(t)
                num, at, rare = v.numbers(w)
                ids.append(i)
                parts.append((num, at, Counter(w[k] for k in rare)))
                held += len(w)
                if held >= CHUNK:
                    yield sums(ids, parts)
                    ids, parts, held = [], [], 0
            if ids:
                yield sums(ids, parts)

    return docs.select("id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base double, model double, words array<binary>, times array<long>")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
                    held: int = 2, growth: float = GROWTH, known_words: int = KNOWN_WORDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Rows whose id's crc32 modulo ``folds`` is ``held`` are held out of all counts and training. Null text
    counts as empty (the end token alone); a null id counts as the empty text in the
    fold rule; repeated rows count and are scored apart; an empty table gives an
    empty result; without training rows every token has count 0.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    learn = src.filter(id_share(F.col("id"), folds) != held)
    counts = written(word_counts(learn), "vocabulary")
    vocab = learn_vocabulary(counts, growth, known_words)
    model = train(learn, vocab)
    rows = written(_scored(src, vocab, model).withColumn("rid", F.monotonically_increasing_id()), "scored")
    other = (rows.select("rid", F.explode(F.arrays_zip("words", "times")).alias("x"))
             .select("rid", F.col("x.words").alias("word"), F.col("x.times").alias("n")))
    found = (other.join(counts, "word").groupBy("rid")
             .agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("add")))
    add, log_all = F.coalesce("add", F.lit(0.0)), F.lit(float(np.log10(vocab.total + vocab.distinct + 1)))
    return (rows.drop("words", "times").join(found, "rid", "left").select(
        "doc_id", (id_share(F.col("doc_id"), folds) == held).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + add - F.col("n_tokens") * log_all).alias("base_score"), (F.col("model") + add).alias("score")))
