"""Byte-pair encoding as a lazily determinised transducer, and streaming decoding.

Two tokens may stand side by side in an encoding exactly if merging their joined
bytes does not cross the border between them. A byte string has one
segmentation whose neighbours all may, and that is its encoding; the same holds
for each of its prefixes. The merges thus compile into a nondeterministic
transducer: it walks a trie of tokens, and where a token ends that may follow
the last one it may emit it and start anew. After any prefix every
earlier position is a possible start, so the open trie positions are those of
the longest suffix that is still on the trie and of its own suffixes. The
subset construction therefore has one state per trie node and is done only for
states and bytes that texts reach. Beside the state a window
remembers the last token of each prefix. Tokens on which all open
positions agree are emitted and leave the window, so the lookahead is bounded
by what open positions still disagree on. Decoding feeds token bytes to a UTF-8 state machine that may be
interrupted between any two bytes.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, raw_texts
from strata.llm.tokens import MEMO_BYTES, MEMO_ENTRIES, ChunkEncoder

MAX_STEPS = 150_000  # determinised transitions a Python worker keeps
WINDOW = 4096  # prefixes after which settled tokens are emitted


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """How each token is built: ``spine`` of its left or right border with the times the parts live.

    A part on a border lives from the rank that forms it to the rank that uses it up.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}

    def merge(self, data: bytes, below: int | None = None) -> list[bytes]:
        """Merge by lowest rank, leftmost first; only ranks less than ``below`` if given."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            pair = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            rank = self.ranks.get(parts[pair] + parts[pair + 1])
            if rank is None or below is not None and rank >= below:
                break
            parts[pair:pair + 2] = [parts[pair] + parts[pair + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts a token is merged from; None for a byte or a token that merging never reaches."""
        if token not in self.halves:
            parts = self.merge(token, self.ranks[token]) if len(token) > 1 else ()
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    @lru_cache(maxsize=200_000)  # noqa: B019  one instance per worker
    def spine(self, token: bytes, side: int) -> tuple[tuple[bytes, int], ...]:
        """(part, rank that uses it up) along the left (0) or right (1) border, the whole token first."""
        out, used = [(token, 1 << 60)], 0
        while (halves := self.split(token)) is not None:
            used, token = self.ranks[token], halves[side]
            out.append((token, used))
        return tuple(out)

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border: none whose two parts are both there when its turn comes.

        Of equal ranks the leftmost goes first: the left part must outlive the
        merge, the right part may be due for the same rank.
        """
        for a, a_end in self.spine(left, 1):
            for b, b_end in self.spine(right, 0):
                rank = self.ranks.get(a + b)
                if rank is not None and rank < a_end and rank <= b_end:
                    return False
        return True


class Transducer:
    """Deterministic steps ``(state, byte) -> state``, made when first needed, and the tokens that may end there."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.merges = Merges(ranks)
        self.ranks = ranks
        self.size_of = {i: len(b) for b, i in ranks.items()}
        self.child: dict[int, int] = {}
        self.above: list[tuple[int, int]] = [(0, 0)]  # parent and byte of each trie node
        self.token_at: list[int] = [-1]
        self.depth: list[int] = [0]
        for token in ranks:
            if len(token) > 1 and self.merges.split(token) is None:
                continue  # merging never makes it
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.above.append((node, byte))
                    self.depth.append(self.depth[node] + 1)
                    self.token_at.append(-1)
                node = self.child[key]
            self.token_at[node] = ranks[token]
        self.shorter: dict[int, int] = {0: 0}  # node of the longest proper suffix on the trie
        self.ending: list[tuple[tuple[int, int], ...] | None] = [()] + [None] * (len(self.token_at) - 1)
        self.steps: dict[int, int] = {}
        self.fit: dict[int, bool] = {}

    def forget(self) -> None:
        """Drop the determinised steps and the checked pairs; they are made again as texts need them."""
        self.steps.clear()
        self.fit.clear()

    def may_follow(self, last: int, token: int) -> bool:
        of = self.merges.bytes_of
        if len(self.fit) > 2 * MAX_STEPS:
            self.fit.clear()
        ok = self.fit[last << 32 | token] = self.merges.fits(of[last], of[token])
        return ok

    def suffix(self, node: int) -> int:
        path = []
        while node not in self.shorter:
            path.append(node)
            node = self.above[node][0]
        for node in reversed(path):
            parent, byte = self.above[node]
            self.shorter[node] = self.follow(self.shorter[parent], byte) if parent else 0
        return self.shorter[node]

    def follow(self, node: int, byte: int) -> int:
        """The longest suffix of the bytes of ``node`` and ``byte`` that is on the trie."""
        while (to := self.child.get(node << 8 | byte)) is None and node:
            node = self.suffix(node)
        return to or 0

    def step(self, state: int, byte: int) -> int:
        """Make one deterministic step, and the tokens (longest first) that may end in the state it leads to."""
        to = self.follow(state, byte)
        if not to:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        if self.ending[to] is None:
            out, node = [], to
            while node:
                if (token := self.token_at[node]) >= 0:
                    out.append((token, self.depth[node]))
                node = self.suffix(node)
            self.ending[to] = tuple(out)
        if len(self.steps) > MAX_STEPS:
            self.forget()
        self.steps[state << 8 | byte] = to
        return to

    def encode(self, data: bytes, window: int = WINDOW) -> list[int]:
        """Token ids of one match of the split pattern; one that is a token by itself is that token."""
        if (token := self.ranks.get(data)) is not None:
            return [token]
        steps, ending, fit = self.steps.get, self.ending, self.fit.get
        ids: list[int] = []
        last, state, at, full = [-1], 0, 0, window  # the last token of each prefix in the window
        for byte in data:
            state = steps(state << 8 | byte) or self.step(state, byte)
            at += 1
            for token, size in ending[state]:
                before = last[at - size]
                if before < 0:
                    break
                ok = fit(before << 32 | token)
                if ok or ok is None and self.may_follow(before, token):
                    break
            last.append(token)
            if at >= full:
                cut = self._agreed(last, at - self.depth[state])
                ids += self._back(last, cut)
                del last[:cut]
                at -= cut
                full = at + window  # disagreement may go on
        return ids + self._back(last, at)

    def _agreed(self, last: list[int], first: int) -> int:
        """The last border that the encodings of all prefixes from ``first`` on have in common."""
        ends = set(range(first, len(last)))
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - self.size_of[last[end]])
        return ends.pop()

    def _back(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end])
            end -= self.size_of[last[end]]
        return out[::-1]


class Utf8Machine:
    """Incremental UTF-8 decoding; malformed bytes become U+FFFD as Python's "replace" does.

    The state is the bytes of a character not complete yet and the range its next byte must lie in.
    """

    def __init__(self) -> None:
        self.held, self.need, self.low, self.high = b"", 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        if not self.held and (not data or data[-1] < 0x80):
            return data.decode("utf-8", "replace")  # nothing held and nothing left over
        if not self.held:
            cut = next((k for k in range(1, min(4, len(data) + 1)) if data[-k] >= 0xC0 or data[-k] < 0x80), 0)
            if cut and data[-cut] >= 0xC0:
                return data[:-cut].decode("utf-8", "replace") + "".join(map(self._byte, data[-cut:]))
        return "".join(map(self._byte, data))

    def _byte(self, b: int) -> str:
        out = ""
        if self.held:
            if self.low <= b <= self.high:
                self.held += bytes((b,))
                self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                if self.need:
                    return ""
                done, self.held = self.held.decode("utf-8"), b""
                return done
            out, self.held = "�", b""
        if b < 0x80:
            return out + chr(b)
        if 0xC2 <= b <= 0xF4:
            self.held, self.need = bytes((b,)), 1 if b < 0xE0 else 2 if b < 0xF0 else 3
            self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
            self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            return out
        return out + "�"

    def finish(self) -> str:
        out, self.held = "�" if self.held else "", b""
        return out


class Codec:
    """Whole-text encoding by the split pattern and the transducer, and decoding of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.machine = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        self.matches: dict[str, bytes] = {}
        size = max(ranks.values()) + 1
        self.token_bytes = [self.machine.merges.bytes_of.get(i, b"") for i in range(size)]
        self.chunks = ChunkEncoder(self._whole, self._many)

    def _ids(self, matches: list[str]) -> list[bytes]:
        if len(self.matches) > MEMO_ENTRIES:
            self.matches.clear()
        memo, encode, out = self.matches, self.machine.encode, []
        for match in matches:
            if (raw := memo.get(match)) is None:
                raw = array("I", encode(match.encode("utf-8"))).tobytes()
                if len(match) <= MEMO_BYTES:
                    memo[match] = raw
            out.append(raw)
        return out

    def _whole(self, text: bytes) -> bytes:
        return b"".join(self._ids(self.split(text.decode("utf-8", "replace"))))

    def _many(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks, split together; the matches that start with a space start the chunks."""
        matches = self.split((b" " + b" ".join(chunks)).decode("utf-8", "replace"))
        start = [k for k, m in enumerate(matches) if m[0] == " "]
        if len(start) != len(chunks):
            return [self._whole(b" " + c) for c in chunks]
        ids = self._ids(matches)
        return [ids[a] if b == a + 1 else b"".join(ids[a:b])
                for a, b in zip(start, [*start[1:], len(matches)], strict=True)]

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.chunks.encode(text)

    def decode(self, ids: bytes, block: int = 4096):
        """Pieces of the decoded text, block by block of ids."""
        of, machine = self.token_bytes.__getitem__, Utf8Machine()
        for i in range(0, len(ids), 4 * block):
            yield machine.feed(b"".join(map(of, np.frombuffer(ids[i:i + 4 * block], dtype="<u4").tolist())))
        yield machine.finish()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the token ids of every whole text; null text counts as empty."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = codec(path, pattern).encode
        ids = [np.frombuffer(enc(t), dtype="<i4") for t in raw_texts(b, "text")]
        return pa.record_batch({"doc_id": b.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))})

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, batch, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every whole text encoded, and its ids decoded.

    Null text counts as empty (no ids); null ids and repeated rows stay;
    other columns are ignored; an empty table gives an empty result.
    """

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path, pattern)
        n, ids_hash, text_hash = [], [], []
        for t in raw_texts(b, "text"):
            raw = own.encode(t)
            h = hashlib.sha256()
            for part in own.decode(raw):
                h.update(part.encode("utf-8"))
            n.append(len(raw) // 4)
            ids_hash.append(hashlib.sha256(raw).hexdigest())
            text_hash.append(h.hexdigest())
        return pa.record_batch({"doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()),
                                "ids_sha256": pa.array(ids_hash, pa.string()),
                                "decoded_sha256": pa.array(text_hash, pa.string())})

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, batch, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
