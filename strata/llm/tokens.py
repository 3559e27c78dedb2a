"""Token ids of whole texts with a memo per space-delimited chunk.

The byte-level split pattern always starts a new match at a space that is
followed by a non-space character. A text whose spaces all are such can be cut
before every space and its chunks encoded apart; the ids of the text are those
of its chunks, one after the other. Frequent chunks are then looked up
instead of encoded again. Texts with other spaces are encoded whole.

Of a plain byte-level vocabulary, ordinary Latin texts go to ``tiktoken`` whole: it
gives the ids of ``tokenizers`` several times as fast. Where token ids follow
the order of the merges, merging the pair that forms the least id is merging
by that order (up to the rank of a token, what merges inside its bytes does not
depend on its neighbours, so its two parts are always those of its merge).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np

#: A space before white space (ASCII or Unicode, as UTF-8) or at the end.
_LOOSE_SPACE = re.compile(
    rb" (?:[\t-\r\x1c-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\Z)")
MEMO_ENTRIES = 250_000  # chunks a Python worker remembers (about 200 bytes each)
MEMO_BYTES = 64  # longer chunks are not remembered
AT_ONCE = 20_000  # chunks of a text encoded together
#: Outside these ranges the two libraries may class a character by different versions of Unicode.
_NOT_LATIN = re.compile(r"[^\x00-\x7f\xa1-\u024f]")
MAX_RUN = 256  # longer runs without (or of) white space make tiktoken slow: its time grows with their square
_LONG_GAP = re.compile(r"\s{%d}" % (MAX_RUN + 1))


class ChunkEncoder:
    """``encode(text)`` as bytes of little-endian unsigned 32-bit ids.

    ``whole(text)`` gives the ids of any text; ``many(chunks)`` those of
    chunks, each with a space before it; ``fast(text)`` those of an ordinary
    Latin text, if such a way is known.
    """

    def __init__(self, whole: Callable[[bytes], bytes], many: Callable[[list[bytes]], list[bytes]],
                 fast: Callable[[str], list[int]] | None = None) -> None:
        self.whole, self.many, self.fast = whole, many, fast
        self.memo: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        if self.fast and ordinary(chars := text.decode("utf-8", "replace")):
            return np.array(self.fast(chars), dtype="<u4").tobytes()
        if _LOOSE_SPACE.search(text):
            return self.whole(text)
        first, *chunks = text.split(b" ")
        out = [self.whole(first)] if first else []
        for k in range(0, len(chunks), AT_ONCE):
            out += self._ids(chunks[k:k + AT_ONCE])
        return b"".join(out)

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        ids = list(map(self.memo.get, chunks))
        if None in ids:
            new = list(dict.fromkeys(c for c, i in zip(chunks, ids, strict=True) if i is None))
            made = dict(zip(new, self.many(new), strict=True))
            ids = [made[c] if i is None else i for c, i in zip(chunks, ids, strict=True)]
            self.memo.update((c, i) for c, i in made.items() if len(c) <= MEMO_BYTES)
        return ids


def ordinary(text: str) -> bool:
    """Whether a text has Latin characters alone and no very long run with or without white space."""
    if not text.isascii() and _NOT_LATIN.search(text):
        return False
    sizes = list(map(len, text.split()))
    spaces = len(text) - sum(sizes) - len(sizes)  # beyond one after each word
    return max(sizes, default=0) <= MAX_RUN and (spaces < MAX_RUN or not _LONG_GAP.search(text))


def plain_ranks(path: str) -> dict[bytes, int] | None:
    """Rank of each token of a tokenizer file; None if it is more than byte-level merges in the order of their ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not spec.get("normalizer") and not spec.get("truncation")
             and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                "fuse_unk", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab["".join(p)] for p in pairs]
    if len(vocab) != 256 + len(ids) or ids != list(range(256, 256 + len(ids))):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
    return {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}


#: Fixed value: how a byte-level tokenizer cuts a text before it merges.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ENCODERS: dict[str, ChunkEncoder] = {}


def tokenizer_encoder(path: str) -> ChunkEncoder:
    """Encoder of a byte-level tokenizer file (``tokenizers`` format), one per Python worker."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        space = np.zeros(tok.get_vocab_size() + 1, dtype=bool)
        for token, i in tok.get_vocab().items():
            space[i] = token.startswith("Ġ")  # how byte-level vocabularies write a space

        def ids_of(text: bytes) -> np.ndarray:
            enc = tok.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
            return np.array(enc[0].ids, dtype="<u4")

        def whole(text: bytes) -> bytes:
            return ids_of(text).tobytes() if text else b""

        def many(chunks: list[bytes]) -> list[bytes]:
            ids = ids_of(b" " + b" ".join(chunks))
            start = np.flatnonzero(space[ids])  # chunks hold no other space
            if len(start) != len(chunks):
                return [whole(b" " + c) for c in chunks]
            raw, at = ids.tobytes(), (4 * np.append(start, len(ids))).tolist()
            return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

        fast = None
        if ranks := plain_ranks(path):
            import tiktoken

            fast = tiktoken.Encoding("plain", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        _ENCODERS[path] = ChunkEncoder(whole, many, fast)
    return _ENCODERS[path]
