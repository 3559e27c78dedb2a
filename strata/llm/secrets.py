"""Secret scan: plain patterns and assignment-aware lexing.

The base kinds are fixed patterns (``assign``, ``access``, ``hex``). The lexer adds the
kind ``literal``: it reads name-literal pairs from source and configuration
syntax (``name = "..."``, ``name: ...``, ``"name": "..."``, ``name => ...``,
``<name>...</name>``, keyword arguments, concatenated strings), follows names
that are given as values (``x = "..."`` then ``password = x``, ``${x}``,
``$x``, ``env["x"]``) back to their literals, and scores a literal by how sensitive the names
are that it reaches and by how random it looks.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, raw_texts

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{16,}")

#: Name parts and how much they say that the value is secret.
SENSITIVE = {
    b"password": 1.0, b"passwd": 1.0, b"pwd": 1.0, b"passphrase": 1.0, b"secret": 1.0, b"token": 0.9,
    b"apikey": 1.0, b"credential": 0.9, b"credentials": 0.9, b"privatekey": 1.0, b"accesskey": 1.0, b"authkey": 1.0,
    b"auth": 0.6, b"bearer": 0.8, b"signature": 0.5, b"salt": 0.5, b"key": 0.5, b"dsn": 0.5, b"pass": 0.8,
}
#: Values that stand for a secret without being one.
PLACEHOLDERS = (b"example", b"changeme", b"placeholder", b"your", b"dummy", b"xxxx", b"redacted", b"none", b"null",
                b"true", b"false", b"undefined", b"****", b"todo")
THRESHOLD = 0.5

_NAME = rb"[A-Za-z_][A-Za-z0-9_.\-]*+"  # whole, so that a long run is read once
_RUN = rb"(?<![A-Za-z0-9_.\-])[0-9.\-]*+"  # what may stand before a name in its run
_STRING = rb"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"
_REF = rb"\$\{?" + _NAME + rb"\}?|(?:os\.)?(?:environ|env|getenv)[\[(.]\s*[\"']?" + _NAME + rb"[\"']?[\])]?"
_VALUE = _STRING + rb"|" + _REF + rb"|[A-Za-z0-9+/_.=~!@%^&*-]+"
_PAIR = re.compile(
    rb"(?:<(?P<tag>" + _NAME + rb")>(?P<body>[^<>\n]+)</|"
    rb"(?:(?P<quote>[\"'])(?P<quoted>" + _NAME + rb")(?P=quote)|" + _RUN + rb"(?P<name>" + _NAME + rb"))"
    rb"\]?[\x20\t]*(?::=|=>|=(?!=)|:(?![:/]))[\x20\t]*"
    rb"(?P<value>(?:" + _VALUE + rb")(?:[\x20\t]*\+[\x20\t]*(?:" + _VALUE + rb"))*))")
_PART = re.compile(_VALUE)
_WORDS = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_TEMPLATE = re.compile(rb"\$\{" + _NAME + rb"\}")
_REF_NAME = re.compile(_RUN + rb"(" + _NAME + rb")[\"'\])}]*$")


def sensitivity(name: bytes) -> float:
    """0 to 1, from the parts of a name in any case style."""
    parts = [w.lower() for w in _WORDS.findall(name)]
    both = [a + b for a, b in zip(parts[:-1], parts[1:], strict=True)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + both), default=0.0)


def randomness(literal: bytes) -> float:
    """0 to 1, from length, character kinds and entropy; placeholders and plain words get 0.

    Several words with a digit among them (a passphrase) get half, so only the
    most sensitive names make them secret; several words without one get 0.
    """
    low, n = literal.lower(), len(literal)
    phrase = b" " in literal.strip()
    if n < 8 or any(p in low for p in PLACEHOLDERS) or phrase and not re.search(rb"[0-9]", literal):
        return 0.0
    kinds = sum(bool(re.search(p, literal)) for p in (rb"[a-z]", rb"[A-Z]", rb"[0-9]", rb"[^A-Za-z0-9]"))
    if kinds < 2 or not re.search(rb"[0-9]", literal) and kinds < 3:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    return min(1.0, entropy / 3.2) * min(1.0, n / 12) * (0.5 if phrase else 1.0)


def literals(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of literals that reach a sensitive name with a sufficient score."""
    pairs: list[tuple[bytes, list, list]] = []  # name, literal spans, names referred to
    for m in _PAIR.finditer(text):
        if m["tag"]:
            pairs.append((m["tag"], [m.span("body")], []))
            continue
        spans, refs = [], []
        for part in _PART.finditer(text, *m.span("value")):
            v = part.group()
            if v == b"+":  # joins its neighbours
                continue
            if v[:1] in b"\"'`" and len(v) > 1:
                inner = v[1:-1]
                if inner[:1] == b"$" and (r := _REF_NAME.search(inner)):
                    refs.append(r[1])
                if not _TEMPLATE.fullmatch(inner):  # a string with $ is a literal if no such name is known
                    spans.append((part.start() + 1, part.end() - 1))
            elif (v[:1] == b"$" or re.match(_REF, v)) and (r := _REF_NAME.search(v)):
                refs.append(r[1])
            elif re.fullmatch(_NAME, v):
                refs.append(v)
                spans.append(part.span())  # a bare word: a name if one is known, else a literal
            else:
                spans.append(part.span())
        pairs.append((m["name"] or m["quoted"], spans, refs))
    last = lambda name: name.rpartition(b".")[2]
    known: dict[bytes, list[int]] = {}
    for i, (name, _, _) in enumerate(pairs):
        known.setdefault(last(name), []).append(i)
    found: set[tuple[int, int]] = set()
    score = [sensitivity(name) for name, _, _ in pairs]
    seen, asked = set(), set()  # a pair, a name: met first from the most sensitive name that leads to it
    for i in sorted((i for i, s in enumerate(score) if s), key=lambda i: -score[i]):
        todo = [i]
        while todo:
            j = todo.pop()
            if j in seen:
                continue
            seen.add(j)
            _, spans, refs = pairs[j]
            leads = False
            for r in map(last, refs):
                to = known.get(r, [])
                leads |= len(to) > 1 or to not in ([], [j])
                if r not in asked:
                    asked.add(r)
                    todo += to
            whole = b"".join(text[a:b] for a, b in spans)
            if not leads and score[i] * randomness(whole) >= THRESHOLD:
                found.update(spans)
    return sorted(found)


def scan(text: bytes) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of all spans in code points, by start and then kind.

    A literal that lies within one base span is left out: the base one stands for it.
    """
    low = text.lower()
    spans = []
    if any(k in low for k in (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if b"=" in text or b":" in text or b"</" in text:
        if any(k in low for k in SENSITIVE):
            base = list(spans)
            spans += [("literal", a, b) for a, b in literals(text) if not any(x <= a and b <= y for _, x, y in base)]
    if not spans:
        return []
    if not text.isascii():
        at, n, done = {}, 0, 0
        for p in sorted({p for _, a, b in spans for p in (a, b)}):
            n += len(text[done:p].decode("utf-8", "replace"))
            done, at[p] = p, n
        spans = [(k, at[a], at[b]) for k, a, b in spans]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest and list of the spans of every row.

    ``(doc_id, n_assign, n_access, n_hex, n_literal, base_sha256, spans)``.
    Null text counts as empty; null ids and repeated rows stay as they are;
    other columns are ignored; an empty table gives an empty result.
    """
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(t) for t in raw_texts(b, "text")]
        count = lambda kind: pa.array([sum(s[0] == kind for s in f) for f in found], pa.int64())
        base = [hashlib.sha256(listed([s for s in f if s[0] != "literal"]).encode()).hexdigest() for f in found]
        return pa.record_batch({"doc_id": b.column(0), **{f"n_{k}": count(k) for k in KINDS},
                                "base_sha256": pa.array(base, pa.string()),
                                "spans": pa.array([listed(f) for f in found], pa.string())})

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, batch, "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, "
                                   "base_sha256 string, spans string")


def masked(text: str, mark: str = "[SECRET]") -> str:
    """The text with every stretch covered by spans replaced by ``mark``."""
    out, done, open_ = [], 0, None
    for _, a, b in scan(text.encode("utf-8", "replace")):
        if open_ and a < open_[1]:
            open_ = (open_[0], max(b, open_[1]))
            continue
        if open_:
            out += [text[done:open_[0]], mark]
            done = open_[1]
        open_ = (a, b)
    if open_:
        out += [text[done:open_[0]], mark]
        done = open_[1]
    return "".join(out) + text[done:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text_col``; same columns, null stays null.

    ``length_col``, if the input has it, is set to the new length of the texts that changed.
    """
    @F.pandas_udf("string")
    def clean(t):
        return t.map(lambda s: None if s is None else masked(s))

    out = docs.withColumn("__masked", clean(F.col(f"`{text_col}`").cast("string")))
    new = F.col("__masked")
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(new.alias(c))
        elif c == length_col:
            changed = ~new.eqNullSafe(F.col(f"`{text_col}`"))
            cols.append(F.when(changed, F.length(new)).otherwise(F.col(f"`{c}`")).cast(dict(docs.dtypes)[c]).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return out.select(*cols)
