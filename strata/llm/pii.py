"""PII surrogates: detected entities get keyed, type-consistent replacements.

Entities: e-mail and IP addresses, phone, card and social security numbers, and
names after one or more honorifics: any number of capitalised words and initials, and
every other whole-word mention of those words in the same document (not of single letters).
A replacement is drawn from a keyed hash of (type, value,
attempt): digits stay digits (a valid card number stays valid, an octet
keeps its length), letters stay letters of the same case and script, separators,
country codes and top-level domains stay, names become names of the
honorific's gender in the same script. The same value always gets the
same replacement, across all documents (coreference; the words of a name are
entities of their own, so "Mr. Roe" and "Mr. Al Roe" agree, and so do "Mr. Roe" and "Mr. Roe Al":
a word has one identity whatever its place in a name, with the gender that most of its
titled mentions as a given name have; none, if there are none or as many of each).
An initial becomes another letter of its alphabet, the same one everywhere.

Distinct values must get distinct replacements, all words of names among
each other. All distinct values are grouped, and a value whose replacement is a real value of the table, or is
taken by another value, tries again with the next attempt until none collides.
Draws keep the shape of the value ``SHAPED`` times; after that they come from a space
that grows with each attempt, so a shape with too few values (1.2.3.4) does not end the query.
Only documents with entities, their values and the replacements are shuffled. Detection takes
time in proportion to a text's length, whatever it holds.
"""

from __future__ import annotations

import hashlib
import hmac
import itertools
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, written

_WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Mme", "Madame", "Mlle", "Г-жа", "Κα")
_MEN = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Г-н", "Κος")
_ANY = ("Dr", "Prof", "Mx")
_TITLE = "|".join(_WOMEN + _MEN + _ANY)
_UPPER = "[" + "".join(c for c in map(chr, range(sys.maxunicode)) if c.isupper() and c.isalpha()) + "]"
_CAP = rf"(?!(?:{_TITLE})\b){_UPPER}\w*(?:[-'’][^\W\d_]\w*)*"
_PART = rf"(?:{_UPPER}\.|{_CAP})"
_HOST = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_PATTERNS = (
    ("email", rf"[A-Za-z0-9][A-Za-z0-9._%+-]*{_HOST}"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])"),
    ("phone", r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
              r"|(?<!\d)(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"),
    ("name", rf"\b(?P<titles>(?:(?:{_TITLE})(?:\.[ ]?|[ ]))++)(?P<who>{_PART}(?:(?:[ ]|(?<=\.)){_PART})*)?"),
)
_BUT_MAIL = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS[1:]))
_AT = re.compile(_HOST)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: The decimal digits of every script; the ranges hold those that are newer than Java's tables.
_DIGIT = r"[\p{Nd}\x{10D30}-\x{11F59}\x{16AC0}-\x{16AC9}\x{1E140}-\x{1E4F9}\x{1FBF0}-\x{1FBF9}]"
#: Texts without a match of this (in the syntax of Java and of Arrow) have no entity.
MAY_HOLD = rf"@|{_DIGIT}\.?{_DIGIT}|" + "|".join(_WOMEN + _MEN + _ANY)
#: Attempts that keep the shape of a value.
SHAPED = 16

#: Syllables for made-up names, and how they end, by script and gender (w, m, n: none known).
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ja jo ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro "
             "sa se si so ta te ti to va ve vi wa we za".split(),
    "cyrillic": "ба бе бо ва ве ви га го да де до за зи ка ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са "
                "се со та те ти то".split(),
    "greek": "βα βε γα γο δα δε δο ζα θα θε κα κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σο τα "
             "τε τι το".split(),
}
_ENDS = {
    "latin": {"w": ("na", "ria", "la"), "m": ("ton", "rik", "dus"), "n": ("man", "ner", "sen")},
    "cyrillic": {"w": ("на", "рия", "ла"), "m": ("тон", "рик", "дан"), "n": ("ман", "нер", "ко")},
    "greek": {"w": ("να", "ρια", "λα"), "m": ("νος", "ρης", "δος"), "n": ("μας", "νης", "κος")},
}


_INITIALS = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
             "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"}


def script_of(word: str) -> str:
    kinds = [unicodedata.name(c, "").split(" ")[0].lower() for c in word if c.isalpha()]
    return max(_SYLLABLES, key=lambda s: (kinds.count(s), s == "latin"))


_NAME_PART = re.compile(rf"{_UPPER}\.|[^\s.]+")
_WORD = re.compile(r"\b[^\W\d_]\w*")
_OWNER = re.compile(r"['’]s$")


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """The e-mail addresses: from each host back over its local part, so that no character is read more than twice."""
    done = 0
    for m in _AT.finditer(text):
        a = m.start()
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        while a < m.start() and text[a] in "._%+-":
            a += 1
        if a < m.start():
            yield a, m.end()
            done = m.end()


def _entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """The entities that the patterns find, in order: e-mail addresses first, the others between them."""
    done = 0
    for a, b in _mails(text):
        yield from _between(text, done, a)
        yield a, b, "email", text[a:b]
        done = b
    yield from _between(text, done, len(text))


def _between(text: str, start: int, end: int) -> Iterator[tuple[int, int, str, str]]:
    for m in _BUT_MAIL.finditer(text, start, end):
        kind = next(k for k, _ in _PATTERNS[1:] if m[k] is not None)
        if kind != "name":
            yield m.start(), m.end(), kind, m[0]
            continue
        if m["who"] is None:
            continue
        titles = re.findall(_TITLE, m["titles"])
        sex = next(("w" if t in _WOMEN else "m" for t in titles if t not in _ANY), "n")
        parts = [(p.start() + m.start("who"), _OWNER.sub("", p[0])) for p in _NAME_PART.finditer(m["who"])]
        for k, (a, w) in enumerate(parts):
            if w[1:] == ".":
                yield a, a + 1, "initial", w[0]
            else:
                yield a, a + len(w), "family" if k == len(parts) - 1 else f"given_{sex}", w


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, value)`` in order; the parts of a name are ``given_w``, ``given_m``, ``given_n``, ``family`` or ``initial``.

    Further mentions of the parts (but of single letters) have the type of the first one.
    """
    out = list(_entities(text))
    names: dict[str, str] = {}
    for _, _, kind, w in out:
        if (kind == "family" or kind.startswith("given_")) and len(w) > 1:
            names.setdefault(w, kind)
    if not names:
        return out
    taken, more, i, done = [x[:2] for x in out], [], 0, 0
    starting: dict[str, list[str]] = {}  # longest first, by the first word
    for w in sorted(names, key=len, reverse=True):
        starting.setdefault(_WORD.search(w)[0], []).append(w)
    for m in _WORD.finditer(text):
        if m.start() < done or m[0] not in starting:
            continue
        end = next((e for w in starting[m[0]] if text.startswith(w, m.start())
                    and not text[(e := m.start() + len(w)):e + 1].isalnum() and text[e:e + 1] != "_"), 0)
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if end and (i == len(taken) or end <= taken[i][0]):
            more.append((m.start(), end, names[text[m.start():end]], text[m.start():end]))
            done = end
    return sorted(out + more)


class _Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: object) -> None:
        self.key, self.what, self.n, self.pool = key, "\x1f".join(map(str, what)).encode(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 32:
            block = hmac.new(self.key, self.what + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.n = int.from_bytes(block, "big"), self.n + 1
        self.pool, r = divmod(self.pool, n)
        return r


def _luhn(digits: list[int]) -> int:
    """Sum modulo 10; 0 for a valid number."""
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10


def _digit(like: str, d: int) -> str:
    """The digit ``d`` in the script of the digit ``like``."""
    return chr(ord(like) - unicodedata.decimal(like) + d)


def _shaped(value: str, draw: _Draw, keep_digits: int = 0) -> str:
    """Digits for digits of the same script, letters for letters of the same case and script; the first ``keep_digits`` digits stay."""
    out = []
    for c in value:
        if c.isdecimal():
            out.append(c if keep_digits > 0 else _digit(c, draw.below(10)))
            keep_digits -= 1
        elif c.isalpha() and c.isascii():
            out.append(chr((65 if c.isupper() else 97) + draw.below(26)))
        elif c.isalpha():
            base = {"cyrillic": "абвгдежзиклмнопрстуф", "greek": "αβγδεζηθικλμνξοπρστυ"}.get(
                script_of(c), "abcdefghiklmnoprstuv")
            x = base[draw.below(len(base))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def is_name(kind: str) -> bool:
    """Types of words of names; ``name_w``, ``name_m`` and ``name_n`` are identities, the others places in a name."""
    return kind.startswith(("given_", "name_")) or kind == "family"


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a value at an attempt; never the value itself.

    From attempt ``SHAPED`` on it is longer by a character an attempt; an IP
    address may have octets of any length, and 16 attempts later it is one of version 6.
    """
    more = max(0, attempt - SHAPED + 1)
    for extra in range(64):
        draw = _Draw(key, kind, value, attempt, extra)
        if kind == "email":
            local, _, host = value.partition("@")
            labels = host.split(".")
            new = _shaped(local + "x" * more, draw) + "@" + ".".join([_shaped(x, draw) for x in labels[:-1]] + labels[-1:])
        elif kind == "ip":
            spans = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
            if more > 16:
                new = "2001:db8:" + ":".join(f"{draw.below(1 << 16):x}" for _ in range(6))
            else:
                octets = value.split(".")
                drawn = [(1, 254) if more else spans[min(3, len(x))] for x in octets]
                new = ".".join("".join(_digit(x[0], int(d)) for d in str(lo + draw.below(hi - lo + 1)))
                               for x, (lo, hi) in zip(octets, drawn, strict=True))
        elif kind == "card":
            new = _shaped(value + value[-1] * more, draw, keep_digits=1)
            was = [int(c) for c in value if c.isdecimal()]
            now = [int(c) for c in new if c.isdecimal()]
            if _luhn(was) == 0:
                new = new[:-1] + _digit(new[-1], (now[-1] - _luhn(now)) % 10)
        elif kind == "phone":
            code = re.match(r"\+(\d{1,3})", value)
            new = _shaped(value + value[-1] * more, draw, keep_digits=len(code[1]) if code and not value[1:].isdigit() else 0)
        elif kind == "initial":
            letters = _INITIALS[script_of(value)]
            turn = 1 + _Draw(key, kind, letters).below(len(letters) - 1)
            new = letters[(letters.find(value) + turn) % len(letters)]
        elif is_name(kind):
            script, sex = script_of(value), kind[-1] if kind != "family" else "n"
            parts = _SYLLABLES[script]
            n = 1 + (len(value) > 5) + attempt + extra
            new = "".join(parts[draw.below(len(parts))] for _ in range(n)) + _ENDS[script][sex][draw.below(3)]
            new = new.upper() if value.isupper() and len(value) > 1 else new.capitalize()
        else:
            new = _shaped(value + value[-1] * more, draw)
        if new != value:
            return new
    return new


def mapping(values: DataFrame, key: bytes) -> DataFrame:
    """Distinct ``values(kind, value)`` -> ``(kind, value, new)``; no two values of a kind share a ``new``.

    Nor is any ``new`` a value of its kind in the input; all ``name_`` kinds count as one. A value that collides tries the next
    attempt, so the rounds end when none does; the space of the draws grows without bound.
    """
    space = F.when(F.col("kind").startswith("name_"), F.lit("name")).otherwise(F.col("kind")).alias("space")
    real = values.select(space, F.col("value").alias("new"))
    pending, done = values.select("kind", "value"), None
    for attempt in itertools.count():

        def batch(b: pa.RecordBatch, attempt: int = attempt) -> pa.RecordBatch:
            new = [surrogate(key, k, v, attempt) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            return pa.record_batch({"kind": b.column(0), "value": b.column(1), "new": pa.array(new, pa.string())})

        tried = written(map_batches(pending, batch, "kind string, value string, new string"), "tried")
        free = tried.withColumn("space", space).join(real, ["space", "new"], "left_anti")
        if done is not None:
            free = free.join(done.select(space, "new"), ["space", "new"], "left_anti")
        good = written(free.groupBy("space", "new").agg(F.min(F.struct("value", "kind")).alias("x"))
                       .select("x.kind", "x.value", "new"), "good")
        done = good if done is None else done.unionByName(good)
        pending = written(tried.join(good, ["kind", "value"], "left_anti").select("kind", "value"), "pending")
        if pending.isEmpty():
            return done


_MENTIONS = "array<struct<a:int,b:int,kind:string,value:string>>"


def replace(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, n_entities, entities)``: every row with its entities replaced.

    ``entities`` lists ``type:start:end`` in the original text. Null text
    stays null with 0 entities; null ids and repeated rows stay; other columns are
    ignored; an empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def may(b: pa.RecordBatch) -> pa.Array:
        return pc.fill_null(pc.match_substring_regex(b.column(1), MAY_HOLD), False)

    def found(b: pa.RecordBatch) -> pa.RecordBatch:
        b = b.filter(may(b))
        rows = [detect(t) for t in b.column(1).to_pylist()]
        has = pa.array([bool(r) for r in rows], pa.bool_())
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))
        own = pa.array([[dict(zip(("a", "b", "kind", "value"), x, strict=True)) for x in r] for r in rows], kind)
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), own], ["doc_id", "text", "mentions"]).filter(has)

    def without(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.if_else(may(b), b.column(1), pa.scalar(None, b.column(1).type)).to_pylist()
        return b.filter(pa.array([t is None or next(_entities(t), None) is None for t in texts], pa.bool_()))

    held = written(map_batches(src, found, f"doc_id long, text string, mentions {_MENTIONS}")
                   .withColumn("rid", F.monotonically_increasing_id()), "held")
    each = held.select("rid", F.explode("mentions").alias("m")).select("rid", "m.*")
    named = F.col("kind").startswith("given_") | (F.col("kind") == "family")
    each = each.withColumn("identity", F.when(named, F.lit("name")).otherwise(F.col("kind")))
    sex = F.count_if(F.col("kind") == "given_w") - F.count_if(F.col("kind") == "given_m")
    values = written(
        each.groupBy("identity", "value").agg(sex.alias("sex"))
        .withColumn("kind", F.when(F.col("identity") != "name", F.col("identity"))
                    .otherwise(F.when(F.col("sex") > 0, "name_w").when(F.col("sex") < 0, "name_m").otherwise("name_n")))
        .select("kind", "value"), "values")

    def letters(b: pa.RecordBatch) -> pa.RecordBatch:
        new = [surrogate(key, "initial", v) for v in b.column(1).to_pylist()]
        return pa.record_batch({"kind": b.column(0), "value": b.column(1), "new": pa.array(new, pa.string())})

    initials = map_batches(values.filter("kind = 'initial'"), letters, "kind string, value string, new string")
    new = (mapping(values.filter("kind != 'initial'"), key).unionByName(initials)
           .select(F.when(F.col("kind").startswith("name_"), F.lit("name")).otherwise(F.col("kind")).alias("identity"),
                   "value", "new"))
    edits = (each.join(new, ["identity", "value"]).groupBy("rid")
             .agg(F.array_sort(F.collect_list(F.struct("a", "b", "kind", "new"))).alias("edits")))

    def changed(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, names = [], []
        for text, edits in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            out, done = [], 0
            for e in edits:
                out += [text[done:e["a"]], e["new"]]
                done = e["b"]
            texts.append("".join(out) + text[done:])
            names.append(",".join(f"{e['kind']}:{e['a']}:{e['b']}" for e in edits))
        return pa.record_batch({"doc_id": b.column(0), "text": pa.array(texts, pa.string()),
                                "n_entities": pa.array([n.count(",") + 1 for n in names], pa.int64()),
                                "entities": pa.array(names, pa.string())})

    edited = map_batches(held.select("rid", "doc_id", "text").join(edits, "rid").select("doc_id", "text", "edits"),
                         changed, "doc_id long, text string, n_entities long, entities string")
    none = map_batches(src, without, "doc_id long, text string")
    return edited.unionByName(none.withColumns({"n_entities": F.lit(0).cast("long"), "entities": F.lit("")}))
