"""Rule ledger: every quality rule is evaluated once per document and kept as one bit.

``ledger`` adds a struct of the measurements and ``failure_bits`` (bit i: rule i failed).
A policy is a set of rules under a version; it is applied to a ledger by a
bitwise AND, without looking at the text again. ``ablations`` answers "what
would be kept without rule r" for all rules from one aggregate over the bits.
All work is done by built-in functions on one row at a time, so nothing is
shuffled but the handful of rows of an ablation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8  # words of a window that counts as repeated

#: Rules in the order of their bits, as conditions on the measurements.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 25 * n_words",
    "upper_case": "n_words >= 20 AND 100 * n_upper > 40 * word_chars",
    "few_distinct_words": "n_words >= 100 AND 100 * n_distinct_words < 5 * n_words",
}

#: Policy versions: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "v2": tuple(RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
            "n_distinct_words")


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _halves(h: str, step: int) -> str:
    rest = f"size({h}) - {step}"
    return f"zip_with(slice({h}, 1, {rest}), slice({h}, {step + 1}, {rest}), (x, y) -> xxhash64(x, y))"


def _repeated(words: str) -> str:
    """Words that lie in windows of ``WINDOW`` words found twice or more.

    Window hashes come by doubling from those of 1, 2 and 4 words. Windows whose
    hash recurs are found by sorting (hash, position); their positions in order give
    the length of the union. (Two different windows of one text share a
    64-bit hash with probability 1e-11 at 20,000 words.)
    """
    hashes = _let(f"transform({words}, x -> xxhash64(x))", "h1",
                  _let(_halves("h1", 1), "h2", _let(_halves("h2", 2), "h4", _halves("h4", 4))))
    twice = ("transform(filter(transform(p, (x, k) -> struct(x.i AS i, (k > 0 AND get(p, k - 1).h = x.h) "
             "OR coalesce(get(p, k + 1).h = x.h, false) AS twice)), x -> x.twice), x -> x.i)")
    union = (f"aggregate(sort_array({twice}), named_struct('n', 0, 'end', 0), (a, i) -> named_struct("
             f"'n', a.n + least({WINDOW}, i + {WINDOW} - a.end), 'end', i + {WINDOW}), a -> a.n)")
    covered = _let("sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))", "p", union)
    found = _let(hashes, "h", f"if(size(array_distinct(h)) < size(h), {covered}, 0)")
    return f"if(size({words}) >= {WINDOW}, {found}, 0)"


def _measured(text: str) -> str:
    """SQL of one struct: all measurements and ``failure_bits``."""
    space, word = "r'[\\x20\\x09-\\x0D]+'", "r'[^\\x20\\x09-\\x0D]'"
    values = {
        "n_words": "size(w)",
        "word_chars": "aggregate(w, 0L, (a, x) -> a + length(x))",
        "n_symbols": "regexp_count(t, '[#*$%&|<>]')",
        "n_lines": "size(l)",
        "n_dup_lines": "size(l) - size(array_distinct(l))",
        "n_repeat_words": _repeated("w"),
        "n_upper": "regexp_count(t, '[A-Z]')",
        "n_distinct_words": "size(array_distinct(w))",
    }
    struct = "named_struct(" + ", ".join(f"'{k}', cast({values[k]} AS bigint)" for k in MEASURES) + ")"
    bits = " + ".join(f"if({re.sub(r'[a-z_]+', lambda m: 'm.' + m[0] if m[0] in values else m[0], r)}, {1 << i}L, 0L)"
                      for i, r in enumerate(RULES.values()))
    fields = ", ".join(f"'{k}', m.{k}" for k in MEASURES)
    whole = _let(struct, "m", f"named_struct({fields}, 'failure_bits', {bits})")
    return _let(text, "t", _let(f"filter(split(t, {space}, -1), x -> x <> '')", "w",
                                _let(f"filter(split(t, '\n', -1), x -> x rlike {word})", "l", whole)))


def ledger(docs: DataFrame, text_col: str = "text", name: str = "ledger") -> DataFrame:
    """``docs`` with the struct ``name``: the measurements and ``failure_bits``.

    Words are runs of characters other than space and \\t-\\r. Null text counts
    as a text without words. Repeated rows are judged apart; an empty table
    gives an empty ledger. Other columns stay as they are.
    """
    return docs.withColumn(name, F.expr(_measured(f"coalesce(cast(`{text_col}` AS string), '')")))


def kept(policy: str = "v2", bits: str = "failure_bits") -> Column:
    """Whether no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(book: DataFrame, policy: str = "v2", bits: str = "failure_bits") -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it rejects, and that stay without it.

    One aggregate over the bits; ``rule`` null is the whole policy.
    """
    b = F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long"))
    names = list(RULES)
    counts = book.groupBy(b.alias("b")).agg(F.count("*").alias("n"))  # at most 2 ** rules rows
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                      for r in POLICIES[policy]],
                    F.struct(F.lit(None).cast("string").alias("rule"), F.lit(0).cast("long").alias("bit")))
    per = counts.select("b", "n", F.explode(rules).alias("r")).select("b", "n", "r.rule", "r.bit")
    has, rest = F.col("b").bitwiseAND(F.col("bit")), F.col("b").bitwiseAND(F.bitwise_not("bit"))
    return per.groupBy("rule").agg(
        F.sum(F.when(F.when(F.col("bit") == 0, F.col("b")).otherwise(has) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when((has != 0) & (rest == 0), F.col("n")).otherwise(0)).alias("only_it"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def filter_documents(docs: DataFrame, text_col: str = "text", policy: str = "v2") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with the same columns."""
    own = "__rule_ledger"
    return ledger(docs, text_col, own).filter(kept(policy, own + ".failure_bits")).select(*docs.columns)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: str = "v2") -> DataFrame:
    """``doc_id``, measurements, ``failure_bits``, ``base_failed`` and ``kept`` of every row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    book = ledger(src).select("doc_id", "ledger.*")
    return book.select("*", (~kept("base")).alias("base_failed"), kept(policy).alias("kept"))


_SQL_BITS = " + ".join(f"CASE WHEN {r} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES.values()))

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, array_to_string(words[i:i+{WINDOW - 1}], ' ') AS g
      FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
f AS (SELECT rid, i, (count(*) OVER (PARTITION BY rid, g)) > 1 AS twice FROM g),
p AS (SELECT rid, unnest(range(1, len(words) + 1)) AS i FROM w),
c AS (SELECT p.rid, max(coalesce(f.twice, false)::INT) OVER (PARTITION BY p.rid ORDER BY p.i
        ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS covered
      FROM p LEFT JOIN f ON p.rid = f.rid AND p.i = f.i),
r AS (SELECT rid, sum(covered) AS n FROM c GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper,
        len(list_distinct(words))::BIGINT AS n_distinct_words
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, ({_SQL_BITS})::BIGINT AS failure_bits FROM m)
SELECT doc_id, {', '.join(MEASURES)}, failure_bits, (failure_bits & {mask(POLICIES['base'])}) <> 0 AS base_failed,
  (failure_bits & {mask(POLICIES['v2'])}) = 0 AS kept FROM b
"""
