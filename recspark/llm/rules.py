"""Quality rules as a short-circuit cascade of built-in expressions.

A rule is a condition on a text. The cascade asks the rules one after another and
stops at the first that fails. As the verdict is the same in any order, the order is
chosen for speed: on a bounded sample each rule's seconds and its share of failures
are measured, and rules come by failures per second, dearest gain first.

Words are runs of characters other than space and ``\\t\\n\\v\\f\\r``. A null or empty
text has no words, every count is 0, and it fails. Repeated rows are judged one by
one; other columns pass through, also where their names clash with those made here
(the input's column is replaced).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base counts.
SYMBOLS = "#*$%&|<>"
CAPITALS = "A-Z"
DIGITS = "0-9"

SAMPLE_ROWS = 2000


class Rule(NamedTuple):
    name: str
    passes: Callable[[Facts], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _count(text: Column, characters: str) -> Column:
    """How many characters of the class ``[characters]`` a text has."""
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("bigint")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(word_list(text)).cast("bigint")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return _count(text, SYMBOLS)


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(lines: Column) -> Column:
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


#: Bits of a sorted long that hold a window's position; longer texts sort pairs of the whole hash and position instead.
_PLACE = 20


def _windows(hashed: Column) -> Column:
    """Hash of the three words from each position on."""
    at = lambda i: F.xxhash64(F.get(hashed, i), F.get(hashed, i + 1), F.get(hashed, i + 2))
    return F.when(F.size(hashed) >= 3, F.transform(F.sequence(F.lit(0), F.size(hashed) - 3), at))


def _pairs(windows: Column, at: Column) -> Column:
    """Windows at some positions as sorted pairs of the whole hash and the position."""
    return F.sort_array(F.transform(at, lambda i: F.struct(F.get(windows, i).alias("h"), i.alias("i"))))


def _packed(windows: Column) -> Column:
    """Windows sorted by hash, as longs with 44 bits of the hash above the position."""
    keep = F.lit(-(1 << _PLACE)).cast("bigint")
    return F.sort_array(F.transform(windows, lambda h, i: h.bitwiseAND(keep).bitwiseOR(i.cast("bigint"))))


def _neighbours(s: Column, same: Callable[[Column, Column], Column], place: Callable[[Column], Column]) -> Column:
    """Sorted positions of the entries of a sorted array that equal the one before or after them."""
    like = lambda x, other: F.coalesce(same(x, other), F.lit(False))
    twice = F.filter(s, lambda x, j: like(x, F.get(s, j - 1)) | like(x, F.get(s, j + 1)))
    return F.sort_array(F.transform(twice, place))


def _covered(at: Column) -> Column:
    """Words inside three-word windows at these positions."""
    added = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
    return F.aggregate(added, F.lit(0).cast("bigint"), lambda a, x: a + x)


def n_repeat_words(hashed: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, from the words' hashes.

    Equal windows are neighbours once windows are sorted by hash. Texts without such
    neighbours are done; else the positions of all repeated windows are sorted, and each
    adds the words up to the next one. Where neighbours are alike in the 44 bits kept beside a
    position, the whole hashes decide.
    """
    top = lambda x: F.shiftright(x, _PLACE)

    def short(s: Column, windows: Column) -> Column:
        twins = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(top(a) == top(b), F.lit(False)))
        place = lambda x: x.bitwiseAND((1 << _PLACE) - 1).cast("int")
        return F.when(
            F.array_contains(twins, True),
            let(_pairs(windows, _neighbours(s, lambda a, b: top(a) == top(b), place)), long),
        ).otherwise(F.lit(0).cast("bigint"))

    def long(s: Column) -> Column:
        return let(_neighbours(s, lambda a, b: a["h"] == b["h"], lambda x: x["i"]), _covered)

    pairs = F.sort_array(F.transform(_windows(hashed), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    packed = let(_windows(hashed), lambda windows: let(_packed(windows), lambda s: short(s, windows)))
    found = F.when(F.size(hashed) < (1 << _PLACE), packed).otherwise(let(pairs, long))
    return F.coalesce(found, F.lit(0).cast("bigint"))


class Facts(NamedTuple):
    """What a rule may ask: the text and the base counts, as columns."""

    text: Column
    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_dup_lines: Column


def facts_of(text: Column) -> Facts:
    """The facts as expressions of the text alone, each computed only where it is asked for."""
    return Facts(
        text,
        n_words(text),
        let(word_list(text), word_chars),
        n_symbols(text),
        n_dup_lines(lines_with_words(text)),
    )


#: The cascade's own rules; the base rule comes before them.
RULES = (
    Rule("word_length", lambda f: f.word_chars.between(f.n_words * 2, f.n_words * 15)),
    Rule("symbols", lambda f: f.n_symbols * 10 <= f.n_words),
    Rule("duplicate_lines", lambda f: f.n_dup_lines * 10 <= F.size(lines_with_words(f.text)) * 5),
    Rule("digits", lambda f: _count(f.text, DIGITS) * 10 <= F.length(f.text) * 2),
    Rule("capitals", lambda f: _count(f.text, CAPITALS) * 10 <= F.length(f.text) * 3),
)


def measure(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds and failures of each rule on at most ``sample_rows`` rows. Only the order hangs on it, no verdict."""
    facts = facts_of(F.coalesce(F.col(text), F.lit("")))
    sample = df.select(text).limit(sample_rows).repartition(1).cache()
    try:
        rows = sample.count()
        found = []
        for rule in rules:
            asked = sample.agg(F.count_if(~rule.passes(facts)).alias("n"))
            took = []
            for _ in range(2):
                began = time.perf_counter()
                failures = asked.first()["n"]
                took.append(time.perf_counter() - began)
            found.append({"rule": rule.name, "seconds": min(took), "failures": failures, "rows": rows})
        return found
    finally:
        sample.unpersist()


def ordered(rules: tuple[Rule, ...], measured: list[dict]) -> tuple[Rule, ...]:
    """Most failures per second first; rules that fail nothing come last, cheapest first."""
    by = {m["rule"]: m for m in measured}
    gain = lambda r: (-by[r.name]["failures"] / max(by[r.name]["seconds"], 1e-6), by[r.name]["seconds"])
    return tuple(sorted(rules, key=gain))


def first_failure(rules: tuple[Rule, ...], facts: Facts) -> Column:
    """Name of the first rule that fails, null if none does; later rules are not evaluated."""
    chain = F
    for rule in rules:
        chain = chain.when(~rule.passes(facts), F.lit(rule.name))
    return chain.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def judge(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", order: bool = True) -> DataFrame:
    """``df`` with the base counts, ``base_failed``, ``failed_rule`` and ``kept``; one map over the rows."""
    if order:
        rules = ordered(rules, measure(df, rules, text))
    column = F.coalesce(F.col(text), F.lit(""))
    split = df.withColumn("_ws", word_list(column)).withColumn("_hashed", F.transform("_ws", lambda w: F.xxhash64(w)))
    out = split.withColumns(
        {
            "n_words": F.size("_ws").cast("bigint"),
            "word_chars": word_chars(F.col("_ws")),
            "n_symbols": n_symbols(column),
            "n_dup_lines": n_dup_lines(lines_with_words(column)),
            "n_repeat_words": n_repeat_words(F.col("_hashed")),
        }
    ).drop("_ws", "_hashed")
    facts = Facts(column, *(F.col(c) for c in Facts._fields[1:]))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (
        out.withColumn("base_failed", failed)
        .withColumn("failed_rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(first_failure(rules, facts)))
        .withColumn("kept", F.col("failed_rule").isNull())
    )
