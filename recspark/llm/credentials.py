"""Secrets in texts: certain finds by pattern, weak ones only where the parts of a credential stand together.

Base finds are assignments with a long value, access identifiers and long hexadecimal runs. Beyond them a text may
hold weak candidates: a user name or address, a short or unusual secret, the address of a service. One alone
means little, so a weak candidate is reported only if complementary parts, weak or base, lie within ``WINDOW`` code
points of it in the same scope, a scope being the text between two blank lines:

* an identifier next to a secret,
* a key next to an identifier or an endpoint,
* an endpoint next to an identifier and a secret.

A secret here is an assignment, a key or a hexadecimal run with a letter in it; a run of digits is found, but is no part of a
credential.

Everything is built-in expressions and joins. Patterns are located by splitting the text at its matches and adding up
lengths. Texts in which parts could meet, and only those, go on to the interval join: parts are dealt to (text, scope, bin of
``WINDOW`` code points), so a join key holds no more parts than a few windows of one text. No key is shared by texts, however
many copies of a text there are.

A null text is empty and has no finds. Repeated rows are scanned each; a null id is kept. Offsets count code points, an end is
exclusive. Columns of the input other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.rules import let
from recspark.llm.tables import stored

WINDOW = 160
#: Base kinds first; spans with one start come in this order.
NO_PART = -1
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
BASE = 3


def any_case(word: str) -> str:
    """A pattern for ``word`` with each ASCII letter in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def names(*words: str) -> str:
    return "(" + "|".join(map(any_case, words)) + ")"


# Patterns. Those of the base kinds are given; "{16,}" finds what "+" finds and a length test keeps.
_SET = r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "([A-Za-z0-9+/_.=-]+)"
ASSIGN = names("password", "passwd", "secret", "token", "api_?key") + _SET + _VALUE
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LONG_VALUE, SHORT_VALUE = 12, 6
BREAK = r"\n[\x20\x09\x0B-\x0D]*\n"


class Finder(NamedTuple):
    """Where a pattern's matches are parts: what they are, and the values that count."""

    kind: str
    pattern: str
    hints: tuple[str, ...]  # a text without any of these characters has no match
    group: int = 0
    least: int = 0
    most: int | None = None
    needs: tuple[str, ...] = ()  # patterns that a match must hold as well
    plain: str | None = None  # matches of this pattern are finds, but no part of a credential


FINDERS = (
    Finder("assign", ASSIGN, (":", "="), 2, LONG_VALUE),
    Finder("access", ACCESS, ("AKIA",)),
    Finder("hex", HEX, (), plain="^[0-9]+$"),
)

#: Weak finds; one that overlaps a base find or one of an earlier finder is left out.
WEAK = (
    Finder("identifier", names("username", "user_?id", "user", "login", "account", "client_?id", "access_?key_?id") + _SET + "([A-Za-z0-9+/_.@=-]+)", (":", "="), 2, 3),
    Finder("key", names("passphrase", "passcode", "pass", "pwd", "credential", "private_?key", "auth_?key", "signature") + _SET + _VALUE, (":", "="), 2, SHORT_VALUE),
    Finder("key", ASSIGN, (":", "="), 2, SHORT_VALUE, LONG_VALUE - 1),
    Finder("endpoint", names("hostname", "host", "server", "endpoint") + _SET + "([A-Za-z0-9_.:/-]+)", (":", "="), 2, 4),
    Finder("endpoint", r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]+""", ("://",)),
    Finder("identifier", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}", ("@",)),
    Finder("endpoint", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?", (".",)),
    Finder("key", "[0-9A-F]{16,}", (), needs=("[A-F]",)),
    Finder("key", "[A-Za-z0-9+/_-]{24,}", (), needs=("[0-9]", "[A-Z]", "[a-z]")),
)

_SPAN = "array<struct<start:int,kind:int,end:int,rank:int>>"


def running_sums(steps: Column) -> Column:
    """0 and the sums of the first 1, 2, ... n-1 numbers of a non-empty array.

    An array that grows by one is copied each time, so the sums are made in runs of about the root of n.
    """
    add = lambda total, x: F.concat(total, F.array(F.element_at(total, -1) + x))
    sums_from = lambda start, xs: F.slice(F.aggregate(xs, F.array(start), add), 1, F.size(xs))
    width = F.ceil(F.sqrt(F.size(steps))).cast("int")

    def joined(runs: Column) -> Column:
        totals = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda a, x: a + x))
        return F.flatten(F.zip_with(runs, sums_from(F.lit(0), totals), lambda r, start: sums_from(start, r)))

    cut = lambda w: F.transform(F.sequence(F.lit(0), F.size(steps) - 1, w), lambda i: F.slice(steps, i + 1, w))
    return let(let(width, cut), joined)


def located(text: Column, finder: Finder, rank: int) -> Column:
    """Spans of a finder's matches, leftmost and without overlap."""
    kind = KINDS.index(finder.kind)
    none = F.array().cast(_SPAN)

    def spans(parts: Column) -> Column:
        found, values, between = parts["found"], parts["values"], parts["between"]
        steps = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.length(b) + F.length(m))

        def made(before: Column) -> Column:
            def span(i: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(between, i))
                place = F.lit(rank)
                if finder.plain:
                    place = F.when(F.get(found, i).rlike(finder.plain), NO_PART).otherwise(place)
                return F.struct(
                    start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(F.get(found, i))).alias("end"), place.alias("rank")
                )

            def counts(i: Column) -> Column:
                n = F.length(F.get(values, i))
                good = n >= finder.least
                if finder.most is not None:
                    good = good & (n <= finder.most)
                for pattern in finder.needs:
                    good = good & F.get(found, i).rlike(pattern)
                return good

            at = F.sequence(F.lit(0), F.size(found) - 1)
            return F.transform(F.filter(at, counts), span)

        return let(running_sums(steps), made)

    matches = F.struct(
        F.regexp_extract_all(text, F.lit(finder.pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(finder.pattern), F.lit(finder.group)).alias("values"),
        F.split(text, finder.pattern, -1).alias("between"),
    )
    able = text.rlike(finder.pattern)
    for i, hint in enumerate(finder.hints):
        seen = F.contains(text, F.lit(hint)) if not i else seen | F.contains(text, F.lit(hint))
    if finder.hints:
        able = seen & able
    return F.when(able, let(matches, spans)).otherwise(none)


def breaks(text: Column) -> Column:
    """Where blank lines begin."""
    found = Finder("hex", BREAK, ("\n",))
    return F.transform(located(text, found, 0), lambda s: s["start"])


def _kinds(*names_: str) -> list[int]:
    return [KINDS.index(n) for n in names_]


_IDENTIFIERS, _SECRETS, _ENDPOINTS = _kinds("access", "identifier"), _kinds("assign", "hex", "key"), _kinds("endpoint")


def _has(spans: Column, kinds: list[int]) -> Column:
    return F.exists(spans, lambda s: s["kind"].isin(kinds))


def scanned(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: its number, id, base spans, and where parts could meet, its weak candidates and blank lines."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.flatten(F.array(*(located(body, f, 0) for f in FINDERS)))
    weak = F.flatten(F.array(*(located(body, f, i + 1) for i, f in enumerate(WEAK))))
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(doc).alias("id"), body.alias("body"), base.alias("base"), weak.alias("weak"))
    both = F.concat("base", "weak")
    able = (F.size("weak") > 0) & _has(both, _SECRETS) & (_has(both, _IDENTIFIERS) | _has(both, _ENDPOINTS))
    rows = rows.withColumn("able", able)
    return rows.select("row", "id", "base", "able", F.when(F.col("able"), F.col("weak")).alias("weak"), F.when(F.col("able"), breaks(F.col("body"))).alias("breaks"))


def _bins(low: Column, high: Column) -> Column:
    """Bins of ``WINDOW`` code points from one that holds ``low`` to one that holds ``high``."""
    of = lambda c: F.floor(c / F.lit(WINDOW)).cast("int")
    return F.sequence(of(low), of(high))


def parts_of(able: DataFrame) -> DataFrame:
    """Parts of each text with their scope; weak ones that overlap what has a smaller rank are gone."""
    each = able.select("row", F.explode(F.concat("base", "weak")).alias("s")).select("row", "s.*")
    spread = each.withColumn("bin", F.explode(_bins(F.col("start"), F.col("end") - 1)))
    above = spread.select(F.col("row").alias("_row"), F.col("bin").alias("_bin"), F.col("start").alias("_start"), F.col("end").alias("_end"), F.col("rank").alias("_rank"))
    covered = (
        spread.filter("rank > 0")
        .join(above, (F.col("row") == F.col("_row")) & (F.col("bin") == F.col("_bin")) & (F.col("_rank") < F.col("rank")) & (F.col("_start") < F.col("end")) & (F.col("start") < F.col("_end")), "left_semi")
        .select("row", "start", "kind", "end", "rank")
        .distinct()
    )
    clear = each.join(covered, ["row", "start", "kind", "end", "rank"], "left_anti")
    gaps = able.select("row", F.explode("breaks").alias("start"))
    marked = clear.withColumn("gap", F.lit(0)).unionByName(gaps.withColumn("gap", F.lit(1)), allowMissingColumns=True)
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("scope", F.sum("gap").over(before)).filter("gap = 0").drop("gap")


def linked(parts: DataFrame) -> DataFrame:
    """Weak parts that have their complement in scope and window: the interval join."""
    weak = parts.filter("rank > 0").withColumn("bin", F.explode(F.array_distinct(F.array(*(F.floor(F.col(c) / WINDOW).cast("int") for c in ("start", "end"))))))
    near = parts.filter(F.col("rank") != NO_PART).select(
        F.col("row").alias("_row"),
        F.col("scope").alias("_scope"),
        F.col("start").alias("_start"),
        F.col("end").alias("_end"),
        F.col("kind").alias("_kind"),
        F.explode(_bins(F.col("start") - WINDOW, F.col("end") + WINDOW)).alias("_bin"),
    )
    same = (F.col("row") == F.col("_row")) & (F.col("scope") == F.col("_scope")) & (F.col("bin") == F.col("_bin"))
    apart = F.greatest(F.col("_start") - F.col("end"), F.col("start") - F.col("_end")).between(0, WINDOW)
    seen = lambda kinds: F.max(F.col("_kind").isin(kinds))
    met = weak.join(near, same & apart).groupBy("row", "start", "kind", "end").agg(
        seen(_IDENTIFIERS).alias("identifier"), seen(_SECRETS).alias("secret"), seen(_ENDPOINTS).alias("endpoint")
    )
    kind = F.col("kind")
    whole = (
        F.when(kind.isin(_IDENTIFIERS), F.col("secret"))
        .when(kind.isin(_SECRETS), F.col("identifier") | F.col("endpoint"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return met.filter(whole).select("row", "start", "kind", "end")


def _text_of(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    name = lambda s: F.element_at(F.array(*(F.lit(k) for k in KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def scan(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """id, base and all spans as sorted arrays of (start, kind, end), kinds by their place in ``KINDS``."""
    _, found = stored(scanned(df, doc, text), "scanned")
    plain = lambda spans: F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    rows = found.withColumn("base", plain("base"))
    links = linked(parts_of(found.filter("able")))
    of_text = links.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    able = rows.filter("able").join(of_text, "row", "left")
    more = F.coalesce(F.col("more"), F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    done = able.select("id", "base", F.sort_array(F.concat("base", more)).alias("spans"))
    return done.unionByName(rows.filter(~F.col("able")).select("id", "base", F.col("base").alias("spans"))).withColumnRenamed("id", doc)


def report(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return scan(df, doc, text).select(
        doc,
        *(n(kind).alias(f"n_{kind}") for kind in KINDS[:BASE]),
        F.sha2(_text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
    )
