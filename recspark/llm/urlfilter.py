"""URL filter: host and path rules, then a blocked Bloom filter before an exact hash join.

The listed URLs are brought to a canonical form and each sets eight bits in one
256-bit block of a Bloom filter, built by a grouping on the block number. A URL is
looked up in its one block; what passes is possibly listed and goes on to an equi-join
with the list itself, which removes the false positives. No listed URL is ever missed.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is
never listed. Repeated rows get equal verdicts; repeated list entries count once. Other
columns pass through, one named as a column made here is replaced.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.session import freeze

#: Fixed values: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: First words in the names of advertising and spam sites, as in ``spam-farm.example.org``.
LISTED_NAMES = ("spam", "ads", "casino", "cheap", "free", "adult")
#: Query keys that only track.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = 8  # 32 bits each, held in longs
_KEYS_PER_BLOCK = 12
_MAX_BROADCAST_BLOCKS = 1 << 18


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.expr("substring({u}, instr({u}, '://') + 3)".format(u="_url"))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.when(at > 0, F.translate(host, _UPPER, _UPPER.lower())).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.expr("substring({u}, instr({u}, '://') + 3)".format(u="_url"))
    return F.when(at > 0, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _parts(df: DataFrame, url: str) -> DataFrame:
    made = df.withColumn("_url", F.coalesce(F.col(url), F.lit("")))
    return made.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})


def canonical(host: Column, path: Column, url: Column) -> Column:
    """Host without ``www.`` and ``m.``, path without a closing slash, query without tracking keys, sorted; no fragment."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.array_sort(F.filter(F.split(query, "&", -1), lambda x: (x != "") & ~x.rlike(TRACKING)))
    tail = F.when(F.size(keys) > 0, F.concat(F.lit("?"), F.array_join(keys, "&"))).otherwise(F.lit(""))
    site = F.regexp_replace(F.regexp_replace(host, r"^(www|m)\.", ""), r":(80|443)$", "")
    return F.concat(site, F.regexp_replace(path, "/+$", ""), tail)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest rule that fits, with its verdict; null if none does."""
    fits = [
        F.when(
            ((host == F.lit(h)) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("bigint")


def _masks(key: Column) -> list[Column]:
    """One bit in each of the eight 32-bit words of a block."""
    second = F.xxhash64(key, F.lit("bits"))
    bit = lambda i: F.shiftright(second, 5 * i).bitwiseAND(31).cast("int")
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(i)) for i in range(_WORDS)]


def bloom_blocks(listed: DataFrame, key: str) -> tuple[DataFrame, int, int]:
    """(block number, its words) of the filter of a list; how many blocks it has; how many are used."""
    n = listed.count()
    blocks = max(1, -(-n // _KEYS_PER_BLOCK))
    marked = listed.select(_block(F.col(key), blocks).alias("_block"), *(m.alias(f"_w{i}") for i, m in enumerate(_masks(F.col(key)))))
    table = freeze(marked.groupBy("_block").agg(*(F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(_WORDS))), "bloom")
    return table, blocks, table.count()


def listed_verdict(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """``df`` with ``possible`` (passed the filter) and ``listed`` (is in the list, exactly).

    The filter's blocks are broadcast while they are at most ``_MAX_BROADCAST_BLOCKS``
    (72 bytes each), beyond that they are joined by block number with a shuffle.
    """
    listed = freeze(listed.select(F.col(key).alias("_listed")).filter("_listed is not null").distinct(), "listed")
    table, blocks, used = bloom_blocks(listed, "_listed")
    if used <= _MAX_BROADCAST_BLOCKS:
        table = F.broadcast(table)
    probed = df.withColumn("_block", _block(F.col(key), blocks)).join(table, "_block", "left")
    set_bits = reduce(
        lambda a, b: a & b, (F.col(f"_w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key))))
    )
    probed = probed.withColumn("possible", F.coalesce(set_bits, F.lit(False))).drop("_block", *(f"_w{i}" for i in range(_WORDS)))
    asked = F.when(F.col("possible"), F.col(key))
    return (
        probed.join(listed, asked == F.col("_listed"), "left")
        .withColumn("listed", F.col("_listed").isNotNull())
        .drop("_listed")
    )


def listed_urls(pages: DataFrame, url: str = "url", names: tuple[str, ...] = LISTED_NAMES) -> DataFrame:
    """The default list: canonical URLs seen on hosts named like advertising and spam sites, by the first words ``names``."""
    listed_host = rf"(^|\.)({'|'.join(map(re.escape, names))})-[a-z]+\."
    parts = _parts(pages.select(url), url)
    spam = parts.filter(F.col("host").rlike(listed_host))
    return spam.select(canonical(F.col("host"), F.col("path"), F.col("_url")).alias("canonical")).distinct()


def judge(df: DataFrame, listed: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``df`` with host, path, canonical, rule, listed and verdict; ``listed`` has a column ``canonical``."""
    made = _parts(df, url).withColumn("canonical", canonical(F.col("host"), F.col("path"), F.col("_url")))
    made = made.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).drop("_url")
    out = listed_verdict(made, "canonical", listed)
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return out.withColumns({"rule": F.col("_rule.rule"), "verdict": verdict}).drop("_rule", "possible")
