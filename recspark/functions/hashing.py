"""Pair hashes that pick and order negative samples.

``xxhash64`` is the default and runs inside generated code. ``md5`` gives the
same numbers in any SQL engine, which makes sampled results comparable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

XXHASH64 = "xxhash64"
MD5 = "md5"

# 15 hexadecimal digits: the most that fit a signed 64-bit integer
_MD5_DIGITS = 15


def pair_hash(left: Column, right: Column, seed: int, method: str = XXHASH64) -> Column:
    if method == XXHASH64:
        return F.xxhash64(left, right, F.lit(seed))
    if method == MD5:
        text = F.concat_ws("|", left.cast("string"), right.cast("string"), F.lit(str(seed)))
        return F.conv(F.substring(F.md5(text), 1, _MD5_DIGITS), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method: {method}")


def hash_bucket(hashed: Column, buckets: int) -> Column:
    """``abs(hash) mod buckets``; the remainder comes first because the absolute
    value of the smallest 64-bit integer does not exist."""
    return F.abs(hashed % F.lit(buckets).cast("bigint"))


def hash_share(hashed: Column, method: str = XXHASH64) -> Column:
    """Position of the hash in its range as a number from 0 to 1, growing with the hash."""
    if method == XXHASH64:
        return hashed.cast("double") / F.lit(2.0**64) + F.lit(0.5)
    return hashed.cast("double") / F.lit(16.0**_MD5_DIGITS)
