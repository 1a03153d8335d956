"""Purchases and look-up tables stored so that repeated joins on a key need no shuffle.

Both sides are bucketed by the key and a salt. The salt is 0 but for hot keys, those with a thousandth of the
purchases or more: their purchases are spread over ``salts`` values and their look-up row is kept once for each. So a
customer with a third of all purchases fills many buckets, whatever the session does about skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_SHARE = 0.001
SALTS = 64
SALT = "_salt"


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys with at least ``share`` of the rows; there are no more than 1 / share of them."""
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = facts.agg(F.count("*")).scalar()
    return counts.filter(F.col("_n") >= total * F.lit(share)).select(key)


def _marked(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")  # its size is bounded by the share


def salted_facts(facts: DataFrame, hot: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """With a salt from the whole row. Copies of one row share it, so they should have been removed before."""
    spread: Column = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    return _marked(facts, hot, key).withColumn(SALT, F.when(F.col("_hot"), spread).otherwise(F.lit(0))).drop("_hot")


def salted_lookup(lookup: DataFrame, hot: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return _marked(lookup, hot, key).withColumn(SALT, F.explode(every)).drop("_hot")


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, share: float = HOT_SHARE, salts: int = SALTS) -> DataFrame:
    """Join with a table that has one row a key, hot keys split over tasks under any session settings."""
    hot = hot_keys(facts, key, share)
    return salted_facts(facts, hot, key, salts).join(salted_lookup(lookup, hot, key, salts), [key, SALT]).drop(SALT)


def store_bucketed(
    facts: DataFrame, lookup: DataFrame, key: str, facts_name: str, lookup_name: str, path: str, buckets: int,
    share: float = HOT_SHARE, salts: int = SALTS,
) -> None:
    """Write both sides as bucketed tables of the catalogue, their files under ``path``."""
    hot = hot_keys(facts, key, share)
    sides = ((salted_facts(facts, hot, key, salts), facts_name), (salted_lookup(lookup, hot, key, salts), lookup_name))
    for rows, name in sides:
        # dealt like the buckets before, so that each bucket is one file
        dealt = rows.repartition(buckets, key, SALT)
        dealt.write.bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", f"{path}/{name}").saveAsTable(name)


def join_bucketed(spark: SparkSession, facts_name: str, lookup_name: str, key: str) -> DataFrame:
    """The join of two such tables: neither side is shuffled."""
    return spark.table(facts_name).join(spark.table(lookup_name), [key, SALT]).drop(SALT)
