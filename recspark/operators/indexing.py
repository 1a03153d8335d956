"""Dense 0-based indices in key order, without sorting the table in one task."""

from __future__ import annotations

from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import freeze

_ROW_BITS = 33


class DenseIndex(NamedTuple):
    table: DataFrame
    size: int


def dense_index(rows: DataFrame, order_by: list[str], index_name: str, name: str = "index") -> DenseIndex:
    """Number the rows 0..n-1 in the order of ``order_by``.

    A window without partitions would send every row to one task. Here the rows
    are range-partitioned and sorted, each is numbered inside its partition, and
    the result is frozen in the shared folder, so that partition sizes and row
    numbers can never come from two different runs of the sampling. What reaches
    the driver is one count per partition, however many rows there are.

    ``order_by`` must identify a row: equal rows cannot be split across ranges.
    """
    slot = F.monotonically_increasing_id()
    numbered = (
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", slot)
        .withColumn("_part", F.shiftright("_slot", _ROW_BITS).cast("int"))
        .withColumn("_row", F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_slot")
    )
    frozen = freeze(numbered, name)
    sizes = {r["_part"]: r["n"] for r in frozen.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return DenseIndex(frozen.select(*rows.columns, F.lit(0).cast("bigint").alias(index_name)), 0)
    counts = [sizes.get(part, 0) for part in range(max(sizes) + 1)]
    starts = [0, *accumulate(counts)]
    start = F.expr(f"array({', '.join(f'{s}L' for s in starts[:-1])})")[F.col("_part")]
    table = frozen.select(*rows.columns, (start + F.col("_row")).alias(index_name))
    return DenseIndex(table, starts[-1])


def key_index(transactions: DataFrame, key: str, index_name: str) -> DenseIndex:
    """Index of the distinct keys; null keys get none and shift nobody."""
    keys = transactions.select(key).filter(F.col(key).isNotNull()).distinct()
    return dense_index(keys, [key], index_name, index_name)


def user_mapping(transactions: DataFrame) -> DenseIndex:
    return key_index(transactions, "customer_id", "user_index")


def item_mapping(transactions: DataFrame) -> DenseIndex:
    return key_index(transactions, "article_id", "item_index")
