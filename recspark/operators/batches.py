"""Fixed-size training batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.indexing import dense_index

# Batch size and shuffle seed.
BATCH_SIZE = 1024
SHUFFLE_SEED = 42


def training_batches(
    examples: DataFrame, batch_size: int = BATCH_SIZE, shuffle: bool = False, seed: int = SHUFFLE_SEED
) -> DataFrame:
    """Number the examples and cut them into batches of ``batch_size``.

    Shuffled order is the order of a seeded digest of the pair: the same on
    every run, and global rather than limited to a buffer. Input rows are
    expected to be distinct, as sampled interactions are.
    """
    columns = ["user_index", "item_index", "label"]
    order = list(columns)
    rows = examples.select(*columns)
    if shuffle:
        text = F.concat_ws("|", F.col("user_index").cast("string"), F.col("item_index").cast("string"), F.lit(str(seed)))
        rows = rows.withColumn("_order", F.md5(text))
        order = ["_order", *columns]
    numbered = dense_index(rows, order, "row_number", "batches").table
    batch = F.floor(F.col("row_number") / F.lit(batch_size)).cast("bigint")
    return numbered.select(batch.alias("batch_id"), "row_number", *columns)


def inspect_batches(batches: DataFrame) -> DataFrame:
    """Size and label count of every batch."""
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("label") == 1).alias("positive_count")
    )
