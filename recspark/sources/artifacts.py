"""Tables that one job writes and another serves from, with their contracts.

A key always travels in the same row as its vector or context, so nothing
depends on two files having the same row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.vectors import is_finite, is_unit

USER_CONTEXT = ("customer_id", "user_index", "customer_total_purchases", "customer_avg_price")
ITEM_CONTEXT = ("article_id", "item_index", "item_total_purchases", "item_avg_price")
ITEM_EMBEDDINGS = ("article_id", "item_index", "embedding")
NORM_TOLERANCE = 1e-4
WEIGHTS = ("tower", "layer", "out_unit", "w", "b")
BATCHES = ("batch_id", "user_index", "item_index", "label")


def _write(df: DataFrame, path: str, columns: tuple[str, ...], partition_by: str | None = None) -> None:
    writer = df.select(*columns).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def _read(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    df = spark.read.parquet(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    return df.select(*columns)


def save_user_context(df: DataFrame, path: str) -> None:
    _write(df, path, USER_CONTEXT)


def load_user_context(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, USER_CONTEXT)


def save_item_embeddings(df: DataFrame, path: str) -> None:
    _write(df, path, ITEM_EMBEDDINGS)


def load_item_embeddings(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """The stored vectors; ends with an error if one is not finite, not of length 1 or of another size than the rest.

    ``size`` is the number of components they must have, by default that of the first one.
    """
    df = _read(spark, path, ITEM_EMBEDDINGS)
    v = F.col("embedding")
    found = df.agg(
        F.count_if(~F.coalesce(is_finite(v) & is_unit(v, NORM_TOLERANCE), F.lit(False))).alias("bad"),
        F.min(F.coalesce(F.size(v), F.lit(-1))).alias("least"),
        F.max(F.size(v)).alias("most"),
    ).first()
    if found.bad or found.least != found.most or size not in (None, found.most):
        raise ValueError(f"{path}: {found.bad} vectors are not finite or not of length 1; sizes {found.least} to {found.most}")
    return df


def save_model_weights(df: DataFrame, path: str) -> None:
    _write(df, path, WEIGHTS)


def load_model_weights(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, WEIGHTS)


def save_training_batches(df: DataFrame, path: str) -> None:
    """Shards for a trainer: rows of one batch lie together, sorted by batch."""
    ordered = df.select(*BATCHES).repartitionByRange("batch_id").sortWithinPartitions("batch_id")
    ordered.write.mode("overwrite").parquet(path)


def load_training_batches(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, BATCHES)


def context_vector(df: DataFrame, total: str, average: str, name: str = "context") -> DataFrame:
    """The two context columns as the float vector a tower takes."""
    vector = F.array(F.col(total).cast("float"), F.col(average).cast("float"))
    return df.withColumn(name, vector)
