"""Customer and article context kept up to date as purchases arrive.

Spark keeps count and sum per key in its state store. Each micro-batch writes
the keys it changed to a folder named by its batch id, so a replayed batch
replaces its own output, and a reader takes the latest row of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.functions.exact import as_double
from recspark.operators.features import price_totals
from recspark.session import scratch_path


def running_totals(purchases: DataFrame, key: str) -> DataFrame:
    """Count and sum of the readable prices per key; ``purchases`` may be a stream.

    The state holds exact sums, so it does not matter which micro-batch a purchase comes in.
    """
    known = purchases.filter(F.col(key).isNotNull() & F.col("price").isNotNull())
    return price_totals(known, key).select(key, F.col("n").alias("purchase_count"), as_double(F.col("total")).alias("price_sum"))


def start_running_context(purchases: DataFrame, key: str, table: str, checkpoint: str):
    """Start the query that maintains ``table``; it stops when all input present has been read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    return (
        running_totals(purchases, key)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_running_context(spark: SparkSession, table: str, key: T.StructField | str, prefix: str) -> DataFrame:
    """Latest totals of each key as context columns; the key by name, or as a field where the table may be empty."""
    latest = F.max(F.struct("batch_id", "purchase_count", "price_sum")).alias("_last")
    rows = _read_totals(spark, table, key)
    name = key if isinstance(key, str) else key.name
    return _as_context(rows.groupBy(name).agg(latest).select(name, "_last.*"), name, prefix)


def _read_totals(spark: SparkSession, table: str, key: T.StructField | str) -> DataFrame:
    """Every row written so far; a folder without any is an empty table if the key's type is given."""
    if isinstance(key, str):
        return spark.read.parquet(table)
    schema = T.StructType(
        [
            key,
            T.StructField("purchase_count", T.LongType()),
            T.StructField("price_sum", T.DoubleType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(table)
    there = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
    return spark.read.schema(schema).parquet(table) if there else spark.createDataFrame([], schema)


def compact_running_context(spark: SparkSession, table: str, key: T.StructField, target: str) -> None:
    """Write the latest row of each key to ``target``, a table of the same layout with one batch folder.

    The stream goes on writing to ``table`` meanwhile; a reader of the union of both takes the
    latest batch of each key, so no row is lost or counted twice.
    """
    latest = F.max(F.struct("batch_id", "purchase_count", "price_sum")).alias("_last")
    rows = _read_totals(spark, table, key).groupBy(key.name).agg(latest).select(key.name, "_last.*")
    rows.write.mode("overwrite").partitionBy("batch_id").parquet(target)


def _as_context(totals: DataFrame, key: str, prefix: str) -> DataFrame:
    average = F.col("price_sum") / F.col("purchase_count")
    return totals.select(
        key, F.col("purchase_count").alias(f"{prefix}_total_purchases"), average.alias(f"{prefix}_avg_price")
    )


def run_running_context(purchases: DataFrame, key: str, prefix: str) -> DataFrame:
    """Drive a stream over everything there is and return the resulting context."""
    spark = purchases.sparkSession
    table = scratch_path(spark, f"stream-{prefix}")
    query = start_running_context(purchases, key, table, scratch_path(spark, f"stream-{prefix}-state"))
    query.awaitTermination()
    return read_running_context(spark, table, purchases.schema[key], prefix)
