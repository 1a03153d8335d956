"""Purchases cleaned as they arrive: the row rules of the batch form, and duplicates removed by bounded state.

A duplicate is recognised for as long as ``delay`` after its day, so the state holds the rows of that span and
not of all time. A row that comes later than that is dropped and counted.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators.clean import typed_purchases

DELAY = "7 days"
_DAY = "_day_begins"


def cleaned(purchases: DataFrame, delay: str = DELAY) -> DataFrame:
    """Distinct usable purchases of a stream; see ``clean.clean_transactions``."""
    columns = purchases.columns
    timed = typed_purchases(purchases).withColumn(_DAY, F.col("t_dat").cast("timestamp")).withWatermark(_DAY, delay)
    return timed.dropDuplicatesWithinWatermark(columns).select(*columns)


class Outcome(NamedTuple):
    late: int  # rows that came too late to be compared
    most_held: int  # most rows that the state held after a micro-batch
    batches: int


def run_clean_stream(purchases: DataFrame, table: str, checkpoint: str, delay: str = DELAY) -> Outcome:
    """Clean everything there is into ``table``, one folder a micro-batch, and stop.

    A replayed batch replaces its own folder. The same checkpoint goes on where the last run ended.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    query = (
        cleaned(purchases, delay)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    return Outcome(sum(s["numRowsDroppedByWatermark"] for s in states), max((s["numRowsTotal"] for s in states), default=0), len(states))


def read_cleaned(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).drop("batch_id")
