"""Tasks that keep some rows of one table while all rows of another pass by.

A grid of cells writes a copy of a row for every group of the other side. Here the kept rows are dealt to tasks once, and each task
reads the other table from where it is stored, so neither side is copied to disk, however many tasks there are. Spark's own way
to do so is a nested-loop join of partitions; rows travel in packets, Arrow streams of some rows each, and each packet is handed
to Python once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKET = "_packet"
SCHEMA = f"{PACKET} binary"
PACKET_BYTES = 256 * 1024
#: Files of packets have small row groups, as a reader holds one whole; vectors do not get smaller by compression.
STORED = {"parquet.block.size": str(16 * 1024 * 1024), "compression": "uncompressed"}
_ROW_BITS = 33


def to_packet(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row that holds all rows of ``batch``."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=[PACKET])


def from_packet(packet: pa.BinaryScalar) -> Iterator[pa.RecordBatch]:
    return pa.ipc.open_stream(packet.as_buffer())


def packets(rows: DataFrame, row_bytes: int) -> DataFrame:
    """``rows`` in packets, in their order."""
    most = max(1, PACKET_BYTES // max(1, row_bytes))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                yield to_packet(batch.slice(at, most))

    return rows.mapInArrow(pack, SCHEMA)


def beside(
    kept: DataFrame,
    passing: DataFrame,
    parts: int,
    meet: Callable[[list[pa.RecordBatch], Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """What ``meet`` makes in each of ``parts`` tasks of the rows it keeps, and of all rows that pass by.

    Both tables consist of packets. ``passing`` is read once per task, so it should be a stored table.
    """
    spark = kept.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    mine = kept.repartition(parts).select(F.col(PACKET).alias("_kept"), (place == 0).alias("_lead"))
    # a row of its own meets all kept packets; every other one meets the first only
    start = spark.range(0, 1, 1, 1).select(F.lit(None).cast("binary").alias("_passing"))
    theirs = start.unionAll(passing.select(F.col(PACKET).alias("_passing"))).coalesce(1)
    starting = F.col("_passing").isNull()
    met = theirs.join(mine.hint("shuffle_replicate_nl"), starting | F.col("_lead"))
    rows = met.select(F.when(starting, F.col("_kept")).alias("_kept"), "_passing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meetings = (pair for batch in batches for pair in zip(batch.column(0), batch.column(1), strict=True))
        held, early = [], []

        def passes(first: pa.BinaryScalar) -> Iterator[pa.RecordBatch]:
            for packet in chain([first], (p for _, p in meetings)):
                yield from from_packet(packet)

        for mine_, theirs_ in meetings:
            if mine_.is_valid:
                held += from_packet(mine_)
            elif held:
                yield from meet(held, chain(iter(early), passes(theirs_)))
                return
            else:  # where a store names the places of its files, the first row need not come first
                early += from_packet(theirs_)
        if held:
            yield from meet(held, iter(early))

    return rows.mapInArrow(run, schema)
