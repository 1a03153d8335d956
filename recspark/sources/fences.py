"""Tables sorted by key, with a directory of the first and last key of every file.

A few requests should not read a table of any size. The table is written in ranges of its key, and a
small table beside it keeps the fences: one row for each file. A look-up finds the files that
can hold the keys asked for by binary search between the fences, and opens only those.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATA, DIRECTORY = "data", "directory"
ROWS_PER_FILE = 1_000_000


class Found(NamedTuple):
    rows: DataFrame  # the requests with the table's columns, null where there is no such key
    files: int  # files that were opened
    of: int  # files of the table


def save_sorted(df: DataFrame, key: str, path: str, files: int | None = None) -> None:
    """Write ``df`` in ranges of ``key`` and then its directory; rows without a key are left out.

    Readers need the directory, which is written last, so a half-written table cannot be read.
    """
    rows = df.filter(F.col(key).isNotNull())
    files = files or max(1, -(-rows.count() // ROWS_PER_FILE))
    rows.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(f"{path}/{DATA}")
    stored = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/{DATA}")
    fences = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows")
    )
    fences.repartitionByRange(1, "first").sortWithinPartitions("first").write.parquet(f"{path}/{DIRECTORY}")


def _places(requests: DataFrame, key: str, first: list, last: list) -> DataFrame:
    """Numbers of the files that can hold a requested key, each once for every task that asks for it."""
    shared = requests.sparkSession.sparkContext.broadcast((first, last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = shared.value
        met: set[int] = set()
        for batch in batches:
            for value in batch.column(0).unique().to_pylist():
                # files hold ranges, so the last one that begins at or before the key is the only one with it
                at = -1 if value is None else bisect_right(first, value) - 1
                if at >= 0 and value <= last[at]:
                    met.add(at)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.int32())], names=["place"])

    return requests.select(key).mapInArrow(run, "place int").distinct()


def look_up(spark: SparkSession, path: str, requests: DataFrame, key: str) -> Found:
    """Join ``requests`` with the rows of the table that have their keys, reading only the files that can hold one.

    The driver holds the directory: two keys and a name for each file.
    """
    fences = spark.read.parquet(f"{path}/{DIRECTORY}").orderBy("first").collect()
    places = [r["place"] for r in _places(requests, key, [r["first"] for r in fences], [r["last"] for r in fences]).collect()]
    table = spark.read.parquet(f"{path}/{DATA}")
    if len(places) < len(fences):
        names = [fences[p]["file"] for p in sorted(places)]
        table = spark.read.schema(table.schema).parquet(*names) if names else table.limit(0)
    return Found(requests.join(table, key, "left"), len(places), len(fences))
