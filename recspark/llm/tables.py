"""Tables between the rounds of an iteration, in the shared folder, and filters that save shuffled bytes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from recspark.session import freeze, scratch_path

#: Words of a bit filter that go to the tasks at most, 8 bytes each.
_FILTER_WORDS = 1 << 24


def stored(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """Write ``df`` to a new path of the shared folder and read it back; (path, table)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that ``stored`` made and nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def bit_filter(keys: DataFrame, key: str) -> Callable[[str], Column] | None:
    """A test on a column that all values of ``key`` pass and few others; none where it would take over ``_FILTER_WORDS`` words.

    Spark sets the bits: a row for each 64-bit word, at most half as many as there are keys, reaches the driver. The test only
    saves shuffled bytes, an exact join follows.
    """
    spark = keys.sparkSession
    hashed = freeze(keys.select(F.xxhash64(key).alias("hashed")), "hashed-keys")
    words = 1 << max(10, (hashed.count() // 4).bit_length())
    if words > _FILTER_WORDS:
        return None
    word, bit = F.shiftrightunsigned("hashed", 6).bitwiseAND(words - 1), F.col("hashed").bitwiseAND(63).cast("int")
    table = hashed.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bit"))
    found = table.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(bits)

    def test(hashes: pa.Array) -> pa.Array:
        h = hashes.to_numpy().view(np.uint64)
        held = sent.value[((h >> np.uint64(6)) & np.uint64(words - 1)).astype(np.int64)]
        return pa.array(((held >> (h & np.uint64(63))) & np.uint64(1)).astype(bool))

    return lambda column: F.arrow_udf(test, ST.BooleanType())(F.xxhash64(column))
