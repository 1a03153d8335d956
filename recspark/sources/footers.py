"""First and last day of stored purchases from the statistics in their Parquet footers.

Files keep the least and greatest value of each column, so the range of the days needs no scan. Where a file lacks
statistics the reader says so, and the column is scanned instead.
"""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Footers are read by the second version of the file source, which a session of its own switches on.
_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def range_query(spark: SparkSession, path: str, column: str = "t_dat") -> DataFrame:
    """One row with the least and greatest value, answered by footers."""
    own = spark.newSession()
    for key, value in _SETTINGS.items():
        own.conf.set(key, value)
    return own.read.parquet(path).agg(F.min(column).alias("first"), F.max(column).alias("last"))


def day_range(spark: SparkSession, path: str, column: str = "t_dat") -> tuple[dt.date | None, dt.date | None]:
    try:
        return tuple(range_query(spark, path, column).first())
    except (PySparkException, Py4JJavaError):  # the scan ends with an error of its own if something else is wrong
        return tuple(spark.read.parquet(path).agg(F.min(column), F.max(column)).first())
