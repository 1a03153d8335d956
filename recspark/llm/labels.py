"""Labelled rows to learn from: a bounded, repeatable sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 30


def held_out(doc: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, rows: int, doc: str = "doc_id") -> DataFrame:
    """(id, label, draw) of about ``rows`` labelled ids at most, one row each; ``draw`` is uniform below 2^30.

    An id labelled more than once takes its greatest label. With n ids, one is taken if its
    hash is under rows / n of the range, so the sample is the same on any cluster, and its
    size exceeds ``rows`` by a tenth with a probability that is negligible for thousands of rows.
    """
    one = labels.filter(F.col(doc).isNotNull() & F.col(label).isNotNull()).groupBy(doc).agg(F.max(label).alias("label"))
    n = one.count()
    draw = F.pmod(F.xxhash64(F.col(doc).cast("string"), F.lit(label)), F.lit(_PARTS))
    drawn = one.withColumn("draw", draw)
    return drawn if n <= rows else drawn.filter(F.col("draw") < int(_PARTS * rows / n))


def labelled_texts(documents: DataFrame, sample: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(draw, label, text) of the sampled ids. The sample is broadcast: its size is bounded by ``labelled_sample``."""
    return documents.select(F.col(doc), F.col(text).alias("text")).join(F.broadcast(sample), doc).select("draw", "label", "text")
