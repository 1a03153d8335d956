"""Artifacts that belong together, checked while they are written and published as one version.

Each table is written once into the folder of a new version. Its checks are metrics that Spark collects in that same pass,
so nothing is read again. Only when every table has passed does a manifest name the version; until then, and if a check
fails, readers keep the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recspark.functions.vectors import is_finite, is_unit
from recspark.operators.quality import BATCH_NORM_TOLERANCE
from recspark.sources import manifest


class Checked(NamedTuple):
    """A table with what is counted while it is written, and what must hold of the counts, by name."""

    table: DataFrame
    metrics: dict[str, Column]
    holds: dict[str, Callable[[dict], bool]]


def index_metrics(index: str) -> tuple[dict[str, Column], dict[str, Callable[[dict], bool]]]:
    """Counts that 0..n-1 has. They tell of gaps, repeats and nulls unless several make up for each other exactly."""
    i = F.col(index)
    metrics = {
        "rows": F.count("*"),
        "indexed": F.count(i),
        "least": F.coalesce(F.min(i), F.lit(0)),
        "greatest": F.coalesce(F.max(i), F.lit(-1)),
        "index_sum": F.coalesce(F.sum(i.cast("decimal(20,0)")), F.lit(0)).cast("string"),
        "square_sum": F.coalesce(F.sum((i.cast("decimal(19,0)") * i).cast("decimal(38,0)")), F.lit(0)).cast("string"),
    }

    def sequential(m: dict) -> bool:
        n = m["rows"]
        sums = n * (n - 1) // 2, n * (n - 1) * (2 * n - 1) // 6
        ends = not n or (m["least"] == 0 and m["greatest"] == n - 1)
        return m["indexed"] == n and ends and sums == (int(m["index_sum"]), int(m["square_sum"]))

    return metrics, {f"{index} is sequential": sequential}


def checked_context(table: DataFrame, index: str, total: str, average: str) -> Checked:
    metrics, holds = index_metrics(index)
    avg = F.col(average)
    metrics |= {
        "positive": F.count_if(F.col(total) > 0),
        "finite": F.count_if(avg.isNotNull() & ~F.isnan(avg) & (F.abs(avg) < F.lit(float("inf")))),
    }
    holds |= {
        "purchase counts are positive": lambda m: m["positive"] == m["rows"],
        "average prices are finite": lambda m: m["finite"] == m["rows"],
    }
    return Checked(table, metrics, holds)


def checked_vectors(table: DataFrame, index: str, size: int, expected: int, norm: float = BATCH_NORM_TOLERANCE) -> Checked:
    """Unit vectors of ``size`` components for ``expected`` keys."""
    metrics, holds = index_metrics(index)
    v = F.col("embedding")
    metrics |= {"sized": F.count_if(F.size(v) == size), "finite": F.count_if(is_finite(v)), "unit": F.count_if(is_unit(v, norm))}
    holds |= {
        "embedding count matches mapping": lambda m: m["rows"] == expected,
        "vector size matches": lambda m: m["sized"] == m["rows"],
        "vectors are finite": lambda m: m["finite"] == m["rows"],
        "vectors have unit length": lambda m: m["unit"] == m["rows"],
    }
    return Checked(table, metrics, holds)


def publish(spark: SparkSession, root: str, tables: dict[str, Checked]) -> manifest.Manifest:
    """Write all tables as the next version under ``root``; ends with an error, and publishes nothing, if a check fails."""
    was, version = manifest.current(spark, root), uuid.uuid4().hex
    found: dict[str, dict] = {}
    failed: list[str] = []
    for name, (table, metrics, holds) in tables.items():
        seen = Observation(name)
        table.observe(seen, *(m.alias(k) for k, m in metrics.items())).write.parquet(f"{root}/{version}/{name}")
        found[name] = dict(seen.get)
        failed += [f"{name}: {check}" for check, ok in holds.items() if not ok(found[name])]
    if failed:
        raise RuntimeError(f"{len(failed)} check(s) failed: {', '.join(failed)}")
    return manifest.publish(spark, root, was, {"version": version, "tables": found})


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version."""
    now = manifest.current(spark, root)
    if not now or name not in now.content["tables"]:
        raise ValueError(f"{root}: no version with {name} was published")
    return spark.read.parquet(f"{root}/{now.content['version']}/{name}")
