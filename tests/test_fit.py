from __future__ import annotations

import glob
import os

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from recspark import session
from recspark.operators import beside, fit, meet
from recspark.session import SHUFFLE_CLEANUP, freeze


def _counts(spark, rows=600):
    rng = np.random.default_rng(5)
    pairs = {(int(u), int(i)): float(c) for u, i, c in zip(rng.integers(0, 40, rows), rng.integers(0, 50, rows), rng.integers(1, 5, rows), strict=True)}
    pairs |= {(7, i): 1.0 for i in range(50)} | {(3, 4): -2.0}
    return pairs, spark.createDataFrame([(u, i, c) for (u, i), c in pairs.items()], "user_index bigint, item_index bigint, interaction_count double")


def _solved(own: dict, other: np.ndarray) -> np.ndarray:
    """The textbook form, a key at a time."""
    rank, out = other.shape[1], []
    for key in sorted(own):
        a, b = other.T @ other, np.zeros(rank)
        for place, c in own[key]:
            a += abs(c) * np.outer(other[place], other[place])
            b += (1 + c) * other[place] if c > 0 else 0
        out.append(np.linalg.solve(a + 0.1 * sum(c > 0 for _, c in own[key]) * np.eye(rank), b))
    return np.array(out).astype(np.float32).astype(np.float64)


def test_vectors_equal_the_textbook_whatever_the_parts(spark, monkeypatch):
    """Before, another number of blocks gave other vectors, and each block was sent a copy of the other side in every iteration."""
    pairs, counts = _counts(spark)
    by_user, by_item = {}, {}
    for (u, i), c in pairs.items():
        by_user.setdefault(u, []).append((i, c))
        by_item.setdefault(i, []).append((u, c))
    users = fit.first_vectors(np.arange(len(by_user)), 6, 42).astype(np.float64)
    for _ in range(3):
        items = _solved(by_item, users)
        users = _solved(by_user, items)
    for blocks, at_once, packet in ((16, 65_536, 20_000), (3, 8, 10)):
        monkeypatch.setattr(fit, "_AT_ONCE", at_once)
        monkeypatch.setattr(fit, "_RATINGS_A_PACKET", packet)
        found = fit.fit_factors(counts, rank=6, iterations=3, blocks=blocks)
        for table, index, vectors in ((found.users, "user_index", users), (found.items, "item_index", items)):
            rows = sorted(table.collect())
            assert [r[index] for r in rows] == list(range(len(vectors)))
            wanted = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            assert np.abs(np.array([r.embedding for r in rows]) - wanted).max() < 1e-4


def test_each_task_keeps_its_rows_and_meets_all_others(spark):
    kept = beside.packets(spark.range(0, 1000, 1, 5), 1 << 14)
    passing = freeze(beside.packets(spark.range(0, 500, 1, 3).select(F.col("id").alias("other")), 1 << 14), "passing", **beside.STORED)

    def meet(mine, theirs):
        own = [x for b in mine for x in b.column("id").to_pylist()]
        met = sorted(x for b in theirs for x in b.column("other").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([met == list(range(500))] * len(own))], names=["id", "whole"])

    rows = beside.beside(kept, passing, 4, meet, "id bigint, whole boolean").collect()
    assert sorted(r.id for r in rows) == list(range(1000)) and all(r.whole for r in rows)
    assert beside.beside(kept.limit(0), passing, 4, meet, "id bigint, whole boolean").count() == 0
    alone = beside.beside(kept, passing.limit(0), 4, meet, "id bigint, whole boolean").collect()
    assert len(alone) == 1000 and not any(r.whole for r in alone)


def test_modules_that_store_tables_travel_with_the_tasks():
    """The package is sent by value, with all that its modules refer to."""
    cloudpickle.loads(cloudpickle.dumps((meet, session, beside)))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """Before, they stayed until the driver collected its garbage."""
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    size = lambda: sum(os.path.getsize(f) for d in folder for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True))
    spark.sparkContext._jvm.System.gc()
    held, before = spark.conf.get(SHUFFLE_CLEANUP), size()
    rows = freeze(spark.range(200_000).repartition(8, "id"), "dealt")
    assert size() <= before
    assert rows.count() == 200_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == held
