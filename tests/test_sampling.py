from __future__ import annotations

import struct
from collections import Counter

import pytest
import xxhash

from recspark.functions.hashing import MD5, XXHASH64, hash_bucket, pair_hash
from recspark.operators import features, indexing, sampling
from pyspark.sql import functions as F


def _xxhash64(customer: str, article: int, seed: int) -> int:
    """What the engine computes: each column seeds the hash of the next, starting from 42."""
    h = xxhash.xxh64_intdigest(customer.encode(), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", article), h)
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), h)
    return h - 2**64 if h >= 2**63 else h


def _pairs(transactions):
    return {(r.customer_id, r.article_id) for r in transactions.collect()}


def test_negatives_equal_brute_force(spark, transactions):
    bought = _pairs(transactions)
    items = sorted({a for _, a in bought})
    expected = {(c, items[abs(_xxhash64(c, a, 42)) % len(items)]) for c, a in bought} - bought
    got = sampling.negative_interactions(transactions).collect()
    assert Counter((r.customer_id, r.article_id) for r in got) == Counter(expected)
    assert {r.label for r in got} == {0.0}


@pytest.mark.parametrize("method", [XXHASH64, MD5])
@pytest.mark.parametrize("seed", [42, 7])
def test_invariants(spark, transactions, method, seed):
    bought = _pairs(transactions)
    rows = sampling.training_interactions(transactions, seed=seed, method=method).collect()
    positives = {(r.customer_id, r.article_id) for r in rows if r.label == 1.0}
    negatives = [(r.customer_id, r.article_id) for r in rows if r.label == 0.0]
    assert positives == bought
    assert not set(negatives) & bought and len(set(negatives)) == len(negatives)
    per_customer = Counter(c for c, _ in negatives)
    assert all(per_customer[c] <= Counter(c for c, _ in bought)[c] for c in per_customer)


@pytest.mark.parametrize("method", [XXHASH64, MD5])
@pytest.mark.parametrize("rows_per_slice", [1, 3, 7, 1_000_000])
def test_slices_do_not_change_the_ratio_filter(spark, transactions, method, rows_per_slice):
    """The large customer's rank is assembled from slices; the outcome is that of one ranking."""
    positives = transactions.select("customer_id", "article_id").distinct()
    pool = positives.select("customer_id", (F.col("article_id") + 1000).alias("article_id"))
    kept = sampling.within_ratio(pool, positives, 0.5, 42, method, rows_per_slice).collect()
    hashed = pool.withColumn("h", pair_hash(F.col("customer_id"), F.col("article_id"), 42, method)).collect()
    expected = set()
    for customer in {r.customer_id for r in hashed}:
        mine = sorted((r.h, r.article_id) for r in hashed if r.customer_id == customer)
        expected |= {(customer, a) for _, a in mine[: len(mine) // 2]}
    assert Counter((r.customer_id, r.article_id) for r in kept) == Counter(expected)


def test_ratio_above_one_changes_nothing(spark, transactions):
    one = sampling.negative_interactions(transactions, 1)
    five = sampling.negative_interactions(transactions, 5)
    assert sorted(one.collect()) == sorted(five.collect())


def test_smallest_hash_has_a_bucket(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (-5,)], "h bigint")
    got = [r.b for r in df.select(hash_bucket(F.col("h"), 7).alias("b")).collect()]
    assert got == [2**63 % 7, (2**63 - 1) % 7, 5]


def test_null_customer_is_positive_but_gets_no_negative(spark):
    rows = [(None, 1), ("a", 1), ("a", 2), ("b", 3)]
    df = spark.createDataFrame(rows, "customer_id string, article_id bigint")
    got = sampling.training_interactions(df).collect()
    assert {(r.customer_id, r.label) for r in got if r.customer_id is None} == {(None, 1.0)}


def test_sampling_has_no_product_join(spark, transactions):
    positives = sampling.stored_positives(transactions)
    sampled = sampling.sample_interactions(positives, indexing.item_mapping(positives))
    plan = sampled._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert features.label_distribution(sampled).count() == 2


def test_grouping_of_pairs_has_tasks_by_rows(transactions, monkeypatch):
    """Before, the number of tasks followed the session, so the memory of one grew with the pairs."""
    monkeypatch.setattr(sampling, "_ROWS_PER_TASK", 10)
    positives = sampling.stored_positives(transactions)
    candidates = sampling.negative_candidates(positives, indexing.item_mapping(positives))
    assert sampling.label_pairs(positives, candidates).rdd.getNumPartitions() == -(-2 * positives.count() // 10)
