"""Whole pipelines, skew, and the shape of plans."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from recspark.operators import assemble, batches, evaluate, features, fit, indexing, split
from recspark.plans import serving, training
from recspark.session import freeze, shared_dir
from recspark.sources import artifacts, views


def test_training_set_has_no_gaps_and_both_labels(spark, transactions):
    rows = training.training_features(transactions)
    assert assemble.context_null_counts(rows).first().asDict() == {f"null_{c}": 0 for c in assemble.CONTEXT_COLUMNS}
    assert {r.label for r in features.label_distribution(rows).collect()} == {0.0, 1.0}


def test_context_comes_from_the_train_period_only(spark, transactions):
    bounds = split.split_bounds(transactions)
    train, _, _ = split.split_parts(transactions, bounds)
    users = indexing.user_mapping(transactions).table.join(features.user_context(train), "customer_id")
    expected = {r.user_index: (r.customer_total_purchases, r.customer_avg_price) for r in users.collect()}
    for r in training.training_features(transactions).collect():
        count, price = expected[r.user_index]
        assert r.customer_total_purchases == count and math.isclose(r.customer_avg_price, price)


def test_null_counts_of_nothing_are_zero(spark, transactions):
    empty = training.training_features(transactions).filter("false")
    assert set(assemble.context_null_counts(empty).first()) == {0}


def test_hot_customer_is_split_by_the_join(spark):
    """One customer has a third of all rows; the join must cut that partition and lose nothing."""
    facts = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END AS customer_id",
        "id % 1000 AS article_id",
        "CAST(id AS DOUBLE) AS price",
        "1 AS sales_channel_id",
    )
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        users, items = indexing.user_mapping(facts).table, indexing.item_mapping(facts).table
        joined = assemble.two_tower_dataset(facts.repartition(16), users, items)
        assert joined.agg(F.count("*"), F.sum("price")).first() == (300_000, float(sum(range(300_000))))
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_batches_are_full_and_keep_every_row(spark):
    rows = spark.range(2500).selectExpr("id AS user_index", "id * 3 AS item_index", "1.0D AS label")
    shuffled = batches.training_batches(rows, 1000, shuffle=True)
    counts = {r.batch_id: r.row_count for r in batches.inspect_batches(shuffled).collect()}
    assert counts == {0: 1000, 1: 1000, 2: 500}
    assert sorted(r.user_index for r in shuffled.collect()) == list(range(2500))
    in_order = batches.training_batches(rows, 1000)
    assert all(r.row_number == r.user_index for r in in_order.collect())
    assert [r.user_index for r in shuffled.orderBy("row_number").limit(5).collect()] != list(range(5))
    again = batches.training_batches(rows.repartition(3), 1000, shuffle=True)
    assert sorted(again.collect()) == sorted(shuffled.collect())


def test_recall(spark):
    lists = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "customer_id string, article_id bigint")
    truth = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3), ("d", 4)], "customer_id string, article_id bigint")
    assert evaluate.recall_at_k(lists, truth).first() == (4, 1, 0.25)
    assert evaluate.recall_at_k(lists, truth.filter("false")).first() == (0, 0, None)


def test_artifacts_are_written_and_checked(spark, sf_dir, tmp_path):
    tx = views.transactions(spark, sf_dir)
    users, items = str(tmp_path / "users"), str(tmp_path / "items")
    serving.build_artifacts(tx, users, items, lambda n: views.index_embeddings(spark, sf_dir, n), views.formula_weights(spark))
    assert artifacts.load_user_context(spark, users).count() == tx.select("customer_id").distinct().count()
    vectors = artifacts.load_item_embeddings(spark, items)
    assert vectors.schema["embedding"].dataType.simpleString() == "array<float>"


def test_unknown_customers_get_no_list(spark, sf_dir):
    recommender = serving.build_recommender(
        views.transactions(spark, sf_dir), lambda n: views.index_embeddings(spark, sf_dir, n), views.formula_weights(spark)
    )
    asked = spark.createDataFrame([(3,), (10**9,)], "customer_id bigint")
    assert {(r.customer_id, r.n) for r in recommender.recommend(asked).groupBy("customer_id").agg(F.count("*").alias("n")).collect()} == {(3, 10)}


def test_fitted_vectors_and_score(spark, sf_dir):
    tx = views.transactions(spark, sf_dir)
    users, items = indexing.user_mapping(tx), indexing.item_mapping(tx)
    counts = assemble.add_id_mappings(features.real_interactions(tx), users.table, items.table)
    factors = fit.fit_factors(counts, rank=8, iterations=2)
    assert factors.users.count() == users.size and factors.items.count() == items.size
    for r in factors.users.collect():
        assert len(r.embedding) == 8 and math.isclose(sum(x * x for x in r.embedding), 1.0, abs_tol=1e-5)
    from recspark.operators.encode import score_pairs

    examples = score_pairs(training.training_features(tx), factors.users, factors.items).cache()
    scored = fit.fit_context_ranker(examples)(examples)
    result = fit.mean_loss(scored).first()
    assert result.example_count == examples.count() and result.mean_loss < math.log(2)
    examples.unpersist()


def test_freeze_uses_the_named_shared_folder(spark):
    frozen = freeze(spark.range(10), "probe")
    assert frozen.count() == 10
    assert shared_dir(spark).split(":")[-1].lstrip("/") in frozen.inputFiles()[0]


@pytest.mark.parametrize("feature", [features.user_context, features.item_context, features.real_interactions])
def test_only_needed_columns_are_scanned(spark, sf_dir, feature):
    plan = feature(views.transactions(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in plan and "o_orderpriority" not in plan and "partial_count" in plan


def test_ranges_follow_the_number_of_partitions_asked_for(spark):
    """Also when the number is changed after the session was built: nothing else is pinned."""
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") is None
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (8, 24):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            ranged = spark.range(1000).repartitionByRange("id").select(F.spark_partition_id().alias("p"))
            assert ranged.distinct().count() == n
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
