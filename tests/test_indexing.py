from __future__ import annotations

import pytest

from recspark.operators import indexing


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_index_equals_sorted_position(spark, n):
    keys = [f"k{(i * 7919) % 10007:05d}" for i in range(n)]
    df = spark.createDataFrame([(k,) for k in keys], "customer_id string")
    got = indexing.user_mapping(df)
    assert got.size == len(set(keys))
    assert {r.customer_id: r.user_index for r in got.table.collect()} == {k: i for i, k in enumerate(sorted(set(keys)))}


def test_null_keys_get_no_index_and_shift_nobody(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (None,), (3,)], "article_id bigint")
    assert sorted(tuple(r) for r in indexing.item_mapping(df).table.collect()) == [(1, 0), (3, 1)]


def test_text_keys_sort_by_bytes(spark):
    keys = ["b", "a", "B", "é", "z", "10", "9"]
    df = spark.createDataFrame([(k,) for k in keys], "customer_id string")
    got = {r.customer_id: r.user_index for r in indexing.user_mapping(df).table.collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys, key=lambda k: k.encode()))}


def test_a_key_with_most_of_the_rows_changes_nothing(spark):
    df = spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN 42 ELSE id END AS article_id")
    got = indexing.item_mapping(df)
    expected = sorted({42 if i % 3 == 0 else i for i in range(20000)})
    assert [r.article_id for r in got.table.orderBy("item_index").collect()] == expected


def test_index_is_not_sorted_in_one_task(spark):
    table = indexing.item_mapping(spark.range(1000).withColumnRenamed("id", "article_id")).table
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
