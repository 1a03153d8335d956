from __future__ import annotations

import pytest

from recspark.operators import features
from recspark.streaming import running_context


def _stream(spark, path):
    schema = "customer_id string, price double"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def _write(path, name, rows):
    import json

    (path / name).write_text("\n".join(json.dumps({"customer_id": c, "price": p}) for c, p in rows))


BATCHES = [[("a", 1.0), ("b", 2.0), ("a", None)], [("a", 3.0), (None, 1.0)], [("c", 5.0), ("b", 4.0), ("b", 6.0)]]


def test_stream_equals_batch_over_many_micro_batches(spark, tmp_path):
    for i, rows in enumerate(BATCHES):
        _write(tmp_path, f"{i}.json", rows)
    got = running_context.run_running_context(_stream(spark, str(tmp_path)), "customer_id", "customer")
    batch = features.served_context(
        spark.read.schema("customer_id string, price double").json(str(tmp_path)).na.drop(), "customer_id", "customer"
    )
    assert sorted(got.collect()) == sorted(batch.collect())
    assert {r.customer_id: r.customer_total_purchases for r in got.collect()} == {"a": 2, "b": 3, "c": 1}


def test_a_restarted_stream_continues(spark, tmp_path):
    source, table, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    for i, rows in enumerate(BATCHES):
        _write(source, f"{i}.json", rows)
        query = running_context.start_running_context(_stream(spark, str(source)), "customer_id", table, state)
        query.awaitTermination()
    got = running_context.read_running_context(spark, table, "customer_id", "customer").collect()
    assert {r.customer_id: (r.customer_total_purchases, r.customer_avg_price) for r in got} == {
        "a": (2, 2.0),
        "b": (3, 4.0),
        "c": (1, 5.0),
    }


def test_empty_stream(spark, tmp_path):
    got = running_context.run_running_context(_stream(spark, str(tmp_path)), "customer_id", "customer")
    assert got.count() == 0 and got.columns == ["customer_id", "customer_total_purchases", "customer_avg_price"]


@pytest.mark.parametrize("times", [1, 3])
def test_replayed_batch_replaces_itself(spark, tmp_path, times):
    df = spark.createDataFrame([("a", 2, 3.0)], "customer_id string, purchase_count bigint, price_sum double")
    for _ in range(times):
        df.write.mode("overwrite").parquet(f"{tmp_path}/t/batch_id=0")
    got = running_context.read_running_context(spark, f"{tmp_path}/t", "customer_id", "customer")
    assert [tuple(r) for r in got.collect()] == [("a", 2, 1.5)]


def test_a_run_whose_latest_batches_were_empty_keeps_its_table(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i, rows in enumerate([[("a", 1.0), ("a", 3.0)], [], [(None, 1.0)], [], [("b", None)]]):
            _write(tmp_path, f"{i}.json", rows)
        got = running_context.run_running_context(_stream(spark, str(tmp_path)), "customer_id", "customer")
        assert [(r.customer_id, r.customer_total_purchases) for r in got.collect()] == [("a", 2)]
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_compaction_keeps_the_latest_totals(spark, tmp_path):
    from pyspark.sql import types as T

    schema = "customer_id string, purchase_count bigint, price_sum double"
    for batch, rows in enumerate([[("a", 1, 1.0), ("b", 1, 2.0)], [("a", 2, 4.0)], [("c", 1, 5.0)]]):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/t/batch_id={batch}")
    key = T.StructField("customer_id", T.StringType())
    running_context.compact_running_context(spark, f"{tmp_path}/t", key, f"{tmp_path}/small")
    for table in ("t", "small"):
        got = running_context.read_running_context(spark, f"{tmp_path}/{table}", key, "customer").collect()
        assert {r.customer_id: r.customer_total_purchases for r in got} == {"a": 2, "b": 1, "c": 1}
    assert spark.read.parquet(f"{tmp_path}/small").count() == 3
