"""Point look-up between fences, the log of stored recommendations, and its streaming form with expiry."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from recspark.sources import fences, log_store, store
from recspark.streaming import expiring_store

# --- fences ----------------------------------------------------------------------------------------------------


def _context(spark, n, as_text=False):
    key = F.format_string("c%06d", "id") if as_text else F.col("id") * 3
    return spark.range(n).select(key.alias("customer_id"), F.col("id").alias("user_index"), (F.col("id") * 0.5).alias("customer_avg_price"))


@pytest.mark.parametrize("as_text", [False, True])
def test_ten_requests_open_few_files(spark, tmp_path, as_text):
    table = _context(spark, 4000, as_text).repartition(5)
    fences.save_sorted(table, "customer_id", str(tmp_path / "t"), files=40)
    wanted = ["c000007", "c000011", "c003999", "nobody", ""] if as_text else [21, 33, 34, 11997, -5, 10**9]
    kind = "string" if as_text else "bigint"
    asked = spark.createDataFrame([(i, k) for i, k in enumerate([*wanted, wanted[0], None, wanted[1], wanted[2]])], f"event_id int, customer_id {kind}")
    found = fences.look_up(spark, str(tmp_path / "t"), asked, "customer_id")
    expected = asked.join(table, "customer_id", "left")
    assert sorted(map(str, found.rows.collect())) == sorted(map(str, expected.collect()))
    assert found.files <= 3 and found.of >= 30
    opened = {f for f in found.rows.inputFiles() if "/data/" in f}
    assert len(opened) == found.files


def test_all_keys_and_no_keys(spark, tmp_path):
    table = _context(spark, 500)
    fences.save_sorted(table, "customer_id", str(tmp_path / "t"), files=8)
    every = fences.look_up(spark, str(tmp_path / "t"), table.select("customer_id"), "customer_id")
    assert every.files == every.of and every.rows.filter("user_index IS NOT NULL").count() == 500
    none = fences.look_up(spark, str(tmp_path / "t"), table.select("customer_id").limit(0), "customer_id")
    assert none.files == 0 and none.rows.collect() == []


def test_rows_without_key_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), (4, 2)], "customer_id bigint, user_index bigint")
    asked = spark.createDataFrame([(None,), (4,)], "customer_id bigint")
    for name, table in (("a", rows), ("b", rows.limit(0))):
        fences.save_sorted(table, "customer_id", str(tmp_path / name))
        found = fences.look_up(spark, str(tmp_path / name), asked, "customer_id").rows
        assert {(r.customer_id, r.user_index) for r in found.collect()} == {(None, None), (4, 2 if name == "a" else None)}


# --- log store -------------------------------------------------------------------------------------------------

START = dt.datetime(2024, 1, 1)


def _lists(spark, rows):
    """Store rows of (customer, items, minute of creation)."""
    made = [(c, items, START + dt.timedelta(minutes=m)) for c, items, m in rows]
    return store.store_recommendations(spark.createDataFrame(made, "customer_id bigint, items array<bigint>, created_at timestamp_ntz"))


def _at(minute):
    return F.lit(START + dt.timedelta(minutes=minute)).cast("timestamp_ntz")


def _customers(spark, n):
    return spark.range(n).select(F.col("id").alias("customer_id"))


def _got(df):
    return sorted((r.customer_id, r["items"]) for r in df.collect())


def test_reads_equal_the_batch_store_through_writes_late_writes_and_compaction(spark, tmp_path):
    rng, path = random.Random(1), str(tmp_path / "log")
    written = None
    for step in range(4):
        rows = [(rng.randrange(30), [rng.randrange(99)], step * 40 + rng.randrange(60)) for _ in range(25)]
        if step == 2:
            rows += [(c, [1000 + c], 5) for c in range(5)]  # late: created before what is already stored
        one = _lists(spark, rows)
        log_store.put(spark, path, one, buckets=8)
        written = one if written is None else written.unionByName(one)
        for minute in (step * 40 + 30, step * 40 + 90):
            expected = _got(store.get_recommendations(written, _customers(spark, 35), _at(minute), "bigint"))
            assert _got(log_store.get(spark, path, _customers(spark, 35), _at(minute), "bigint")) == expected
        if step == 1:
            log_store.compact(spark, path, _at(60))
            assert len(log_store.state(spark, path).runs) == 1
    assert len(log_store.state(spark, path).runs) == 3


def test_a_replayed_write_counts_once(spark, tmp_path):
    path, rows = str(tmp_path / "log"), _lists(spark, [(1, [5], 0), (2, [6], 0)])
    for _ in range(3):
        log_store.put(spark, path, rows, run="monday", buckets=4)
    assert log_store.state(spark, path).runs == ["monday"]
    keys = rows.select("key")
    assert log_store.entries_for(spark, path, keys).entries.count() == 2


def test_reads_open_only_buckets_that_can_hold_the_keys(spark, tmp_path):
    path = str(tmp_path / "log")
    for step in range(3):
        log_store.put(spark, path, _lists(spark, [(c, [c], step) for c in range(step * 300, step * 300 + 300)]), buckets=16)
    one = spark.createDataFrame([(store.KEY_PREFIX + "310",)], "key string")
    read = log_store.entries_for(spark, path, one)
    assert read.of == 48 and read.parts <= 2  # the key's own run, and at most one false hit
    assert read.entries.filter(F.col("key") == store.KEY_PREFIX + "310").count() == 1
    assert log_store.entries_for(spark, path, one.limit(0)).parts == 0


def test_compaction_drops_what_has_expired_and_hides_older_late_writes(spark, tmp_path):
    path = str(tmp_path / "log")
    log_store.put(spark, path, _lists(spark, [(1, [1], 0), (2, [2], 0), (2, [22], 50), (3, [3], 2000)]), buckets=2)
    log_store.compact(spark, path, _at(2010))
    kept = log_store.entries_for(spark, path, _customers(spark, 9).select(store.store_key(F.col("customer_id")).alias("key"))).entries
    assert [(r.key, json.loads(r.payload)["items"]) for r in kept.collect()] == [(store.KEY_PREFIX + "3", [3])]
    # expired a moment ago: stays without payload, so that an older write with a longer life does not come up
    log_store.put(spark, path, _lists(spark, [(4, [4], 1900)]))
    log_store.compact(spark, path, _at(2000))
    late = store.store_recommendations(
        spark.createDataFrame([(4, [44], START + dt.timedelta(minutes=1890))], "customer_id bigint, items array<bigint>, created_at timestamp_ntz"), ttl=99_999
    )
    log_store.put(spark, path, late)
    assert dict(_got(log_store.get(spark, path, _customers(spark, 5), _at(2001), "bigint")))[4] is None


def test_an_unpublished_run_is_not_read_and_a_taken_number_ends_the_job(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = _lists(spark, [(1, [5], 0)])
    assert log_store.get(spark, path, _customers(spark, 2), _at(1), "bigint").filter("items IS NOT NULL").count() == 0
    assert log_store.compact(spark, path, _at(1)) is None
    log_store._write_run(spark, path, "half", rows, 4)
    before = log_store.state(spark, path)
    assert before.found is None
    log_store.put(spark, path, rows, buckets=4)
    with pytest.raises(RuntimeError, match="meanwhile"):
        log_store._publish(spark, path, before, ["other"])
    assert _got(log_store.get(spark, path, _customers(spark, 2), _at(1), "bigint")) == [(0, None), (1, [5])]


# --- streaming state that expires ------------------------------------------------------------------------------


def _write_stream(spark, folder, rows):
    timed = _lists(spark, rows).withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "expires_at")})
    timed.coalesce(1).write.mode("append").parquet(folder)
    return timed.schema


def _run(spark, folder, schema, tmp_path):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = expiring_store.start_expiring_store(stream, str(tmp_path / "table"), str(tmp_path / "state"))
    query.awaitTermination()
    return query


def test_stream_equals_the_batch_store_and_survives_a_restart(spark, tmp_path):
    folder, written = str(tmp_path / "in"), []
    steps = [
        [(1, [1], 0), (2, [2], 10), (2, [22], 20)],
        [(1, [11], 15), (3, [3], 55), (1, [111], 50)],  # not late: within the delay
        [(4, [4], 200), (2, [222], 190)],
        [(5, [5], 400)],
        [(5, [55], 402)],
    ]
    for step, rows in enumerate(steps):
        schema = _write_stream(spark, folder, rows)
        written += rows
        if step in (1, 4):  # two runs: the second goes on from the first one's checkpoint
            _run(spark, folder, schema, tmp_path)
            last = max(m for _, _, m in written)
            for minute in (last, last + 30, last + 100):
                entries = expiring_store.read_entries(spark, str(tmp_path / "table"), _at(minute))
                got = _got(store.get_recommendations(entries, _customers(spark, 7), _at(minute), "bigint"))
                assert got == _got(store.get_recommendations(_lists(spark, written), _customers(spark, 7), _at(minute), "bigint"))
    changes = spark.read.parquet(str(tmp_path / "table"))
    gone = {r.key for r in changes.filter(F.col("change") == expiring_store.EXPIRED).collect()}
    assert store.KEY_PREFIX + "1" in gone and store.KEY_PREFIX + "3" in gone and store.KEY_PREFIX + "5" not in gone


def test_state_holds_only_what_is_alive(spark, tmp_path):
    folder = str(tmp_path / "in")
    for step in range(5):
        schema = _write_stream(spark, folder, [(100 * step + i, [i], step * 200) for i in range(20)])
    query = _run(spark, folder, schema, tmp_path)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 100  # of 100 keys in all: a value and two timer entries for each of the latest 20, and some that are about to go
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 80


def test_stream_runs_in_a_session_that_names_no_store_on_disk(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    held, other = spark.conf.get(key), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    schema = _write_stream(spark, str(tmp_path / "in"), [(1, [1], 0), (2, [2], 10)])
    spark.conf.set(key, other)
    try:
        _run(spark, str(tmp_path / "in"), schema, tmp_path)
        assert spark.conf.get(key) == other
    finally:
        spark.conf.set(key, held)
    entries = expiring_store.read_entries(spark, str(tmp_path / "table"), _at(20))
    assert {r.key for r in entries.collect()} == {store.KEY_PREFIX + "1", store.KEY_PREFIX + "2"}
