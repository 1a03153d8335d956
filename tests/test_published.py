"""Versions checked in the writing pass, sketches of days, footers, buckets, and cleaning of a stream."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recspark.operators import clean, colocate, features, indexing, sketches, split
from recspark.sources import footers, manifest, published, retail, views
from recspark.streaming import clean_stream

# --- versions --------------------------------------------------------------------------------------------------


def _vectors(spark, n, bad=None):
    unit = F.when(F.col("id") == (-1 if bad is None else bad), F.array(F.lit(2.0), F.lit(0.0))).otherwise(F.array(F.lit(0.6), F.lit(0.8)))
    return spark.range(n).select(F.col("id").alias("article_id"), F.col("id").alias("item_index"), unit.alias("embedding"))


def test_a_version_is_checked_in_the_pass_that_writes_it(spark, tmp_path):
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)

    table = _vectors(spark, 500)
    published.publish(spark, str(tmp_path), {"items": published.checked_vectors(table.mapInArrow(count, table.schema), "item_index", 2, 500)})
    assert counter.value == 500
    found = manifest.current(spark, str(tmp_path)).content["tables"]["items"]
    assert found["rows"] == found["unit"] == 500 and found["greatest"] == 499
    assert published.load(spark, str(tmp_path), "items").count() == 500


def test_a_failed_check_publishes_nothing(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="no version"):
        published.load(spark, root, "items")
    published.publish(spark, root, {"items": published.checked_vectors(_vectors(spark, 5), "item_index", 2, 5)})
    broken = {
        "a vector that is too long": published.checked_vectors(_vectors(spark, 6, bad=3), "item_index", 2, 6),
        "a key without vector": published.checked_vectors(_vectors(spark, 6), "item_index", 2, 7),
        "an index twice": published.checked_vectors(_vectors(spark, 6).withColumn("item_index", F.greatest(F.col("item_index"), F.lit(1))), "item_index", 2, 6),
    }
    for table in broken.values():
        with pytest.raises(RuntimeError, match="failed"):
            published.publish(spark, root, {"good": published.checked_vectors(_vectors(spark, 2), "item_index", 2, 2), "items": table})
        assert published.load(spark, root, "items").count() == 5 and manifest.current(spark, root).number == 0
    published.publish(spark, root, {"items": published.checked_vectors(_vectors(spark, 9), "item_index", 2, 9)})
    assert published.load(spark, root, "items").count() == 9


def test_of_two_writers_one_fails(spark, tmp_path):
    was = manifest.publish(spark, str(tmp_path), None, {"v": 1})
    manifest.publish(spark, str(tmp_path), was, {"v": 2})
    with pytest.raises(RuntimeError, match="meanwhile"):
        manifest.publish(spark, str(tmp_path), was, {"v": 3})
    assert manifest.current(spark, str(tmp_path)).content == {"v": 2}


def test_an_empty_context_passes_and_a_count_of_zero_does_not(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, 2.0), (1, 0, 2.0)], "user_index bigint, n bigint, avg double")
    check = lambda df: {"users": published.checked_context(df, "user_index", "n", "avg")}
    published.publish(spark, str(tmp_path), check(rows.limit(0)))
    with pytest.raises(RuntimeError, match="purchase counts are positive"):
        published.publish(spark, str(tmp_path), check(rows))


# --- sketches --------------------------------------------------------------------------------------------------


def test_sketched_counts_are_near_and_grow_by_days(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 10).cast("int")).alias("t_dat"),
        F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("customer_id"),
        (F.col("id") % 700).alias("article_id"),
    )
    path, day = str(tmp_path / "days"), lambda n: F.lit(dt.date(2020, 1, 1) + dt.timedelta(days=n))
    sketches.add_days(rows.filter(F.col("t_dat") < day(6)), path)
    before = {f.name for f in (tmp_path / "days").glob("*.parquet")}
    sketches.add_days(rows, path, after=sketches.last_day(spark, path))
    assert before < {f.name for f in (tmp_path / "days").glob("*.parquet")}  # earlier days were not written again
    table = spark.read.parquet(path)
    assert table.count() == 10
    for first, end in ((0, 10), (2, 3), (4, 9)):
        part = rows.filter((F.col("t_dat") >= day(first)) & (F.col("t_dat") < day(end)))
        exact, found = features.unique_counts(part).first(), sketches.distinct_counts(table, day(first), day(end)).first()
        assert found.row_count == exact.row_count
        assert abs(found.unique_customers - exact.unique_customers) < 0.03 * exact.unique_customers
        assert abs(found.unique_articles - exact.unique_articles) < 0.03 * exact.unique_articles
    assert tuple(sketches.distinct_counts(table, day(50)).first()) == (0, 0, 0)


# --- footers ---------------------------------------------------------------------------------------------------


def test_range_of_days_comes_from_footers(spark, sf_dir, tmp_path):
    tx = views.transactions(spark, sf_dir)
    tx.repartition(4).write.parquet(str(tmp_path / "t"))
    query = footers.range_query(spark, str(tmp_path / "t"))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(t_dat), MAX(t_dat)]" in plan
    assert split.bounds_between(*footers.day_range(spark, str(tmp_path / "t"))) == split.split_bounds(tx)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's session is as it was


def test_without_statistics_the_column_is_scanned(spark, sf_dir, tmp_path):
    tx = views.transactions(spark, sf_dir)
    tx.write.option("parquet.column.statistics.enabled", "false").parquet(str(tmp_path / "t"))
    assert footers.day_range(spark, str(tmp_path / "t")) == tuple(tx.agg(F.min("t_dat"), F.max("t_dat")).first())


# --- buckets ---------------------------------------------------------------------------------------------------


def _skewed(spark, n=60_000):
    """One customer has a third of all rows."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END AS customer_id", "id % 1000 AS article_id", "CAST(id AS DOUBLE) AS price"
    )


@pytest.fixture()
def plain_joins(spark):
    """No broadcast and no help from adaptive execution."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_sides_are_joined_without_a_shuffle(spark, tmp_path, plain_joins):
    facts, run = _skewed(spark), uuid.uuid4().hex
    users = indexing.user_mapping(facts).table
    names = f"facts_{run}", f"users_{run}"
    colocate.store_bucketed(facts, users, "customer_id", *names, str(tmp_path), 16)
    joined = colocate.join_bucketed(spark, *names, "customer_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    expected = facts.join(users, "customer_id").agg(F.count("*"), F.sum("price"), F.sum("user_index")).first()
    assert joined.agg(F.count("*"), F.sum("price"), F.sum("user_index")).first() == expected
    files = [r.n for r in spark.table(names[0]).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert max(files) < 60_000 / 6  # the hot customer is in many buckets
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_a_salted_join_splits_the_hot_key_under_any_settings(spark, plain_joins):
    facts = _skewed(spark)
    users = indexing.user_mapping(facts).table
    joined = colocate.salted_join(facts, users, "customer_id")
    rows = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(rows) == 60_000 and max(rows) < 60_000 / 6
    assert colocate.hot_keys(facts, "customer_id").count() == 1
    nothing = colocate.salted_join(facts.limit(0), users, "customer_id")
    assert nothing.collect() == [] and set(nothing.columns) == {"customer_id", "article_id", "price", "user_index"}


# --- cleaning of a stream --------------------------------------------------------------------------------------

FIRST = dt.date(2021, 3, 1)
SCHEMA = "customer_id string, article_id bigint, t_dat string, price string, sales_channel_id int"


def _purchase(rng, day):
    return (
        rng.choice(["a", "b", "c", None]),
        rng.choice([1, 2, 3, None]),
        rng.choice([str(FIRST + dt.timedelta(days=day))] * 6 + ["unknown", None]),
        rng.choice(["1.5", "2", "0", "-1", "n/a", None]),
        rng.choice([1, 2]),
    )


def _run(spark, tmp_path, batches, delay):
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return clean_stream.run_clean_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), delay)


def test_shuffled_micro_batches_give_the_batch_result(spark, tmp_path):
    rng, batches = random.Random(2), []
    for step in range(5):
        rows = [_purchase(rng, step * 2 + rng.randrange(5)) for _ in range(120)]
        rows += rng.sample(rows, 40)
        batches.append(rows)
    batches[3] += rng.sample(batches[2], 30)  # copies that come in a later batch
    outcome = _run(spark, tmp_path, batches, "30 days")
    raw = spark.createDataFrame([r for rows in batches for r in rows], SCHEMA)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(clean_stream.read_cleaned(spark, str(tmp_path / "out"))) == rows(clean.clean_transactions(raw))
    assert outcome.late == 0 and outcome.batches >= 5


def test_state_is_bounded_and_late_rows_are_counted(spark, tmp_path):
    day = lambda d, n: [(f"c{i}", 1, str(FIRST + dt.timedelta(days=d)), "1", 1) for i in range(n)]
    batches = [day(10 * step, 50) for step in range(6)]
    batches.append(day(0, 7))  # long gone
    outcome = _run(spark, tmp_path, batches, "3 days")
    assert outcome.late == 7 and outcome.most_held <= 150
    assert clean_stream.read_cleaned(spark, str(tmp_path / "out")).count() == 300


def test_the_registered_stream_has_the_schema_of_the_batch_form(spark, sf_dir):
    raw = views.raw_transactions(spark, sf_dir)
    assert retail.with_day(raw).schema["t_dat"].dataType.simpleString() == "date"
    assert clean.typed_purchases(raw).schema == clean.clean_transactions(raw).schema
