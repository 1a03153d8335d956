from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recspark.__main__ import run
from recspark.sources import artifacts, published, views

TABLES = {
    "clean": {"articles", "customers", "transactions", "statistics"},
    "features": {"customer_frequency", "real_interactions", "monthly_item_popularity", "calendar_features"},
    "training": {"training_features", "null_counts", "label_distribution", "context_statistics"},
    "batches": {"batches"},
    "context": {"user_context", "item_context"},
    "recommend": {"user_embeddings", "item_embeddings", "recommendations"},
    "evaluate": {"recall"},
    "towers": {"weights", "user_vectors", "item_vectors", "losses", "recall"},
}


@pytest.fixture(scope="module")
def csv_data(spark, tmp_path_factory, transactions):
    folder = tmp_path_factory.mktemp("raw")
    rows = transactions.collect()
    lines = [f"{r.t_dat},{r.customer_id},{r.article_id},{r.price},{r.sales_channel_id}" for r in rows]
    (folder / "transactions_train.csv").write_text("t_dat,customer_id,article_id,price,sales_channel_id\n" + "\n".join(lines))
    (folder / "articles.csv").write_text("article_id,product_code\n" + "\n".join(f"{a},{a // 10}" for a in range(60)))
    (folder / "customers.csv").write_text("customer_id\n" + "\n".join(f"c{c}" for c in range(1, 6)))
    return str(folder)


@pytest.mark.parametrize("job", sorted(TABLES))
def test_job_writes_its_tables(spark, csv_data, tmp_path, job):
    run(spark, [job, csv_data, str(tmp_path)])
    for name in TABLES[job]:
        assert spark.read.parquet(f"{tmp_path}/{name}").count() > 0
    if job == "recommend":
        lists = spark.read.parquet(f"{tmp_path}/recommendations")
        assert {r["count"] for r in lists.groupBy("customer_id").count().collect()} == {10}
    if job == "evaluate":
        recall = spark.read.parquet(f"{tmp_path}/recall").first()
        assert 0 <= recall.recall <= 1 and recall.user_count > 0


def test_serving_jobs(spark, csv_data, tmp_path, sf_dir):
    out, weights, vectors = str(tmp_path), str(tmp_path / "weights"), str(tmp_path / "vectors")
    artifacts.save_model_weights(views.formula_weights(spark), weights)
    assert sorted(map(str, artifacts.load_model_weights(spark, weights).collect())) == sorted(map(str, views.formula_weights(spark).collect()))
    views.index_embeddings(spark, sf_dir, 100).write.parquet(vectors)
    run(spark, ["artifacts", csv_data, out, "--weights", weights, "--vectors", vectors])
    run(spark, ["validate", out, out])
    assert spark.read.parquet(f"{out}/checks").filter("passed").count() == 6
    asked = [(1, " c1 ", 3), (2, "c2", None), (3, "nobody", 3), (4, "", 3), (5, "c1", 0)]
    spark.createDataFrame(asked, "request_id bigint, customer_id string, top_k int").write.parquet(f"{out}/requests")
    run(spark, ["answer", f"{out}/requests", out, "--model", out, "--weights", weights, "--vectors", vectors])
    answers = {r.request_id: r for r in spark.read.parquet(f"{out}/answers").collect()}
    assert {i: r.status for i, r in answers.items()} == {1: 200, 2: 200, 3: 404, 4: 400, 5: 422}
    assert len(answers[1].recommendations) == 3 and len(answers[2].recommendations) == 10
    lists = spark.read.parquet(f"{out}/answers").filter("status = 200").select("customer_id", F.explode("recommendations").alias("r"))
    lists.select("customer_id", "r.rank", "r.item_index").write.parquet(f"{out}/lists")
    run(spark, ["store", f"{out}/lists", out])
    spark.createDataFrame([("c1",), ("c5",)], "customer_id string").write.parquet(f"{out}/asked")
    run(spark, ["fetch", f"{out}/store", f"{out}/fetched", "--asked", f"{out}/asked"])
    fetched = {r.customer_id: r["items"] for r in spark.read.parquet(f"{out}/fetched/lists").collect()}
    assert fetched == {"c1": [x.item_index for x in answers[1].recommendations], "c5": None}
    # the same through the log of runs
    for name in ("first", "first", "second"):
        run(spark, ["put", f"{out}/lists", f"{out}/log", "--run", name])
    run(spark, ["merge", f"{out}/log", out])
    run(spark, ["get", f"{out}/log", f"{out}/got", "--asked", f"{out}/asked"])
    assert {r.customer_id: r["items"] for r in spark.read.parquet(f"{out}/got/lists").collect()} == fetched
    # published in one version, and searched by an index
    run(spark, ["publish", csv_data, f"{out}/published", "--weights", weights, "--vectors", vectors])
    assert published.load(spark, f"{out}/published", "item_embeddings").count() == spark.read.parquet(f"{out}/item_embeddings").count()
    run(spark, ["index", f"{out}/item_embeddings", out, "--lists", "4"])
    spark.read.parquet(f"{out}/item_embeddings").select(F.col("article_id").alias("customer_id"), "embedding").write.parquet(f"{out}/asking")
    run(spark, ["near", f"{out}/asking", f"{out}/near", "--model", f"{out}/index", "--probes", "4", "--top-k", "3"])
    near = spark.read.parquet(f"{out}/near/lists")
    assert {r["count"] for r in near.groupBy("customer_id").count().collect()} == {3}
    # a damaged vector is refused when it is loaded
    artifacts.save_item_embeddings(spark.read.parquet(f"{out}/item_embeddings").withColumn("embedding", F.transform("embedding", lambda x: x * 2)), f"{out}/bad/item_embeddings")
    with pytest.raises(ValueError, match="length 1"):
        artifacts.load_item_embeddings(spark, f"{out}/bad/item_embeddings")


def test_compact_job(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2, 3.0)], "customer_id string, purchase_count bigint, price_sum double")
    for batch in range(3):
        rows.write.parquet(f"{tmp_path}/t/batch_id={batch}")
    run(spark, ["compact", f"{tmp_path}/t", str(tmp_path)])
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/context").collect()] == [("a", 2, 3.0, 2)]
