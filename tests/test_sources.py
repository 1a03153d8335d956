from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recspark.operators import clean
from recspark.sources import artifacts, retail, store


@pytest.fixture()
def csv_dir(tmp_path):
    (tmp_path / "articles.csv").write_text("article_id,name,product_code\n108775015,shirt,108775\n108775044,shirt,\n7,x,1\n7,a,2\n")
    (tmp_path / "customers.csv").write_text("customer_id,age\nc1,20\nc1,19\nc2,\n,30\n")
    (tmp_path / "transactions_train.csv").write_text(
        "t_dat,customer_id,article_id,price,sales_channel_id\n"
        "2020-01-01,c1,1,0.5,2\n2020-01-01,c1,1,0.5,2\n"
        "garbage,c1,2,0.5,1\n2020-02-30,c1,2,0.5,1\n2020-01-02,c1,3,abc,1\n2020-01-02,c2,3,-1,1\n"
        "2020-01-02,c2,3,0,1\n2020-01-03,,4,1.0,1\n2020-01-03,c2,,1.0,1\n2020-01-03,c2,5,2.5,1\n"
    )
    return str(tmp_path)


def test_csv_columns_are_found_by_name_and_typed(spark, csv_dir):
    articles, customers, transactions = retail.load_datasets(spark, csv_dir)
    assert dict(articles.dtypes) == {"article_id": "bigint", "name": "string", "product_code": "bigint"}
    assert dict(customers.dtypes) == {"customer_id": "string", "age": "string"}
    assert dict(transactions.dtypes) == retail.CONTRACT["transactions"]
    assert transactions.filter("t_dat IS NULL").count() == 2
    assert transactions.filter("price IS NULL").count() == 1


def test_transactions_reader_parses_only_contract_columns(spark, csv_dir):
    assert retail.load_transactions(spark, csv_dir).columns == list(retail.CONTRACT["transactions"])


def test_cleaning_text_rows(spark, csv_dir):
    raw = retail.load_datasets(spark, csv_dir, raw=True)
    articles, customers, transactions = clean.clean_datasets(*raw)
    assert {(r.article_id, r.product_code, r.name) for r in articles.collect()} == {
        ("108775015", "108775", "shirt"),
        ("7", "2", "a"),
    }
    assert {r.customer_id for r in customers.collect()} == {"c1", "c2"}
    assert {(r.customer_id, r.article_id, r.t_dat, r.price) for r in transactions.collect()} == {
        ("c1", "1", dt.date(2020, 1, 1), 0.5),
        ("c2", "5", dt.date(2020, 1, 3), 2.5),
    }
    statistics = {r.table_name: r for r in clean.dataset_statistics(articles, customers, transactions).collect()}
    assert statistics["transactions"].row_count == 2
    assert statistics["transactions"].max_date == dt.date(2020, 1, 3)


def test_dedupe_does_not_lose_an_article_with_an_incomplete_copy(spark):
    rows = [(1, None, "a"), (1, 10, "b"), (1, 10, "a"), (2, None, "z")]
    df = spark.createDataFrame(rows, "article_id bigint, product_code bigint, name string")
    assert [tuple(r) for r in clean.clean_articles(df).collect()] == [(1, 10, "a")]


def test_priced_rows_need_a_number(spark, csv_dir):
    raw = retail.load_table(spark, csv_dir, "transactions", raw=True)
    by_customer = retail.priced_rows(raw, "customer_id")
    assert by_customer.count() == 8
    assert dict(retail.priced_rows(raw, "article_id").dtypes)["article_id"] == "bigint"


def test_probe_reports_missing_columns(spark, csv_dir):
    transactions = retail.load_table(spark, csv_dir, "transactions", raw=True).drop("price")
    got = {r.column_name: (r.present, r.filled_rows, r.table_rows) for r in retail.probe_columns({"transactions": transactions}).collect()}
    assert got["price"] == (False, 0, 10)
    assert got["customer_id"] == (True, 9, 10)
    with pytest.raises(ValueError, match="price"):
        retail.conform(transactions, "transactions")


def test_artifacts_round_trip(spark, tmp_path):
    vectors = spark.createDataFrame([(5, 0, [1.0, 0.0]), (7, 1, [0.0, 1.0])], "article_id bigint, item_index bigint, embedding array<float>")
    artifacts.save_item_embeddings(vectors, str(tmp_path / "items"))
    assert sorted(artifacts.load_item_embeddings(spark, str(tmp_path / "items")).collect()) == sorted(vectors.collect())
    users = spark.createDataFrame([("a", 0, 3, 1.5)], "customer_id string, user_index bigint, customer_total_purchases bigint, customer_avg_price double")
    artifacts.save_user_context(users, str(tmp_path / "users"))
    loaded = artifacts.load_user_context(spark, str(tmp_path / "users"))
    assert loaded.collect() == users.collect()
    vector = artifacts.context_vector(loaded, "customer_total_purchases", "customer_avg_price")
    assert dict(vector.dtypes)["context"] == "array<float>" and vector.first().context == [3.0, 1.5]
    with pytest.raises(ValueError, match="embedding"):
        artifacts.load_item_embeddings(spark, str(tmp_path / "users"))


def test_training_batches_round_trip(spark, tmp_path):
    rows = [(i // 2, i, i % 3, 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "batch_id bigint, user_index bigint, item_index bigint, label double")
    artifacts.save_training_batches(df, str(tmp_path / "b"))
    assert sorted(artifacts.load_training_batches(spark, str(tmp_path / "b")).collect()) == sorted(df.collect())


def test_store_returns_latest_unexpired(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [
        (5, [1, 2], day),
        (5, [3, 4, 5], day + dt.timedelta(minutes=10)),
        (6, [9], day - dt.timedelta(hours=2)),
    ]
    lists = spark.createDataFrame(rows, "customer_id bigint, items array<bigint>, created_at timestamp_ntz")
    stored = store.store_recommendations(lists)
    assert stored.filter("key = 'recommendations:user_6'").first().payload == '{"user_id":6,"items":[9]}'
    asked = spark.createDataFrame([(5,), (6,), (7,)], "customer_id bigint")

    def read(now):
        got = store.get_recommendations(stored, asked, F.lit(now).cast("timestamp_ntz"), "bigint")
        return {r.customer_id: r["items"] for r in got.collect()}

    assert read(day + dt.timedelta(minutes=30)) == {5: [3, 4, 5], 6: None, 7: None}
    assert read(day + dt.timedelta(minutes=70)) == {5: None, 6: None, 7: None}


def test_files_of_one_folder_must_agree_in_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t_dat,customer_id\n2020-01-01,c1\n")
    (tmp_path / "b.csv").write_text("customer_id,t_dat\nc2,2020-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        retail.read_csv(spark, str(tmp_path)).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("t_dat,customer_id\n2020-01-01,c1\n")
    (tmp_path / "c" / "b.csv").write_text("t_dat\n2020-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        retail.read_csv(spark, str(tmp_path / "c")).collect()


def test_one_scan_gives_both_contexts(spark, sf_dir):
    from recspark.plans import serving
    from recspark.sources import views

    raw = views.raw_transactions(spark, sf_dir)
    users, items = serving.context_lookups(raw)
    for got, expected in ((users, serving.user_context_lookup(raw)), (items, serving.item_context_lookup(raw))):
        rows = lambda lookup: sorted(str((*r[:3], round(r[3], 2))) for r in lookup.table.collect())
        assert got.size == expected.size and rows(got) == rows(expected)
