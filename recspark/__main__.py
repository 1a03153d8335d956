"""Jobs over a folder of retail CSV files.

    python -m recspark clean     DATA OUT     cleaned tables and their statistics
    python -m recspark features  DATA OUT     behavioural and calendar features
    python -m recspark training  DATA OUT     context training set, with its checks
    python -m recspark batches   DATA OUT     indexed pairs in batches
    python -m recspark context   DATA OUT     serving context of customers and articles
    python -m recspark recommend DATA OUT     fitted vectors and top-k lists of all customers
    python -m recspark evaluate  DATA OUT     recall on the test period
    python -m recspark towers    DATA OUT     both towers trained: weights, vectors, losses and recall (--epochs, --rate)
    python -m recspark artifacts DATA OUT     user context and item vectors through the towers (--weights, --vectors)
    python -m recspark publish   DATA OUT     the same and the item context as the next version of OUT, checked while written

Jobs over Parquet tables:

    python -m recspark answer    DATA OUT     lists for the requests in DATA (--model: OUT of artifacts; --weights, --vectors)
    python -m recspark store     DATA OUT     ranked lists in DATA as entries that expire
    python -m recspark fetch     DATA OUT     unexpired entries of the store DATA for the customers in --asked
    python -m recspark put       DATA OUT     ranked lists in DATA as a run of the log store OUT (--run)
    python -m recspark get       DATA OUT     unexpired entries of the log store DATA for the customers in --asked
    python -m recspark merge     DATA OUT     all runs of the log store DATA as one
    python -m recspark index     DATA OUT     inverted-file index of the item vectors in DATA (--lists)
    python -m recspark near      DATA OUT     top-k lists of the vectors in DATA (customer_id, embedding) from the index --model
    python -m recspark validate  DATA OUT     checks of the artifacts in DATA; ends with an error if one fails
    python -m recspark compact   DATA OUT     running context DATA with one row per key (--key, --key-type)

``--weights`` is a weights table, ``--vectors`` a table of (index, embedding). Every result is a
Parquet table in a folder of OUT.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators import assemble, batches, clean, encode, features, ivf, quality, retrieve, towers
from recspark.plans import fitted, serving, training
from recspark.session import build_session, freeze
from recspark.sources import artifacts, log_store, retail, store
from recspark.streaming import running_context


def clean_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    names = ("articles", "customers", "transactions")
    for name, table in zip(names, clean.clean_datasets(*retail.load_datasets(spark, data)), strict=True):
        table.write.mode("overwrite").parquet(f"{args.out}/{name}")
    return {"statistics": clean.dataset_statistics(*(spark.read.parquet(f"{args.out}/{name}") for name in names))}


def features_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    tx = freeze(retail.load_transactions(spark, data), "transactions")  # the text is parsed once for all features
    return {
        fn.__name__: fn(tx)
        for fn in (
            features.customer_frequency,
            features.article_popularity,
            features.customer_article_features,
            features.calendar_features,
            features.customer_features,
            features.item_features,
            features.monthly_item_popularity,
            features.real_interactions,
        )
    }


def training_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    path = f"{args.out}/training_features"
    rows = training.training_features(retail.load_transactions(spark, data), args.seed, negative_ratio=args.ratio)
    rows.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    return {
        "null_counts": assemble.context_null_counts(stored),
        "label_distribution": features.label_distribution(stored),
        "context_statistics": assemble.context_statistics(stored),
    }


def batches_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    examples = training.two_tower_training(retail.load_transactions(spark, data), args.seed)
    return {"batches": batches.training_batches(examples, args.batch_size, shuffle=True)}


def context_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    raw = retail.load_table(spark, data, "transactions", raw=True)
    users, items = serving.context_lookups(raw)
    return {"user_context": users.table, "item_context": items.table}


def recommend_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    model = fitted.fit_model(retail.load_transactions(spark, data))
    return {
        "user_embeddings": model.users,
        "item_embeddings": model.items,
        "recommendations": fitted.recommend(model, model.users, args.top_k),
    }


def evaluate_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    return {"recall": fitted.fitted_recall(retail.load_transactions(spark, data), args.top_k)}


def towers_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    tx = freeze(retail.load_transactions(spark, data), "transactions")
    made = fitted.fit_tower_model(tx, args.epochs, rate=args.rate, seed=args.seed)
    losses = spark.createDataFrame(list(enumerate(made.fitted.losses)), "epoch int, held_out_loss double")
    return {
        "weights": made.fitted.weights,
        "user_vectors": made.model.users,
        "item_vectors": made.model.items,
        "losses": losses,
        "recall": fitted.tower_recall(tx, made, args.top_k),
    }


def publish_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    raw = retail.load_table(spark, data, "transactions", raw=True)
    vectors, weights = spark.read.parquet(args.vectors), artifacts.load_model_weights(spark, args.weights)
    serving.publish_artifacts(raw, args.out, lambda size: vectors.filter(F.col("index") < size), weights)
    return {}


def artifacts_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    raw = retail.load_table(spark, data, "transactions", raw=True)
    vectors, weights = spark.read.parquet(args.vectors), artifacts.load_model_weights(spark, args.weights)
    serving.build_artifacts(
        raw, f"{args.out}/user_context", f"{args.out}/item_embeddings", lambda size: vectors.filter(F.col("index") < size), weights
    )
    return {}


def _stored_recommender(spark: SparkSession, args: argparse.Namespace) -> serving.Recommender:
    users = artifacts.load_user_context(spark, f"{args.model}/user_context")
    items = artifacts.load_item_embeddings(spark, f"{args.model}/item_embeddings", encode.EMBEDDING_DIM)
    weights = artifacts.load_model_weights(spark, args.weights)
    return serving.Recommender(serving.Lookup(users, users.count()), items, spark.read.parquet(args.vectors), weights, "float")


def answer_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    return {"answers": _stored_recommender(spark, args).answer(spark.read.parquet(data))}


def _entries(spark: SparkSession, data: str, ttl: int) -> DataFrame:
    entry = F.struct("rank", "item_index")
    lists = spark.read.parquet(data).groupBy("customer_id").agg(F.sort_array(F.collect_list(entry))["item_index"].alias("items"))
    return store.store_recommendations(lists.withColumn("created_at", F.current_timestamp()), ttl)


def store_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    return {"store": _entries(spark, data, args.ttl)}


def put_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "expires_at")}
    log_store.put(spark, args.out, _entries(spark, data, args.ttl).withColumns(times), args.run)
    return {}


def get_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    asked = spark.read.parquet(args.asked).select("customer_id")
    kind = asked.schema["customer_id"].dataType.simpleString()
    return {"lists": log_store.get(spark, data, asked, F.current_timestamp().cast("timestamp_ntz"), kind)}


def merge_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    log_store.compact(spark, data, F.current_timestamp().cast("timestamp_ntz"))
    return {}


def index_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    ivf.build(artifacts.load_item_embeddings(spark, data), f"{args.out}/index", args.lists)
    return {}


def near_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    index, queries = ivf.load(spark, args.model), spark.read.parquet(data)
    probes = args.probes or ivf.probes_for(queries, ivf.vectors(spark, index), index, k=args.top_k)
    return {"lists": ivf.search(queries, index, probes, args.top_k).lists}


def fetch_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    asked = spark.read.parquet(args.asked).select("customer_id")
    kind = asked.schema["customer_id"].dataType.simpleString()
    return {"lists": store.get_recommendations(spark.read.parquet(data), asked, F.current_timestamp(), kind)}


def validate_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    users = artifacts.load_user_context(spark, f"{data}/user_context")
    items = artifacts.load_item_embeddings(spark, f"{data}/item_embeddings")
    own = items.select("article_id", "item_index")
    checks = (
        quality.context_quality(users, "customer_total_purchases", "customer_avg_price")
        .unionByName(quality.index_is_sequential(users, "user_index", "user indices are sequential"))
        .unionByName(quality.keys_follow_index(users, "customer_id", "user_index", "customer keys are sorted"))
        .unionByName(quality.index_is_sequential(own, "item_index", "item indices are sequential"))
        .unionByName(quality.keys_follow_index(own, "article_id", "item_index", "article keys are sorted"))
    )
    quality.require(checks)
    return {"checks": checks}


def compact_job(spark: SparkSession, data: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    key = spark.createDataFrame([], f"{args.key} {args.key_type}").schema[args.key]
    running_context.compact_running_context(spark, data, key, f"{args.out}/context")
    return {}


JOBS = {
    "clean": clean_job,
    "features": features_job,
    "training": training_job,
    "batches": batches_job,
    "context": context_job,
    "recommend": recommend_job,
    "evaluate": evaluate_job,
    "towers": towers_job,
    "artifacts": artifacts_job,
    "publish": publish_job,
    "answer": answer_job,
    "store": store_job,
    "fetch": fetch_job,
    "put": put_job,
    "get": get_job,
    "merge": merge_job,
    "index": index_job,
    "near": near_job,
    "validate": validate_job,
    "compact": compact_job,
}


def run(spark: SparkSession, argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="recspark", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("data")
    parser.add_argument("out")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--ratio", type=float, default=1)
    parser.add_argument("--batch-size", type=int, default=batches.BATCH_SIZE)
    parser.add_argument("--top-k", type=int, default=retrieve.TOP_K)
    for name in ("--weights", "--vectors", "--model", "--asked"):
        parser.add_argument(name)
    parser.add_argument("--epochs", type=int, default=1)
    parser.add_argument("--rate", type=float, default=towers.LEARNING_RATE)
    parser.add_argument("--run")
    parser.add_argument("--lists", type=int)
    parser.add_argument("--probes", type=int)
    parser.add_argument("--ttl", type=int, default=store.DEFAULT_TTL)
    parser.add_argument("--key", default="customer_id")
    parser.add_argument("--key-type", default="string")
    args = parser.parse_args(argv)
    for name, table in JOBS[args.job](spark, args.data, args).items():
        table.write.mode("overwrite").parquet(f"{args.out}/{name}")


if __name__ == "__main__":
    import sys

    run(build_session(), sys.argv[1:])
