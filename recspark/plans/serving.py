"""From purchases to stored context, item vectors and recommendation lists."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators import encode, evaluate, features, indexing, quality, requests, retrieve, split
from recspark.session import freeze, side_by_side
from recspark.sources import artifacts, manifest, published, retail

# Rows of a query table per task, so that all cores are busy with matrix products.
_ROWS_PER_TASK = 1_000_000


class Lookup(NamedTuple):
    table: DataFrame
    size: int


def user_context_lookup(raw_transactions: DataFrame) -> Lookup:
    """Context of every customer with a readable price, indexed in key order."""
    context = features.served_context(retail.priced_rows(raw_transactions, "customer_id"), "customer_id", "customer")
    index = indexing.dense_index(context, ["customer_id"], "user_index", "user-context")
    return Lookup(index.table.select(*artifacts.USER_CONTEXT), index.size)


def context_lookups(raw_transactions: DataFrame) -> tuple[Lookup, Lookup]:
    """Both contexts from one scan: readable prices are folded into one stored row per customer and article.

    A row without a customer still counts for its article, and the other way round.
    """
    priced = retail.priced_rows(raw_transactions, "customer_id", "article_id")
    pairs = freeze(features.price_totals(priced, "customer_id", "article_id"), "priced-pairs")

    def lookup(key: str, prefix: str, index: str, columns: tuple[str, ...]) -> Lookup:
        totals = features.merge_totals(pairs.filter(F.col(key).isNotNull()), key)
        made = indexing.dense_index(features.context_of(totals, key, prefix), [key], index, f"{prefix}-context")
        return Lookup(made.table.select(*columns), made.size)

    return tuple(
        side_by_side(
            raw_transactions.sparkSession,
            lambda: lookup("customer_id", "customer", "user_index", artifacts.USER_CONTEXT),
            lambda: lookup("article_id", "item", "item_index", artifacts.ITEM_CONTEXT),
        )
    )


def item_context_lookup(raw_transactions: DataFrame) -> Lookup:
    context = features.served_context(retail.priced_rows(raw_transactions, "article_id"), "article_id", "item")
    index = indexing.dense_index(context, ["article_id"], "item_index", "item-context")
    return Lookup(index.table.select(*artifacts.ITEM_CONTEXT), index.size)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks to spread a query table over: one per core, and more as rows grow."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // _ROWS_PER_TASK))


def build_artifacts(
    raw_transactions: DataFrame, user_path: str, item_path: str, embeddings, weights: DataFrame, dim: int = encode.EMBEDDING_DIM
) -> None:
    """Write the user context and the item vectors; ends with an error if a check fails.

    ``embeddings(size)`` gives the ``(index, embedding)`` table of the item tower.
    """
    spark = raw_transactions.sparkSession
    users, items = context_lookups(raw_transactions)
    artifacts.save_user_context(users.table, user_path)
    vectors = encode.encode_items(items.table, embeddings(items.size), weights)
    artifacts.save_item_embeddings(vectors, item_path)
    saved_users = artifacts.load_user_context(spark, user_path)
    saved_items = artifacts.load_item_embeddings(spark, item_path)
    quality.require(
        quality.context_quality(saved_users, "customer_total_purchases", "customer_avg_price")
        .unionByName(quality.index_is_sequential(saved_users, "user_index", "user indices are sequential"))
        .unionByName(quality.index_is_sequential(saved_items, "item_index", "item indices are sequential"))
        .unionByName(quality.embedding_contract(vectors, items.table, saved_items, "article_id", dim))
    )


def publish_artifacts(
    raw_transactions: DataFrame, root: str, embeddings, weights: DataFrame, dim: int = encode.EMBEDDING_DIM, value_type: str = "float"
) -> manifest.Manifest:
    """Both contexts and the item vectors as one version, checked in the passes that write them."""
    users, items = context_lookups(raw_transactions)
    vectors = encode.encode_items(items.table, embeddings(items.size), weights, True, value_type)
    return published.publish(
        raw_transactions.sparkSession,
        root,
        {
            "user_context": published.checked_context(users.table, "user_index", "customer_total_purchases", "customer_avg_price"),
            "item_context": published.checked_context(items.table, "item_index", "item_total_purchases", "item_avg_price"),
            "item_embeddings": published.checked_vectors(vectors.select(*artifacts.ITEM_EMBEDDINGS), "item_index", dim, items.size),
        },
    )


class Recommender(NamedTuple):
    """Stored tables a recommendation run reads."""

    users: Lookup
    items: DataFrame
    user_embeddings: DataFrame
    weights: DataFrame
    value_type: str

    def query_vectors(self, customers: DataFrame) -> DataFrame:
        """``(customer_id, embedding)`` of the customers that are known; ``customers`` names each once."""
        vectors = encode.encode_customers(
            customers,
            self.users.table,
            self.user_embeddings,
            self.weights,
            self.value_type,
            tasks_for(customers.sparkSession, self.users.size),
        )
        return vectors.select("customer_id", "embedding")

    def recommend(self, customers: DataFrame, k: int = retrieve.TOP_K) -> DataFrame:
        """Ranked lists for the known customers; a vector that cannot be searched with ends the job."""
        fine = retrieve.is_searchable(encode.EMBEDDING_DIM)
        refused = F.raise_error(F.lit("query vectors must be finite and of length 1")).cast("boolean")
        vectors = self.query_vectors(customers).filter(F.when(fine, True).otherwise(refused))
        return retrieve.top_k(vectors, self.items, k)

    def recommend_all(self, k: int = retrieve.TOP_K) -> DataFrame:
        return self.recommend(self.users.table.select("customer_id"), k)

    def answer(self, asked: DataFrame) -> DataFrame:
        """Statuses and lists for a table of ``(request_id, customer_id, top_k)``, ids as text."""
        checked = requests.check_requests(asked)
        key_type = self.users.table.schema["customer_id"].dataType.simpleString()
        wanted = requests.wanted_customers(checked).select(F.col("customer_id").try_cast(key_type).alias("customer_id"))
        vectors = freeze(self.query_vectors(wanted.filter(F.col("customer_id").isNotNull()).distinct()), "asked")
        fine = retrieve.is_searchable(encode.EMBEDDING_DIM)
        lists = retrieve.top_k(vectors.filter(fine), self.items, retrieve.MAX_TOP_K)
        as_text = F.col("customer_id").cast("string").alias("customer_id")
        named = lists.withColumn("customer_id", as_text)
        return requests.answer_requests(checked, named, vectors.filter(~fine).select(as_text))


def build_recommender(raw_transactions: DataFrame, embeddings, weights: DataFrame, value_type: str = "float") -> Recommender:
    """Context and item vectors computed once and stored in the shared folder."""
    (users, items), weights = side_by_side(
        raw_transactions.sparkSession, lambda: context_lookups(raw_transactions), lambda: freeze(weights, "weights")
    )
    vectors = encode.encode_items(
        items.table, embeddings(items.size), weights, True, value_type, tasks_for(weights.sparkSession, items.size)
    )
    stored = freeze(vectors.select(*artifacts.ITEM_EMBEDDINGS), "item-vectors")
    return Recommender(users, stored, embeddings(users.size), weights, value_type)


def recall(recommender: Recommender, transactions: DataFrame, k: int = retrieve.TOP_K) -> DataFrame:
    """Recall at k against the last purchase each customer made in the test period."""
    _, _, test = split.split_parts(transactions, split.split_bounds(transactions))
    truth = freeze(evaluate.held_out_item(test), "truth")
    lists = recommender.recommend(truth.select("customer_id"), k)
    return evaluate.recall_at_k(lists, truth)
