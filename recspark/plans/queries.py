"""The registered queries: each operator over the given tables.

Sampling uses the md5 hash here because a SQL engine can recompute it; averages
and scores are rounded at the very end so that two engines print the same
digits.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.functions import vectors as vec
from recspark.functions.hashing import MD5
from recspark.functions.vectors import is_finite, is_unit
from recspark.operators import (
    assemble,
    batches,
    clean,
    colocate,
    encode,
    features,
    fit,
    indexing,
    ivf,
    meet,
    quality,
    retrieve,
    sampling,
    sketches,
    split,
)
from recspark.plans import fitted, serving, training
from recspark.session import freeze, scratch_path, side_by_side
from recspark.sources import artifacts, fences, footers, log_store, published, retail, store, views
from recspark.streaming import clean_stream, expiring_store, running_context

Query = Callable[[SparkSession, str], DataFrame]

_USER_CONTEXT = ("customer_total_purchases", "customer_avg_price")
_DIM = encode.EMBEDDING_DIM
#: Rows of a written file, the work of one task.
_FILE_ROWS = 1_000_000

_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def _round(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Round half up on the decimal value, after removing floating-point noise."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("decimal(30,9)"), digits).cast("double") for c in columns}
    )


def _components(df: DataFrame, *keys: str, vector: str = "embedding") -> DataFrame:
    """One row per vector component, rounded to six digits."""
    long = df.select(*keys, F.posexplode(vector).alias("component", "value"))
    return _round(long, "value", digits=6)


def _mappings(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    users, items = side_by_side(
        tx.sparkSession, lambda: indexing.user_mapping(tx).table, lambda: indexing.item_mapping(tx).table
    )
    return users, items


def _recommender(spark: SparkSession, sf: str) -> serving.Recommender:
    return serving.build_recommender(
        views.transactions(spark, sf),
        lambda size: views.index_embeddings(spark, sf, size),
        views.formula_weights(spark),
        "double",
    )


# scans and sources


@_query
def scan_articles(spark, sf):
    return views.articles(spark, sf)


@_query
def scan_customers(spark, sf):
    return views.customers(spark, sf)


@_query
def scan_transactions(spark, sf):
    return views.transactions(spark, sf)


@_query
def probe_columns(spark, sf):
    return retail.probe_columns(
        {
            "articles": views.raw_articles(spark, sf),
            "customers": views.raw_customers(spark, sf),
            "transactions": views.raw_transactions(spark, sf),
        }
    )


@_query
def sample_transactions(spark, sf):
    keys = ("customer_id", "t_dat", "article_id", "price")
    return retail.sample_rows(views.transactions(spark, sf), 5, *keys)


# cleaning, projection, split


@_query
def clean_articles(spark, sf):
    return clean.clean_articles(views.raw_articles(spark, sf))


@_query
def clean_customers(spark, sf):
    return clean.clean_customers(views.raw_customers(spark, sf))


@_query
def clean_transactions(spark, sf):
    return clean.clean_transactions(views.raw_transactions(spark, sf))


@_query
def dataset_statistics(spark, sf):
    return clean.dataset_statistics(
        *clean.clean_datasets(
            views.raw_articles(spark, sf), views.raw_customers(spark, sf), views.raw_transactions(spark, sf)
        )
    )


@_query
def coerce_and_drop(spark, sf):
    return retail.priced_rows(views.raw_transactions(spark, sf), "customer_id")


@_query
def label_all_transactions(spark, sf):
    return clean.label_all(views.transactions(spark, sf))


@_query
def temporal_split(spark, sf):
    tx = views.transactions(spark, sf)
    return split.temporal_split(tx, split.split_bounds(tx))


@_query
def split_statistics(spark, sf):
    return split.split_statistics(temporal_split(spark, sf))


@_query
def split_bounds_footers(spark, sf):
    """Boundary dates of stored purchases from the statistics in their footers."""
    path = scratch_path(spark, "purchases")
    views.transactions(spark, sf).write.parquet(path)
    bounds = split.bounds_between(*footers.day_range(spark, path))
    return spark.range(1).select(*(F.lit(day).alias(name) for name, day in bounds._asdict().items()))


# aggregations


@_query
def customer_frequency(spark, sf):
    return features.customer_frequency(views.transactions(spark, sf))


@_query
def article_popularity(spark, sf):
    return features.article_popularity(views.transactions(spark, sf))


@_query
def customer_article_features(spark, sf):
    return features.customer_article_features(views.transactions(spark, sf))


@_query
def calendar_features(spark, sf):
    return features.calendar_features(views.transactions(spark, sf))


@_query
def customer_features(spark, sf):
    return _round(features.customer_features(views.transactions(spark, sf)), "customer_avg_price")


@_query
def item_features(spark, sf):
    return _round(features.item_features(views.transactions(spark, sf)), "item_avg_price")


@_query
def monthly_item_popularity(spark, sf):
    return features.monthly_item_popularity(views.transactions(spark, sf))


@_query
def user_context(spark, sf):
    return _round(features.user_context(views.transactions(spark, sf)), "customer_avg_price")


@_query
def item_context(spark, sf):
    return _round(features.item_context(views.transactions(spark, sf)), "item_avg_price")


@_query
def real_interactions(spark, sf):
    raw = retail.with_day(views.raw_transactions(spark, sf)).withColumn("price", F.col("price").try_cast("double"))
    return _round(features.real_interactions(raw), "average_price")


@_query
def unique_counts(spark, sf):
    return features.unique_counts(views.transactions(spark, sf))


@_query
def unique_counts_sketched(spark, sf):
    """Distinct counts of all days from sketches that were made in two instalments, next to the exact ones."""
    tx = freeze(views.transactions(spark, sf), "purchases")
    path, bounds = scratch_path(spark, "day-sketches"), split.split_bounds(tx)
    sketches.add_days(split.split_parts(tx, bounds)[0], path)
    sketches.add_days(tx, path, after=sketches.last_day(spark, path))
    exact = features.unique_counts(tx).first()
    close = lambda c, n: (F.abs(F.col(c) - n) <= max(2, 0.05 * n)).alias(f"{c}_close")
    found = sketches.distinct_counts(spark.read.parquet(path))
    return found.select("row_count", close("unique_customers", exact.unique_customers), close("unique_articles", exact.unique_articles))


@_query
def published_user_context(spark, sf):
    """The user context of the published version, after a second version replaced the first."""
    root = scratch_path(spark, "artifacts")
    vectors, weights = lambda size: views.index_embeddings(spark, sf, size), views.formula_weights(spark)
    for raw in (views.transactions(spark, sf), views.raw_transactions(spark, sf)):
        serving.publish_artifacts(raw, root, vectors, weights)
    return _round(published.load(spark, root, "user_context"), "customer_avg_price")


@_query
def user_context_lookup(spark, sf):
    return _round(serving.user_context_lookup(views.raw_transactions(spark, sf)).table, "customer_avg_price")


@_query
def item_context_lookup(spark, sf):
    return _round(serving.item_context_lookup(views.raw_transactions(spark, sf)).table, "item_avg_price")


@_query
def user_context_vector(spark, sf):
    lookup = serving.user_context_lookup(views.transactions(spark, sf)).table
    vectors = artifacts.context_vector(lookup, *_USER_CONTEXT)
    long = vectors.select("customer_id", "user_index", F.posexplode("context").alias("component", "value"))
    return long.withColumn("value", F.round(F.col("value").cast("double"), 2))


# indices and joins


@_query
def user_mapping(spark, sf):
    return indexing.user_mapping(views.transactions(spark, sf)).table


@_query
def item_mapping(spark, sf):
    return indexing.item_mapping(views.transactions(spark, sf)).table


@_query
def two_tower_dataset(spark, sf):
    tx = views.transactions(spark, sf)
    users, items = _mappings(tx)
    return assemble.two_tower_dataset(tx, users, items)


@_query
def two_tower_dataset_bucketed(spark, sf):
    """The same rows from purchases and customer indices that are stored in buckets of the customer."""
    tx = views.transactions(spark, sf).select("customer_id", "article_id", "price", "sales_channel_id")
    users, items = _mappings(tx)
    run = uuid.uuid4().hex
    names = f"purchases_{run}", f"customers_{run}"
    colocate.store_bucketed(tx, users, "customer_id", *names, scratch_path(spark, "buckets"), 8)
    joined = colocate.join_bucketed(spark, *names, "customer_id").join(items, "article_id")
    return joined.select("user_index", "item_index", "price", "sales_channel_id", F.lit(1).alias("label"))


@_query
def id_mapped_interactions(spark, sf):
    tx = views.transactions(spark, sf)
    users, items = _mappings(tx)
    return assemble.add_id_mappings(sampling.positive_interactions(tx), users, items)


@_query
def context_joined(spark, sf):
    """Interactions of all periods with context of the train period: some have none."""
    tx = views.transactions(spark, sf)
    train, _, _ = split.split_parts(tx, split.split_bounds(tx))
    joined = assemble.add_context(
        sampling.positive_interactions(tx), features.user_context(train), features.item_context(train)
    )
    return _round(joined, "customer_avg_price", "item_avg_price")


def _lookup_requests(spark, sf):
    """One request per event, for customers of whom about half exist."""
    events = views.table(spark, sf, "events")
    return events.select("event_id", (F.col("user_id") * 20).alias("customer_id"))


@_query
def lookup_user_index(spark, sf):
    users = serving.user_context_lookup(views.transactions(spark, sf)).table
    found = encode.look_up_users(_lookup_requests(spark, sf), users)
    return found.select("event_id", "customer_id", "user_index", "found")


@_query
def lookup_user_context(spark, sf):
    users = serving.user_context_lookup(views.transactions(spark, sf)).table
    found = encode.look_up_users(_lookup_requests(spark, sf), users)
    return _round(found.select("event_id", "customer_id", *_USER_CONTEXT, "found"), "customer_avg_price")


@_query
def lookup_by_fences(spark, sf):
    """The same look-up in a table that is stored in ranges of its key: only files that can hold a requested key are read."""
    users = serving.user_context_lookup(views.transactions(spark, sf)).table
    path = scratch_path(spark, "sorted-context")
    fences.save_sorted(users, "customer_id", path, files=16)
    found = fences.look_up(spark, path, _lookup_requests(spark, sf), "customer_id").rows
    return _round(
        found.select("event_id", "customer_id", *_USER_CONTEXT, F.col("user_index").isNotNull().alias("found")), "customer_avg_price"
    )


# sampling and training sets


@_query
def positive_interactions(spark, sf):
    return sampling.positive_interactions(views.transactions(spark, sf))


@_query
def positive_counts(spark, sf):
    return sampling.positive_counts(sampling.positive_interactions(views.transactions(spark, sf)))


@_query
def negative_candidates(spark, sf):
    tx = views.transactions(spark, sf)
    positives = sampling.positive_interactions(tx)
    return sampling.negative_candidates(positives, indexing.item_mapping(tx), method=MD5)


@_query
def negative_candidates_unpurchased(spark, sf):
    tx = views.transactions(spark, sf)
    positives = freeze(sampling.positive_interactions(tx), "positives")  # read for the candidates and for what was bought
    candidates = sampling.negative_candidates(positives, indexing.item_mapping(tx), method=MD5)
    return sampling.unpurchased(candidates, positives)


@_query
def negative_interactions(spark, sf):
    return sampling.negative_interactions(views.transactions(spark, sf), method=MD5)


@_query
def negative_interactions_xxhash64(spark, sf):
    """The default hash, which SQL engines cannot recompute: per customer what must hold whatever it is."""
    tx = views.transactions(spark, sf)
    bought = sampling.positive_interactions(tx).select("customer_id", "article_id")
    drawn = sampling.negative_interactions(tx).select("customer_id", "article_id")
    both = bought.withColumn("side", F.lit(1)).unionByName(drawn.withColumn("side", F.lit(2)))
    pairs = both.groupBy("customer_id", "article_id").agg(F.count_if(F.col("side") == 1).alias("p"), F.count_if(F.col("side") == 2).alias("n"))
    return pairs.groupBy("customer_id").agg(
        F.sum("p").alias("positives"),
        (F.sum("n") <= F.sum("p")).alias("no_more_negatives"),
        F.count_if((F.col("p") > 0) & (F.col("n") > 0)).alias("overlap"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )


@_query
def negative_interactions_half(spark, sf):
    """Half as many negatives as positives: here the rank filter removes rows."""
    return sampling.negative_interactions(views.transactions(spark, sf), negative_ratio=0.5, method=MD5)


@_query
def training_interactions(spark, sf):
    return sampling.training_interactions(views.transactions(spark, sf), method=MD5)


@_query
def label_distribution(spark, sf):
    return features.label_distribution(training_interactions(spark, sf))


@_query
def two_tower_training(spark, sf):
    return training.two_tower_training(views.transactions(spark, sf), method=MD5)


@_query
def training_features(spark, sf):
    data = training.training_features(views.transactions(spark, sf), method=MD5)
    return _round(data, "customer_avg_price", "item_avg_price")


@_query
def normalized_context(spark, sf):
    data = training.training_features(views.transactions(spark, sf), method=MD5)
    return _round(assemble.normalized_context(data), *assemble.CONTEXT_COLUMNS, digits=6)


@_query
def context_null_counts(spark, sf):
    return assemble.context_null_counts(context_joined(spark, sf))


@_query
def context_statistics(spark, sf):
    data = training.training_features(views.transactions(spark, sf), method=MD5)
    return _round(assemble.context_statistics(data), "mean", "stddev", "min_value", "max_value")


@_query
def training_batches(spark, sf):
    return batches.training_batches(training.two_tower_training(views.transactions(spark, sf), method=MD5), shuffle=True)


@_query
def batch_inspection(spark, sf):
    examples = training.two_tower_training(views.transactions(spark, sf), method=MD5)
    return batches.inspect_batches(batches.training_batches(examples))


# vectors and encoding


@_query
def pair_similarity(spark, sf):
    """Inner product of the vectors assigned to both sides of each positive pair."""
    tx = views.transactions(spark, sf)
    vectors = views.table(spark, sf, "embeddings")
    count = vectors.count()
    one = vectors.select(F.col("vec_id").alias("_u"), "embedding")
    two = vectors.select(F.col("vec_id").alias("_i"), "embedding")
    pairs = sampling.positive_interactions(tx).select(
        "customer_id", "article_id", (F.col("customer_id") % count).alias("_u"), (F.col("article_id") % count).alias("_i")
    )
    scored = meet.score_pairs(pairs, one, two, "_u", "_i", "similarity")
    return _round(scored.select("customer_id", "article_id", "similarity"), "similarity", digits=6)


@_query
def l2_normalize(spark, sf):
    """Each vector, shifted by its label so that it is no longer of length 1, normalised again."""
    shifted = views.table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") + F.col("label")).alias("embedding")
    )
    unit = shifted.select("vec_id", vec.l2_normalize(F.col("embedding")).alias("embedding"))
    return _components(unit, "vec_id")


@_query
def vector_norms(spark, sf):
    vectors = views.table(spark, sf, "embeddings")
    return _round(vectors.select("vec_id", vec.l2_norm(F.col("embedding")).alias("norm")), "norm", digits=6)


@_query
def encode_users(spark, sf):
    users = serving.user_context_lookup(views.transactions(spark, sf))
    out = encode.encode_customers(
        users.table.select("customer_id"),
        users.table,
        views.index_embeddings(spark, sf, users.size),
        views.formula_weights(spark),
        "double",
    )
    return _components(out, "customer_id", "user_index")


def _encode_items(spark, sf, use_context, value_type="double"):
    items = serving.item_context_lookup(views.transactions(spark, sf))
    embeddings = views.index_embeddings(spark, sf, items.size)
    return encode.encode_items(items.table, embeddings, views.formula_weights(spark), use_context, value_type)


@_query
def encode_items(spark, sf):
    return _components(_encode_items(spark, sf, True), "article_id", "item_index")


@_query
def encode_items_no_context(spark, sf):
    return _components(_encode_items(spark, sf, False), "article_id", "item_index")


@_query
def encode_customers_detail(spark, sf):
    """Requested customers with index, raw and normalised context, and the norm of their vector."""
    users = serving.user_context_lookup(views.transactions(spark, sf))
    asked = _lookup_requests(spark, sf).select("customer_id").distinct()
    vectors = encode.encode_customers(
        asked, users.table, views.index_embeddings(spark, sf, users.size), views.formula_weights(spark), "double"
    )
    logs = [F.log1p(F.col(c).cast("double")).alias(f"log_{c}") for c in _USER_CONTEXT]
    detail = (
        encode.look_up_users(asked, users.table)
        .join(vectors.select("customer_id", vec.l2_norm(F.col("embedding")).alias("norm")), "customer_id", "left")
        .select("customer_id", "found", "user_index", *_USER_CONTEXT, *logs, "norm")
    )
    return _round(detail, "customer_avg_price", *[f"log_{c}" for c in _USER_CONTEXT], "norm")


def _pair_scores(spark, sf):
    tx = views.transactions(spark, sf)
    recommender = _recommender(spark, sf)
    users = encode.encode_customers(
        recommender.users.table.select("customer_id"),
        recommender.users.table,
        recommender.user_embeddings,
        recommender.weights,
        "double",
    )
    users = freeze(users.select("user_index", "embedding"), "user-vectors")
    return encode.score_pairs(training.two_tower_training(tx, method=MD5), users, recommender.items)


@_query
def pair_scores(spark, sf):
    return _round(_pair_scores(spark, sf), "score", digits=6)


@_query
def bce_loss(spark, sf):
    return _round(fit.mean_loss(_pair_scores(spark, sf), "score"), "mean_loss")


# retrieval and evaluation


def _vectors_as_items(spark, sf):
    return views.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("article_id"), F.col("vec_id").alias("item_index"), "embedding"
    )


@_query
def item_topk(spark, sf):
    items = _vectors_as_items(spark, sf)
    queries = items.select(F.col("article_id").alias("query_id"), "embedding")
    return retrieve.top_k(queries, items, key="query_id")


@_query
def item_topk_blocks(spark, sf):
    """The same search without broadcasting the items."""
    items = _vectors_as_items(spark, sf)
    queries = items.select(F.col("article_id").alias("query_id"), "embedding")
    return retrieve.top_k(queries, items, key="query_id", broadcast_bytes=0)


@_query
def item_topk_ivf(spark, sf):
    """The search with an inverted-file index: what it found of the exact lists, and what it cost."""
    items = _vectors_as_items(spark, sf)
    queries = items.select(F.col("article_id").alias("query_id"), "embedding")
    index = ivf.build(items, scratch_path(spark, "ivf"))
    exact = freeze(retrieve.top_k(queries, items, key="query_id"), "exact-lists")
    probes = ivf.probes_for(queries, items, index, key="query_id")
    near = ivf.search(queries, index, probes, key="query_id")
    every = ivf.search(queries, index, len(index.centroids), key="query_id")
    found = freeze(near.lists, "near-lists")
    n = queries.count()
    facts = found.agg(F.countDistinct("query_id").alias("query_count"))
    return facts.select(
        "query_count",
        F.lit(ivf.recall_of(found, exact, "query_id") >= 0.9).alias("recall_reached"),
        F.lit(near.scored < n * n).alias("fewer_than_all_pairs"),
        F.lit(quality.same_rows(every.lists, exact, "same").first()["passed"] and every.scored == n * n).alias("all_lists_are_exact"),
    )


@_query
def item_to_item_topk(spark, sf):
    return retrieve.self_retrieval(_vectors_as_items(spark, sf))


@_query
def recommend_topk(spark, sf):
    return _recommender(spark, sf).recommend_all()


def _asked(spark, sf):
    """One request per event: the user as text, the value as the wanted list length."""
    customer: Column = F.concat(F.lit(" "), (F.col("user_id") * 20).cast("string"), F.lit("  "))
    return views.table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("event_type") == "error", "   ").otherwise(customer).alias("customer_id"),
        # a signup asks for no length of its own
        F.when(F.col("event_type") != "signup", F.floor("value").cast("int")).alias("top_k"),
    )


@_query
def recommend_requests(spark, sf):
    answered = _recommender(spark, sf).answer(_asked(spark, sf))
    return answered.select(
        "request_id", "customer_id", "top_k", "status", F.explode_outer("recommendations").alias("r")
    ).select("request_id", "customer_id", "top_k", "status", "r.rank", "r.article_id", "r.item_index", "r.similarity")


@_query
def recall_at_k(spark, sf):
    tx = freeze(views.transactions(spark, sf), "purchases")  # read for both contexts, the bounds and the test period
    made = serving.build_recommender(tx, lambda size: views.index_embeddings(spark, sf, size), views.formula_weights(spark), "double")
    return _round(serving.recall(made, tx), "recall", digits=6)


def _store(spark, sf):
    """Each customer's list is stored twice: five items at the first purchase, ten at the last."""
    days = features.real_interactions(views.transactions(spark, sf)).groupBy("customer_id").agg(
        F.min("first_purchase_date").alias("first_day"), F.max("last_purchase_date").alias("last_day")
    )
    lists = _recommender(spark, sf).recommend_all()
    items = F.sort_array(F.collect_list(F.struct("rank", "item_index")))["item_index"]
    lists = lists.groupBy("customer_id").agg(items.alias("items")).join(days, "customer_id")
    first = lists.select("customer_id", F.slice("items", 1, 5).alias("items"), F.col("first_day").cast("timestamp_ntz").alias("created_at"))
    last = lists.select("customer_id", "items", F.col("last_day").cast("timestamp_ntz").alias("created_at"))
    return store.store_recommendations(first.unionByName(last))


@_query
def rec_store_put(spark, sf):
    return _store(spark, sf)


@_query
def rec_store_get(spark, sf):
    """Read half an hour into the last day: what was stored that day is alive, all else has expired."""
    tx = views.transactions(spark, sf)
    now = tx.agg((F.max("t_dat").cast("timestamp_ntz") + F.expr("INTERVAL 30 MINUTES")).alias("now")).scalar()
    entries = freeze(_store(spark, sf), "store")
    asked = views.customers(spark, sf).select("customer_id")
    got = store.get_recommendations(entries, asked, now, "bigint")
    return got.select("customer_id", "key", F.posexplode_outer("items").alias("position", "item_index"))


def _last_instant(tx: DataFrame) -> Column:
    return tx.agg((F.max("t_dat").cast("timestamp_ntz") + F.expr("INTERVAL 30 MINUTES")).alias("now")).scalar()


def _got(got: DataFrame) -> DataFrame:
    return got.select("customer_id", "key", F.posexplode_outer("items").alias("position", "item_index"))


@_query
def rec_store_log_get(spark, sf):
    """The same read from a log of three runs, two of which are merged by a compaction in between."""
    now = _last_instant(views.transactions(spark, sf))
    entries, path = freeze(_store(spark, sf), "store"), scratch_path(spark, "log-store")
    early = F.size(F.from_json("payload", "items array<bigint>")["items"]) == 5
    log_store.put(spark, path, entries.filter(early))
    log_store.put(spark, path, entries.filter(~early & (F.crc32("key") % 2 == 0)))
    log_store.compact(spark, path, now)
    log_store.put(spark, path, entries.filter(~early & (F.crc32("key") % 2 == 1)))
    return _got(log_store.get(spark, path, views.customers(spark, sf).select("customer_id"), now, "bigint"))


@_query
def stream_rec_store(spark, sf):
    """The same read from streaming state whose entries expire by timers."""
    now = _last_instant(views.transactions(spark, sf))
    source, table = scratch_path(spark, "store-writes"), scratch_path(spark, "expiring-store")
    timed = _store(spark, sf).withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "expires_at")})
    timed.repartitionByRange(3, "created_at").write.parquet(source)
    writes = spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 2).parquet(source)
    expiring_store.start_expiring_store(writes, table, scratch_path(spark, "expiring-state")).awaitTermination()
    asked = views.customers(spark, sf).select("customer_id")
    return _got(store.get_recommendations(expiring_store.read_entries(spark, table, now), asked, now, "bigint"))


# checks


@_query
def index_quality(spark, sf):
    tx = views.transactions(spark, sf)
    items = indexing.item_mapping(tx).table
    served = serving.item_context_lookup(tx).table.select("article_id", "item_index")
    return quality.index_quality(indexing.user_mapping(tx).table, items, served)


@_query
def embedding_contract(spark, sf):
    tx = views.transactions(spark, sf)
    vectors = _encode_items(spark, sf, True)
    stored = freeze(vectors, "item-vectors")
    return quality.embedding_contract(vectors, indexing.item_mapping(tx).table, stored, "article_id", _DIM)


@_query
def context_quality(spark, sf):
    users = serving.user_context_lookup(views.raw_transactions(spark, sf)).table
    return quality.context_quality(users, *_USER_CONTEXT)


@_query
def recommendation_quality(spark, sf):
    lists = _recommender(spark, sf).recommend_all()
    return quality.recommendation_quality(lists, retrieve.TOP_K)


@_query
def quality_verdict(spark, sf):
    return quality.verdict(index_quality(spark, sf).unionByName(context_quality(spark, sf)))


def _damaged_index(index: DataFrame, key: str, name: str) -> DataFrame:
    """Index 3 is missing, and the keys at 0 and 1 have changed places."""
    swapped = F.when(F.col(name) == 0, 1).when(F.col(name) == 1, 0).otherwise(F.col(name)).cast("bigint")
    return index.filter(F.col(name) != 3).select(key, swapped.alias(name))


@_query
def damaged_index_quality(spark, sf):
    """The index checks on damaged user indices, sound item indices, and a copy of them that lacks a row."""
    tx = views.transactions(spark, sf)
    items = indexing.item_mapping(tx).table.select("article_id", "item_index")
    users = _damaged_index(indexing.user_mapping(tx).table, "customer_id", "user_index")
    return quality.index_quality(users, items, items.filter("item_index != 5"))


@_query
def damaged_embedding_contract(spark, sf):
    """The given vectors, every seventh doubled and the first without a copy; the copy has an extra row."""
    vectors = views.table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")
    doubled = F.transform("embedding", lambda x: x * 2)
    made = vectors.withColumn("embedding", F.when(F.col("article_id") % 7 == 3, doubled).otherwise(F.col("embedding")))
    stored = vectors.filter("article_id > 0").unionByName(vectors.filter("article_id = 1"))
    return quality.embedding_contract(made, vectors.select("article_id"), stored, "article_id", _DIM)


@_query
def damaged_context_quality(spark, sf):
    """Served contexts where one customer in eleven counts no purchase."""
    users = serving.user_context_lookup(views.raw_transactions(spark, sf)).table
    total, average = _USER_CONTEXT
    bad = F.when(F.col("user_index") % 11 == 0, 0).otherwise(F.col(total))
    return quality.context_quality(users.withColumn(total, bad), total, average)


@_query
def damaged_recommendation_quality(spark, sf):
    """Lists of purchased articles, up to ten of them, some of which repeat."""
    tx = views.transactions(spark, sf)
    place = Window.partitionBy("customer_id").orderBy("t_dat", "article_id", "price")
    lists = tx.withColumn("rank", F.row_number().over(place)).filter("rank <= 10")
    lists = lists.select("customer_id", F.pmod("article_id", F.lit(7)).alias("article_id"), F.lit(0.5).alias("similarity"))
    return quality.recommendation_quality(lists, retrieve.TOP_K)


@_query
def damaged_verdict(spark, sf):
    return quality.verdict(damaged_index_quality(spark, sf).unionByName(damaged_context_quality(spark, sf)))


@_query
def scan_transactions_csv(spark, sf):
    """The purchases written as CSV by several tasks and read back by name."""
    folder = f"{scratch_path(spark, 'csv')}/{retail.FILES['transactions']}"
    tx = views.transactions(spark, sf).select(*retail.CONTRACT["transactions"])
    tx.repartition(_files(tx, 3)).write.option("header", True).csv(folder)
    read = retail.conform(retail.read_csv(spark, folder), "transactions")
    return read.withColumn("customer_id", F.col("customer_id").cast("bigint"))


# streaming


def _files(rows: DataFrame, least: int) -> int:
    """A multiple of ``least`` that leaves no task more than ``_FILE_ROWS`` rows."""
    return least * max(1, -(-rows.count() // (least * _FILE_ROWS)))


def _in_files(spark, sf, name: str, steps: int = 4) -> tuple[str, int]:
    """A folder with the table's rows in files for a stream of several micro-batches, and the number of files of each."""
    rows, folder = views.table(spark, sf, name), f"{scratch_path(spark, 'stream-input')}/{name}.parquet"
    files = _files(rows, steps)
    rows.repartition(files).write.parquet(folder)
    return folder, files // steps


@_query
def stream_user_context(spark, sf):
    context = running_context.run_running_context(
        views.purchase_stream(spark, sf, *_in_files(spark, sf, "events")), "customer_id", "customer"
    )
    return _round(context, "customer_avg_price")


@_query
def stream_item_context(spark, sf):
    context = running_context.run_running_context(
        views.transaction_stream(spark, sf, *_in_files(spark, sf, "lineitem")), "article_id", "item"
    )
    return _round(context, "item_avg_price")


@_query
def stream_clean_transactions(spark, sf):
    """Cleaning as purchases arrive, one period after another."""
    raw = freeze(views.raw_transactions(spark, sf), "raw-purchases")
    source, table = scratch_path(spark, "purchase-files"), scratch_path(spark, "cleaned")
    bounds, files = split.split_bounds(retail.with_day(raw)), _files(raw, 1)
    day = F.coalesce(F.col("t_dat").try_cast("date"), F.lit(bounds.first_day))
    for part in split.split_parts(raw.withColumn("_text", F.col("t_dat")).withColumn("t_dat", day), bounds):
        part.withColumn("t_dat", F.col("_text")).drop("_text").repartition(files).write.mode("append").parquet(source)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(source)
    clean_stream.run_clean_stream(stream, table, scratch_path(spark, "cleaned-state"))
    return clean_stream.read_cleaned(spark, table)


# fitting


def _factors(spark, sf):
    tx = views.transactions(spark, sf)
    users, items = _mappings(tx)
    counts = assemble.add_id_mappings(features.real_interactions(tx), users, items)
    return fit.fit_factors(counts)


@_query
def als_embeddings(spark, sf):
    """What must hold for the fitted vector of every key of both sides."""
    factors = _factors(spark, sf)
    v = F.col("embedding")
    facts = [F.size(v).alias("size"), is_finite(v).alias("finite"), is_unit(v, 1e-4).alias("unit")]
    users = factors.users.select(F.lit("user").alias("side"), F.col("user_index").alias("index"), *facts)
    items = factors.items.select(F.lit("item").alias("side"), F.col("item_index").alias("index"), *facts)
    return users.unionByName(items)


@_query
def context_ranker_loss(spark, sf):
    """Whether the fitted context-aware score beats an even guess on its training set."""
    factors = _factors(spark, sf)
    data = training.training_features(views.transactions(spark, sf), method=MD5)
    examples = freeze(encode.score_pairs(data, factors.users, factors.items), "ranker-examples")
    loss = fit.mean_loss(fit.fit_context_ranker(examples)(examples))
    return loss.select("example_count", (F.col("mean_loss") < math.log(2)).alias("better_than_even"))


@_query
def fitted_recall(spark, sf):
    """Fit on the train period, recommend, and compare with the test period: what must hold of the outcome."""
    found = fitted.fitted_recall(views.transactions(spark, sf))
    return found.select(
        "user_count",
        F.col("hit_count").between(0, F.col("user_count")).alias("hits_are_customers"),
        (F.abs(F.col("recall") - F.col("hit_count") / F.col("user_count")) < 1e-9).alias("recall_is_their_share"),
    )


@_query
def two_tower_fit(spark, sf):
    """Both towers trained on the train period: size of what came out, whether the loss fell, and recall on the test period."""
    tx = views.transactions(spark, sf)
    made = fitted.fit_tower_model(tx, epochs=2, steps=3, rate=0.02, method=MD5, batch_rows=256)
    losses = made.fitted.fitted_losses
    found = fitted.tower_recall(tx, made)
    return found.select(
        "user_count",
        made.model.users.agg(F.count_if(is_unit(F.col("embedding"), 1e-9))).scalar().alias("user_vectors"),
        made.model.items.agg(F.count_if(is_unit(F.col("embedding"), 1e-9))).scalar().alias("item_vectors"),
        made.fitted.weights.agg(F.count("*")).scalar().alias("weight_rows"),
        F.lit(all(map(math.isfinite, losses)) and losses[-1] < losses[0]).alias("loss_fell"),
        F.col("hit_count").between(0, F.col("user_count")).alias("hits_are_customers"),
    )


@_query
def item_topk_float(spark, sf):
    """The search over vectors of the float tower path: length of each vector and rank of its own article."""
    vectors = freeze(_encode_items(spark, sf, True, "float"), "float-vectors")
    own = retrieve.self_retrieval(vectors.select("article_id", "item_index", "embedding"))
    near = vectors.select(F.col("article_id").alias("query_id"), is_unit(F.col("embedding"), 1e-5).alias("unit"))
    close = F.abs(F.col("best_similarity") - 1) < 1e-5
    return own.join(near, "query_id").select("query_id", "unit", close.alias("finds_itself"), "result_count")


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)
