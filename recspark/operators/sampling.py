"""Positive interactions and hash-sampled negative ones.

A negative is found without pairing customers with articles: the hash of each
positive pair names one article index, and the pair is kept when that customer
never bought that article.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.hashing import XXHASH64, hash_bucket, hash_share, pair_hash
from recspark.operators.indexing import DenseIndex, item_mapping
from recspark.session import freeze

# Labels and default seed.
POSITIVE_LABEL = 1.0
NEGATIVE_LABEL = 0.0
SEED = 42

PAIR = ["customer_id", "article_id"]

#: Rows that one task groups.
_ROWS_PER_TASK = 1_000_000


def positive_interactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(*PAIR).distinct().withColumn("label", F.lit(POSITIVE_LABEL))


def positive_counts(positives: DataFrame) -> DataFrame:
    return positives.groupBy("customer_id").agg(F.count("*").alias("positive_count"))


def negative_candidates(
    positives: DataFrame, items: DenseIndex, seed: int = SEED, method: str = XXHASH64
) -> DataFrame:
    """One candidate article per positive pair.

    Candidate indices are spread evenly by the hash, so this join has no hot
    key; the item table is broadcast when its files are small enough for that.
    """
    hashed = pair_hash(F.col("customer_id"), F.col("article_id"), seed, method)
    wanted = positives.select(
        "customer_id",
        F.col("article_id").alias("positive_article_id"),
        hash_bucket(hashed, max(items.size, 1)).alias("item_index"),
    )
    named = items.table.select("item_index", F.col("article_id").alias("negative_article_id"))
    return wanted.join(named, "item_index").select("customer_id", "positive_article_id", "negative_article_id")


def label_pairs(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every positive with label 1 and every other candidate, once, with label 0.

    Both sets meet in one grouping by pair, where the greatest label wins: that
    removes purchased and repeated candidates in a single shuffle that is
    combined beforehand. The key is the whole pair, so a customer with very many
    rows is spread over all tasks. Partitions follow the number of positives, and there are no more candidates than
    positives, so the memory of a task stays the same; ``positives`` is counted for it and should be a stored table.
    """
    tasks = max(positives.sparkSession.sparkContext.defaultParallelism, -(-2 * positives.count() // _ROWS_PER_TASK))
    bought = positives.select(*PAIR, F.lit(POSITIVE_LABEL).alias("label"))
    offered = candidates.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", F.col("negative_article_id").alias("article_id"), F.lit(NEGATIVE_LABEL).alias("label")
    )
    return bought.unionByName(offered).repartition(tasks, *PAIR).groupBy(*PAIR).agg(F.max("label").alias("label"))


def unpurchased(candidates: DataFrame, positives: DataFrame) -> DataFrame:
    """Distinct candidates the customer never bought."""
    return label_pairs(positives, candidates).filter(F.col("label") == NEGATIVE_LABEL).select(*PAIR)


def within_ratio(
    negatives: DataFrame,
    positives: DataFrame,
    negative_ratio: float,
    seed: int = SEED,
    method: str = XXHASH64,
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """Keep, per customer, the first ``positives * ratio`` negatives in hash order.

    The rank is exact for a customer of any size: the hash range of a large
    customer is cut into slices, each slice is ranked by itself, and the sizes of
    the earlier slices are added. A window over the customer alone would put all
    of that customer's rows into one task.
    """
    hashed = pair_hash(F.col("customer_id"), F.col("article_id"), seed, method)
    slices = F.ceil(F.col("positive_count") / F.lit(rows_per_slice))
    placed = (
        negatives.join(positive_counts(positives), "customer_id")
        .withColumn("_hash", hashed)
        .withColumn("_slices", slices)
        .withColumn(
            "_slice",
            F.least(F.floor(hash_share(F.col("_hash"), method) * F.col("_slices")), F.col("_slices") - 1),
        )
    )
    earlier = Window.partitionBy("customer_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.filter("_slices > 1")
        .groupBy("customer_id", "_slice")
        .agg(F.count("*").alias("_rows"))
        .select("customer_id", "_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    in_slice = Window.partitionBy("customer_id", "_slice").orderBy("_hash", "article_id")
    rank = F.coalesce("_start", F.lit(0)) + F.col("_rank")
    return (
        placed.withColumn("_rank", F.row_number().over(in_slice))
        .join(starts, ["customer_id", "_slice"], "left")
        .filter(rank <= F.col("positive_count") * F.lit(negative_ratio))
        .select(*PAIR)
    )


def sample_interactions(
    positives: DataFrame,
    items: DenseIndex,
    negative_ratio: float = 1,
    seed: int = SEED,
    method: str = XXHASH64,
) -> DataFrame:
    """Labelled positives and negatives from distinct positive pairs.

    ``positives`` is read more than once and should be a stored table.

    With one candidate per positive a customer cannot have more negatives than
    positives, so for a ratio of one or more the rank filter would keep every row
    and is left out of the plan.
    """
    labelled = label_pairs(positives, negative_candidates(positives, items, seed, method))
    if negative_ratio >= 1:
        return labelled
    negatives = freeze(labelled.filter(F.col("label") == NEGATIVE_LABEL).select(*PAIR), "negatives")
    kept = within_ratio(negatives, positives, negative_ratio, seed, method)
    return positives.select(*PAIR, F.lit(POSITIVE_LABEL).alias("label")).unionByName(
        kept.withColumn("label", F.lit(NEGATIVE_LABEL))
    )


def stored_positives(transactions: DataFrame) -> DataFrame:
    """Distinct pairs in the shared folder: the purchases are scanned once."""
    return freeze(transactions.select(*PAIR).distinct(), "positives")


def training_interactions(
    transactions: DataFrame, negative_ratio: float = 1, seed: int = SEED, method: str = XXHASH64
) -> DataFrame:
    """Positives and negatives together."""
    positives = stored_positives(transactions)
    return sample_interactions(positives, item_mapping(positives), negative_ratio, seed, method)


def negative_interactions(
    transactions: DataFrame, negative_ratio: float = 1, seed: int = SEED, method: str = XXHASH64
) -> DataFrame:
    """Negatives of all customers; at most one per positive pair."""
    sampled = training_interactions(transactions, negative_ratio, seed, method)
    return sampled.filter(F.col("label") == NEGATIVE_LABEL)
