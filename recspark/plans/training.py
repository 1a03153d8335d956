"""Training sets from purchases: sampling, indexing, context and split in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.hashing import XXHASH64
from recspark.operators import assemble, indexing, sampling, split
from recspark.session import freeze, side_by_side


def two_tower_training(transactions: DataFrame, seed: int = sampling.SEED, method: str = XXHASH64) -> DataFrame:
    """(user_index, item_index, label) of all positives and negatives.

    Indices and samples all come from the stored distinct pairs.
    """
    positives = sampling.stored_positives(transactions)
    items, users = side_by_side(
        transactions.sparkSession,
        lambda: indexing.item_mapping(positives),
        lambda: indexing.user_mapping(positives),
    )
    interactions = sampling.sample_interactions(positives, items, 1, seed, method)
    indexed = assemble.add_id_mappings(interactions, users.table, items.table)
    return indexed.select("user_index", "item_index", "label")


def pair_totals(transactions: DataFrame, bounds: split.SplitBounds) -> DataFrame:
    """One row per customer-article pair of any period, with its totals in the train period.

    Everything the training set needs follows from this table, so the purchases
    themselves are read once for it.
    """
    in_train = F.col("t_dat") < F.lit(bounds.train_end)
    price = F.when(in_train, F.col("price"))
    return transactions.groupBy(*sampling.PAIR).agg(
        F.count_if(in_train).alias("train_rows"),
        F.count(price).alias("train_prices"),
        F.sum(price).alias("train_price_sum"),
    )


def side_table(pairs: DataFrame, key: str, index: str, prefix: str) -> indexing.DenseIndex:
    """Index over all periods and context of the train period, one row per key.

    A key without purchases in the train period has null context.
    """
    rows, prices = F.sum("train_rows"), F.sum("train_prices")
    context = (
        pairs.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.when(rows > 0, rows).alias(f"{prefix}_total_purchases"),
            F.when(prices > 0, F.sum("train_price_sum") / prices).alias(f"{prefix}_avg_price"),
        )
    )
    return indexing.dense_index(context, [key], index, f"{prefix}-side")


def training_features(
    transactions: DataFrame, seed: int = sampling.SEED, method: str = XXHASH64, negative_ratio: float = 1
) -> DataFrame:
    """The context training set: interactions and context of the train period,
    indices of all periods.

    Index and context of a key sit in one stored table per side, so the
    interactions meet two joins instead of four, and the planner knows from the
    files which side is small enough to broadcast.
    """
    pairs = freeze(pair_totals(transactions, split.split_bounds(transactions)), "pairs")
    positives = pairs.filter(F.col("train_rows") > 0).select(*sampling.PAIR)
    users, items, train_items = side_by_side(
        transactions.sparkSession,
        lambda: side_table(pairs, "customer_id", "user_index", "customer").table,
        lambda: side_table(pairs, "article_id", "item_index", "item").table,
        lambda: indexing.item_mapping(positives),
    )
    interactions = sampling.sample_interactions(positives, train_items, negative_ratio, seed, method)
    return assemble.select_model_features(assemble.add_id_mappings(interactions, users, items))
