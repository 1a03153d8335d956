"""Interactions joined with indices and context, ready for a model.

Each join looks one key up in a table that has one row per key. Where the fact
side has a hot key, adaptive execution splits that partition; small lookup
tables are broadcast by the planner from their file sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT_COLUMNS = (
    "customer_total_purchases",
    "customer_avg_price",
    "item_total_purchases",
    "item_avg_price",
)


def add_id_mappings(interactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Articles first: theirs is the smaller table, so the larger join comes last."""
    return interactions.join(items, "article_id").join(users, "customer_id")


def two_tower_dataset(transactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Every purchase with its indices, price and channel, labelled with integer 1."""
    facts = transactions.select("customer_id", "article_id", "price", "sales_channel_id")
    return add_id_mappings(facts, users, items).select(
        "user_index", "item_index", "price", "sales_channel_id", F.lit(1).alias("label")
    )


def add_context(interactions: DataFrame, user_context: DataFrame, item_context: DataFrame) -> DataFrame:
    """Context of both sides; null where a key has none."""
    return interactions.join(item_context, "article_id", "left").join(user_context, "customer_id", "left")


def with_context(mapping: DataFrame, context: DataFrame, key: str) -> DataFrame:
    """One lookup row per key holding its index and its context.

    Joining the two small tables first means that the interactions are joined,
    and shuffled, once per side instead of twice.
    """
    return mapping.join(context, key, "left")


def select_model_features(data: DataFrame) -> DataFrame:
    return data.select("user_index", "item_index", *CONTEXT_COLUMNS, "label")


def context_null_counts(data: DataFrame) -> DataFrame:
    """Missing context values per column, in one pass; zero on empty input."""
    return data.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CONTEXT_COLUMNS])


def context_statistics(data: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per context column, in one pass."""
    totals = data.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("value_count"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min_value"),
                F.max(c).cast("double").alias("max_value"),
            ).alias(c)
            for c in CONTEXT_COLUMNS
        ]
    )
    return totals.select(F.inline(F.array(*CONTEXT_COLUMNS)))


def normalized_context(data: DataFrame, *columns: str) -> DataFrame:
    """``log1p`` of the context columns, as the towers expect them."""
    return data.withColumns({c: F.log1p(F.col(c).cast("double")) for c in columns or CONTEXT_COLUMNS})
