"""Cleaning of the three retail tables, label projections and table statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.dates import to_day, to_number


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keep the smallest row of each key, comparing the other columns left to right.

    A plain ``dropDuplicates([key])`` keeps whichever row arrives first. The
    minimum is the same on every run, and it is combined before the shuffle, so
    a key with any number of copies sends one row per input task.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    smallest = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(key, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def clean_articles(articles: DataFrame) -> DataFrame:
    """Unique articles that have a product code.

    Incomplete rows go first, so that an article is not lost because the copy
    that was kept happens to lack its product code.
    """
    complete = articles.filter(F.col("article_id").isNotNull() & F.col("product_code").isNotNull())
    return one_row_per_key(complete, "article_id")


def clean_customers(customers: DataFrame) -> DataFrame:
    return one_row_per_key(customers.filter(F.col("customer_id").isNotNull()), "customer_id")


def typed_purchases(transactions: DataFrame) -> DataFrame:
    """Purchases with both keys, a positive price and a readable date; the row rules of cleaning."""
    typed = transactions.withColumns({"t_dat": to_day("t_dat"), "price": to_number("price")})
    usable = F.col("customer_id").isNotNull() & F.col("article_id").isNotNull() & F.col("t_dat").isNotNull()
    return typed.filter(usable & (F.col("price") > 0))


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Distinct purchases with both keys, a positive price and a readable date.

    Dates and prices may still be text. They are read first and the filters sit
    below the duplicate removal, so that bad rows are never shuffled and the
    rest is compared and shuffled as typed values.
    """
    return typed_purchases(transactions).distinct()


def clean_datasets(
    articles: DataFrame, customers: DataFrame, transactions: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return clean_articles(articles), clean_customers(customers), clean_transactions(transactions)


def dataset_statistics(articles: DataFrame, customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Row count, column count and, for purchases, the date range."""

    def describe(name: str, df: DataFrame, low, high) -> DataFrame:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            low.alias("min_date"),
            high.alias("max_date"),
        )

    no_date = F.lit(None).cast("date")
    return (
        describe("articles", articles, no_date, no_date)
        .unionByName(describe("customers", customers, no_date, no_date))
        .unionByName(describe("transactions", transactions, F.min("t_dat"), F.max("t_dat")))
    )


def label_all(transactions: DataFrame) -> DataFrame:
    """Every purchase as a positive example; the label is an integer here."""
    return transactions.select("customer_id", "article_id", F.lit(1).alias("label"))
