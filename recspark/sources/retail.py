"""The three retail tables: purchases, articles and customers.

CSV files are read by column name with a fixed contract. Only the header line
is looked at up front; no pass over the data guesses types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.dates import to_day, to_number

# File names and the columns each table must have, with their types.
FILES = {"articles": "articles.csv", "customers": "customers.csv", "transactions": "transactions_train.csv"}
CONTRACT = {
    "articles": {"article_id": "bigint", "product_code": "bigint"},
    "customers": {"customer_id": "string"},
    "transactions": {
        "t_dat": "date",
        "customer_id": "string",
        "article_id": "bigint",
        "price": "double",
        "sales_channel_id": "int",
    },
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, named by the header line.

    A folder may hold several files. One whose header differs from the first one's, in
    names or order, ends the job when it is read instead of being read by position.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Give the contract columns their types; others pass through untouched.

    Values that cannot be read become null and are left to the cleaning step.
    """
    missing = [c for c in CONTRACT[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns {missing}")
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in CONTRACT[table].items()})


def load_table(spark: SparkSession, data_dir: str, table: str, raw: bool = False) -> DataFrame:
    df = read_csv(spark, f"{data_dir}/{FILES[table]}")
    return df if raw else conform(df, table)


def load_datasets(spark: SparkSession, data_dir: str, raw: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Articles, customers and transactions from one folder of CSV files."""
    return tuple(load_table(spark, data_dir, table, raw) for table in ("articles", "customers", "transactions"))


def load_transactions(spark: SparkSession, data_dir: str) -> DataFrame:
    """The contract columns of the purchases; the reader parses no others."""
    return load_table(spark, data_dir, "transactions").select(*CONTRACT["transactions"])


def priced_rows(raw: DataFrame, *keys: str) -> DataFrame:
    """``(keys, price)`` of the rows where some key is present and whose price is a number.

    An article key must be a number too, else it counts as absent.
    """
    named = [F.col(k).try_cast("bigint").alias(k) if k == "article_id" else F.col(k) for k in keys]
    return raw.select(*named, to_number("price").alias("price")).na.drop(subset=["price"]).na.drop("all", subset=list(keys))


def with_day(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("t_dat", to_day("t_dat"))


def probe_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per contract column: is it there, and in how many rows is it filled?

    One pass per table counts every column at once.
    """
    parts = []
    for table, df in tables.items():
        wanted = CONTRACT[table]
        counts = df.agg(
            F.count("*").alias("table_rows"),
            *[F.count(c if c in df.columns else F.lit(None)).alias(c) for c in wanted],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(c).alias("column_name"),
                    F.lit(c in df.columns).alias("present"),
                    F.col(c).alias("filled_rows"),
                    F.col("table_rows"),
                )
                for c in wanted
            ]
        )
        parts.append(counts.select(F.inline(entries)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def sample_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows in key order: a look at the data that is the same on every run."""
    return df.orderBy(*(keys or df.columns)).limit(n)
