"""Retail tables as views over star-schema Parquet tables.

``transactions`` are order lines joined with their orders; parts are the
articles. The ``raw_*`` views carry what real exports carry: text where a number
belongs, refunds, missing keys and repeated rows. Which rows are affected
follows from ordinary attributes, and no row of the tables is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = (
    "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(*_LINES)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("o_orderdate").cast("date").alias("t_dat"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(2).alias("sales_channel_id"),
        "l_quantity",
        "l_returnflag",
        "o_orderstatus",
        "o_orderpriority",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select("customer_id", "article_id", "t_dat", "price", "sales_channel_id")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("article_id"),
        F.floor(F.col("p_partkey") / 10).cast("bigint").alias("product_code"),
        "p_name",
        "p_brand",
        "p_type",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_nationkey", "c_mktsegment"
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and prices as text, some unreadable; lines of pending orders come twice."""
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    amount = F.col("price").cast("string")
    lines = _order_lines(spark, sf_dir)
    rows = lines.select(
        F.when((F.col("o_orderpriority") != "4-NOT SPECIFIED") | (quantity != 5), F.col("customer_id")).alias("customer_id"),
        F.when(quantity != 6, F.col("article_id")).alias("article_id"),
        F.when((quantity == 7) & (flag == "N"), "unknown").otherwise(F.col("t_dat").cast("string")).alias("t_dat"),
        F.when((quantity == 1) & (flag == "R"), F.concat(F.lit("-"), amount))
        .when((quantity == 2) & (flag == "N"), F.lit(None))
        .when((quantity == 3) & (flag == "A"), "n/a")
        .when((quantity == 4) & (flag == "A"), "0")
        .otherwise(amount)
        .alias("price"),
        "sales_channel_id",
        "o_orderstatus",
    )
    return rows.unionByName(rows.filter(F.col("o_orderstatus") == "P")).drop("o_orderstatus")


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some product codes are missing; promotional articles have a second, renamed row."""
    parts = table(spark, sf_dir, "part")
    code = F.floor(F.col("p_partkey") / 10).cast("bigint")
    first = parts.select(
        F.col("p_partkey").alias("article_id"),
        F.when(F.col("p_size") != 1, code).alias("product_code"),
        "p_name",
        "p_brand",
        "p_type",
    )
    second = parts.filter(F.col("p_type") == "PROMO").select(
        F.col("p_partkey").alias("article_id"),
        F.when(F.col("p_size") != 2, code).alias("product_code"),
        F.upper("p_name").alias("p_name"),
        "p_brand",
        "p_type",
    )
    return first.unionByName(second)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt have no key; one market segment comes twice, renamed."""
    base = table(spark, sf_dir, "customer").select(
        F.when((F.col("c_acctbal") >= 0) | (F.col("c_nationkey") != 3), F.col("c_custkey")).alias("customer_id"),
        "c_nationkey",
        "c_mktsegment",
    )
    again = base.filter(F.col("c_mktsegment") == "BUILDING").withColumn("c_mktsegment", F.lit("AUTOMOBILE"))
    return base.unionByName(again)


def purchase_stream(spark: SparkSession, sf_dir: str, folder: str | None = None, files_per_trigger: int = 1) -> DataFrame:
    """Purchase events as a stream of ``(customer_id, event_type, price)``, from a folder of event files if one is given."""
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet" if folder else "events.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder or sf_dir)
        .filter(F.col("event_type") == "purchase")
        .select(F.col("user_id").alias("customer_id"), F.col("value").alias("price"))
    )


def transaction_stream(spark: SparkSession, sf_dir: str, folder: str | None = None, files_per_trigger: int = 1) -> DataFrame:
    """Order lines as a stream of ``(article_id, price)``, from a folder of line files if one is given."""
    schema = table(spark, sf_dir, "lineitem").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet" if folder else "lineitem.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder or sf_dir)
        .select(F.col("l_partkey").alias("article_id"), F.col("l_extendedprice").alias("price"))
    )


def index_embeddings(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """``(index, embedding)`` for indices below ``size``: the given vectors, assigned in turn."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    count = vectors.count()
    return (
        spark.range(size)
        .select(F.col("id").alias("index"), (F.col("id") % count).alias("vec_id"))
        .join(vectors, "vec_id")
        .select("index", "embedding")
    )


def formula_weights(spark: SparkSession) -> DataFrame:
    """Tower weights by formula, in the layout of the weights table.

    No trained weights exist, and these can be recomputed anywhere. With input
    i, output unit j and layer number L (the item tower adds 5):
    ``w = (((31 i + 17 j + 13 L) mod 101) - 50) / 500`` and
    ``b = (((7 j + L) mod 11) - 5) / 100``.
    """
    layers = [("context", 1, 2, 32), ("hidden", 2, 96, 128), ("hidden_no_context", 2, 64, 128), ("output", 3, 128, 64)]
    rows = [
        (tower, layer, number + shift, inputs, units)
        for tower, shift in (("user", 0), ("item", 5))
        for layer, number, inputs, units in layers
    ]
    shape = spark.createDataFrame(rows, "tower string, layer string, level int, inputs int, units int")
    unit = shape.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("units") - 1)))
    j, level = F.col("j"), F.col("level")
    weight = F.transform(
        F.sequence(F.lit(0), F.col("inputs") - 1),
        lambda i: (((i * 31 + j * 17 + level * 13) % 101) - 50).cast("double") / 500.0,
    )
    bias = (((j * 7 + level) % 11) - 5).cast("double") / 100.0
    return unit.select("tower", "layer", j.alias("out_unit"), weight.alias("w"), bias.alias("b"))
