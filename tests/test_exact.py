"""Sums that are the same in any order, and the contexts made from them."""

from __future__ import annotations

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from recspark.functions.exact import as_double, exact_sum, merged
from recspark.operators import features
from recspark.plans import serving
from recspark.sources import views
from recspark.streaming import running_context


def _prices(n, seed=0):
    rng = random.Random(seed)
    return [rng.choice([rng.uniform(-5, 5), rng.uniform(0, 1e9), 0.1, 0.05083050847457627, -0.1, 1e-12]) for _ in range(n)]


def test_sums_are_exact_and_do_not_depend_on_order(spark):
    prices = _prices(5000)
    exact = sum((Fraction(math.floor(Fraction(p) * 2**60), 2**60) for p in prices), Fraction(0))
    found = set()
    for seed, parts in ((1, 1), (2, 7), (3, 64)):
        random.Random(seed).shuffle(prices)
        df = spark.createDataFrame([(p,) for p in prices], "price double").repartition(parts)
        found.add(df.agg(exact_sum(F.col("price")).alias("s")).select(as_double(F.col("s"))).first()[0])
    assert len(found) == 1
    (total,) = found
    assert abs(Fraction(total) - exact) <= Fraction(math.ulp(total))  # one rounding


def test_merged_partials_equal_one_pass(spark):
    df = spark.createDataFrame([(i % 5, i % 3, p) for i, p in enumerate(_prices(999, 4))], "k int, day int, price double")
    once = features.served_context(df, "k", "customer")
    days = features.merge_totals(features.price_totals(df, "day", "k"), "k")
    assert sorted(once.collect()) == sorted(features.context_of(days, "k", "customer").collect())
    nothing = df.filter("false").agg(exact_sum(F.col("price")).alias("s"))
    assert nothing.select(as_double(F.col("s")).alias("d")).first().d is None
    assert nothing.agg(merged(F.col("s")).alias("s")).select(as_double(F.col("s")).alias("d")).first().d is None


def test_batch_one_scan_and_stream_are_equal_bit_for_bit(spark, sf_dir, tmp_path):
    raw = views.transactions(spark, sf_dir)
    _, one_scan = serving.context_lookups(raw)
    batch = serving.item_context_lookup(raw)
    views.table(spark, sf_dir, "lineitem").repartition(5).write.parquet(str(tmp_path / "lines"))
    stream = running_context.run_running_context(views.transaction_stream(spark, sf_dir, str(tmp_path / "lines")), "article_id", "item")
    rows = lambda df: sorted(map(tuple, df.select("article_id", "item_total_purchases", "item_avg_price").collect()))
    assert rows(batch.table) == rows(one_scan.table) == rows(stream)
