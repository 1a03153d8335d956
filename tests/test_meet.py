import random

from pyspark.sql import functions as F

from recspark.functions.vectors import dot
from recspark.operators import encode, meet
from recspark.session import freeze


def _joined(pairs, left, right, lk, rk):
    one, two = left.select(lk, F.col("embedding").alias("_a")), right.select(rk, F.col("embedding").alias("_b"))
    return pairs.join(two, rk).join(one, lk).withColumn("score", dot(F.col("_a"), F.col("_b"))).drop("_a", "_b")


def _vectors(spark, key, rows, kind="double"):
    return freeze(spark.createDataFrame(rows, f"{key} bigint, embedding array<{kind}>"), key)


def _lines(df):
    return sorted(map(str, df.collect()))


def test_equals_the_join_bit_for_bit(spark, monkeypatch):
    random.seed(1)
    vector = lambda: [random.gauss(0, 1) for _ in range(7)]
    odd = [None, [], [1.0, None], [float("nan")] * 7, [1.0]]
    users = [(i, vector()) for i in range(60)] + [(3, vector()), (3, vector()), (None, vector())] + [(100 + i, v) for i, v in enumerate(odd)]
    items = [(i, vector()) for i in range(90)] + [(5, vector()), (None, vector())] + [(100 + i, v) for i, v in enumerate(odd)]
    keys = [*range(65), 100, 101, 102, 103, 104, None]
    rows = [(random.choice(keys), random.choice(keys), f"p{i}" if i % 3 else None) for i in range(3000)] + [(3, 5, "x")] * 2
    pairs = spark.createDataFrame(rows, "user_index bigint, item_index bigint, name string")
    u, i = _vectors(spark, "user_index", users), _vectors(spark, "item_index", items, "float")
    plain = _joined(pairs, u, i, "user_index", "item_index")
    for block in (meet._BLOCK_BYTES, 200):
        monkeypatch.setattr(meet, "_BLOCK_BYTES", block)
        found = encode.score_pairs(pairs, u, i)
        assert found.columns == plain.columns
        assert _lines(found) == _lines(plain)
    assert encode.score_pairs(pairs, u.limit(0), i).count() == 0


def test_vectors_are_not_copied_for_every_pair(spark):
    """Before, each pair was shuffled with a vector; now only rows of the two tables are, once per group of the other."""
    pairs = spark.range(50_000).select((F.col("id") % 50).alias("user_index"), (F.col("id") % 49).alias("item_index"))
    vector = F.array_repeat(F.rand(1), 64)
    u, i = (freeze(spark.range(50).select(F.col("id").alias(k), vector.alias("embedding")), k) for k in ("user_index", "item_index"))
    found = encode.score_pairs(pairs, u, i)
    assert found.count() == 50_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_cells_follow_tasks_and_bytes():
    mb = 1 << 20
    assert meet.cells_of(24, 100 * mb, 100 * mb) == (5, 5)
    left, right = meet.cells_of(24, 3000 * mb, 4000 * mb)
    assert 3000 / left <= 128 and left * right >= 7000 / 64
    assert meet.cells_of(24, 0, 0)[0] >= 1


def test_copies_of_a_pass_are_removed_before_the_next(spark, monkeypatch):
    """Before, all copies were on disk at the same time."""
    random.seed(2)
    pairs = spark.range(2_000).select((F.col("id") % 53).alias("user_index"), (F.col("id") % 47).alias("item_index"), "id")
    rows = lambda n: [(i, [random.gauss(0, 1) for _ in range(5)]) for i in range(n)] + [(None, [1.0] * 5)]
    u, i = _vectors(spark, "user_index", rows(50)), _vectors(spark, "item_index", rows(40))
    plain, names = _lines(_joined(pairs, u, i, "user_index", "item_index")), []
    monkeypatch.setattr(meet, "_PASS_BYTES", 8_000)
    monkeypatch.setattr(meet, "freeze", lambda df, name: names.append(name) or freeze(df, name))
    found = encode.score_pairs(pairs, u, i)
    assert _lines(found) == plain and names.count("pairs") == 1 and names.count("scored") > 1
