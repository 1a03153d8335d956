from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import encode, quality, requests, retrieve
from recspark.sources import views

SCHEMA = "article_id bigint, item_index bigint, embedding array<float>"


def _unit(rng, n, d=8):
    m = rng.standard_normal((n, d)).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def data(spark):
    """Articles with many exact copies, so that ties at the edge of a list are common."""
    rng = np.random.default_rng(3)
    vectors = _unit(rng, 60)[rng.integers(0, 60, 200)]
    ids = (np.arange(200) * 37) % 1009
    items = spark.createDataFrame([(int(a), i, v.tolist()) for i, (a, v) in enumerate(zip(ids, vectors, strict=True))], SCHEMA)
    queries = _unit(rng, 40)
    asked = spark.createDataFrame([(f"u{i}", q.tolist()) for i, q in enumerate(queries)], "customer_id string, embedding array<float>")
    expected = {}
    for i, q in enumerate(queries):
        scores = np.round(vectors.astype(np.float64) @ q.astype(np.float64), 6)
        order = sorted(range(200), key=lambda j: (-scores[j], ids[j]))
        expected[f"u{i}"] = [(int(ids[j]), j, scores[j]) for j in order]
    return asked, items, expected


def _lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.customer_id, r["rank"])):
        out.setdefault(r.customer_id, []).append((r.article_id, r.item_index, r.similarity))
    return out


@pytest.mark.parametrize("broadcast_bytes", [retrieve.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("k", [1, 10, 100, 500])
def test_equals_brute_force(data, k, broadcast_bytes, monkeypatch):
    asked, items, expected = data
    monkeypatch.setattr(retrieve, "_BLOCK_BYTES", 64 * (8 * 8 + 16))
    monkeypatch.setattr(retrieve, "_QUERY_BLOCK", 16)
    got = _lists(retrieve.top_k(asked, items, k, broadcast_bytes=broadcast_bytes))
    assert set(got) == set(expected)
    for customer, rows in got.items():
        assert [r[:2] for r in rows] == [r[:2] for r in expected[customer][:k]]
        assert [r[2] for r in rows] == pytest.approx([r[2] for r in expected[customer][:k]], abs=1e-9)


def test_scores_cut_into_small_pieces(data, monkeypatch):
    asked, items, expected = data
    monkeypatch.setattr(retrieve, "_SCORES_AT_ONCE", 450)
    got = _lists(retrieve.top_k(asked.coalesce(1), items, 5))
    assert {c: [r[0] for r in rows] for c, rows in got.items()} == {c: [r[0] for r in rows[:5]] for c, rows in expected.items()}


def test_bad_k_and_no_items(spark, data):
    asked, items, _ = data
    with pytest.raises(ValueError):
        retrieve.top_k(asked, items, 0)
    assert retrieve.top_k(asked, items.filter("false"), 5).count() == 0


def test_self_retrieval(data, spark):
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(i + 100, i, v.tolist()) for i, v in enumerate(_unit(rng, 50))], SCHEMA)
    for r in retrieve.self_retrieval(items).collect():
        assert r.self_rank == 1 and r.self_similarity >= retrieve.SELF_SIMILARITY and r.result_count == 10


def test_invalid_queries(spark):
    rows = [("ok", [0.6, 0.8]), ("short", [1.0]), ("nan", [float("nan"), 1.0]), ("long", [3.0, 4.0]), ("none", None)]
    df = spark.createDataFrame(rows, "customer_id string, embedding array<double>")
    assert {r.customer_id for r in retrieve.invalid_queries(df, 2).collect()} == {"short", "nan", "long", "none"}


def test_tower_matches_plain_arithmetic(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(64).tolist(), i + 1, 0.5 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "user_index bigint, embedding array<double>, n bigint, p double")
    weights = views.formula_weights(spark)
    got = {r.user_index: np.array(r.embedding) for r in encode.encode(df, weights, "user", ("n", "p"), True, "double").collect()}
    w = {(r.layer, r.out_unit): (np.array(r.w), r.b) for r in weights.filter("tower = 'user'").collect()}

    def layer(name, x, units):
        return np.array([w[name, j][0] @ x + w[name, j][1] for j in range(units)])

    for i, v, n, p in rows:
        side = np.maximum(layer("context", np.log1p([n, p]), 32), 0)
        out = layer("output", np.maximum(layer("hidden", np.concatenate([v, side]), 128), 0), 64)
        assert got[i] == pytest.approx(out / np.linalg.norm(out), abs=1e-12)
    plain = encode.encode(df.drop("n", "p"), weights, "user", None, True, "float")
    assert plain.schema["embedding"].dataType.simpleString() == "array<float>"
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 for r in plain.collect())


def test_wrong_vector_length_is_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "user_index bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 components"):
        encode.encode(df, views.formula_weights(spark), "user").collect()


def test_requests(spark):
    rows = [(1, " a ", 2), (2, "a", 100), (3, "   ", 5), (4, "nobody", 5), (5, "a", 0), (6, "a", 101), (7, None, 5), (8, "a", None)]
    asked = spark.createDataFrame(rows, "request_id bigint, customer_id string, top_k int")
    lists = spark.createDataFrame(
        [("a", r, 10 + r, r, 1.0 / r) for r in range(1, 6)],
        "customer_id string, rank int, article_id bigint, item_index bigint, similarity double",
    )
    checked = requests.check_requests(asked)
    assert {r.customer_id for r in requests.wanted_customers(checked).collect()} == {"a", "nobody"}
    got = {r.request_id: r for r in requests.answer_requests(checked, lists).collect()}
    assert {i: r.status for i, r in got.items()} == {1: 200, 2: 200, 3: 400, 4: 404, 5: 422, 6: 422, 7: 400, 8: 200}
    assert [x.article_id for x in got[1].recommendations] == [11, 12]
    assert len(got[2].recommendations) == 5 and got[4].recommendations is None and got[5].recommendations is None


def test_quality_checks_notice_faults(spark):
    def outcome(df):
        return {r.check_name: r.passed for r in df.collect()}

    index = spark.createDataFrame([(1, 0), (2, 1), (9, 3)], "article_id bigint, item_index bigint")
    assert outcome(quality.index_is_sequential(index, "item_index", "seq")) == {"seq": False}
    swapped = spark.createDataFrame([(2, 0), (1, 1)], "article_id bigint, item_index bigint")
    assert outcome(quality.keys_follow_index(swapped, "article_id", "item_index", "sorted")) == {"sorted": False}
    twice = index.unionByName(index.filter("article_id = 9"))
    assert outcome(quality.same_rows(index, twice, "same")) == {"same": False}
    assert outcome(quality.same_rows(index, index.orderBy("item_index"), "same")) == {"same": True}
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (9, [float("nan"), 1.0])], "article_id bigint, embedding array<double>")
    stored = vectors.filter("article_id < 9")
    assert outcome(quality.embedding_contract(vectors, index, stored, "article_id", 2)) == {
        "embedding count matches mapping": True,
        "stored count matches": False,
        "vector size matches": True,
        "vectors are finite": False,
        "vectors have unit length": False,
        "stored vectors match": False,
    }
    lists = spark.createDataFrame([("a", 1, 0.5), ("a", 1, 0.4)], "customer_id string, article_id bigint, similarity double")
    checks = quality.recommendation_quality(lists, 2)
    assert outcome(checks)["articles of a list are distinct"] is False and outcome(checks)["every list has the expected length"] is True
    assert quality.verdict(checks).first().failed_checks == 1
    with pytest.raises(RuntimeError, match="distinct"):
        quality.require(checks)
    many = spark.range(150).select(F.concat(F.lit("check "), "id").alias("check_name"), F.lit(False).alias("passed"))
    with pytest.raises(RuntimeError, match=r"^150 check\(s\) failed.*check 149.*check 99$"):
        quality.require(many)


@pytest.mark.parametrize("broadcast_bytes", [retrieve.BROADCAST_BYTES, 0])
def test_every_query_row_has_its_own_list(spark, data, broadcast_bytes):
    asked, items, _ = data
    rows = asked.limit(4).collect()
    repeated = [("u", rows[0].embedding), ("u", rows[1].embedding), (None, rows[2].embedding), (None, rows[3].embedding), ("u", rows[0].embedding)]
    df = spark.createDataFrame(repeated, "customer_id string, embedding array<float>")
    got = retrieve.top_k(df, items, 3, broadcast_bytes=broadcast_bytes).collect()
    assert len(got) == 15 and sum(r.customer_id is None for r in got) == 6


@pytest.mark.parametrize("broadcast_bytes", [retrieve.BROADCAST_BYTES, 0])
def test_vectors_that_are_not_finite_end_the_job(spark, data, broadcast_bytes):
    asked, items, _ = data
    bad = spark.createDataFrame([(5000, 200, [float("nan")] + [0.0] * 7)], SCHEMA)
    with pytest.raises(Exception, match="finite"):
        retrieve.top_k(asked, items.union(bad), 3, broadcast_bytes=broadcast_bytes).collect()


def test_copies_in_block_search_grow_with_the_root_of_the_tasks(spark, data, monkeypatch):
    asked, items, _ = data
    assert retrieve.grid_of(100, 1000) == (10, 10) and retrieve.grid_of(100, 3) == (34, 3) and retrieve.grid_of(7, 1) == (7, 1)
    monkeypatch.setattr(retrieve, "_BLOCK_BYTES", 10 * (8 * 8 + 16))
    counted = spark.sparkContext.accumulator(0)
    finished = retrieve._finished

    def count(running, schema):
        out = finished(running, schema)
        counted.add(out.num_rows)
        return out

    monkeypatch.setattr(retrieve, "_finished", count)
    retrieve.top_k(asked.coalesce(1), items, 5, broadcast_bytes=0).collect()
    across = retrieve.grid_of(8, 20)[1]
    assert 0 < counted.value <= asked.count() * 5 * across


def test_refused_vectors_are_answered_with_400(spark):
    asked = spark.createDataFrame([(1, "a", 2), (2, "b", 2)], "request_id bigint, customer_id string, top_k int")
    lists = spark.createDataFrame([("a", 1, 10, 0, 0.5)], "customer_id string, rank int, article_id bigint, item_index bigint, similarity double")
    refused = spark.createDataFrame([("b",)], "customer_id string")
    got = requests.answer_requests(requests.check_requests(asked), lists, refused).collect()
    assert {r.request_id: r.status for r in got} == {1: 200, 2: 400}


def test_few_items_are_scored_in_double_precision(monkeypatch):
    """Before, every score was made in double precision and every block began a list of its own."""
    rng = np.random.default_rng(3)
    whole, seen = retrieve._ranked, []
    monkeypatch.setattr(retrieve, "_ranked", lambda v, x, ids, k, held, waiting: (seen.append(sum(len(w[0]) for w in waiting)), whole(v, x, ids, k, held, waiting))[1])
    items, vectors, k = rng.normal(size=(20_000, 16)), rng.normal(size=(50, 16)), 5
    ids, index, held = rng.permutation(20_000), np.arange(20_000), None
    for at in range(0, 20_000, 4_000):
        part = slice(at, at + 4_000)
        held = retrieve._merged(held, retrieve._block_lists(vectors, items[part], ids[part], index[part], k, held), k)
    assert sum(seen) < 50 * 20_000 // 100
    rows, positions, scores, _ = retrieve._best_of_all(vectors, items, ids, k)
    assert np.array_equal(held["row"], rows) and np.array_equal(held["index"], positions) and np.array_equal(held["score"], scores)


def test_lists_are_equal_with_many_ties_and_odd_lengths():
    rng = np.random.default_rng(4)
    for scale in (1.0, 1e-30, 1e9, 1e20):
        items, vectors = np.round(rng.normal(size=(3_000, 4))) * scale, np.round(rng.normal(size=(600, 4))) * scale
        ids = rng.integers(0, 2_000, 3_000)
        for found, expected in zip(retrieve._best(vectors, items, ids, 20), retrieve._best_of_all(vectors, items, ids, 20), strict=True):
            assert np.array_equal(found, expected)


def _decaying(rng, n, d=16):
    """Vectors that mostly differ along a few directions, as those of a fitted model do."""
    m = rng.normal(size=(n, d)) * 0.5 ** np.arange(d)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_boxes_are_passed_over_and_lists_stay(monkeypatch):
    """Before, every query was compared with every item."""
    rng = np.random.default_rng(8)
    items, vectors = _decaying(rng, 20_000), _decaying(rng, 300)
    items[5_000:6_000] = items[:1_000]  # ties
    ids = rng.permutation(20_000)
    seen, matmul = [], np.matmul
    monkeypatch.setattr(np, "matmul", lambda a, b, **kw: (seen.append(a.shape[0] * b.shape[1]), matmul(a, b, **kw))[1])
    for k in (1, 10, 400):
        seen.clear()
        boxes = retrieve._boxed(items, ids, np.arange(20_000))
        rows, positions, scores, rank = retrieve._best_in_boxes(vectors, boxes, k)
        expected = retrieve._best_of_all(vectors, items, ids, k)
        assert np.array_equal(rows, expected[0]) and np.array_equal(scores, expected[2]) and np.array_equal(rank, expected[3])
        assert np.array_equal(boxes.ids[positions], ids[expected[1]])
        assert sum(seen) < 300 * 20_000 // (4 if k < 400 else 1)


def test_boxes_with_ties_odd_lengths_and_few_items():
    rng = np.random.default_rng(9)
    for scale in (1.0, 1e-30, 1e9, 1e20):
        for n in (1, 7, 3_000):
            items, vectors = np.round(rng.normal(size=(n, 4))) * scale, np.round(rng.normal(size=(600, 4))) * scale
            ids = rng.integers(0, 2_000, n)
            boxes = retrieve._boxed(items, ids, np.arange(n))
            rows, positions, scores, rank = retrieve._best_in_boxes(vectors, boxes, 20)
            expected = retrieve._best_of_all(vectors, items, ids, min(20, n))
            for found, right in zip((rows, boxes.ids[positions], scores, rank), (expected[0], ids[expected[1]], *expected[2:]), strict=True):
                assert np.array_equal(found, right)


def test_grid_follows_the_bytes_of_both_sides():
    """Before, the number of cells followed the shuffle partitions and every item block was copied once per row of the grid."""
    assert retrieve.grid_of(36, 1000, 600, 10) == (1, 36) and retrieve.grid_of(36, 1000, 10, 600) == (36, 1)
    assert retrieve.grid_of(36, 1000, 600, 600) == (6, 6) and retrieve.grid_of(36, 1000, 600, 600, 20) == (2, 20)


def test_two_boxes_that_all_queries_begin_with():
    """Every query meets both boxes first, in its own order."""
    rng = np.random.default_rng(10)
    items, vectors, ids = _decaying(rng, 300), _decaying(rng, 200), rng.permutation(300)
    boxes = retrieve._boxed(items, ids, np.arange(300))
    assert len(boxes.starts) == 3
    rows, positions, scores, _ = retrieve._best_in_boxes(vectors, boxes, 10)
    expected = retrieve._best_of_all(vectors, items, ids, 10)
    assert np.array_equal(rows, expected[0]) and np.array_equal(boxes.ids[positions], ids[expected[1]]) and np.array_equal(scores, expected[2])


def test_item_groups_are_as_few_as_copies_and_memory_allow():
    grid = retrieve.grid_of(36, 1000, 634, 691, 3)
    assert grid == (8, 5) and retrieve.large_item_groups(36, grid, 634, 691, 3) == (12, 3)
    assert retrieve.large_item_groups(24, (6, 4), 105, 115, 1) == (12, 2)
    assert retrieve.large_item_groups(36, retrieve.grid_of(36, 1000, 3800, 4100, 15), 3800, 4100, 15) == (3, 15)


def test_a_first_list_leaves_few_items_to_be_ranked(monkeypatch):
    """Four boxes instead of two: fewer items are scored in double precision, and the lists are those of a full search."""
    rng = np.random.default_rng(4)
    items = rng.normal(size=(20_000, 64)) * 0.8 ** np.arange(64)
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    vectors, ids, ranked, count = items[:500] + 0.01, np.arange(len(items)), retrieve._ranked, []
    monkeypatch.setattr(retrieve, "_ranked", lambda *a: count.append(sum(len(w[0]) for w in a[5])) or ranked(*a))
    found = retrieve._best_in_boxes(vectors, boxes := retrieve._boxed(items, ids, ids), 10)
    want = retrieve._best_of_all(vectors, items, ids, 10)
    assert (boxes.ids[found[1]] == ids[want[1]]).all() and np.abs(found[2] - want[2]).max() < 2e-6
    assert sum(count) < 18 * len(vectors)


def test_neither_side_is_copied_for_the_other(spark, monkeypatch):
    """Before, a query was shuffled once per group of items and an item once per group of queries."""
    rng = np.random.default_rng(11)
    vectors, asked = _decaying(rng, 3_000), _decaying(rng, 400)
    vectors[2_000:2_200] = vectors[7]
    items = spark.createDataFrame([(int(i * 7 % 4001), i, v.tolist()) for i, v in enumerate(vectors)], "article_id bigint, item_index bigint, embedding array<double>")
    queries = spark.createDataFrame([(f"u{i}", v.tolist()) for i, v in enumerate(asked)], "customer_id string, embedding array<double>").repartition(6)
    monkeypatch.setattr(retrieve, "_PART_ITEMS", 100)
    monkeypatch.setattr(retrieve, "_PASSING_ITEMS", 500)
    monkeypatch.setattr(retrieve, "_SAMPLE_BYTES", 200 * 16 * 8)
    monkeypatch.setattr(retrieve, "_QUERY_BLOCK", 30)
    stored, freeze = {}, retrieve.freeze
    monkeypatch.setattr(retrieve, "freeze", lambda df, name, **o: stored.setdefault(name, freeze(df, name, **o)))
    found = retrieve.top_k(queries, items, 10, broadcast_bytes=0)
    rows, positions, scores, rank = retrieve._best_of_all(asked, vectors, np.arange(3_000) * 7 % 4001, 10)
    want = {(f"u{r}", int(n)): (int(p), float(s)) for r, p, s, n in zip(rows, positions, scores, rank, strict=True)}
    assert {(r.customer_id, r["rank"]): (r.item_index, r.similarity) for r in found.collect()} == want
    assert set(stored) == {"queries", "item-packets"} and "RepartitionByExpression" not in found._jdf.queryExecution().optimizedPlan().toString()
    held = stored["item-packets"].agg(F.sum(F.length("_packet"))).first()[0]
    assert held < 2 * 3_000 * (16 * 8 + 16)


def test_parts_of_space_hold_neighbours():
    rng = np.random.default_rng(12)
    vectors = _decaying(rng, 4_000)
    parts = retrieve._parts_of(vectors[:1_000], 4)
    number = parts.of(vectors)
    assert set(number) == set(range(16)) and np.bincount(number).max() < 700
    assert sum(vectors[number == n].var(0).sum() * (number == n).sum() for n in range(16)) < 0.6 * vectors.var(0).sum() * 4_000
    assert set(retrieve._parts_of(vectors[:0], 4).of(np.zeros((3, 1)))) == {0}
    assert retrieve._parts_of(vectors, 0).of(vectors).max() == 0
    assert len(parts.of(np.full((2, 16), np.nan))) == 2
