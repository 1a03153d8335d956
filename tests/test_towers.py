"""Training both towers: gradients, falling loss, seeds and partitions, recall on planted taste."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from recspark.operators import batches, encode, evaluate, retrieve, split, towers
from recspark.plans import fitted

GROUPS = 4


def _examples(spark, customers=60, articles=40, seed=1):
    """Customers buy the articles of their own group; everything else is a negative."""
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(customers):
        for i in rng.permutation(articles)[:24]:
            rows.append((u, int(i), float(u % GROUPS == i % GROUPS)))
    return spark.createDataFrame(rows, "user_index bigint, item_index bigint, label double")


def _sides(spark, customers=60, articles=40):
    users = spark.createDataFrame([(u, 5 + u % 3, 2.0) for u in range(customers)], "user_index bigint, customer_total_purchases bigint, customer_avg_price double")
    items = spark.createDataFrame([(i, 9, None if i == 3 else 1.5) for i in range(articles)], "item_index bigint, item_total_purchases bigint, item_avg_price double")
    return users, items


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    weights = towers.unflat(towers.flat(towers.first_weights(3)) + 0.05 * rng.normal(size=len(towers.flat(towers.first_weights(3)))))
    u, i = rng.normal(size=(6, 64)), rng.normal(size=(6, 64))
    cu, ci, y = rng.random((6, 2)), rng.random((6, 2)), rng.integers(0, 2, 6).astype(float)
    _, grads, du, di = towers.loss_and_gradients(weights, u, cu, i, ci, y)
    at, flat = towers.flat(weights), towers.flat(grads)
    loss = lambda v, u=u, i=i: towers.loss_and_gradients(towers.unflat(v), u, cu, i, ci, y)[0]
    for j in rng.choice(len(at), 40, replace=False):
        step = np.zeros(len(at))
        step[j] = 1e-6
        assert abs((loss(at + step) - loss(at - step)) / 2e-6 - flat[j]) < 1e-5
    for row, col in ((0, 5), (3, 63)):
        step = np.zeros_like(u)
        step[row, col] = 1e-6
        assert abs((loss(at, u + step) - loss(at, u - step)) / 2e-6 - du[row, col]) < 1e-5
        assert abs((loss(at, i=i + step) - loss(at, i=i - step)) / 2e-6 - di[row, col]) < 1e-5


@pytest.fixture(scope="module")
def made(spark):
    users, items = _sides(spark)
    return towers.fit_towers(_examples(spark), users, items, epochs=3, steps=3, rate=0.02, batch_rows=64)


def test_held_out_loss_falls(made):
    assert len(made.losses) == 4 and made.losses[-1] < made.losses[1] < made.losses[0]


def test_weights_can_be_loaded_and_encode(spark, made):
    layers = encode.load_tower(made.weights, "user")
    assert {n: layer.weight.shape for n, layer in layers.items()} == {"context": (2, 32), "hidden": (96, 128), "output": (128, 64)}
    rows = encode.encode(made.users, made.weights, "user", ("customer_total_purchases", "customer_avg_price"), True, "double").collect()
    assert len(rows) == 60 and all(abs(np.linalg.norm(r.embedding) - 1) < 1e-9 for r in rows)


def test_a_fit_depends_on_its_seed_and_not_on_partitions(spark):
    users, items = _sides(spark)
    fit = lambda e, u, seed: towers.fit_towers(e, u, items, epochs=1, steps=2, rate=0.02, seed=seed, batch_rows=128)
    rows = lambda m: sorted((r.user_index, tuple(r.embedding)) for r in m.users.collect())
    examples = _examples(spark)
    a, b = fit(examples.repartition(2), users.repartition(1), 42), fit(examples.repartition(9), users.repartition(5), 42)
    assert a.losses == b.losses and rows(a) == rows(b)
    assert fit(examples, users, 43).losses != a.losses


def test_rows_that_no_example_touches_stay(spark):
    users, items = _sides(spark)
    more = users.unionByName(spark.createDataFrame([(99, 1, 1.0)], users.schema))
    start = towers._start(more, "user_index", ("customer_total_purchases", "customer_avg_price"), 42)
    before = {r.user_index: r.embedding for r in start.collect()}
    after = {r.user_index: r.embedding for r in towers.fit_towers(_examples(spark), more, items, steps=1, rate=0.02, batch_rows=64).users.collect()}
    assert after[99] == before[99] and after[0] != before[0]
    assert max(abs(x) for x in before[99]) <= 0.05


def test_fitted_towers_beat_popularity(spark):
    """Customers buy within their group, so what all buy most is a poor guess for most of them."""
    rng = np.random.default_rng(5)
    first, rows = dt.date(2020, 1, 1), []
    for u in range(80):
        own = [i for i in range(120) if i % GROUPS == u % GROUPS]
        for n, i in enumerate(rng.permutation(own)[:22]):
            rows.append((u, int(i), first + dt.timedelta(days=int(n * 4 + rng.integers(0, 4))), 1.0, 1))
    tx = spark.createDataFrame(rows, "customer_id bigint, article_id bigint, t_dat date, price double, sales_channel_id int")
    made = fitted.fit_tower_model(tx, epochs=8, steps=2, rate=0.05)
    train, _, test = split.split_parts(tx, split.split_bounds(tx))
    found = fitted.tower_recall(tx, made, 30).first()
    baseline = evaluate.popularity_recall(train, evaluate.held_out_item(test), 30).first()
    assert found.user_count == baseline.user_count > 0
    assert found.recall > 1.5 * baseline.recall
    assert retrieve.top_k(made.model.users.select("customer_id", "embedding").limit(1), made.model.items, 5).count() == 5


def _spread(spark):
    """Examples and sides whose keys lie in many blocks."""
    far = lambda t, *c: t.select(*[(t[x] * 1000).alias(x) if x in c else t[x] for x in t.columns])
    users, items = _sides(spark)
    return far(_examples(spark), "user_index", "item_index"), far(users, "user_index"), far(items, "item_index")


def test_a_step_sends_a_vector_once_per_group_of_the_other_side(spark, monkeypatch):
    examples, users, items = _spread(spark)
    fit = lambda: towers.fit_towers(examples, users, items, epochs=1, steps=2, rate=0.02, batch_rows=64)
    rows = lambda m: sorted((r.user_index, tuple(r.embedding)) for r in m.users.collect())
    one, sent, met = fit(), [], towers._met
    monkeypatch.setattr(towers, "grid_of", lambda *_: (2, 3))
    monkeypatch.setattr(towers, "_met", lambda *a: sent.append(met(*a)) or sent[-1])
    many = fit()
    assert [t.filter("kind < 2").count() for t in sent] == [60 * 3 + 40 * 2] * 3
    assert one.losses == many.losses and rows(one) == rows(many)


def test_one_step_is_that_of_all_its_pairs_at_once(spark):
    examples, users, items = _spread(spark)
    made = towers.fit_towers(examples, users, items, epochs=1, steps=1, rate=0.02, batch_rows=64)
    starts = [
        {r[0]: r for r in towers._start(t, index, tuple(t.columns[1:]), 42).collect()}
        for t, index in ((users, "user_index"), (items, "item_index"))
    ]
    pairs = [r for r in batches.training_batches(examples, 64, True, 42).collect() if r.batch_id % towers.HELD_OUT != towers.HELD_OUT - 1]
    column = lambda side, key, name: np.array([starts[side][r[key]][name] for r in pairs])
    parts = [column(side, key, name) for side, key in ((0, "user_index"), (1, "item_index")) for name in ("embedding", "context")]
    loss, grads, d_users, _ = towers.loss_and_gradients(towers.first_weights(42), *parts, np.array([r.label for r in pairs]))
    assert abs(made.fitted_losses[0] - loss / len(pairs)) < 1e-7
    first = towers.flat(towers.first_weights(42))
    dense, *_ = towers._stepped(first, 0.0, 0.0, towers.flat(grads) / len(pairs), 0.02, 1)
    told = {(r.tower, r.layer, r.out_unit): r.w for r in made.weights.collect()}
    assert max(np.abs(np.array(w) - towers.unflat(dense)[t][n].weight[:, j]).max() for (t, n, j), w in told.items()) < 1e-3
    got = {r.user_index: r.embedding for r in made.users.collect()}
    for user in (0, 17_000, 59_000):
        gradient = d_users[[i for i, r in enumerate(pairs) if r.user_index == user]].sum(0) / len(pairs)
        want, *_ = towers._stepped(np.array(starts[0][user].embedding), 0.0, 0.0, gradient, 0.02, 1)
        assert np.abs(want - got[user]).max() < 1e-3


def test_the_disk_holds_two_states(spark, monkeypatch):
    """Before, the states of all steps stayed, with the shuffle files that led to them."""
    examples, users, items = _spread(spark)
    monkeypatch.setattr(towers, "_SMALL_STATE_BYTES", 0)
    held, stored = [], towers._stored

    def count(state, buckets):
        out = stored(state, buckets)
        held.append(sum("tower_state_" in t.name for t in spark.catalog.listTables()))
        return out

    before = sum("tower_state_" in t.name for t in spark.catalog.listTables())
    monkeypatch.setattr(towers, "_stored", count)
    made = towers.fit_towers(examples, users, items, epochs=2, steps=3, rate=0.02, batch_rows=64)
    assert len(held) == 7 and max(held) == before + 2
    assert sum("tower_state_" in t.name for t in spark.catalog.listTables()) == before
    assert made.users.count() == 60 and made.losses[-1] < made.losses[0]
