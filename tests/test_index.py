"""The inverted-file index: exact when every list is probed, recall and cost when few are."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import ivf, retrieve


def _items(spark, n, size=16, groups=20, spread=0.15, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, size))
    x = middles[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "article_id bigint, item_index bigint, embedding array<double>")


def _queries(items):
    return items.select(F.col("article_id").alias("query_id"), "embedding")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    items = _items(spark, 3000).repartition(4).cache()
    return items, ivf.build(items, str(tmp_path_factory.mktemp("ivf") / "index"), lists=40, rounds=6)


def _rows(df):
    return sorted((r.query_id, r.rank, r.article_id, r.item_index, r.similarity) for r in df.collect())


def test_probing_every_list_is_the_exact_search(built):
    items, index = built
    queries = _queries(items).filter("query_id % 30 = 0")
    found = ivf.search(queries, index, len(index.centroids), key="query_id")
    assert _rows(found.lists) == _rows(retrieve.top_k(queries, items, key="query_id"))
    assert found.scored == 100 * 3000


def test_few_lists_give_most_of_the_result_at_a_fraction_of_the_cost(built):
    items, index = built
    queries = _queries(items)
    probes = ivf.probes_for(queries, items, index, 0.95, key="query_id")
    found = ivf.search(queries, index, probes, key="query_id")
    exact = retrieve.top_k(queries, items, key="query_id")
    assert ivf.recall_of(found.lists, exact, "query_id") >= 0.9
    assert probes < 20 and found.scored < 3000 * 3000 / 4


def test_only_the_lists_asked_for_are_opened(spark, built):
    items, index = built
    one = _queries(items).filter("query_id = 7")
    found = ivf.search(one, index, 2, key="query_id")
    assert 1 <= found.lists_read <= 2
    folders = {f.split("list=")[1].split("/")[0] for f in found.lists.inputFiles() if "list=" in f}
    assert len(folders) <= 2
    assert found.lists.filter("rank = 1").first().article_id == 7


def test_centroids_do_not_depend_on_partitions(spark):
    items = _items(spark, 800)
    a = ivf.fit_centroids(items.repartition(1), 800, 16, 12, 4)
    b = ivf.fit_centroids(items.repartition(7), 800, 16, 12, 4)
    assert (a == b).all() and not (a == ivf.fit_centroids(items, 800, 16, 12, 4, seed=1)).all()


def test_copies_ties_and_null_keys(spark, tmp_path, monkeypatch):
    """A third of all vectors are copies: their list is cut into blocks, and ties go by article."""
    monkeypatch.setattr(ivf, "_ITEM_BLOCK", 16)
    monkeypatch.setattr(ivf, "_QUERY_BLOCK", 4)
    monkeypatch.setattr(ivf, "_MEETINGS", 2)
    one = [1.0, 0.0, 0.0]
    rows = [(i, i, one if i % 3 == 0 else [0.6, 0.8 * (-1) ** i, 0.0]) for i in range(300)]
    items = spark.createDataFrame(rows, "article_id bigint, item_index bigint, embedding array<double>")
    index = ivf.build(items, str(tmp_path / "index"), lists=3)
    queries = spark.createDataFrame([(None, one)] * 20 + [(5, one)] * 3 + [(6, [0.6, 0.8, 0.0])], "query_id bigint, embedding array<double>")
    found = ivf.search(queries, index, 3, k=4, key="query_id").lists.collect()
    assert len(found) == 24 * 4
    assert {(r.rank, r.article_id) for r in found if r.query_id == 5} == {(1, 0), (2, 3), (3, 6), (4, 9)}
    assert max(r.blocks for r in index.counts.collect()) > 5


def test_index_of_nothing_and_bad_arguments(spark, tmp_path, built):
    items, index = built
    with pytest.raises(ValueError):
        ivf.build(items.limit(0), str(tmp_path / "none"))
    with pytest.raises(ValueError):
        ivf.search(_queries(items), index, 0, key="query_id")
    assert ivf.search(_queries(items).limit(0), index, 2, key="query_id").lists.collect() == []


def test_a_query_is_stored_once_however_many_lists_it_asks_for(built, monkeypatch):
    """Before, a query's vector was written and shuffled once for each list that it asks for."""
    items, index = built
    stored, freeze = {}, ivf.freeze
    monkeypatch.setattr(ivf, "freeze", lambda df, name: stored.setdefault(name, freeze(df, name)))
    ivf.search(_queries(items).filter("query_id % 30 = 0"), index, len(index.centroids), key="query_id")
    assert stored["probes"].count() == 100
