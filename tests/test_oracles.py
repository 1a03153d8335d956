"""Every registered query against its SQL twin, names, types and values."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from recspark.plans import oracles  # noqa: E402
from recspark.plans import queries as registered  # noqa: E402



@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    outcome = compare(spark, sf_dir, name, duck)
    assert outcome.startswith("equal"), outcome


def test_every_query_has_a_twin():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_full_lists(spark):
    assert set(entry.entry(spark).columns) == {"customer_id", "rank", "article_id", "item_index", "similarity"}
