"""Registered queries of the subpackage next to their SQL twins, and schemas of the others."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from check_queries import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from recspark.llm import oracles, queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    outcome = compare(spark, sf_dir, name, duck)
    assert outcome.startswith("equal"), outcome


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "MinHash near-dedup"
