from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.functions import vectors
from recspark.functions.losses import bce_from_logits


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist(), rng.standard_normal(8).tolist()) for i in range(50)]
    return spark.createDataFrame(rows, "id bigint, a array<double>, b array<double>")


def test_dot_and_norm(pairs):
    for r in pairs.select("*", vectors.dot(F.col("a"), F.col("b")).alias("d"), vectors.l2_norm(F.col("a")).alias("n")).collect():
        assert r.d == pytest.approx(np.dot(r.a, r.b)) and r.n == pytest.approx(np.linalg.norm(r.a))


def test_float_vectors_multiply_in_double(spark):
    a, b = np.float32(0.1), np.float32(0.3)
    df = spark.createDataFrame([([float(a)], [float(b)])], "a array<float>, b array<float>")
    assert df.select(vectors.dot(F.col("a"), F.col("b"))).first()[0] == float(a) * float(b)


def test_normalize_keeps_zero_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    got = [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0]]


def test_finite_unit_and_close(spark):
    rows = [([1.0, 0.0],), ([float("nan"), 1.0],), ([float("inf"), 0.0],), ([None, 1.0],), ([0.5, 0.5],)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert [r[0] for r in df.select(vectors.is_finite(F.col("v"))).collect()] == [True, False, False, False, True]
    assert df.select(vectors.is_unit(F.col("v"), 1e-5)).first()[0] is True
    near = spark.createDataFrame([([1.0], [1.0 + 5e-6]), ([1.0], [1.1]), ([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert [r[0] for r in near.select(vectors.all_close(F.col("a"), F.col("b"), 1e-6)).collect()] == [True, False, False]


def test_loss_is_stable_for_large_scores(spark):
    rows = [(0.0, 1.0), (2.0, 0.0), (800.0, 1.0), (-800.0, 1.0), (800.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = [r[0] for r in df.select(bce_from_logits(F.col("x"), F.col("y"))).collect()]
    assert got == pytest.approx([math.log(2), 2 + math.log1p(math.exp(-2)), 0.0, 800.0, 800.0])
