"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Tokens are runs of letters and digits, and runs of other characters; one that repeats the
token before its separator is a repeat token. Features are single tokens, pairs of them and triples of
their shapes (lower, capitalised, capitals, digits, signs, repeat), hashed into 2^18 dimensions,
with 1 + ln(count) as value and unit length. A document is scored as the sparse dot
product of its features and the weights.

Training takes at most about ``sample_rows`` labelled documents, dealt to a fixed number of
shards by their hash. Each shard follows the regularised leader through its rows, in the order of
the hash, ``epochs`` times; the shards' weights are averaged. So a fit depends on the
data alone, not on the cluster.

Only the text is scored. A null or empty text has no features and gets the score of the
intercept. Without labelled rows every score is 0.5. Repeated rows get equal scores; other columns
pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from recspark.llm import text as T
from recspark.llm.labels import labelled_sample, labelled_texts

BITS = 18
SAMPLE_ROWS = 12_000
SHARDS = 8
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.2, 0.01

_SIGN = ~(T.WORD | T.SPACE)
_REPEAT = np.uint64(0xA5A5A5A5A5A5A5A5)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, dimension, value), sorted by row; each row's values have unit length."""
    rows = len(offsets) - 1
    word, sign = T.runs(T.WORD[data], offsets), T.runs(_SIGN[data], offsets)
    start, end = np.concatenate([word[0], sign[0]]), np.concatenate([word[1], sign[1]])
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    is_word = (order < len(word[0])).astype(np.int64)
    row = np.searchsorted(offsets, start, side="right") - 1
    token = T.span_hashes(T.FOLD[data], start, end)
    uppers = np.concatenate([[0], np.cumsum(T.UPPER[data])])
    digits = np.concatenate([[0], np.cumsum(T.DIGIT[data])])
    upper, digit, size = uppers[end] - uppers[start], digits[end] - digits[start], end - start
    shape = np.where(is_word == 0, 4, np.where(digit * 2 > size, 3, np.where((upper > 1) & (upper * 2 > size), 2, np.where(upper > 0, 1, 0))))
    # a word that equals the word before it, whatever signs stand between
    at = np.flatnonzero(is_word)
    same = np.flatnonzero((token[at][1:] == token[at][:-1]) & (row[at][1:] == row[at][:-1])) + 1
    token[at[same]] = _REPEAT
    shape[at[same]] = 5
    pair = T.within_row(row, 2)
    triple = T.within_row(row, 3)
    shapes = T.mix(shape.astype(np.uint64) + np.uint64(77))
    owner = np.concatenate([row, row[: len(pair)][pair], row[: len(triple)][triple]])
    hashed = np.concatenate([token, T.grams(token, 2)[pair], T.grams(shapes, 3)[triple]])
    place = (owner.astype(np.int64) << BITS) | (hashed >> np.uint64(64 - BITS)).astype(np.int64)
    place, count = np.unique(place, return_counts=True)
    owner = place >> BITS
    value = 1.0 + np.log(count)
    norm = np.sqrt(np.bincount(owner, weights=value * value, minlength=rows))
    return owner, place & ((1 << BITS) - 1), value / norm[owner]


_FEATURES = ST.StructType(
    [ST.StructField("at", ST.ArrayType(ST.IntegerType())), ST.StructField("value", ST.ArrayType(ST.FloatType()))]
)


def _sparse(column: pa.Array) -> pa.Array:
    owners, ats, values, n = [], [], [], 0
    for _, data, offsets in T.slices(column):
        owner, at, value = features(data, offsets)
        owners.append(owner + n)
        ats.append(at)
        values.append(value)
        n += len(offsets) - 1
    counts = np.bincount(np.concatenate(owners), minlength=n) if owners else np.zeros(0, np.int64)
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
    made = [T.lists(joined(ats), counts, pa.int32()), T.lists(joined(values), counts, pa.float32())]
    return pa.StructArray.from_arrays(made, names=["at", "value"])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes; the last one is the intercept."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        zs = z[at]
        shrunk = np.sign(zs) * L1 - zs
        return np.where(np.abs(zs) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, value, label in rows:
            at, value = np.append(at, size - 1), np.append(value, 1.0)
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - label) * value
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    return weights(np.arange(size))


def _train_shard(epochs: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("draw", "ascending"), ("label", "ascending")])
        at, value, label = (group.column(c).to_pylist() for c in ("at", "value", "label"))
        rows = [(np.array(a, np.int64), np.array(v, np.float64), int(y)) for a, v, y in zip(at, value, label, strict=True)]
        w = ftrl(rows, epochs)
        used = np.flatnonzero(w)
        return pa.table({"at": pa.array(used, pa.int32()), "w": pa.array(w[used])})

    return run


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", doc: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS, shards: int = SHARDS, epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights fitted on about ``sample_rows`` of the labelled documents at most."""
    sample = labelled_sample(labels, label, sample_rows, doc)
    made = labelled_texts(documents, sample, doc, text).withColumn("_f", F.arrow_udf(_sparse, _FEATURES)("text"))
    dealt = made.select((F.col("draw") % shards).alias("shard"), "draw", "label", "_f.at", "_f.value")
    fitted = dealt.groupBy("shard").applyInArrow(_train_shard(epochs), "at int, w double")
    summed = fitted.groupBy("at").agg((F.sum("w") / shards).alias("w")).toArrow()
    weights = np.zeros((1 << BITS) + 1)
    weights[summed["at"].to_numpy()] = summed["w"].to_numpy()
    return weights


def scorer(spark, weights: np.ndarray):
    """Column function from a text to its score."""
    sent = spark.sparkContext.broadcast(weights)

    def score(column: pa.Array) -> pa.Array:
        w = sent.value
        out = np.full(len(column), w[-1])
        for low, data, offsets in T.slices(column):
            owner, at, value = features(data, offsets)
            rows = len(offsets) - 1
            out[low : low + rows] += np.bincount(owner, weights=w[at] * value, minlength=rows)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return F.arrow_udf(score, ST.DoubleType())
