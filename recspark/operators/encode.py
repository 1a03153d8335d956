"""Customers and articles encoded into unit vectors by the two towers.

Looking up an embedding is a join on the dense index. The dense layers run on
Arrow batches with the layer weights broadcast; their size depends on the
architecture alone and not on the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.operators import meet
from recspark.operators.arrow import to_list_column, to_matrix

# Layer sizes of both towers.
EMBEDDING_DIM = 64
CONTEXT_DIM = 2
CONTEXT_UNITS = 32
HIDDEN_UNITS = 128

# layer names in the weights table
CONTEXT, HIDDEN, HIDDEN_NO_CONTEXT, OUTPUT = "context", "hidden", "hidden_no_context", "output"

_MAX_WEIGHT_ROWS = 100_000


class Layer(NamedTuple):
    weight: np.ndarray  # inputs x units
    bias: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weight + self.bias


def load_tower(weights: DataFrame, tower: str) -> dict[str, Layer]:
    """Layers of one tower from the weights table, one row per output unit."""
    rows = weights.filter(F.col("tower") == tower).limit(_MAX_WEIGHT_ROWS + 1).collect()
    if len(rows) > _MAX_WEIGHT_ROWS:
        raise ValueError("too many weight rows for a model that is broadcast")
    layers: dict[str, Layer] = {}
    for name in {r["layer"] for r in rows}:
        units = sorted((r for r in rows if r["layer"] == name), key=lambda r: r["out_unit"])
        layers[name] = Layer(np.array([u["w"] for u in units]).T, np.array([u["b"] for u in units]))
    return layers


def forward(layers: dict[str, Layer], vectors: np.ndarray, context: np.ndarray | None) -> np.ndarray:
    """Tower output for a batch; rows have length 1, zero rows stay zero."""
    if context is None:
        hidden = layers[HIDDEN_NO_CONTEXT](vectors)
    else:
        side = np.maximum(layers[CONTEXT](context), 0.0)
        hidden = layers[HIDDEN](np.concatenate([vectors, side], axis=1))
    out = layers[OUTPUT](np.maximum(hidden, 0.0))
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def look_up_embeddings(rows: DataFrame, index: str, embeddings: DataFrame) -> DataFrame:
    """Attach the embedding of each row's dense index; ``embeddings`` has ``(index, embedding)``."""
    return rows.join(embeddings.withColumnRenamed("index", index), index)


def encode(
    rows: DataFrame,
    weights: DataFrame,
    tower: str,
    context: tuple[str, str] | None = None,
    normalize: bool = True,
    value_type: str = "float",
    partitions: int | None = None,
) -> DataFrame:
    """Replace ``embedding`` by the tower output; context columns are used up.

    Other columns are kept. Without ``context`` the tower takes the embedding
    alone. ``normalize`` applies ``log1p`` to the context first. ``partitions``
    spreads a table that is small in bytes, but not in work, over that many
    tasks; it hashes the kept columns, which identify a row.
    """
    spark = rows.sparkSession
    # plain tuples: a broadcast is unpickled where this package is not installed
    shared = spark.sparkContext.broadcast({name: tuple(layer) for name, layer in load_tower(weights, tower).items()})
    keep = [c for c in rows.columns if c != "embedding" and c not in (context or ())]
    inputs = rows.select(
        *keep,
        "embedding",
        *[
            (F.log1p(F.col(c).cast("double")) if normalize else F.col(c).cast("double")).alias(f"_context_{i}")
            for i, c in enumerate(context or ())
        ],
    )
    if partitions:
        inputs = inputs.repartition(partitions, *keep)
    element = T.FloatType() if value_type == "float" else T.DoubleType()
    schema = T.StructType([inputs.schema[c] for c in keep] + [T.StructField("embedding", T.ArrayType(element))])
    arrow_type = pa.float32() if value_type == "float" else pa.float64()
    with_context = context is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers = {name: Layer(*parts) for name, parts in shared.value.items()}
        for batch in batches:
            vectors = to_matrix(batch.column("embedding"), EMBEDDING_DIM)
            side = None
            if with_context:
                side = np.column_stack(
                    [batch.column(f"_context_{i}").to_numpy(zero_copy_only=False) for i in range(CONTEXT_DIM)]
                )
            out = forward(layers, vectors, side)
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, to_list_column(out, arrow_type)], names=[*keep, "embedding"]
            )

    return inputs.mapInArrow(run, schema)


def look_up_users(requests: DataFrame, user_context: DataFrame) -> DataFrame:
    """Index and context of each requested customer; ``found`` is false for unknown ones."""
    return requests.join(user_context, "customer_id", "left").withColumn("found", F.col("user_index").isNotNull())


def encode_customers(
    requests: DataFrame,
    user_context: DataFrame,
    embeddings: DataFrame,
    weights: DataFrame,
    value_type: str = "float",
    partitions: int | None = None,
) -> DataFrame:
    """Unit vector of every requested customer that is known."""
    known = look_up_users(requests, user_context).filter("found").drop("found")
    context = ("customer_total_purchases", "customer_avg_price")
    rows = look_up_embeddings(known, "user_index", embeddings)
    return encode(rows, weights, "user", context, True, value_type, partitions)


def encode_items(
    item_context: DataFrame,
    embeddings: DataFrame,
    weights: DataFrame,
    use_context: bool = True,
    value_type: str = "float",
    partitions: int | None = None,
) -> DataFrame:
    """Unit vector of every article."""
    context = ("item_total_purchases", "item_avg_price")
    rows = look_up_embeddings(item_context, "item_index", embeddings)
    if not use_context:
        return encode(rows.drop(*context), weights, "item", None, True, value_type, partitions)
    return encode(rows, weights, "item", context, True, value_type, partitions)


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Score of each (user_index, item_index) pair: the inner product of its two vectors.

    ``users`` and ``items`` are read twice and should be stored tables.
    """
    return meet.score_pairs(pairs, users, items, "user_index", "item_index")
