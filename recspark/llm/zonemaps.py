"""Vectors grouped around centroids, with a zone map that leaves most centroids out.

Vectors are laid along a Hilbert curve over their main directions of spread and cut into blocks. A block
stores its vectors, the least and greatest value of every component (its box), and the sum of its
vectors. In each round a block first bounds, over its whole box, how much nearer the centroid at the box's
middle is than each other one. Only centroids for which that can be nothing or less are candidates and
are compared exactly, vector by vector; a block with one candidate adds its stored sum and is not
looked into. The curve, its directions and the blocks decide how much work is saved and never a result: all
results are integers.

Blocks are written once to the shared folder. Each round is one pass over them in which a task sends one row of sums for each
centroid. The driver holds centroids and sums, and one number for each pair of components while it looks for the
directions of spread.

Rows whose vector is null, has another number of components than ``size`` or holds a null or non-finite one are dropped.
Repeated rows count each; equal distances go to the smaller centroid number. A null id is assigned, but starts no
centroid. With fewer vectors than ``centroids`` there are fewer centroids; an empty table gives no rows. Other columns
are ignored. A component of 2^20 or more in size ends the job, as its square would not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.llm.codes import products, usable, whole
from recspark.llm.tables import stored
from recspark.operators.arrow import to_matrix

SIZE = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SALT = 2

BLOCK = 64
_DIRECTIONS, _BITS = 8, 7
#: Vectors of a partition of blocks.
_PARTITION = 1 << 18
#: Boxes bounded at once.
_AT_ONCE = 512
#: Under this size the bounds over a box are whole numbers in double precision.
_EXACT = 1 << 21


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Position along a Hilbert curve of points with whole coordinates under 2^bits, at most 63 bits together.

    The coordinates are turned into those of the curve bit plane by bit plane (Skilling's transform) and then
    read off plane by plane.
    """
    axes = [places[:, i].astype(np.int64) for i in range(places.shape[1])]
    for level in reversed(range(1, bits)):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(len(axes)):
            turned = (axes[i] & bit) != 0
            swap = np.where(turned, 0, (axes[0] ^ axes[i]) & below)
            axes[0] = axes[0] ^ np.where(turned, below, swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(places), np.int64)
    for level in reversed(range(1, bits)):
        turn = np.where(axes[-1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    key = np.zeros(len(places), np.int64)
    for level in reversed(range(bits)):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


class _Spread(NamedTuple):
    n: int
    mean: np.ndarray
    directions: np.ndarray  # (size, few)
    deviation: np.ndarray


def _spread(rows: DataFrame, size: int, scale: int) -> _Spread:
    """Main directions of the vectors from sums of products: ``size`` rows a task, added up by Spark."""
    names = [f"p{i}" for i in range(size)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("n", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("s", *names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, outer = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            x = whole(to_matrix(batch.column("v"), size), scale).astype(np.float64)
            n, total, outer = n + len(x), total + x.sum(0), outer + x.T @ x
        if n:
            columns = [np.arange(size, dtype=np.int32), np.full(size, n), total, *outer.T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    sums = rows.select("v").mapInArrow(run, schema).groupBy("i").agg(*(F.sum(c).alias(c) for c in ("n", "s", *names)))
    found = sorted(sums.collect(), key=lambda r: r["i"])
    if not found:
        return _Spread(0, np.zeros(size), np.zeros((size, 0)), np.zeros(0))
    n = found[0]["n"]
    mean = np.array([r["s"] for r in found]) / n
    spread = np.array([[r[c] for c in names] for r in found]) / n - np.outer(mean, mean)
    values, vectors = np.linalg.eigh((spread + spread.T) / 2)
    few = np.argsort(values)[::-1][: min(_DIRECTIONS, size)]
    return _Spread(n, mean, vectors[:, few], np.sqrt(np.maximum(values[few], 0)))


def _block_schema(key: T.StructField) -> T.StructType:
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    return T.StructType(
        [
            T.StructField("ids", T.ArrayType(key.dataType)),
            T.StructField("x", ints),
            T.StructField("least", ints),
            T.StructField("greatest", ints),
            T.StructField("total", longs),
        ]
    )


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1)).cast(kind))


def _blocks(rows: DataFrame, size: int, scale: int, spread: _Spread) -> DataFrame:
    """Blocks of vectors that lie together on the curve.

    Partitions are ranges of (place on the curve, hash of the id), so that any number of equal vectors is
    spread over many of them.
    """
    width = len(spread.deviation)
    top = (1 << _BITS) - 1
    placed_schema = T.StructType([rows.schema["id"], rows.schema["v"], T.StructField("place", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(to_matrix(batch.column("v"), size), scale) - spread.mean
            # four deviations to either side fill the curve's grid
            at = (x @ spread.directions) / np.maximum(spread.deviation, 1e-9) * (top / 8) + top / 2
            key = hilbert(np.clip(np.rint(at), 0, top).astype(np.int64), _BITS) if width else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(key)], names=["id", "v", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(to_matrix(batch.column("v"), size), scale)
            starts = np.arange(0, len(x), BLOCK)
            if not len(starts):
                continue
            ends = np.append(starts[1:], len(x))
            ids = pa.ListArray.from_arrays(pa.array(np.append(starts, len(x)).astype(np.int32)), batch.column("id"))
            offsets = pa.array((np.append(starts, len(x)) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)).cast(pa.int32())),
                    _lists(np.stack([x[a:b].min(0) for a, b in zip(starts, ends, strict=True)]), pa.int32()),
                    _lists(np.stack([x[a:b].max(0) for a, b in zip(starts, ends, strict=True)]), pa.int32()),
                    _lists(np.add.reduceat(x, starts, axis=0), pa.int64()),
                ],
                names=["ids", "x", "least", "greatest", "total"],
            )

    partitions = max(rows.sparkSession.sparkContext.defaultParallelism, -(-spread.n // _PARTITION))
    salt = F.xxhash64("id")
    ordered = (
        rows.select("id", "v")
        .mapInArrow(place, placed_schema)
        .repartitionByRange(partitions, "place", salt)
        .sortWithinPartitions("place")
    )
    return stored(ordered.select("id", "v").mapInArrow(cut, _block_schema(rows.schema["id"])), "blocks")[1]


def candidates(least: np.ndarray, greatest: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(block, centroid): whether the centroid can be the nearest one to any point of the block's box.

    Let m be the centroid nearest to the middle of the box. By how much a centroid c is further than m, in
    squared distances, is linear in the point, so its least value over the box is found component by component. If
    that is over nothing, c is nearest nowhere in the box.
    """
    if not len(centroids) or max(np.abs(a).max(initial=0) for a in (least, greatest, centroids)) >= _EXACT:
        return np.ones((len(least), len(centroids)), bool)
    c = centroids.astype(np.float64)
    own = (c * c).sum(1)
    out = np.empty((len(least), len(c)), bool)
    for at in range(0, len(least), _AT_ONCE):
        low, high = least[at : at + _AT_ONCE].astype(np.float64), greatest[at : at + _AT_ONCE].astype(np.float64)
        both, width = low + high, high - low  # twice the middle and twice the half width
        middle = (own[None, :] - both @ c.T).argmin(1)
        step = c[None, :, :] - c[middle][:, None, :]
        further = own[None, :] - own[middle][:, None] - np.einsum("bkd,bd->bk", step, both) - np.einsum("bkd,bd->bk", np.abs(step), width)
        out[at : at + _AT_ONCE] = further <= 0
    return out


def _nearest(x: np.ndarray, block: np.ndarray, able: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest candidate of each vector's block, and its squared distance."""
    best = np.full(len(x), np.iinfo(np.int64).max)
    name = np.zeros(len(x), np.int64)
    norm = (x * x).sum(1)
    for k in np.flatnonzero(able.any(0)):  # ascending, so that ties stay with the smaller number
        rows = np.flatnonzero(able[block, k])
        d = norm[rows] - 2 * products(x[rows], centroids[k : k + 1])[:, 0] + (centroids[k] ** 2).sum()
        nearer = d < best[rows]
        best[rows[nearer]], name[rows[nearer]] = d[nearer], k
    return name, best


def _read(batch: pa.RecordBatch, size: int):
    """Vectors, their blocks, boxes, sums and ids of a batch of blocks."""
    column = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)
    lengths = batch.column("ids").value_lengths().to_numpy()
    return column("x"), np.repeat(np.arange(batch.num_rows), lengths), column("least"), column("greatest"), column("total"), lengths


def _moved(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Centroids at the floor of the mean of their vectors, and the number of blocks with one candidate."""
    k, size = centroids.shape
    names = [f"s{i}" for i in range(size)]
    schema = T.StructType([T.StructField("k", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("n", "whole_blocks", *names))])
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        n, whole_blocks, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, block, least, greatest, sums, lengths = _read(batch, size)
            able = candidates(least, greatest, centroids)
            single = able.sum(1) == 1
            only = able[single].argmax(1)
            np.add.at(n, only, lengths[single])
            np.add.at(whole_blocks, only, 1)
            np.add.at(total, only, sums[single])
            rows = np.flatnonzero(~single[block])
            name, _ = _nearest(x[rows], block[rows], able, centroids)
            order = np.argsort(name, kind="stable")
            met, first, count = np.unique(name[order], return_index=True, return_counts=True)
            if len(met):
                total[met] += np.add.reduceat(x[rows][order], first, axis=0)
                n[met] += count
        met = np.flatnonzero(n)
        columns = [met.astype(np.int32), n[met], whole_blocks[met], *total[met].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    sums = blocks.mapInArrow(run, schema).groupBy("k").agg(*(F.sum(c).alias(c) for c in ("n", "whole_blocks", *names)))
    moved, skipped = centroids.copy(), 0
    for row in sums.collect():  # a row for each centroid
        moved[row["k"]] = [row[c] // row["n"] for c in names]
        skipped += row["whole_blocks"]
    return moved, skipped


def _assigned(blocks: DataFrame, centroids: np.ndarray, key: T.DataType) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    schema = T.StructType([T.StructField("id", key), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    shared, size = blocks.sparkSession.sparkContext.broadcast(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for batch in batches:
            if batch.num_rows:
                x, block, least, greatest, _, _ = _read(batch, size)
                name, d = _nearest(x, block, candidates(least, greatest, centroids), centroids)
                yield pa.RecordBatch.from_arrays([batch.column("ids").flatten(), pa.array(name.astype(np.int32)), pa.array(d)], names=schema.names)

    return blocks.mapInArrow(run, schema)


class Clusters(NamedTuple):
    table: DataFrame  # id, cluster, distance
    centroids: np.ndarray
    skipped: list[int]  # blocks with one candidate in each round


def first_centroids(rows: DataFrame, centroids: int, salt: int) -> DataFrame:
    """Vectors with the least hashes of ``salt:id``."""
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    return rows.filter(F.col("id").isNotNull()).withColumn("drawn", drawn).orderBy("drawn", "v").limit(centroids)


def fit_clusters(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    size: int = SIZE,
    salt: int = SALT,
) -> Clusters:
    """Rounds of assigning every vector and moving every centroid, then a last assignment."""
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).alias("v")).filter(usable(F.col("v")) & (F.size("v") == size))
    key = rows.schema["id"].dataType
    start = first_centroids(rows, centroids, salt).select("v").collect()
    middle = whole(np.array([r["v"] for r in start], np.float64).reshape(len(start), size), scale)
    if not start:
        schema = T.StructType([T.StructField("id", key), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        return Clusters(df.sparkSession.createDataFrame([], schema), middle, [])
    blocks = _blocks(rows, size, scale, _spread(rows, size, scale))
    skipped = []
    for _ in range(rounds):
        middle, few = _moved(blocks, middle)
        skipped.append(few)
    return Clusters(stored(_assigned(blocks, middle, key), "clusters")[1], middle, skipped)


def _by_cluster(values: list, kind: str) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("cluster") + 1).cast(kind)


def cluster(df: DataFrame, **options) -> DataFrame:
    """id, cluster, distance, the cluster's and the table's total distance and the digest of the centroid; see ``fit_clusters``."""
    made = fit_clusters(df, **options)
    key = F.col("id").alias(options.get("vec_id", "vec_id"))
    if not len(made.centroids):
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"))]
        return made.table.select(key, "cluster", "distance", *nothing)
    sums = {r["cluster"]: r["d"] for r in made.table.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in made.centroids]
    return made.table.select(
        key,
        "cluster",
        "distance",
        _by_cluster([sums.get(k, 0) for k in range(len(names))], "bigint").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        _by_cluster(names, "string").alias("centroid_sha256"),
    )
