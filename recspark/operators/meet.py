"""Inner products of given pairs of vectors, without a copy of a vector for every pair.

A join would write both vectors of a pair next to it and shuffle them. Here both sides are cut into groups by a hash
of their key, and a pair belongs to the cell of its two groups. A vector is copied once per group of the other side. A cell is one
task's work: it keeps its left vectors, and its right ones pass by block after block, each followed by its pairs.

Where the copies are many, some left groups are done at a time, and the copies of a pass are removed before the next one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.session import freeze

#: Bytes of left vectors that a cell keeps, of right vectors that it keeps at a time, and of both tables for each cell.
_LEFT_BYTES = 128 * 1024 * 1024
_BLOCK_BYTES = 16 * 1024 * 1024
_CELL_BYTES = 64 * 1024 * 1024
#: Bytes of copied vectors that are on disk at a time.
_PASS_BYTES = 8 * 1024 * 1024 * 1024
_PAIRS_AT_ONCE = 16_384
_LEFT, _RIGHT, _PAIR = range(3)


def _bytes_of(vectors: DataFrame) -> int:
    count, size = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    return count * 8 * (max(size or 0, 0) + 4)


def cells_of(tasks: int, left_bytes: int, right_bytes: int) -> tuple[int, int]:
    """(left groups, right groups): as few copied bytes as a number of cells allows."""
    cells = max(tasks, -(-(left_bytes + right_bytes) // _CELL_BYTES), 1)
    left = round(math.sqrt(cells * max(left_bytes, 1) / max(right_bytes, 1)))
    left = max(1, min(left, cells), -(-left_bytes // _LEFT_BYTES))
    return left, -(-cells // left)


class _Table:
    """Vectors met so far, by key. A vector that is null or holds a null has no inner product."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.made = None

    def add(self, keys: pa.Array, null: pa.Array, vectors: pa.Array) -> None:
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        width, flat = int(lengths.max(initial=0)), vectors.flatten().to_numpy(zero_copy_only=False)
        if (lengths == width).all():
            matrix = flat.reshape(len(lengths), width)
        else:
            matrix = np.zeros((len(lengths), width), flat.dtype)
            matrix[np.arange(width) < lengths[:, None]] = flat
        sizes = np.where(null.to_numpy(zero_copy_only=False), -1, lengths)
        self.parts.append((keys.to_numpy(zero_copy_only=False), sizes, matrix))
        self.made = None

    def _joined(self):
        if self.made is None:
            width = max((m.shape[1] for *_, m in self.parts), default=0)
            wide = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for *_, m in self.parts]
            keys = np.concatenate([k for k, *_ in self.parts]) if self.parts else np.zeros(0, np.int64)
            sizes = np.concatenate([s for _, s, _ in self.parts]) if self.parts else np.zeros(0, np.int64)
            matrix = np.concatenate(wide) if wide else np.zeros((0, 0))
            order = np.argsort(keys, kind="stable")
            self.parts, self.made = [(keys, sizes, matrix)], (keys[order], order, sizes, matrix)
        return self.made

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first vector of each key, in key order, and how many there are."""
        keys = self._joined()[0]
        first = np.searchsorted(keys, wanted, "left")
        return first, np.searchsorted(keys, wanted, "right") - first

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, order, sizes, matrix = self._joined()
        rows = order[places]
        return sizes[rows], matrix[rows].astype(np.float64, copy=False)


def _dots(left: _Table, right: _Table, lefts: np.ndarray, rights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, inner product, whether it is null) of every meeting of a pair's two keys; terms are added from first to last."""
    (at_left, n_left), (at_right, n_right) = left.find(lefts), right.find(rights)
    meetings = n_left * n_right
    row = np.repeat(np.arange(len(lefts)), meetings)
    number = np.arange(len(row)) - np.repeat(np.cumsum(meetings) - meetings, meetings)
    dots, null = np.zeros(len(row)), np.zeros(len(row), bool)
    for at in range(0, len(row), _PAIRS_AT_ONCE):
        part = slice(at, at + _PAIRS_AT_ONCE)
        of = row[part]
        size_a, a = left.take(at_left[of] + number[part] // n_right[of])
        size_b, b = right.take(at_right[of] + number[part] % n_right[of])
        null[part] = (size_a != size_b) | (size_a < 0)
        width = min(a.shape[1], b.shape[1])
        terms = np.ascontiguousarray((a[:, :width] * b[:, :width]).T)
        total = np.zeros(len(of))
        for term in terms:
            total += term
        dots[part] = total
    return row, dots, null


def _group(key: Column, groups: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(groups)).cast("int")


def score_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str = "score") -> DataFrame:
    """``pairs`` with the inner product of the vectors of their two keys, as an inner join with both tables gives it.

    ``left`` has ``(left_key, embedding)``, ``right`` has ``(right_key, embedding)``, both read twice, so they should be
    stored. Keys are whole numbers; rows that share one all meet.
    """
    spark: SparkSession = pairs.sparkSession
    left, right = (t.select(k, "embedding").filter(F.col(k).isNotNull()) for t, k in ((left, left_key), (right, right_key)))
    left_bytes, right_bytes = _bytes_of(left), _bytes_of(right)
    left_groups, right_groups = cells_of(3 * spark.sparkContext.defaultParallelism, left_bytes, right_bytes)
    blocks = max(1, -(-right_bytes // (right_groups * _BLOCK_BYTES)))
    passes = max(1, min(left_groups, -(-(left_bytes * right_groups + right_bytes * left_groups) // _PASS_BYTES)))
    if passes > 1:
        pairs = freeze(pairs, "pairs")  # read once in each pass

    kept = [left_key, right_key, *(c for c in pairs.columns if c not in (left_key, right_key))]
    pair = F.struct(*kept)
    pair_type = pairs.select(pair.alias("pair")).schema["pair"].dataType
    no_pair = F.lit(None).cast(pair_type).alias("_pair")

    # an empty list stands for none: a run of null lists is counted again for every row that is handed to Python
    types = {_LEFT: left.schema["embedding"].dataType, _RIGHT: right.schema["embedding"].dataType}
    none = {kind: F.array().cast(t) for kind, t in types.items()}

    def sides(key: str, kind: int) -> tuple[Column, ...]:
        vectors = none | {kind: F.coalesce("embedding", none[kind])}
        return (
            F.lit(kind).alias("_kind"),
            F.col(key).cast("bigint").alias("_key"),
            (F.col("embedding").isNull() | F.exists("embedding", lambda x: x.isNull())).alias("_null"),
            vectors[_LEFT].alias("_left"),
            vectors[_RIGHT].alias("_right"),
            no_pair,
        )

    every = lambda first, end: F.explode(F.sequence(F.lit(first), F.lit(end - 1)))
    lkey, rkey = F.col(left_key).cast("bigint"), F.col(right_key).cast("bigint")
    left_group, right_group = _group(lkey, left_groups, 1), _group(rkey, right_groups, 2)
    block = _group(rkey, blocks, 3)
    empty = [F.lit(0).cast("bigint").alias("_key"), F.lit(False).alias("_null"), none[_LEFT].alias("_left"), none[_RIGHT].alias("_right")]

    def cells(first: int, end: int) -> DataFrame:
        """The left groups from ``first`` to ``end``: vectors and pairs, each in the partitions of its cells."""

        def cell(group: Column, right_group: Column) -> Column:
            return ((group - first) * right_groups + right_group).cast("int").alias("_cell")

        now = (left_group >= first) & (left_group < end)
        lefts = left.filter(now).withColumn("_other", every(0, right_groups)).select(
            cell(left_group, F.col("_other")), F.lit(-1).alias("_block"), *sides(left_key, _LEFT)
        )
        rights = right.withColumn("_other", every(first, end)).select(
            cell(F.col("_other"), right_group), block.alias("_block"), *sides(right_key, _RIGHT)
        )
        asked = pairs.filter(F.col(left_key).isNotNull() & F.col(right_key).isNotNull() & now).select(
            cell(left_group, right_group), block.alias("_block"), F.lit(_PAIR).alias("_kind"), *empty, pair.alias("_pair")
        )
        return (
            lefts.unionByName(rights).unionByName(asked)
            .repartitionById((end - first) * right_groups, F.col("_cell"))
            .sortWithinPartitions("_cell", "_block", "_kind")
        )

    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in pair_type.fields), T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = {_LEFT: _Table(), _RIGHT: _Table()}, (None, None)
        for batch in batches:
            cells, parts, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_cell", "_block", "_kind"))
            changed = (np.diff(cells) != 0) | (np.diff(parts) != 0) | (np.diff(kinds) != 0)
            starts = [0, *(np.flatnonzero(changed) + 1), batch.num_rows]
            for first, end in zip(starts, starts[1:], strict=False):
                if first == end:
                    continue
                if cells[first] != at[0]:
                    held = {_LEFT: _Table(), _RIGHT: _Table()}
                elif parts[first] != at[1]:
                    held[_RIGHT] = _Table()
                at, kind, run_of = (cells[first], parts[first]), kinds[first], batch.slice(first, end - first)
                if kind != _PAIR:
                    held[kind].add(run_of.column("_key"), run_of.column("_null"), run_of.column("_left" if kind == _LEFT else "_right"))
                    continue
                fields = run_of.column("_pair").flatten()
                keys = [pc.cast(f, pa.int64()).to_numpy(zero_copy_only=False) for f in fields[:2]]
                row, dots, null = _dots(held[_LEFT], held[_RIGHT], *keys)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(f.take(taken) for f in fields), pa.array(dots, mask=null)], names=[*kept, name])

    if passes == 1:
        return cells(0, left_groups).mapInArrow(run, schema)
    ends = [left_groups * i // passes for i in range(passes + 1)]
    scored = [freeze(cells(first, end).mapInArrow(run, schema), "scored") for first, end in zip(ends, ends[1:], strict=False)]
    return reduce(DataFrame.unionAll, scored)
