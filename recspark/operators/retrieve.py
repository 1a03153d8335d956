"""Exact top-k retrieval by inner product.

Scores are computed as matrix products inside tasks and reduced to k rows per
query on the spot; the full score table never exists. Items travel by broadcast
only while their measured size is within a bound. Beyond it, a task keeps some
queries with their lists while all items pass by, with the same result.

Items lie in boxes of neighbours. A box that cannot hold anything better than a query's list is passed
over, which changes no list. How many are passed over depends on the vectors: none where they are noise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.functions.vectors import is_finite, is_unit
from recspark.operators import beside
from recspark.operators.arrow import to_matrix
from recspark.session import freeze

# Default and greatest list length, acceptance bounds.
TOP_K = 10
MAX_TOP_K = 100
SELF_SIMILARITY = 0.999
QUERY_NORM_TOLERANCE = 1e-4

# Scores equal to this many digits are ties, ordered by article.
SCORE_DIGITS = 6

BROADCAST_BYTES = 256 * 1024 * 1024
_SCORES_AT_ONCE = 4_000_000
_QUERY_BLOCK = 2_048
_QUERIES_AT_ONCE, _ITEMS_AT_ONCE, _RESCORED_AT_ONCE = 512, 1_024, 16_384
#: Vectors of a greater length are searched in double precision throughout.
_SINGLE_LENGTH = 1e12
#: Items of a box, and axes along which boxes are cut.
_BOX_ITEMS, _AXES = 256, 16
_BLOCK_BYTES = 32 * 1024 * 1024
#: Item vectors that a cell of a grid keeps, and cells for each core.
_GROUP_BYTES = 256 * 1024 * 1024
_CELLS_PER_CORE = 3
_MORE_COPIES = 1.5
#: Queries with their lists that a task keeps, and items that are boxed together as they pass.
_KEPT_BYTES, _PASSING_ITEMS = 192 * 1024 * 1024, 65_536
#: Items of a part of space, and vectors that the parts and the first bounds of lists come from.
_PART_ITEMS, _SAMPLE_BYTES = 16_384, 16 * 1024 * 1024


def _best(
    vectors: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, item position, score and rank of the k best items of each query row.

    Items pass by some at a time. A product in single precision finds those that can still enter a list, as its error has
    a bound; only they are scored in double precision, rounded, and ranked, so ties are settled by id.
    A score that is not finite has no rank; it ends the job. ``floor`` is the least score of each query's full list from
    other items: what is below it may be left out.
    """
    k, error = min(k, items.shape[0]), _single_error(vectors, items)
    if error is None:  # too large for single precision, or not finite
        return _best_of_all(vectors, items, ids, k)
    floor = np.full(vectors.shape[0], -np.inf) if floor is None else floor
    ends = [slice(at, at + _QUERIES_AT_ONCE) for at in range(0, vectors.shape[0], _QUERIES_AT_ONCE)]
    parts = [_best_by_sight(vectors[part], items, ids, k, error, floor[part]) for part in ends]
    if not parts:
        return _best_of_all(vectors, items, ids, k)
    rows = np.concatenate([part[0] + i * _QUERIES_AT_ONCE for i, part in enumerate(parts)])
    return rows, *(np.concatenate([part[c] for part in parts]) for c in (1, 2, 3))


def _single_error(vectors: np.ndarray, items: np.ndarray) -> float | None:
    """How far a product in single precision can be from the one in double precision."""
    with np.errstate(over="ignore", invalid="ignore"):
        longest = [np.sqrt(np.einsum("ij,ij->i", m, m).max(initial=0.0)) for m in (vectors, items)]
    if not all(0 <= length < _SINGLE_LENGTH for length in longest):
        return None
    return (2 * vectors.shape[1] + 16) * float(np.finfo(np.float32).eps) * longest[0] * longest[1] + 1e-30


def _best_by_sight(vectors: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int, error: float, floor: np.ndarray):
    n, single = vectors.shape[0], vectors.astype(np.float32)
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    floor = floor - error - 10.0**-SCORE_DIGITS
    least, waiting, count = floor.copy(), [], 0
    first = max(_ITEMS_AT_ONCE, 4 * k)
    scored, met = np.empty((n, _ITEMS_AT_ONCE), np.float32), np.empty((n, _ITEMS_AT_ONCE), bool)  # used again for every part
    for at, end in [(0, first), *((i, i + _ITEMS_AT_ONCE) for i in range(first, items.shape[0], _ITEMS_AT_ONCE))]:
        part = items[at:end].astype(np.float32).T
        whole = part.shape[1] == _ITEMS_AT_ONCE
        raw = np.matmul(single, part, out=scored if whole else None)
        if at == 0 and raw.shape[1] > k and np.isneginf(floor).any():
            kth = np.partition(raw, raw.shape[1] - k, axis=1)[:, raw.shape[1] - k].astype(np.float64)
            least = np.maximum(floor, kth - 2 * error - 10.0**-SCORE_DIGITS)
        # a bound in single precision must not be above the one in double precision
        bound = np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None]
        seen = np.flatnonzero(np.greater_equal(raw, bound, out=met if whole else None))
        if len(seen):
            waiting.append((seen // raw.shape[1], at + seen % raw.shape[1]))
            count += len(seen)
        if waiting and (at == 0 or count > 2 * k * n or end >= items.shape[0]):
            held, waiting, count = _ranked(vectors, items, ids, k, held, waiting), [], 0
            full = held[3] == k
            least[held[0][full]] = np.maximum(floor[held[0][full]], held[2][full] - error - 10.0**-SCORE_DIGITS)
    return held


def _ranked(vectors: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int, held, waiting):
    """The k best of the lists so far and of the items seen since."""
    rows, positions = (np.concatenate([w[c] for w in waiting]) for c in (0, 1))
    scores = np.empty(len(rows))
    for at in range(0, len(rows), _RESCORED_AT_ONCE):
        part = slice(at, at + _RESCORED_AT_ONCE)
        scores[part] = np.einsum("ij,ij->i", vectors[rows[part]], items[positions[part]])
    scores = np.round(scores, SCORE_DIGITS) + 0.0
    rows, positions, scores = (np.concatenate([h, new]) for h, new in zip(held[:3], (rows, positions, scores), strict=True))
    order = np.lexsort((ids[positions], -scores, rows))
    rows, positions, scores = rows[order], positions[order], scores[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows) + 1
    keep = rank <= k
    return rows[keep], positions[keep], scores[keep], rank[keep]


class _Boxes(NamedTuple):
    """Items dealt to boxes of neighbours. A box's corners bound the score of a query with all that it holds."""

    vectors: np.ndarray
    ids: np.ndarray
    indices: np.ndarray
    starts: np.ndarray  # first row of each box, and the number of rows
    turn: np.ndarray | None  # axes that the boxes lie along; none for items that must be searched in double precision
    middle: np.ndarray | None
    half: np.ndarray | None


def _boxed(vectors: np.ndarray, ids: np.ndarray, indices: np.ndarray) -> _Boxes:
    """Boxes of at most ``_BOX_ITEMS`` items, halved along the axis on which they are spread most."""
    n = vectors.shape[0]
    if not n or _single_error(vectors, vectors) is None:
        return _Boxes(vectors, ids, indices, np.array([0, n]), None, None, None)
    middle = vectors.mean(0)
    turn = np.ascontiguousarray(np.linalg.eigh(vectors.T @ vectors / n - np.outer(middle, middle))[1][:, ::-1])
    lead = (vectors @ turn[:, :_AXES]).astype(np.float32)
    parts, waiting = [], [np.arange(n)]
    while waiting:
        part = waiting.pop()
        if len(part) <= _BOX_ITEMS:
            parts.append(part)
            continue
        spread, cut = lead[part], len(part) // 2
        part = part[np.argpartition(spread[:, spread.var(0).argmax()], cut)]
        waiting += [part[:cut], part[cut:]]
    order = np.concatenate(parts)
    starts = np.cumsum([0, *map(len, parts)])
    vectors = vectors[order]
    low, high = np.empty((2, len(parts), vectors.shape[1]))
    for i, (at, end) in enumerate(zip(starts, starts[1:], strict=False)):
        turned = vectors[at:end] @ turn
        low[i], high[i] = turned.min(0), turned.max(0)
    return _Boxes(vectors, ids[order], indices[order], starts, turn, ((low + high) / 2).astype(np.float32), ((high - low) / 2).astype(np.float32))


def _best_in_boxes(
    vectors: np.ndarray, items: _Boxes, k: int, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_best`` gives, without a look into boxes whose bound is below the list that a query has already."""
    n, k = vectors.shape[0], min(k, items.vectors.shape[0])
    error = _single_error(vectors, items.vectors) if items.turn is not None else None
    if error is None or not n:
        return _best_of_all(vectors, items.vectors, items.ids, k)
    single, turned, boxes = vectors.astype(np.float32), (vectors @ items.turn).astype(np.float32), len(items.starts) - 1
    bound = items.middle @ turned.T + items.half @ np.abs(turned).T
    bound += np.float32(4 * error + 1e-30)  # what single precision may have lost in it
    rounding = 10.0**-SCORE_DIGITS

    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    widest = int(np.diff(items.starts).max())
    scored, met = np.empty(n * widest, np.float32), np.empty(n * widest, bool)  # used again for every box

    def scores_of(box: int, rows: np.ndarray) -> np.ndarray:
        part = items.vectors[items.starts[box] : items.starts[box + 1]].astype(np.float32).T
        out = scored[: len(rows) * part.shape[1]].reshape(len(rows), -1)
        return np.matmul(single if len(rows) == n else single[rows], part, out=out)

    def first_lists() -> np.ndarray:
        """The k-th score of each query in the boxes with the greatest bounds."""
        slots = min(boxes, max(4, -(-2 * k // widest)))
        tops = np.argpartition(np.ascontiguousarray(-bound.T), slots - 1, axis=1)[:, :slots].T
        first = np.full((n, slots, widest), -np.inf, np.float32)
        for box in np.unique(tops):
            rows, slot = np.nonzero((tops == box).T)  # in the order of the queries
            raw = scores_of(box, rows)
            first[rows, slot, : raw.shape[1]] = raw
        first = first.reshape(n, -1)
        if first.shape[1] < k:
            return np.full(n, -np.inf)
        return np.partition(first, first.shape[1] - k, axis=1)[:, first.shape[1] - k].astype(np.float64)

    least = np.full(n, -np.inf) if floor is None else floor - error - rounding
    if np.isneginf(least).any():
        least = np.maximum(least, first_lists() - 2 * error - rounding)
    waiting, count = [], 0
    lowest = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
    hopeful = np.flatnonzero((bound >= lowest).any(1))
    for box in hopeful[np.argsort(-bound[hopeful].mean(1), kind="stable")]:
        rows = np.flatnonzero(bound[box] >= lowest)
        if not len(rows):
            continue
        raw = scores_of(box, rows)
        seen = np.flatnonzero(np.greater_equal(raw, lowest[rows][:, None], out=met[: raw.size].reshape(raw.shape)))
        if len(seen):
            waiting.append((rows[seen // raw.shape[1]], items.starts[box] + seen % raw.shape[1]))
            count += len(seen)
        if count > 2 * k * n:
            held, waiting, count = _ranked(vectors, items.vectors, items.ids, k, held, waiting), [], 0
            full = held[3] == k
            least[held[0][full]] = np.maximum(least[held[0][full]], held[2][full] - error - rounding)
            lowest = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
    return _ranked(vectors, items.vectors, items.ids, k, held, waiting) if waiting else held


def _best_of_all(vectors: np.ndarray, items: np.ndarray, ids: np.ndarray, k: int):
    """The same from all scores in double precision.

    Everything within rounding distance of the k-th raw score stays in the
    running until the rounded scores are compared.
    """
    parts, step = [], max(1, _SCORES_AT_ONCE // max(1, items.shape[0]))
    for at in range(0, max(1, vectors.shape[0]), step):
        raw = vectors[at : at + step] @ items.T
        if not np.isfinite(raw).all():
            raise ValueError("query and item vectors must be finite")
        kth = np.partition(raw, items.shape[0] - k, axis=1)[:, items.shape[0] - k]
        rows, positions = np.nonzero(raw >= (kth - 2 * 10.0**-SCORE_DIGITS)[:, None])
        scores = np.round(raw[rows, positions], SCORE_DIGITS) + 0.0
        order = np.lexsort((ids[positions], -scores, rows))
        rows, positions, scores = rows[order], positions[order], scores[order]
        first = np.searchsorted(rows, np.arange(raw.shape[0]))
        rank = np.arange(len(rows)) - first[rows] + 1
        keep = rank <= k
        parts.append((rows[keep] + at, positions[keep], scores[keep], rank[keep]))
    return tuple(np.concatenate([part[c] for part in parts]) for c in range(4))


def _result_schema(key: T.StructField) -> T.StructType:
    return T.StructType(
        [
            key,
            T.StructField("rank", T.IntegerType()),
            T.StructField("article_id", T.LongType()),
            T.StructField("item_index", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )


def _emit(keys: pa.Array, vectors: np.ndarray, items: _Boxes, k: int, key_name: str):
    """Ranked lists of a matrix of queries, some rows at a time."""
    step = _QUERY_BLOCK
    for at in range(0, vectors.shape[0], step):
        rows, positions, scores, rank = _best_in_boxes(vectors[at : at + step], items, k)
        yield pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(rows + at)),
                pa.array(rank, pa.int32()),
                pa.array(items.ids[positions], pa.int64()),
                pa.array(items.indices[positions], pa.int64()),
                pa.array(scores, pa.float64()),
            ],
            names=[key_name, "rank", "article_id", "item_index", "similarity"],
        )


def top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int = TOP_K,
    key: str = "customer_id",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The k items with the greatest inner product for each query, ranked from 1.

    ``queries`` has ``(key, embedding)``, ``items`` has ``(article_id,
    item_index, embedding)`` with dense indices. ``items`` is read twice, so it
    should be a stored table. Every query row gets a list of its own, also rows that
    share a key or have none, however large the item table is.
    """
    if k <= 0:
        raise ValueError("top_k must be greater than zero")
    count, size = items.agg(F.count("*"), F.max(F.size("embedding"))).first()
    queries = queries.select(key, "embedding")
    schema = _result_schema(queries.schema[key])
    if not count:
        return queries.sparkSession.createDataFrame([], schema)
    k = min(k, count)
    if count * (size + 2) * 8 <= broadcast_bytes:
        return _top_k_broadcast(queries, items, k, key, size, schema)
    return _top_k_blocks(queries, items, k, key, count, size, schema)


def _top_k_broadcast(queries, items, k: int, key: str, size: int, schema: T.StructType) -> DataFrame:
    spark = queries.sparkSession
    table = items.select("article_id", "item_index", "embedding").toArrow().combine_chunks()
    matrix = to_matrix(table.column("embedding").combine_chunks(), size)
    boxed = _boxed(matrix, table.column("article_id").to_numpy(), table.column("item_index").to_numpy())
    shared = spark.sparkContext.broadcast(tuple(boxed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = _Boxes(*shared.value)
        for batch in batches:
            if batch.num_rows:
                yield from _emit(batch.column(key), to_matrix(batch.column("embedding"), size), boxes, k, key)

    return queries.mapInArrow(run, schema)


def grid_of(tasks: int, item_blocks: int, item_bytes: int = 1, query_bytes: int = 1, least: int = 1) -> tuple[int, int]:
    """(query groups, item groups): about one cell per task, with as few copied bytes as ``least`` and the item blocks allow."""
    across = max(1, least, min(item_blocks, tasks, math.isqrt(tasks * item_bytes // max(query_bytes, 1))))
    return -(-tasks // across), across


def large_item_groups(tasks: int, grid: tuple[int, int], item_bytes: int, query_bytes: int, least: int) -> tuple[int, int]:
    """The grid with the fewest item groups, from ``least``, that copies at most ``_MORE_COPIES`` times what ``grid`` does.

    Boxes of a larger group are smaller, and a query starts its list anew in every group.
    """
    grids = [(-(-tasks // across), across) for across in range(max(1, least), grid[1])]
    copied = lambda g: g[0] * item_bytes + g[1] * query_bytes
    return next((g for g in grids if copied(g) <= _MORE_COPIES * copied(grid)), grid)


class _Parts(NamedTuple):
    """Space cut in halves again and again. A vector of either half goes on to a cut of its own."""

    turn: np.ndarray  # axes that the cuts are made across
    axis: np.ndarray  # of each cut: those of a level after the one above, in order
    at: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The number of each vector's part; neighbours have numbers near each other."""
        if not len(self.axis):
            return np.zeros(len(vectors), np.int64)
        with np.errstate(invalid="ignore", over="ignore"):
            lead = vectors @ self.turn
        place, row = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
        for _ in range((len(self.axis) + 1).bit_length() - 1):
            place = 2 * place + 1 + (lead[row, self.axis[place]] > self.at[place])
        return place - len(self.axis)


def _parts_of(sample: np.ndarray, depth: int) -> _Parts:
    """``2 ** depth`` parts with about as many of the sample's vectors, cut across the axis on which they are spread most."""
    if not len(sample):
        return _Parts(np.zeros((0, 1)), np.zeros(0, np.int64), np.zeros(0))
    middle = sample.mean(0)
    turn = np.ascontiguousarray(np.linalg.eigh(sample.T @ sample / len(sample) - np.outer(middle, middle))[1][:, ::-1][:, :_AXES])
    lead, axis, at, level = sample @ turn, [], [], [np.arange(len(sample))]
    for _ in range(depth):
        halves = []
        for part in level:
            across = int(lead[part].var(0).argmax()) if len(part) else 0
            cut = float(np.median(lead[part, across])) if len(part) else 0.0
            upper = lead[part, across] > cut
            axis, at, halves = [*axis, across], [*at, cut], [*halves, part[~upper], part[upper]]
        level = halves
    return _Parts(turn, np.array(axis, np.int64), np.array(at))


def _sample(items: DataFrame, count: int, size: int) -> np.ndarray:
    """Some item vectors, of bounded size, without those that single precision cannot hold."""
    most = max(1, _SAMPLE_BYTES // (8 * max(size, 1)))
    rows = items.select("embedding")
    if count > most:
        rows = rows.sample(most / count, seed=1).limit(2 * most)
    vectors = to_matrix(rows.toArrow().combine_chunks().column("embedding").combine_chunks(), size)
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return vectors[length < _SINGLE_LENGTH]


def _item_packets(items: DataFrame, sample: np.ndarray, count: int, size: int) -> DataFrame:
    """Stored packets of ``(article_id, item_index, embedding)``, neighbours near each other."""
    spark, schema = items.sparkSession, T.StructType([*items.schema.fields, T.StructField("_part", T.LongType())])
    depth = (count // _PART_ITEMS).bit_length()
    shared = spark.sparkContext.broadcast(tuple(_parts_of(sample, depth)))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _Parts(*shared.value)
        for batch in batches:
            number = parts.of(to_matrix(batch.column("embedding"), size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], names=[*batch.schema.names, "_part"])

    row_bytes = 8 * size + 16
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-count // _PART_ITEMS)), -(-count * row_bytes // _KEPT_BYTES))
    task = F.floor(F.col("_part") * tasks / (1 << depth)).cast("int")
    near = items.mapInArrow(placed, schema).repartitionById(tasks, task).sortWithinPartitions("_part").drop("_part")
    return freeze(beside.packets(near, row_bytes), "item-packets", **beside.STORED)


def _together(passing: Iterator[pa.RecordBatch], size: int) -> Iterator[_Boxes]:
    """Boxes of the items that pass by, many at a time."""
    waiting, rows = [], 0

    def boxed() -> _Boxes:
        columns = [(to_matrix(b.column("embedding"), size), *(b.column(c).to_numpy(zero_copy_only=False) for c in ("article_id", "item_index"))) for b in waiting]
        return _boxed(*(np.concatenate([c[i] for c in columns]) for i in range(3)))

    for batch in passing:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= _PASSING_ITEMS:
            yield boxed()
            waiting, rows = [], 0
    if waiting:
        yield boxed()


class _Found(NamedTuple):
    """Entries of lists by their place."""

    ids: np.ndarray
    indices: np.ndarray


def _floors(lists: np.ndarray, k: int, floor: np.ndarray) -> np.ndarray:
    """The least score of each query's list where it is full; ``floor`` for the others."""
    starts = np.flatnonzero(np.diff(lists["row"], prepend=-1))
    full = np.diff(starts, append=len(lists)) == k
    if full.any():
        rows = lists["row"][starts][full]
        floor[rows] = np.maximum(floor[rows], np.minimum.reduceat(lists["score"], starts)[full])
    return floor


def _top_k_blocks(queries, items, k: int, key: str, count: int, size: int, schema: T.StructType) -> DataFrame:
    """Queries that stay in a task, with their lists, while all items pass by.

    Neither side is copied for the other: queries are dealt to tasks once, and each task reads the stored items. The number of
    tasks follows the bytes of queries and lists. A sample of the items gives each query a first bound that its list cannot
    stay below, and items pass by in the order of their place in space, so that whole boxes are out of reach.
    """
    spark, key_field = queries.sparkSession, queries.schema[key]
    row_bytes = 8 * size + 16
    asked = freeze(beside.packets(queries.select(F.col(key).alias("_key"), "embedding"), row_bytes), "queries", **beside.STORED)
    query_packets = asked.count()
    most = query_packets * (beside.PACKET_BYTES + beside.PACKET_BYTES // row_bytes * _LIST.itemsize * k)
    tasks = max(1, min(query_packets, max(spark.sparkContext.defaultParallelism, -(-most // _KEPT_BYTES))))
    items = items.filter(F.col("item_index").isNotNull()).select(F.col("article_id").cast("bigint"), F.col("item_index").cast("bigint"), "embedding")
    sample = _sample(items, count, size)
    passing = _item_packets(items, sample, count, size)
    known = spark.sparkContext.broadcast(tuple(_boxed(sample, np.arange(len(sample)), np.arange(len(sample)))) if len(sample) >= k else None)
    lists = list_schema(key_field.dataType)

    def meet(kept: list[pa.RecordBatch], passing: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = pa.concat_arrays([b.column("_key") for b in kept])
        vectors = np.concatenate([to_matrix(b.column("embedding"), size) for b in kept])
        kept.clear()
        parts = [slice(at, at + _QUERY_BLOCK) for at in range(0, len(vectors), _QUERY_BLOCK)]
        floors, held = [np.full(len(vectors[part]), -np.inf) for part in parts], [np.zeros(0, _LIST) for _ in parts]
        if known.value is not None:
            first = _Boxes(*known.value)
            for part, floor in zip(parts, floors, strict=True):
                rows, _, scores, rank = _best_in_boxes(vectors[part], first, k)
                floor[rows[rank == k]] = scores[rank == k]
        for boxes in _together(passing, size):
            for i, part in enumerate(parts):
                rows, positions, scores, _ = _best_in_boxes(vectors[part], boxes, k, floors[i])
                if len(rows):
                    held[i] = _merged(held[i], _lists_of(rows, boxes.ids[positions], boxes.indices[positions], scores), k)
                    floors[i] = _floors(held[i], k, floors[i])
        for part, found in zip(parts, held, strict=True):
            numbers = pa.array(np.arange(part.start, min(part.stop, len(vectors))))
            entries = found["row"], np.arange(len(found)), found["score"], None
            yield _finished((keys[part.start : part.stop], numbers, _Found(found["id"], found["index"]), entries), lists)

    return merged_lists(beside.beside(asked, passing, tasks, meet, lists), key, k, 1)


def merged_lists(found: DataFrame, key: str, k: int, parts: int) -> DataFrame:
    """Ranked rows of ``(_key, _query, article_id, item_index, similarity)``, the last three arrays: up to ``parts`` lists of a query."""
    entry = "array<struct<score:double,article_id:bigint,item_index:bigint>>"

    def entries(lists: Column) -> Column:
        return F.arrays_zip(F.transform(lists["similarity"], lambda s: -s), lists["article_id"], lists["item_index"]).cast(entry)

    one_list = F.struct("similarity", "article_id", "item_index")
    if parts > 1:  # each of at most k entries
        found = found.groupBy("_query").agg(F.first("_key").alias("_key"), F.collect_list(one_list).alias("_lists"))
        best = F.slice(F.sort_array(F.flatten(F.transform("_lists", entries))), 1, k)
    else:
        best = entries(one_list)
    return found.select(F.col("_key").alias(key), F.posexplode(best).alias("_at", "_entry")).select(
        key,
        (F.col("_at") + 1).alias("rank"),
        "_entry.article_id",
        "_entry.item_index",
        (F.lit(0.0) - F.col("_entry.score")).alias("similarity"),
    )


def list_schema(key_type: T.DataType) -> T.StructType:
    """One row for a query, its list in arrays."""
    long_list = T.ArrayType(T.LongType())
    return T.StructType(
        [
            T.StructField("_key", key_type),
            T.StructField("_query", T.LongType()),
            T.StructField("article_id", long_list),
            T.StructField("item_index", long_list),
            T.StructField("similarity", T.ArrayType(T.DoubleType())),
        ]
    )


def _block_lists(vectors: np.ndarray, items: np.ndarray, ids: np.ndarray, indices: np.ndarray, k: int, held: np.ndarray | None = None) -> np.ndarray:
    """Rows (query row, article, index, score) of the k best of each query in one block of items; what cannot enter ``held`` may be left out."""
    floor = np.full(vectors.shape[0], -np.inf)
    if held is not None and len(held):
        starts = np.flatnonzero(np.diff(held["row"], prepend=-1))
        full = np.diff(starts, append=len(held)) == k
        floor[held["row"][starts][full]] = np.minimum.reduceat(held["score"], starts)[full]
    rows, positions, scores, _ = _best(vectors, items, ids, k, floor)
    return _lists_of(rows, ids[positions], indices[positions], scores)


_LIST = np.dtype([("row", np.int64), ("id", np.int64), ("index", np.int64), ("score", np.float64)])


def _lists_of(rows, ids, indices, scores) -> np.ndarray:
    out = np.empty(len(rows), _LIST)
    out["row"], out["id"], out["index"], out["score"] = rows, ids, indices, scores
    return out


def _merged(held: np.ndarray | None, found: np.ndarray, k: int) -> np.ndarray:
    """The k best of two sets of lists, ties by article."""
    if held is None:
        return found
    both = np.concatenate([held, found])
    both = both[np.lexsort((both["id"], -both["score"], both["row"]))]
    first = np.searchsorted(both["row"], both["row"])
    return both[np.arange(len(both)) - first < k]


def _finished(found, schema: T.StructType) -> pa.RecordBatch:
    """One row for each query, its list."""
    keys, numbers, items, (rows, positions, scores, _) = found
    return list_rows(keys, numbers, rows, items.ids[positions], items.indices[positions], scores, schema)


def list_rows(keys: pa.Array, numbers: pa.Array, rows, ids, indices, scores, schema: T.StructType) -> pa.RecordBatch:
    """Entries, those of a query one after the other, as arrays of their query."""
    offsets = pa.array(np.searchsorted(rows, np.arange(len(numbers) + 1)).astype(np.int32))
    columns = [pa.array(ids, pa.int64()), pa.array(indices, pa.int64()), pa.array(scores)]
    return pa.RecordBatch.from_arrays([keys, numbers, *(pa.ListArray.from_arrays(offsets, c) for c in columns)], names=schema.names)


def self_retrieval(items: DataFrame, k: int = TOP_K) -> DataFrame:
    """Search with every item's own vector: does it come back first, with score 1?"""
    lists = top_k(items.select(F.col("article_id").alias("query_id"), "embedding"), items, k, "query_id")
    own = F.col("article_id") == F.col("query_id")
    return lists.groupBy("query_id").agg(
        F.min(F.when(own, F.col("rank"))).alias("self_rank"),
        F.max(F.when(own, F.col("similarity"))).alias("self_similarity"),
        F.max("similarity").alias("best_similarity"),
        F.count("*").alias("result_count"),
    )


def is_searchable(size: int, tolerance: float = QUERY_NORM_TOLERANCE) -> Column:
    """Whether ``embedding`` can be searched with: right length, finite, and of length 1."""
    v = F.col("embedding")
    return F.coalesce((F.size(v) == size) & is_finite(v) & is_unit(v, tolerance), F.lit(False))


def invalid_queries(queries: DataFrame, size: int, tolerance: float = QUERY_NORM_TOLERANCE) -> DataFrame:
    """Query rows a search must refuse."""
    return queries.filter(~is_searchable(size, tolerance))
