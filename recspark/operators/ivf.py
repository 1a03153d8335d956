"""Approximate top-k retrieval with an inverted-file index.

Vectors are dealt to lists by their nearest centroid, and a list lies in a folder of its own. A query is
compared with the vectors of the ``probes`` lists whose centroids are nearest to it and with no
others; files of lists that no query asks for are not opened. Probing every list gives the exact result.

Centroids come from rounds of k-means on a bounded sample of vectors, drawn by a hash of their key. Sums are of whole
numbers (vectors times 2^20), so centroids do not depend on partitions. Every vector is then assigned. How many lists
to probe for a wanted recall is measured, not guessed: see ``probes_for``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.operators import retrieve
from recspark.operators.arrow import to_matrix
from recspark.session import freeze

#: Sampled vectors for each list, and the most that are sampled at all.
SAMPLE_PER_LIST = 256
MAX_SAMPLE = 4_000_000
ROUNDS = 10
#: Centroids are held by the driver and by every task.
MAX_CENTROID_BYTES = 256 * 1024 * 1024
#: Queries that are searched exactly to find the number of probes.
TUNING_QUERIES = 256
TARGET_RECALL = 0.95

_VECTORS, _LISTS = "vectors", "lists"
_UNIT = float(1 << 20)
_ITEM_BLOCK = 8_192
_QUERY_BLOCK = 2_048
#: Lists that a block of queries meets before what it found in them is merged.
_MEETINGS = 64
#: Next lists begin this far apart among the item groups.
_SPREAD = 7_919
_ITEM, _QUERY = range(2)
_DRAWS = 1 << 30


class Index(NamedTuple):
    path: str  # its folder: vectors, in one folder for each list, and a table of the lists
    lists: np.ndarray  # numbers of the lists that hold something
    centroids: np.ndarray  # (lists, size)
    counts: DataFrame  # list, items, blocks
    size: int


def _order(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance to each centroid, up to the vector's own length."""
    return (centroids * centroids).sum(1)[None, :] - 2 * vectors @ centroids.T


def _draw(key: str, seed: int):
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_DRAWS))


def _sample(items: DataFrame, count: int, rows: int, seed: int) -> DataFrame:
    """About ``rows`` of ``count`` vectors; which ones follows from their keys alone."""
    drawn = items.select("article_id", "embedding", _draw("article_id", seed).alias("draw"))
    return drawn if count <= rows else drawn.filter(F.col("draw") < int(_DRAWS * rows / count))


def _move(sample: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: a task sends one row of whole-number sums for each list that it met."""
    lists, size = centroids.shape
    names = [f"s{i}" for i in range(size)]
    shared = sample.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((lists, size), np.int64), np.zeros(lists, np.int64)
        for batch in batches:
            x = to_matrix(batch.column("embedding"), size)
            of = _order(x, shared.value).argmin(1)
            order = np.argsort(of, kind="stable")
            met, first, count = np.unique(of[order], return_index=True, return_counts=True)
            if len(met):
                total[met] += np.add.reduceat(np.rint(x[order] * _UNIT).astype(np.int64), first, axis=0)
                n[met] += count
        met = np.flatnonzero(n)
        columns = [met.astype(np.int32), n[met], *total[met].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["list", "n", *names])

    schema = "list int, n bigint, " + ", ".join(f"{c} bigint" for c in names)
    sums = sample.select("embedding").mapInArrow(run, schema).groupBy("list").agg(*(F.sum(c).alias(c) for c in ("n", *names)))
    moved = centroids.copy()
    for row in sums.collect():  # at most one row for each list
        moved[row["list"]] = np.array([row[c] for c in names], np.float64) / (row["n"] * _UNIT)
    shared.destroy()
    return moved


def fit_centroids(items: DataFrame, count: int, size: int, lists: int, rounds: int = ROUNDS, seed: int = 42) -> np.ndarray:
    """Centroids of at most ``lists`` lists, from ``SAMPLE_PER_LIST`` vectors a list, ``MAX_SAMPLE`` in all."""
    if lists * size * 8 > MAX_CENTROID_BYTES:
        raise ValueError(f"{lists} centroids of {size} components are too large to be sent to every task")
    sample = freeze(_sample(items, count, min(MAX_SAMPLE, SAMPLE_PER_LIST * lists), seed), "index-sample")
    first = sample.orderBy("draw", "article_id").limit(lists).select("embedding").collect()
    centroids = np.array([r["embedding"] for r in first], np.float64).reshape(-1, size)
    for _ in range(rounds):
        centroids = _move(sample, centroids)
    return centroids


def _assigned(items: DataFrame, centroids: np.ndarray) -> DataFrame:
    size = centroids.shape[1]
    shared = items.sparkSession.sparkContext.broadcast(centroids)
    names = ["article_id", "item_index", "embedding"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = _order(to_matrix(batch.column("embedding"), size), shared.value).argmin(1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(of, pa.int32())], names=[*names, "list"])

    rows = items.select(*names)
    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("list", T.IntegerType())]))


def build(items: DataFrame, path: str, lists: int | None = None, rounds: int = ROUNDS, seed: int = 42) -> Index:
    """Write the index of ``(article_id, item_index, embedding)`` to ``path``; by default with about root-of-n lists.

    A list is cut into blocks by a hash of the key, so a list that holds a third of all vectors is
    written and searched by many tasks.
    """
    spark = items.sparkSession
    count, size = items.agg(F.count("*"), F.max(F.size("embedding"))).first()
    lists = max(1, min(count, lists or math.isqrt(max(count, 1))))
    if not count:
        raise ValueError("an index needs at least one vector")
    centroids = fit_centroids(items, count, size, lists, rounds, seed)
    assigned = freeze(_assigned(items, centroids), "assigned")
    blocks = F.ceil(F.count("*") / F.lit(_ITEM_BLOCK)).cast("int")
    counts = freeze(assigned.groupBy("list").agg(F.count("*").alias("items"), blocks.alias("blocks")), "list-sizes")
    placed = assigned.join(F.broadcast(counts.select("list", "blocks")), "list")  # a row for each centroid, checked above
    block = F.pmod(F.xxhash64("article_id", F.lit(seed)), F.col("blocks")).cast("int")
    placed = placed.withColumn("block", block).drop("blocks")
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // (16 * _ITEM_BLOCK)))
    ordered = placed.repartitionByRange(tasks, "list", "block").sortWithinPartitions("list", "block")
    ordered.write.partitionBy("list").parquet(f"{path}/{_VECTORS}")
    rows = [(int(n), [float(x) for x in c]) for n, c in enumerate(centroids)]
    named = spark.createDataFrame(rows, "list int, centroid array<double>")
    counts.join(F.broadcast(named), "list").coalesce(1).write.parquet(f"{path}/{_LISTS}")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Index:
    """An index that ``build`` wrote. The driver holds one centroid for each list that holds something."""
    table = spark.read.parquet(f"{path}/{_LISTS}")
    rows = table.select("list", "centroid").orderBy("list").collect()
    centroids = np.array([r["centroid"] for r in rows], np.float64)
    return Index(path, np.array([r["list"] for r in rows], np.int32), centroids, table.drop("centroid"), centroids.shape[1])


def nearest_lists(queries: DataFrame, index: Index, key: str, probes: int) -> DataFrame:
    """(key, embedding, list, rank): the ``probes`` lists nearest to each query, ranked from 0."""
    shared = queries.sparkSession.sparkContext.broadcast((index.lists, index.centroids))
    size, probes = index.size, min(probes, len(index.centroids))
    rows = queries.select(key, "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, centroids = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, _QUERY_BLOCK):
                part = batch.slice(at, _QUERY_BLOCK)
                vectors = to_matrix(part.column("embedding"), size)
                near = lists[np.argsort(_order(vectors, centroids), axis=1, kind="stable")[:, :probes]]
                row = pa.array(np.repeat(np.arange(part.num_rows), probes))
                columns = [part.column(key).take(row), part.column("embedding").take(row)]
                columns += [pa.array(near.reshape(-1), pa.int32()), pa.array(np.tile(np.arange(probes, dtype=np.int32), part.num_rows))]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "embedding", "list", "rank"])

    more = [T.StructField("list", T.IntegerType()), T.StructField("rank", T.IntegerType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema, *more]))


def vectors(spark: SparkSession, index: Index, lists: list[int] | None = None) -> DataFrame:
    """What the index, or some of its lists, holds: ``(article_id, item_index, embedding, block, list)``."""
    folder = f"{index.path}/{_VECTORS}"
    if lists is None or 2 * len(lists) > len(index.lists):
        table = spark.read.parquet(folder)
        return table if lists is None else table.filter(F.col("list").isin(lists))
    # named one by one, so that the folders of the other lists are not even listed
    return spark.read.option("basePath", folder).parquet(*(f"{folder}/list={n}" for n in lists))


class Search(NamedTuple):
    lists: DataFrame  # as retrieve.top_k gives them
    scored: int  # inner products computed
    lists_read: int


def search(queries: DataFrame, index: Index, probes: int, k: int = retrieve.TOP_K, key: str = "customer_id") -> Search:
    """The k best items of each query among those of its ``probes`` nearest lists, ranked from 1; ties by article.

    Query rows are numbered, so rows that share a key or have none get a list each. Which lists a query asks for travels
    as one bit a list. Blocks of the lists are dealt to item groups and queries to query groups, and a cell of both is one
    task's work: it keeps its blocks, and the queries that ask for one of them pass by. So neither a large list nor one that
    every query asks for ends up in one task, and a query is copied once per item group at most, not once per list.
    """
    if k <= 0 or probes <= 0:
        raise ValueError("top_k and probes must be greater than zero")
    spark, size = queries.sparkSession, index.size
    schema = retrieve._result_schema(queries.schema[key])
    key_type = queries.schema[key].dataType
    numbered = queries.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_query"), "embedding")
    asked = freeze(_asked(numbered, index, probes), "probes")
    wanted = freeze(_askers(asked, len(index.lists), index.lists).join(index.counts, "list"), "wanted-lists")
    scored, lists_read = wanted.agg(F.coalesce(F.sum(F.col("queries") * F.col("items")), F.lit(0)), F.count("*")).first()
    sizes = wanted.select("list", "items", "blocks").collect()  # at most one for each centroid
    names = [r["list"] for r in sizes]
    if not names:
        return Search(spark.createDataFrame([], schema), 0, 0)
    row_bytes, count = 8 * size + 16, sum(r["items"] for r in sizes)
    tasks = retrieve._CELLS_PER_CORE * spark.sparkContext.defaultParallelism
    query_count = asked.count()
    query_groups, item_groups = retrieve.grid_of(
        tasks, sum(r["blocks"] for r in sizes), count * row_bytes, query_count * (row_bytes + 24 * k), -(-count * row_bytes // retrieve._GROUP_BYTES)
    )
    query_groups = max(1, min(query_groups, query_count))
    place = {int(n): i for i, n in enumerate(index.lists)}  # bit of a list
    masks = np.zeros((item_groups, len(index.lists)), bool)
    for r in sizes:
        masks[(r["list"] * _SPREAD + np.arange(min(r["blocks"], item_groups))) % item_groups, place[r["list"]]] = True
    masks = np.packbits(masks, axis=1)

    none = F.lit(None).cast("bigint")
    item_group = F.pmod(F.col("list").cast("bigint") * _SPREAD + F.col("block"), F.lit(item_groups))
    every = F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1)))
    item_rows = vectors(spark, index, names).withColumn("_other", every).select(
        (F.col("_other") * item_groups + item_group).cast("int").alias("_cell"), F.lit(_ITEM).alias("_kind"),
        F.lit(None).cast(key_type).alias("_key"), none.alias("_query"), F.col("list").cast("int"),
        F.col("article_id").cast("bigint"), F.col("item_index").cast("bigint"), F.lit(None).cast("binary").alias("_bits"), "embedding",
    )

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _bits_of(batch.column("_bits"), masks.shape[1])
            row, group = np.nonzero(np.stack([(bits & mask).any(1) for mask in masks], axis=1))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(group.astype(np.int32))], names=[*taken.schema.names, "_group"])

    query_group = F.pmod(F.xxhash64("_query"), F.lit(query_groups))
    query_rows = asked.mapInArrow(copied, T.StructType([*asked.schema, T.StructField("_group", T.IntegerType())])).select(
        (query_group * item_groups + F.col("_group")).cast("int").alias("_cell"), F.lit(_QUERY).alias("_kind"), "_key", "_query",
        F.lit(None).cast("int").alias("list"), none.alias("article_id"), none.alias("item_index"), "_bits", "embedding",
    )
    rows = (
        item_rows.unionByName(query_rows)
        .repartitionById(query_groups * item_groups, F.col("_cell"))
        .sortWithinPartitions("_cell", "_kind", "list")
    )
    lists = retrieve.list_schema(key_type)
    columns_of = ("list", "article_id", "item_index")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, [], None
        for batch in batches:
            cells, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_cell", "_kind"))
            starts = [0, *(np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1), batch.num_rows]
            for first, end in zip(starts, starts[1:], strict=False):
                if first == end:
                    continue
                if cells[first] != at:
                    at, parts, held = cells[first], [], None
                run_of = batch.slice(first, end - first)
                if kinds[first] == _ITEM:
                    parts.append((to_matrix(run_of.column("embedding"), size).copy(), *(run_of.column(c).to_numpy(zero_copy_only=False) for c in columns_of)))
                    continue
                if parts:
                    held, parts = [np.concatenate([part[c] for part in parts]) for c in range(4)], []
                for begin in range(0, run_of.num_rows if held else 0, _QUERY_BLOCK):
                    some = run_of.slice(begin, _QUERY_BLOCK)
                    bits = np.unpackbits(_bits_of(some.column("_bits"), masks.shape[1]), axis=1).view(bool)
                    best = _best_of_lists(to_matrix(some.column("embedding"), size), bits, held, place, k)
                    yield retrieve.list_rows(some.column("_key"), some.column("_query"), *(best[c] for c in ("row", "id", "index", "score")), lists)

    found = retrieve.merged_lists(rows.mapInArrow(meet, lists), key, k, item_groups)
    return Search(found.select(*schema.names), scored, lists_read)


def _bits_of(column: pa.Array, width: int) -> np.ndarray:
    """Packed bits of the lists that each query asks for, a row a query."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _asked(numbered: DataFrame, index: Index, probes: int) -> DataFrame:
    """``numbered`` with one bit for each list of the index: whether it is among the ``probes`` nearest."""
    shared = numbered.sparkSession.sparkContext.broadcast(index.centroids)
    size, probes = index.size, min(probes, len(index.centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, _QUERY_BLOCK):
                part = batch.slice(at, _QUERY_BLOCK)
                near = np.argsort(_order(to_matrix(part.column("embedding"), size), centroids), axis=1, kind="stable")[:, :probes]
                asked = np.zeros((part.num_rows, len(centroids)), bool)
                np.put_along_axis(asked, near, True, axis=1)
                bits = pa.array([row.tobytes() for row in np.packbits(asked, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, bits], names=[*part.schema.names, "_bits"])

    return numbered.mapInArrow(run, T.StructType([*numbered.schema, T.StructField("_bits", T.BinaryType())]))


def _askers(asked: DataFrame, count: int, names: np.ndarray) -> DataFrame:
    """``(list, queries)``: how many queries ask for each list that some query asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _QUERY_BLOCK):
                bits = _bits_of(batch.column("_bits").slice(at, _QUERY_BLOCK), -(-count // 8))
                total += np.unpackbits(bits, axis=1, count=count).sum(0, dtype=np.int64)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(names[met], pa.int32()), pa.array(total[met])], names=["list", "queries"])

    return asked.select("_bits").mapInArrow(run, "list int, queries bigint").groupBy("list").agg(F.sum("queries").alias("queries"))


def _best_of_lists(queries: np.ndarray, bits: np.ndarray, held, place: dict[int, int], k: int) -> np.ndarray:
    """The k best of each query among the lists that it asks for, of a cell's items in the order of their lists."""
    items, of, ids, indices = held
    names, starts = np.unique(of, return_index=True)
    best, waiting = None, []
    for number, (name, at, end) in enumerate(zip(names, starts, [*starts[1:], len(of)], strict=True)):
        rows = np.flatnonzero(bits[:, place[int(name)]])
        if len(rows):
            known = None
            if best is not None and len(best):  # lists of these queries so far, by their new row
                known = best[np.isin(best["row"], rows)]
                known["row"] = np.searchsorted(rows, known["row"])
            found = retrieve._block_lists(queries[rows], items[at:end], ids[at:end], indices[at:end], k, known)
            found["row"] = rows[found["row"]]
            waiting.append(found)
        if waiting and (best is None or (number + 1) % _MEETINGS == 0 or end == len(of)):
            best = retrieve._merged(best if best is not None else np.zeros(0, retrieve._LIST), np.concatenate(waiting), k)
            waiting = []
    if waiting:
        best = retrieve._merged(best, np.concatenate(waiting), k)
    return best if best is not None else np.zeros(0, retrieve._LIST)


def probes_for(
    queries: DataFrame, items: DataFrame, index: Index, recall: float = TARGET_RECALL, k: int = retrieve.TOP_K,
    key: str = "customer_id", rows: int = TUNING_QUERIES, seed: int = 7,
) -> int:
    """Least number of lists to probe at which a sample of about ``rows`` queries finds that share of its exact lists.

    The sample is searched exactly. For each item found, it is looked up how many lists are nearer to the query than
    the item's own.
    """
    count = queries.count()
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(_DRAWS))
    sample = queries.select(key, "embedding").filter(F.col(key).isNotNull())
    sample = freeze(sample if count <= rows else sample.filter(draw < int(_DRAWS * rows / count)), "tuning-queries")
    exact = retrieve.top_k(sample, items, k, key).select(key, "article_id")
    home = vectors(queries.sparkSession, index).select("article_id", F.col("list"))
    ranks = nearest_lists(sample, index, key, len(index.centroids)).select(key, "list", "rank")
    per_rank = exact.join(home, "article_id").join(ranks, [key, "list"]).groupBy("rank").agg(F.count("*").alias("n"))
    found = sorted((r["rank"], r["n"]) for r in per_rank.collect())  # at most one row for each list
    total, seen = sum(n for _, n in found), 0
    for rank, n in found:
        seen += n
        if seen >= recall * total:
            return rank + 1
    return len(index.centroids)


def recall_of(found: DataFrame, exact: DataFrame, key: str) -> float:
    """Share of the exact lists' entries that were found."""
    hits = exact.select(key, "article_id").join(found.select(key, "article_id"), [key, "article_id"], "left_semi").count()
    return hits / max(1, exact.count())
