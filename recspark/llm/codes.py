"""Vectors compressed into short codes: product quantisation with norm-of-sum bounds.

A vector is cut into equal parts; each part position has a codebook, learnt by rounds of
assigning every part to its nearest entry and moving entries to the mean of their parts. All arithmetic
is on integers, so a result does not hang on partitions or on the order of sums.

Most distances are never computed. A row keeps, per part, an upper bound of the distance to its
own entry and one lower bound for each group of entries, all with the round in which they were exact.
Every earlier codebook is retained, so a bound of round T is carried to round t by the net
displacement of the entries between the two: ``|c_t - c_T|``. That is never more than the sum of the
steps in between, which bounds without a stamp would have to add up. Only a group that the bounds
cannot rule out is scanned again.

Rows and their bounds live in a table in the shared folder, one per round; the one before is removed once its
successor is complete. The driver holds codebooks (``parts x entries x part size`` numbers for each round) and
sums of that size, whatever the number of rows.

Rows whose vector is null, holds a null or non-finite component, or has another length than the rest are dropped.
"The rest" is the length of the vector with the smallest id among the lengths that can be cut, unless ``size``
names it. Repeated rows are coded each; equal distances go to the lower entry. A null id is coded, but starts no
codebook entry. With fewer rows than ``entries`` the codebooks are smaller; an empty table gives no rows. Other
columns are ignored. A component of 2^18 or more in size ends the job, as its square would not fit.
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

from recspark.functions.vectors import is_finite
from recspark.llm.tables import discard, stored
from recspark.operators.arrow import to_matrix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
GROUPS = 16

_LARGEST = 1 << 28
#: Under this size sums of products of 64 components are whole numbers in double precision.
_EXACT = 1 << 22
#: A label with this share of the rows is looked up by broadcast, so there are at most 1 / share of them.
_HOT = 0.001
#: Squared distance to an entry that does not exist.
_FAR = 1 << 60


class Codebooks(NamedTuple):
    """``history[t]`` has the entries that round t assigns to, shape (parts, entries, part size)."""

    history: list[np.ndarray]
    group: np.ndarray  # (parts, entries): group of each entry

    def flat(self) -> list[int]:
        return self.history[-1].reshape(-1).tolist()


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    scaled = np.floor(vectors * float(scale))
    if scaled.size and np.abs(scaled).max() >= _LARGEST:
        raise ValueError(f"components must stay under {_LARGEST // scale} in size")
    return scaled.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exactly; in double precision where nothing can be rounded."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < _EXACT and a.shape[1] <= 64:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return (a * a).sum(1)[:, None] - 2 * products(a, b) + (b * b).sum(1)[None, :]


def usable(vector: Column) -> Column:
    return F.coalesce(vector.isNotNull() & is_finite(vector), F.lit(False))


def _size_of(rows: DataFrame, parts: int) -> int:
    n = F.size("v")
    return rows.filter((n > 0) & (n % parts == 0)).agg(F.min_by(n, F.struct(F.col("id").isNull(), "id", n))).first()[0] or 0


def _groups(entries: np.ndarray, groups: int) -> np.ndarray:
    """Entries of one codebook in groups of neighbours; any grouping gives the same codes."""
    groups = max(1, min(groups, len(entries)))
    centres = entries[:: max(1, len(entries) // groups)][:groups]
    for _ in range(5):
        of = squared(entries, centres).argmin(1)
        centres = np.array([entries[of == g].sum(0) // max(1, (of == g).sum()) for g in range(len(centres))])
    return squared(entries, centres).argmin(1)


class _Bounds(NamedTuple):
    """State of one part of a batch: own entry, and whole-number bounds with the rounds they date from."""

    entry: np.ndarray  # (n)
    upper: np.ndarray  # (n), not less than the distance to the own entry in round ``upper_at``
    upper_at: np.ndarray
    lower: np.ndarray  # (n, groups), not more than the distance to any other entry of the group
    lower_at: np.ndarray


def _moved(history: list[np.ndarray], part: int) -> np.ndarray:
    """(round, entry): net displacement from each round's entry to the newest, rounded up."""
    steps = np.stack([book[part] for book in history]) - history[-1][part]
    return np.sqrt((steps * steps).sum(2).astype(np.float64)) * (1 + 1e-12)


def first_bounds(x: np.ndarray, book: np.ndarray, group: np.ndarray, groups: int) -> _Bounds:
    """Full scan: nothing is known yet."""
    n = len(x)
    zero, none = np.zeros(n, np.int64), np.zeros((n, groups), np.int64)
    return _rescan(x, book, group, _Bounds(zero, zero, zero, none, none), none.astype(float), np.ones((n, groups), bool), 0)


def next_bounds(x: np.ndarray, history: list[np.ndarray], part: int, group: np.ndarray, held: _Bounds) -> tuple[_Bounds, int]:
    """State in the newest round, and the number of rows that needed an exact look."""
    now, book = len(history) - 1, history[-1][part]
    moved = _moved(history, part)
    groups = held.lower.shape[1]
    furthest = np.stack([moved[:, group == g].max(1, initial=0) for g in range(groups)], axis=1)
    lower = held.lower - furthest[held.lower_at, np.arange(groups)]
    upper = held.upper + moved[held.upper_at, held.entry]
    rows = np.flatnonzero((lower <= upper[:, None]).any(1))
    some = _Bounds(*(f[rows] for f in held))
    step = x[rows] - book[some.entry]
    own = np.sqrt((step * step).sum(1))  # tightens the upper bound before any group is scanned
    found = _rescan(x[rows], book, group, some, lower[rows], lower[rows] <= own[:, None], now)
    out = _Bounds(*(f.copy() for f in held))
    for mine, theirs in zip(out, found, strict=True):
        mine[rows] = theirs
    return out, len(rows)


def _rescan(x: np.ndarray, book: np.ndarray, group: np.ndarray, held: _Bounds, carried: np.ndarray, scan: np.ndarray, now: int) -> _Bounds:
    """Exact distances to the entries of the groups to ``scan``; the other groups are known to be further than the own entry.

    ``carried`` has the lower bounds of ``held`` moved to this round.
    """
    n, groups = scan.shape
    step = x - book[held.entry]
    own = (step * step).sum(1)
    best, entry = own.copy(), held.entry.copy()
    lower, lower_at = held.lower.copy(), held.lower_at.copy()
    least, second, nearest = (np.zeros((n, groups), np.int64) for _ in range(3))
    scan = scan & np.isin(np.arange(groups), group)
    for g in range(groups):
        rows, members = np.flatnonzero(scan[:, g]), np.flatnonzero(group == g)
        if not len(rows):
            continue
        d, at = squared(x[rows], book[members]), np.arange(len(rows))
        first = d.argmin(1)
        found, name = d[at, first], members[first]
        d[at, first] = _FAR
        least[rows, g], second[rows, g], nearest[rows, g] = found, d.min(1), name
        nearer = (found < best[rows]) | ((found == best[rows]) & (name < entry[rows]))
        best[rows] = np.where(nearer, found, best[rows])
        entry[rows] = np.where(nearer, name, entry[rows])
    r, g = np.nonzero(scan)
    others = np.where(nearest[r, g] == entry[r], second[r, g], least[r, g])
    lower[r, g] = np.floor(np.sqrt(others.astype(np.float64)))
    lower_at[r, g] = now
    # an entry that is left behind in a group that was not scanned counts for that group's bound again
    left = np.flatnonzero((entry != held.entry) & ~scan[np.arange(n), group[held.entry]])
    behind = group[held.entry[left]]
    lower[left, behind] = np.floor(np.minimum(carried[left, behind], np.sqrt(own[left])))
    lower_at[left, behind] = now
    return _Bounds(entry, np.ceil(np.sqrt(best)).astype(np.int64), np.full(n, now), lower, lower_at)


_INTS = T.ArrayType(T.IntegerType())
_WIDE = T.ArrayType(T.LongType())
_STATE = ["x", "entry", "upper", "upper_at", "lower", "lower_at"]


def _list_of(matrix: np.ndarray, kind=pa.int32()) -> pa.Array:
    n, width = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, max(1, width), dtype=np.int32)[: n + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1)).cast(kind))


def _ints(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _assigner(spark: SparkSession, books: Codebooks, size: int, scale: int, last: bool):
    """Map over rows: the newest round's entries and bounds, or the final codes."""
    parts, entries, width = books.history[0].shape
    groups = int(books.group.max()) + 1
    shared = spark.sparkContext.broadcast((books.history, books.group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history, group = shared.value
        for batch in batches:
            started = "entry" in batch.schema.names
            x = _ints(batch.column("x"), size) if started else whole(to_matrix(batch.column("v"), size), scale)
            state = {name: _ints(batch.column(name), parts * (groups if "lower" in name else 1)) for name in _STATE[1:]} if started else {}
            made, error = [], np.zeros(len(x), np.int64)
            for p in range(parts):
                xp = x[:, p * width : (p + 1) * width]
                if started:
                    one = [state[name][:, p] for name in ("entry", "upper", "upper_at")]
                    held = _Bounds(*one, *(state[name][:, p * groups : (p + 1) * groups] for name in ("lower", "lower_at")))
                    found, _ = next_bounds(xp, history, p, group[p], held)
                else:
                    found = first_bounds(xp, history[0][p], group[p], groups)
                made.append(found)
                step = xp - history[-1][p][found.entry]
                error += (step * step).sum(1)
            keys = [batch.column("id"), batch.column("label")]
            entry = np.stack([m.entry for m in made], axis=1)
            if last:
                code = np.char.mod("%02x", entry)
                text = code[:, 0] if parts else np.zeros(len(x), "U1")
                for p in range(1, parts):
                    text = np.char.add(text, code[:, p])
                yield pa.RecordBatch.from_arrays([*keys, pa.array(text.tolist(), pa.string()), pa.array(error)], names=["id", "label", "code", "error"])
                continue
            columns = [x, entry, *(np.stack([getattr(m, f) for m in made], axis=1) for f in ("upper", "upper_at"))]
            columns += [np.concatenate([getattr(m, f) for m in made], axis=1) for f in ("lower", "lower_at")]
            yield pa.RecordBatch.from_arrays([*keys, *(_list_of(np.minimum(c, 2**31 - 1)) for c in columns)], names=["id", "label", *_STATE])

    return run


def _mean_entries(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries moved to the floor of the mean of their parts. A task sends one row for each entry that it met."""
    parts, entries, width = books.shape
    names = [f"s{i}" for i in range(width)]
    schema = T.StructType([T.StructField("slot", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("n", *names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            x, entry = _ints(batch.column("x"), parts * width), _ints(batch.column("entry"), parts)
            for p in range(parts):
                order = np.argsort(entry[:, p], kind="stable")
                met, first, count = np.unique(entry[order, p], return_index=True, return_counts=True)
                if len(met):
                    total[p * entries + met] += np.add.reduceat(x[order, p * width : (p + 1) * width], first, axis=0)
                    n[p * entries + met] += count
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(n[met]), *(pa.array(total[met, i]) for i in range(width))], names=schema.names
        )

    sums = state.select("x", "entry").mapInArrow(run, schema).groupBy("slot").agg(*(F.sum(c).alias(c) for c in ("n", *names)))
    moved = books.copy().reshape(parts * entries, width)
    for row in sums.collect():  # at most parts x entries rows
        moved[row["slot"]] = [row[c] // row["n"] for c in names]
    return moved.reshape(books.shape)


class Codes(NamedTuple):
    table: DataFrame  # id, label, code, error
    codebooks: Codebooks


def fit_codes(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    size: int | None = None,
    groups: int = GROUPS,
) -> Codes:
    """Codes of all usable rows and every round's codebooks."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    rows = rows.filter(usable(F.col("v")))
    size = _size_of(rows, parts) if size is None else size
    keys = [rows.schema["id"], rows.schema["label"]]
    done = T.StructType([*keys, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    rows = rows.filter(F.size("v") == size)
    start = rows.filter(F.col("id").isNotNull()).orderBy("id", "v").limit(entries).select("v").collect()
    if not size or not start:
        none = Codebooks([np.zeros((parts, 0, size // parts), np.int64)], np.zeros((parts, 0), np.int64))
        return Codes(spark.createDataFrame([], done), none)
    x = whole(np.array([r["v"] for r in start], np.float64), scale).reshape(len(start), parts, size // parts)
    book = np.ascontiguousarray(x.transpose(1, 0, 2))
    books = Codebooks([book], np.stack([_groups(b, groups) for b in book]))
    state_schema = T.StructType([*keys, *(T.StructField(c, _INTS) for c in _STATE)])
    state, before = rows.select("id", "label", "v"), None
    for t in range(rounds):
        path, state = stored(state.mapInArrow(_assigner(spark, books, size, scale, False), state_schema), f"codes-{t}")
        if before:
            discard(spark, before)
        before = path
        books = books._replace(history=[*books.history, _mean_entries(state, books.history[-1])])
    _, table = stored(state.mapInArrow(_assigner(spark, books, size, scale, True), done), "codes")
    if before:
        discard(spark, before)
    return Codes(table, books)


def with_label_errors(table: DataFrame) -> DataFrame:
    """``label_error`` on every row: its label's total, nulls being one label.

    Labels with a thousandth of the rows or more, of which there are a thousand at most, are broadcast; the
    others meet their totals in a join in which no key has more rows than that.
    """
    sums = table.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    _, sums = stored(sums.withColumnRenamed("label", "_label"), "label-errors")
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") >= F.lit(total * _HOT)
    same = F.col("label").eqNullSafe(F.col("_label"))
    often = sums.filter(hot).withColumn("_hot", F.lit(True))
    marked = table.join(F.broadcast(often), same, "left")
    kept = [*table.columns, "label_error"]
    rare = marked.filter("_hot IS NULL").select(*table.columns).join(sums.filter(~hot), same).select(*kept)
    return marked.filter("_hot").select(*kept).unionByName(rare)


def compress(df: DataFrame, **options) -> DataFrame:
    """id, code, error, label_error and the digest of all final codebooks, for every usable row; see ``fit_codes``."""
    made = fit_codes(df, **options)
    digest = hashlib.sha256(",".join(map(str, made.codebooks.flat())).encode()).hexdigest()
    out = with_label_errors(made.table).withColumn("codebooks_sha256", F.lit(digest))
    return out.select(F.col("id").alias(options.get("vec_id", "vec_id")), "code", "error", "label_error", "codebooks_sha256")


def decode(codebooks: Codebooks, codes: list[str], scale: int = SCALE) -> np.ndarray:
    """The vectors that codes stand for."""
    book = codebooks.history[-1]
    entry = np.array([[int(c[2 * p : 2 * p + 2], 16) for p in range(len(book))] for c in codes], np.int64).reshape(-1, len(book))
    return (np.concatenate([book[p][entry[:, p]] for p in range(len(book))], axis=1) + 0.5) / scale
