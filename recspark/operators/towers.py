"""Both towers trained on labelled pairs, with logistic loss and Adam, over all executors.

An epoch is cut into batches of fixed rows and its batches into steps. In a step all keys pass their tower once, in blocks of
fixed keys, and their unit vectors meet the pairs of the step in cells, one group of customers by one of articles: a vector is
sent once per group of the other side, not once per pair. A cell adds up the gradients of the unit vectors that its pairs
touch. They go to the state, which stays in its buckets, where each block goes back through its tower: that moves the embedding
rows, which grow with the data, with their Adam moments, and gives the gradient of every dense weight. Dense weights, whose
number follows from the architecture, are updated on the driver.

Batches are the same rows in the same order on any cluster, and gradients of pairs and of blocks are added as whole numbers
(times 2^30), so a fit depends on its seed and not on partitions. Moments of an embedding row change only in the steps that touch it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators import batches, encode
from recspark.operators.arrow import to_list_column, to_matrix
from recspark.session import discard, freeze, scratch_path, shuffles_removed

# Learning rate and the constants of Adam.
LEARNING_RATE = 0.001
BETA_1, BETA_2, EPSILON = 0.9, 0.999, 1e-7

STEPS = 4
HELD_OUT = 10  # one batch in so many
_DIM = encode.EMBEDDING_DIM
_FIXED = float(1 << 30)
#: Keys of a block, whose rows pass a tower together; and keys or pairs of a step for which another cell is worth its copies.
_BLOCK, _KEYS_A_CELL, _PAIRS_A_CELL = 4_096, 400_000, 3_000_000
_PAIRS_AT_ONCE = 16_384
#: Unit vectors that a cell keeps (and gradients of the same size), and state of one bucket.
_CELL_BYTES = 512 * 1024 * 1024
_BUCKET_BYTES = 128 * 1024 * 1024
#: The state of an earlier step is removed where it is greater.
_SMALL_STATE_BYTES = 16 * 1024 * 1024
#: Rows that cells meet: customers, articles, pairs; and sums of loss and row count, fitted and held out.
_USER, _ITEM, _PAIR, _LOSS = range(4)
_SIDES = (("user", _USER, "user_index"), ("item", _ITEM, "item_index"))
_SHAPES = {
    encode.CONTEXT: (encode.CONTEXT_DIM, encode.CONTEXT_UNITS),
    encode.HIDDEN: (_DIM + encode.CONTEXT_UNITS, encode.HIDDEN_UNITS),
    encode.OUTPUT: (encode.HIDDEN_UNITS, _DIM),
}

Weights = dict[str, dict[str, encode.Layer]]


class FittedTowers(NamedTuple):
    users: DataFrame  # user_index, context columns, embedding
    items: DataFrame  # item_index, context columns, embedding
    weights: DataFrame  # as encode.load_tower reads them
    losses: list[float]  # held-out loss before the first and after each epoch
    fitted_losses: list[float]  # mean loss of each epoch's batches, each before the step that it was in


def first_weights(seed: int) -> Weights:
    """Uniform start values, narrower for wider layers; biases of 0."""
    rng = np.random.default_rng(seed)

    def layer(inputs: int, units: int) -> encode.Layer:
        reach = np.sqrt(6 / (inputs + units))
        return encode.Layer(rng.uniform(-reach, reach, (inputs, units)), np.zeros(units))

    return {tower: {name: layer(*shape) for name, shape in _SHAPES.items()} for tower, *_ in _SIDES}


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([np.concatenate([w.reshape(-1), b]) for t, *_ in _SIDES for w, b in (weights[t][n] for n in _SHAPES)])


def unflat(values: np.ndarray) -> Weights:
    out, at = {}, 0
    for tower, *_ in _SIDES:
        out[tower] = {}
        for name, (inputs, units) in _SHAPES.items():
            w, at = values[at : at + inputs * units].reshape(inputs, units), at + inputs * units
            out[tower][name], at = encode.Layer(w, values[at : at + units]), at + units
    return out


def as_table(spark: SparkSession, weights: Weights) -> DataFrame:
    """The weights in the layout of the weights table, one row per output unit."""
    rows = [
        (tower, name, j, [float(x) for x in layer.weight[:, j]], float(layer.bias[j]))
        for tower, layers in weights.items()
        for name, layer in layers.items()
        for j in range(layer.weight.shape[1])
    ]
    return spark.createDataFrame(rows, "tower string, layer string, out_unit int, w array<double>, b double")


class _Pass(NamedTuple):
    """What the way back through a tower needs of the way forth."""

    context: np.ndarray
    side: np.ndarray
    inputs: np.ndarray
    hidden: np.ndarray
    length: np.ndarray
    unit: np.ndarray


def forward(layers: dict[str, encode.Layer], vectors: np.ndarray, context: np.ndarray) -> _Pass:
    side = np.maximum(layers[encode.CONTEXT](context), 0.0)
    inputs = np.concatenate([vectors, side], axis=1)
    hidden = np.maximum(layers[encode.HIDDEN](inputs), 0.0)
    out = layers[encode.OUTPUT](hidden)
    length = np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    return _Pass(context, side, inputs, hidden, length, out / length)


def backward(layers: dict[str, encode.Layer], p: _Pass, d_unit: np.ndarray) -> tuple[dict[str, encode.Layer], np.ndarray]:
    """Gradients of the layers and of the embeddings, given that of the unit vectors."""
    d_out = (d_unit - p.unit * (p.unit * d_unit).sum(1, keepdims=True)) / p.length
    d_hidden = (d_out @ layers[encode.OUTPUT].weight.T) * (p.hidden > 0)
    d_inputs = d_hidden @ layers[encode.HIDDEN].weight.T
    d_side = d_inputs[:, _DIM:] * (p.side > 0)
    grads = {
        encode.CONTEXT: encode.Layer(p.context.T @ d_side, d_side.sum(0)),
        encode.HIDDEN: encode.Layer(p.inputs.T @ d_hidden, d_hidden.sum(0)),
        encode.OUTPUT: encode.Layer(p.hidden.T @ d_out, d_out.sum(0)),
    }
    return grads, d_inputs[:, :_DIM]


def loss_and_gradients(weights: Weights, users: np.ndarray, user_context: np.ndarray, items: np.ndarray, item_context: np.ndarray, label: np.ndarray):
    """Summed logistic loss of the pairs' inner products, and its gradients."""
    u, i = forward(weights["user"], users, user_context), forward(weights["item"], items, item_context)
    logit = (u.unit * i.unit).sum(1)
    loss = np.maximum(logit, 0) - logit * label + np.log1p(np.exp(-np.abs(logit)))
    d_logit = (1 / (1 + np.exp(-logit)) - label)[:, None]
    user_grads, d_users = backward(weights["user"], u, d_logit * i.unit)
    item_grads, d_items = backward(weights["item"], i, d_logit * u.unit)
    return float(loss.sum()), {"user": user_grads, "item": item_grads}, d_users, d_items


def _fixed(values: np.ndarray) -> np.ndarray:
    return np.rint(values * _FIXED).astype(np.int64)


def _dense_of(grads: dict[str, encode.Layer]) -> np.ndarray:
    return np.concatenate([np.concatenate([grads[n].weight.reshape(-1), grads[n].bias]) for n in _SHAPES])


def _tower(kind: int) -> str:
    return next(side for side, k, _ in _SIDES if k == kind)


def _unit_rows(shared):
    """Unit vectors of one block of keys."""

    def run(key, table):
        table = table.sort_by("index")
        parts = [to_matrix(table.column(c).combine_chunks(), n) for c, n in (("embedding", _DIM), ("context", encode.CONTEXT_DIM))]
        unit = forward(unflat(shared.value)[_tower(key[0].as_py())], *parts).unit
        return table.select(["kind", "block", "index"]).append_column("unit", to_list_column(unit, pa.float64()))

    return run


class _Cell:
    """Vectors of one group of customers and one of articles, and the whole-number gradients of those that pairs touch."""

    def __init__(self, vectors: dict[int, list[tuple[np.ndarray, np.ndarray]]]) -> None:
        self.keys, self.units, self.sums, self.touched = {}, {}, {}, {}
        self.told = np.zeros(4, np.int64)
        for _, kind, _ in _SIDES:
            parts = vectors[kind] or [(np.zeros(0, np.int64), np.zeros((0, _DIM)))]
            keys = np.concatenate([k for k, _ in parts])
            order = np.argsort(keys, kind="stable")
            self.keys[kind] = keys[order]
            self.units[kind] = np.concatenate([u for _, u in parts])[order]
            self.sums[kind] = np.zeros(self.units[kind].shape, np.int64)
            self.touched[kind] = np.zeros(len(keys), bool)
            parts.clear()

    def add(self, users: np.ndarray, items: np.ndarray, label: np.ndarray, held: np.ndarray) -> None:
        at = {kind: np.searchsorted(self.keys[kind], keys) for kind, keys in ((_USER, users), (_ITEM, items))}
        u, i = (self.units[kind][at[kind]] for kind in (_USER, _ITEM))
        logit = (u * i).sum(1)
        loss = _fixed(np.maximum(logit, 0) - logit * label + np.log1p(np.exp(-np.abs(logit))))
        self.told += [loss[~held].sum(), (~held).sum(), loss[held].sum(), held.sum()]
        d_logit = (1 / (1 + np.exp(-logit)) - label)[~held, None]
        for kind, other in ((_USER, i), (_ITEM, u)):
            place = at[kind][~held]
            if len(place):
                order = np.argsort(place, kind="stable")
                met, first = np.unique(place[order], return_index=True)
                self.sums[kind][met] += np.add.reduceat(_fixed(d_logit * other[~held])[order], first, axis=0)
                self.touched[kind][met] = True

    def rows(self) -> Iterator[pa.RecordBatch]:
        for _, kind, _ in _SIDES:
            met = np.flatnonzero(self.touched[kind])
            for begin in range(0, len(met), _BLOCK):
                some = met[begin : begin + _BLOCK]
                yield _sums_batch(kind, self.keys[kind][some], self.sums[kind][some])
        yield _sums_batch(_LOSS, np.zeros(1, np.int64), self.told[None, :])


def _sums_batch(kind: int, keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys // _BLOCK), pa.array(keys), to_list_column(sums, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "block", "index", "sums"])


def _meet(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells one after the other: their vectors first, then their pairs."""
    at, vectors, cell = None, {_USER: [], _ITEM: []}, None
    for batch in batches_:
        cells, kinds = (batch.column(c).to_numpy() for c in ("cell", "kind"))
        starts = [0, *(np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1), batch.num_rows]
        for first, end in zip(starts, starts[1:], strict=False):
            if first == end:
                continue
            if cells[first] != at:
                if cell:
                    yield from cell.rows()
                at, vectors, cell = cells[first], {_USER: [], _ITEM: []}, None
            run_of = batch.slice(first, end - first)
            if kinds[first] != _PAIR:
                vectors[kinds[first]].append((run_of.column("index").to_numpy().copy(), to_matrix(run_of.column("unit"), _DIM).copy()))
                continue
            cell = cell or _Cell(vectors)
            columns = [run_of.column(c).to_numpy(zero_copy_only=False) for c in ("index", "other", "label", "held")]
            for begin in range(0, len(columns[0]), _PAIRS_AT_ONCE):
                cell.add(*(c[begin : begin + _PAIRS_AT_ONCE] for c in columns))
    if cell:
        yield from cell.rows()


def grid_of(tasks: int, users: int, items: int, pairs: int) -> tuple[int, int]:
    """(customer groups, article groups) of the cells: as few copied vectors as their work and the memory of a cell allow."""
    row, tasks = 8 * _DIM, max(1, min(tasks, max(-(-(users + items) // _KEYS_A_CELL), -(-pairs // _PAIRS_A_CELL))))
    best = None
    for across in range(1, max(tasks, -(-4 * items * row // _CELL_BYTES)) + 1):
        room = _CELL_BYTES - -(-items // across) * row
        if room < _BLOCK * row:
            continue
        down = max(1, -(-tasks // across), -(-users * row // room))
        copies = users * across + items * down
        best = min(best or (copies, down, across), (copies, down, across))
    return best[1:]


def _sums(state: DataFrame, pairs: DataFrame, values: np.ndarray, grid: tuple[int, int]) -> DataFrame:
    """(kind, block, index, sums): gradients of the unit vectors that pairs touch, and losses, not yet added up over cells.

    A vector is copied once per group of the other side, however many pairs it has.
    """
    return _met(state, pairs, values, grid).mapInArrow(_meet, "kind int, block bigint, index bigint, sums array<bigint>")


def _met(state: DataFrame, pairs: DataFrame, values: np.ndarray, grid: tuple[int, int]) -> DataFrame:
    """Vectors and pairs, each in the partitions of its cells."""
    down, across = grid
    shared = state.sparkSession.sparkContext.broadcast(values)
    units = state.select("kind", "block", "index", "context", "embedding").groupBy("kind", "block")
    units = units.applyInArrow(_unit_rows(shared), "kind int, block bigint, index bigint, unit array<double>")
    cell = lambda user_block, item_block: F.pmod(user_block, F.lit(down)) * across + F.pmod(item_block, F.lit(across))
    is_user, block = F.col("kind") == _USER, F.col("block")
    copies = F.sequence(F.lit(0), F.when(is_user, across - 1).otherwise(down - 1))
    vectors = units.withColumn("_other", F.explode(copies)).select(
        F.when(is_user, cell(block, F.col("_other"))).otherwise(cell(F.col("_other"), block)).cast("int").alias("cell"), "kind", "index",
        F.lit(0).cast("bigint").alias("other"), F.lit(0.0).alias("label"), F.lit(False).alias("held"), "unit",
    )
    asked = pairs.select(
        cell(_block("user_index"), _block("item_index")).cast("int").alias("cell"), F.lit(_PAIR).alias("kind"), F.col("user_index").alias("index"),
        F.col("item_index").alias("other"), F.col("label").cast("double").alias("label"), "held", F.array().cast("array<double>").alias("unit"),
    )
    return vectors.unionByName(asked).repartitionById(down * across, F.col("cell")).sortWithinPartitions("cell", "kind")


def _block(index: str) -> Column:
    return F.floor(F.col(index) / _BLOCK).cast("bigint")


def _start(table: DataFrame, index: str, context: tuple[str, str], seed: int) -> DataFrame:
    """State of one side: context, embedding by hash within 0.05 of 0, moments of 0."""
    value = lambda i: (F.pmod(F.xxhash64(F.col(index), i, F.lit(f"{index}-{seed}")), F.lit(1 << 24)) / float(1 << 24) - 0.5) * 0.1
    zero = F.array_repeat(F.lit(0.0), _DIM)
    logs = F.array(*(F.log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in context))
    return table.select(
        index, *context, logs.alias("context"), F.transform(F.sequence(F.lit(0), F.lit(_DIM - 1)), value).alias("embedding"), zero.alias("m"), zero.alias("v")
    )


def _stepped(value: np.ndarray, m: np.ndarray, v: np.ndarray, grad: np.ndarray, rate: float, step: int):
    m = BETA_1 * m + (1 - BETA_1) * grad
    v = BETA_2 * v + (1 - BETA_2) * grad * grad
    scaled = rate * np.sqrt(1 - BETA_2**step) / (1 - BETA_1**step)
    return value - scaled * m / (np.sqrt(v) + EPSILON), m, v


_STATE = "kind int, block bigint, index bigint, context array<double>, embedding array<double>, m array<double>, v array<double>, dense array<bigint>"
_NAMES = ("kind", "block", "index", "context", "embedding", "m", "v", "dense")


def _update(shared, rows: int, rate: float, step: int):
    """One block of keys and the gradients that cells sent for it: rows that the step touched, moved, the others as they
    were, and a row of whole-number gradients of the dense weights. Losses only are added up."""

    def told(kind: int, block: int, sums: np.ndarray) -> pa.Table:
        row = dict.fromkeys(_NAMES) | {"kind": kind, "block": block, "dense": sums.tolist()}
        return pa.Table.from_pylist([row], schema)

    whole = [pa.list_(pa.float64())] * 4
    schema = pa.schema(list(zip(_NAMES, [pa.int32(), pa.int64(), pa.int64(), *whole, pa.list_(pa.int64())], strict=True)))

    def run(key, state, sums):
        kind, block = (k.as_py() for k in key)
        if kind == _LOSS:
            return told(kind, block, to_whole(sums).sum(0))
        state = state.sort_by("index").append_column("dense", pa.nulls(len(state), pa.list_(pa.int64())))
        if not len(sums):
            return state.cast(schema)
        index = sums.column("index").to_numpy()
        order = np.argsort(index, kind="stable")
        keys, first = np.unique(index[order], return_index=True)
        gradient = np.add.reduceat(to_whole(sums)[order], first, axis=0) / _FIXED
        met = np.searchsorted(state.column("index").to_numpy(), keys)
        columns = {c: to_matrix(state.column(c).combine_chunks(), _DIM).copy() for c in ("embedding", "m", "v")}
        context = to_matrix(state.column("context").combine_chunks(), encode.CONTEXT_DIM)
        layers = unflat(shared.value)[_tower(kind)]
        dense, gradient = backward(layers, forward(layers, columns["embedding"][met], context[met]), gradient)
        moved = _stepped(*(columns[c][met] for c in ("embedding", "m", "v")), gradient / rows, rate, step)
        for name, new in zip(("embedding", "m", "v"), moved, strict=True):
            columns[name][met] = new
            state = state.set_column(state.schema.get_field_index(name), name, to_list_column(columns[name], pa.float64()))
        return pa.concat_tables([state.cast(schema), told(kind, block, _fixed(_dense_of(dense)))])

    return run


def to_whole(sums: pa.Table) -> np.ndarray:
    return sums.column("sums").combine_chunks().flatten().to_numpy().reshape(len(sums), -1)


def _stored(state: DataFrame, buckets: int) -> tuple[str, DataFrame]:
    """(path, table) in buckets of blocks, so that a step sends gradients to the state and not the state to the gradients."""
    spark = state.sparkSession
    path = scratch_path(spark, "tower-state")
    with shuffles_removed(spark):
        state.write.bucketBy(buckets, "kind", "block").sortBy("kind", "block").option("path", path).saveAsTable(_name_of(path))
    return path, spark.table(_name_of(path))


def _name_of(path: str) -> str:
    return "tower_state_" + path.rsplit("-", 1)[-1]


def _forget(spark: SparkSession, path: str) -> None:
    """Remove the state of an earlier step, so that the disk holds two large ones at most."""
    spark.sql(f"DROP TABLE {_name_of(path)}")
    discard(spark, path)


def _added(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each kind of sums that a partition holds."""
    total: dict[int, np.ndarray] = {}
    for batch in batches_:
        for kind, dense in zip(batch.column("kind").to_pylist(), batch.column("dense"), strict=True):
            total[kind] = total.get(kind, 0) + dense.values.to_numpy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([t.tolist() for t in total.values()], pa.list_(pa.int64()))], names=["kind", "dense"]
    )


def _told(sums: DataFrame) -> dict[int, np.ndarray]:
    """Sums of losses and dense weights, whose number follows from the architecture."""
    found: dict[int, np.ndarray] = {}
    with shuffles_removed(sums.sparkSession):
        rows = sums.mapInArrow(_added, "kind int, dense array<bigint>").collect()
    for row in rows:
        found[row["kind"]] = found.get(row["kind"], 0) + np.array(row["dense"], np.int64)
    return found


def fit_towers(
    examples: DataFrame, users: DataFrame, items: DataFrame, epochs: int = 1, steps: int = STEPS, rate: float = LEARNING_RATE,
    seed: int = 42, batch_rows: int = batches.BATCH_SIZE,
) -> FittedTowers:
    """Towers fitted to ``(user_index, item_index, label)``.

    ``users`` and ``items`` hold one row per index with its two context columns; null contexts count as 0. One batch in
    ``HELD_OUT`` takes no part in the fit and measures its loss. ``steps`` updates are made in an epoch, each from the mean
    gradient of all batches of that step.
    """
    spark = examples.sparkSession
    numbered = batches.training_batches(examples, batch_rows, True, seed)
    for table, (_, _, index) in zip((users, items), _SIDES, strict=True):
        numbered = numbered.join(table.select(index), index, "left_semi")
    held = F.col("batch_id") % HELD_OUT == HELD_OUT - 1
    step_of = F.when(~held, F.floor(F.col("batch_id") / HELD_OUT) % steps)
    numbered = freeze(numbered.select("user_index", "item_index", "label", held.alias("held"), step_of.alias("step")), "tower-batches")
    rows_of = {r["step"]: r["n"] for r in numbered.groupBy("step").agg(F.count("*").alias("n")).collect()}  # one row a step
    contexts = (("customer_total_purchases", "customer_avg_price"), ("item_total_purchases", "item_avg_price"))
    starts = [freeze(_start(t, s[2], c, seed), f"{s[0]}-start") for t, s, c in zip((users, items), _SIDES, contexts, strict=True)]
    keyed = [
        t.filter(F.col(index).isNotNull()).select(
            F.lit(kind).alias("kind"), _block(index).alias("block"), F.col(index).cast("bigint").alias("index"), "context", "embedding", "m", "v"
        )
        for t, (_, kind, index) in zip(starts, _SIDES, strict=True)
    ]
    counts = [t.count() for t in keyed]
    tasks = spark.sparkContext.defaultParallelism
    grid = grid_of(tasks, *counts, max(rows_of.values(), default=0))
    buckets = max(min(tasks, -(-sum(counts) // _BLOCK)), -(-sum(counts) * 24 * _DIM // _BUCKET_BYTES), 1)
    state = keyed[0].unionByName(keyed[1]).withColumn("dense", F.lit(None).cast("array<bigint>"))
    large = sum(counts) * 24 * _DIM > _SMALL_STATE_BYTES
    at, state = _stored(state.repartition(buckets, "kind", "block"), buckets)
    values = flat(first_weights(seed))
    m, v = np.zeros_like(values), np.zeros_like(values)

    def mean(told: np.ndarray) -> float:
        return told[0] / _FIXED / told[1] if told[1] else float("nan")

    def held_out_loss() -> float:
        sums = _sums(state, numbered.filter("held"), values, grid).filter(F.col("kind") == _LOSS)
        return mean(_told(sums.select("kind", F.col("sums").alias("dense"))).get(_LOSS, np.zeros(4, np.int64))[2:])

    losses, fitted_losses, step = [], [], 0
    for epoch in range(epochs):
        loss = rows_of_epoch = 0
        for part in range(steps):
            number = (part + epoch) % steps
            rows_met = rows_of.get(number, 0)
            first = len(losses) == epoch  # the loss at the start of the epoch is measured in the pass of its first step
            if not rows_met:
                continue
            step += 1
            sums = _sums(state, numbered.filter((F.col("step") == number) | (F.col("held") & F.lit(first))), values, grid)
            dealt = sums.repartition(buckets, "kind", "block").groupBy("kind", "block")
            moved = state.drop("dense").groupBy("kind", "block").cogroup(dealt)
            shared = spark.sparkContext.broadcast(values)
            before, (at, stored) = at, _stored(moved.applyInArrow(_update(shared, rows_met, rate, step), _STATE), buckets)
            if large:
                _forget(spark, before)
            told, state = _told(stored.filter("dense is not null").select("kind", "dense")), stored.filter("dense is null")
            if first:
                losses.append(mean(told[_LOSS][2:]))
            loss, rows_of_epoch = loss + told[_LOSS][0] / _FIXED, rows_of_epoch + rows_met
            grad = np.concatenate([told.get(kind, 0) for _, kind, _ in _SIDES]) / (_FIXED * rows_met)
            values, m, v = _stepped(values, m, v, grad, rate, step)
        if len(losses) == epoch:  # no step had rows
            losses.append(held_out_loss())
        fitted_losses.append(loss / rows_of_epoch if rows_of_epoch else float("nan"))
    losses.append(held_out_loss())

    def moved_side(start: DataFrame, kind: int, index: str) -> DataFrame:
        last = state.filter(F.col("kind") == kind).select(F.col("index").alias("_index"), F.col("embedding").alias("_moved"))
        joined = start.join(last, F.col(index) == F.col("_index"), "left").withColumn("embedding", F.coalesce("_moved", "embedding"))
        return joined.drop("m", "v", "context", "_index", "_moved")

    users, items = (freeze(moved_side(t, kind, index), f"{side}-state") for t, (side, kind, index) in zip(starts, _SIDES, strict=True))
    if large:
        _forget(spark, at)
    return FittedTowers(users, items, as_table(spark, unflat(values)), losses, fitted_losses)
