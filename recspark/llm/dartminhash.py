"""Near-duplicate documents by DartMinHash signatures, banded joins and exact verification.

A text is the weighted set of its five-word shingles; a text of one to four words is one
shingle. The similarity of two texts is the weighted Jaccard similarity: the sum of the smaller
weights over the sum of the greater ones. Every distinct shingle weighs 1, which makes this the Jaccard
similarity of the sets; with ``weighted`` it weighs as often as it occurs, which lets a phrase that
fills two otherwise different texts make them alike.

DartMinHash: every shingle owns a strip of the plane, as wide as its weight. Darts are
thrown at unit cells of it, how many and where is decided by hashing the shingle and
the cell (a Poisson process of rate one), so that texts share the darts of what they share. A
dart has a height, its rank, and a coordinate of the signature. Cells are visited up to
a rank that gives about k ln k + 4k darts in all, and the lowest dart of each coordinate is
kept: two texts agree on a coordinate with the probability of their similarity. Texts with
an empty coordinate are thrown at again, higher up.

Texts that agree on all four coordinates of one of 24 bands are candidates (missed at 0.8 with a
probability under 4 in a million), compared exactly. Within a band's bucket all texts are
compared with one of them, its head, so that a bucket costs as many comparisons as it has
texts. Twice more, texts of a bucket that are in different classes meet another member, drawn by a hash. Where texts of a bucket are then still in different classes, all links between these
texts are found by prefix filtering: similar texts share one of their rarest shingles, and enough after it.

Equal word sequences are one node from the start. Words are runs of letters, digits and
characters beyond ASCII, A-Z lower-cased. Texts without words (null and empty ones too)
form one class of exact copies. Repeated rows are copies of each other. An id may be null or
repeated; each row gets one result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from recspark.llm import text as T
from recspark.llm.components import components
from recspark.llm.tables import bit_filter, discard, stored
from recspark.session import freeze

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
#: Counters of element frequencies, 8 bytes each.
SLOTS = 1 << 21

#: Times that members of different classes in one bucket meet another member before links are completed.
_TURNS = 2
#: 64-bit words of a text's parity sketch.
_SKETCH = 4
#: Cells that are visited at once.
_CELLS = 1 << 18
_U32 = np.uint64(0xFFFFFFFF)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE):
    """Per row: distinct shingles and weights (row, hash, weight), and two hashes of the word sequence."""
    w = T.words(data, offsets)
    rows = len(offsets) - 1
    counts = T.row_counts(w.row, rows)
    whole = T.within_row(w.row, k)
    row, value = w.row[: len(whole)][whole], T.grams(w.hash, k)[whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    first = np.concatenate([[0], np.cumsum(counts)])
    tail = np.array([T.grams(w.hash[first[r] : first[r] + counts[r]], int(counts[r]))[0] for r in short], np.uint64)
    row, value = np.concatenate([row, short]), np.concatenate([value, tail])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.concatenate([at, [len(row)]]))
    keys = []
    for seed in (11, 12):
        place = np.arange(len(w.hash)) - first[w.row]
        parts = T.mix(w.hash ^ T.mix(place.astype(np.uint64) + np.uint64(seed << 32)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
        keys.append(T.mix(total[first[1:]] - total[first[:-1]] + counts.astype(np.uint64)))
    return row[at], value[at], weight, keys[0], keys[1]


#: Poisson(1) by inversion of a 32-bit uniform: the number of darts in a cell is how many of these it passes.
_POISSON = (np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880)]) * 2.0**32).astype(np.uint64)


def _throw(row, value, weight, heights, k: int, seed: int):
    """Darts (row, coordinate, rank, id) below each row's height."""
    cells = weight * np.ceil(heights[row]).astype(np.int64)
    at = np.repeat(np.arange(len(row)), cells)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    across, up = nth % weight[at], nth // weight[at]
    cell = T.mix(value[at] ^ T.mix((across.astype(np.uint64) << np.uint64(32)) + up.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)))
    darts = np.searchsorted(_POISSON, cell >> np.uint64(32), side="right")
    of = np.repeat(np.arange(len(at)), darts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(darts) - darts, darts)
    dart = T.mix(cell[of] + (nth + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    rank = up[of] + (dart >> np.uint64(32)).astype(np.float64) / 2.0**32
    row = row[at[of]]
    low = rank < heights[row]
    coordinate = ((T.mix(dart) & _U32) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
    return row[low], coordinate[low], rank[low], dart[low]


def signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, k: int, seed: int = 1) -> np.ndarray:
    """(rows, k) ids of the lowest darts; rows without shingles keep zeros. Weights are whole numbers, ``row`` ascends.

    Rows are thrown at in groups of about ``_CELLS`` cells, however long or short their texts are.
    """
    total = np.bincount(row, weights=weight, minlength=rows)
    cells = np.cumsum(np.maximum(total, k * np.log(k) + 4 * k) + total)
    ends = np.searchsorted(row, np.arange(rows + 1))
    out, low = np.zeros((rows, k), np.uint64), 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(cells, (cells[low - 1] if low else 0) + _CELLS, side="right")))
        some = slice(ends[low], ends[high])
        out[low:high] = _signatures(row[some] - low, value[some], weight[some], high - low, k, seed)
        low = high
    return out


def _signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, k: int, seed: int) -> np.ndarray:
    out = np.zeros((rows, k), np.uint64)
    total = np.bincount(row, weights=weight, minlength=rows)
    darts = k * np.log(k) + 4 * k
    heights = np.where(total > 0, darts / np.maximum(total, 1), 0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        mine = np.isin(row, todo) if len(todo) < rows else slice(None)
        r, c, rank, dart = _throw(row[mine], value[mine], weight[mine], heights, k, seed)
        slot = r * k + c
        order = np.lexsort((dart, rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        out.reshape(-1)[slot[first]] = dart[first]
        filled = np.bincount(slot[first] // k, minlength=rows)
        todo = todo[filled[todo] < k]
        heights[todo] *= 2
    return out


def _signed(shingle: int, bands: int, per_band: int, weighted: bool):
    """Arrow map over (id, text): content key, elements (32 bits, one per unit of weight) and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in T.slices(batch.column(1)):
                rows = len(offsets) - 1
                row, value, weight, h1, h2 = shingles(data, offsets, shingle)
                weight = weight if weighted else np.ones_like(weight)
                signature = signatures(row, value, weight, rows, bands * per_band)
                keys = np.zeros((rows, bands), np.uint64)
                for b in range(bands):
                    part = np.full(rows, b + 1, np.uint64)
                    for j in range(per_band):
                        part = T.mix(part * np.uint64(31) + signature[:, b * per_band + j])
                    keys[:, b] = part
                has = np.bincount(row, minlength=rows) > 0
                unit = np.repeat(np.arange(len(row)), weight)
                nth = np.arange(len(unit)) - np.repeat(np.cumsum(weight) - weight, weight)
                element = (T.mix(value[unit] + nth.astype(np.uint64)) & _U32).astype(np.uint32).view(np.int32)
                columns = [
                    batch.column(0).slice(low, rows),
                    pa.array(h1.view(np.int64)),
                    pa.array(h2.view(np.int64)),
                    pa.array(np.bincount(row[unit], minlength=rows), pa.int32()),
                    T.lists(element, np.bincount(row[unit], minlength=rows), pa.int32()),
                    T.lists(keys[has].reshape(-1).view(np.int64), np.where(has, bands, 0), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "h1", "h2", "units", "elements", "bands"])

    return run


def _similar(a: pa.Array, b: pa.Array) -> pa.Array:
    """Jaccard similarity of two element lists; elements of a list differ from each other but for rare collisions."""
    out = np.zeros(len(a))
    ends = [(x.offsets.to_numpy(), x.values.to_numpy()) for x in (a, b)]
    for i in range(len(a)):
        x, y = (v[e[i] : e[i + 1]] for e, v in ends)
        shared = len(np.intersect1d(x, y))
        out[i] = shared / max(1, len(x) + len(y) - shared)
    return pa.array(out)


def _close(pairs: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b), a > b, whose sizes do not rule the similarity out: the smaller is at least that share of the greater."""
    fit = F.least("node_units", "other_units") >= similarity * F.greatest("node_units", "other_units") - 1e-9
    return pairs.filter(fit).select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct()


def _verified(pairs: DataFrame, elements: DataFrame, similarity: float) -> DataFrame:
    """Of frozen pairs (a, b) those whose similarity reaches the threshold, frozen with it. Element lists of other nodes stay where they are."""
    able = bit_filter(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")
    elements = elements if able is None else elements.filter(able("node"))
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    scored = both.withColumn("similarity", F.arrow_udf(_similar, ST.DoubleType())("x", "y"))
    return freeze(scored.filter(F.col("similarity") >= similarity - 1e-9).select("a", "b", "similarity"), "links")


def _across(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Of (band, node): the rows of buckets that hold several roots, with the root."""
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo != _hi")
    return rooted.join(mixed.select("band"), "band")


def _met_across(members: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """Pairs (node, other) with their sizes: of buckets with several roots, one member drawn by a hash and all of other roots."""
    across = _across(members, roots)
    drawn = F.min_by(F.struct("node", "root", "node_units"), F.xxhash64("node", F.lit(turn))).alias("head")
    heads = across.groupBy("band").agg(drawn).select("band", "head.*").toDF("band", "other", "other_root", "other_units")
    met = across.join(heads, "band").filter("root != other_root")
    return met.select("node", "other", "node_units", "other_units").distinct()


def _slot_counts(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy() & (slots - 1), minlength=slots)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    return run


_SKETCHED = [f"s{w}" for w in range(_SKETCH)]


def _sketch(elements: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of elements fall on i: two sketches differ in no more bits than the sets in elements."""
    at = T.mix(elements.view(np.uint32).astype(np.uint64)) >> np.uint64(58 - (_SKETCH - 1).bit_length())
    odd = np.bincount(at.astype(np.int64), minlength=64 * _SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _prefixes(counts, similarity: float):
    """Arrow map over (node, root, elements): the rarest elements of a text that may be shared by one similar enough, with its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts.value
        for batch in batches:
            ends, values = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            made = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            sketches = np.zeros((batch.num_rows, _SKETCH), np.int64)
            for i in range(batch.num_rows):
                own = values[ends[i] : ends[i + 1]]
                sketches[i] = _sketch(own)
                often = known[own & (len(known) - 1)]
                first = np.lexsort((own, often))[: len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1]
                at = np.flatnonzero(often[first] > 1)
                made.append((np.full(len(at), i), own[first[at]], at, np.full(len(at), len(own))))
            row, element, place, units = (np.concatenate(x) for x in zip(*made, strict=True))
            columns = [batch.column(c).take(pa.array(row)) for c in (0, 1)]
            columns += [pa.array(element, pa.int32()), pa.array(place, pa.int32()), pa.array(units, pa.int32())]
            columns += [pa.array(sketches[row, w]) for w in range(_SKETCH)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "root", "element", "place", "units", *_SKETCHED])

    return run


def _prefix_pairs(nodes: DataFrame, similarity: float, slots: int = SLOTS) -> DataFrame:
    """Every pair of texts of different roots that is similar enough, and few others.

    Elements are ordered by how often they occur, rare ones first. Of two similar texts the first
    share - similarity plus one element - of the one meets that of the other, and what follows their first
    common element must be enough for the overlap. Both are exact in any order; counts, added up in a fixed
    number of slots, only decide how few other pairs there are. An element that occurs once meets nobody.

    Texts of a large class share their rare elements, and a text that is somewhat like one of them is so to all. Sketches
    tell most of these pairs apart in the join itself: sets differ in at least as many elements as their sketches in bits,
    and sets that are similar enough differ in at most (1 - similarity) / (1 + similarity) of the sum of their sizes.
    """
    spark = nodes.sparkSession
    counted = nodes.select("elements").mapInArrow(_slot_counts(slots), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    counted = counted.toArrow()
    counts = np.zeros(slots, np.int64)
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    sent = spark.sparkContext.broadcast(counts)
    rows = nodes.select("node", "root", "elements").mapInArrow(
        _prefixes(sent, similarity), ", ".join(["node bigint, root bigint, element int, place int, units int", *(f"{c} bigint" for c in _SKETCHED)])
    )
    rows = freeze(rows, "prefixes")
    left = rows.withColumnRenamed("units", "node_units")
    right = rows.select("element", *(F.col(c).alias(f"other_{c}") for c in ("root", "place", "units", *_SKETCHED)), F.col("node").alias("other"))
    both = F.col("node_units") + F.col("other_units")
    enough = F.least(F.col("node_units") - F.col("place"), F.col("other_units") - F.col("other_place")) >= (similarity / (1 + similarity) * both - 1e-9)
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in _SKETCHED)
    near = apart <= (1 - similarity) / (1 + similarity) * both + 1e-9
    met = left.join(right, (left["element"] == right["element"]) & (F.col("root") < F.col("other_root")) & enough & near)
    return met.select("node", "other", "node_units", "other_units")


def classes(
    documents: DataFrame, doc: str = "doc_id", text: str = "text", extra: list[str] | None = None,
    similarity: float = SIMILARITY, shingle: int = SHINGLE, bands: int = BANDS, per_band: int = ROWS,
    weighted: bool = False,
) -> DataFrame:
    """One row per document: its id, ``extra`` columns, ``class_id`` (smallest id of its class) and ``kept`` (one per class).

    Of a class the row with the smallest id is kept, a null id after all others.
    """
    extra = extra or []
    source = documents.select(F.struct(F.col(doc).alias("doc"), *extra).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = source.mapInArrow(
        _signed(shingle, bands, per_band, weighted),
        f"id {kind}, h1 bigint, h2 bigint, units int, elements array<int>, bands array<bigint>",
    )
    signatures_path, rows = stored(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    nodes = rows.groupBy("h1", "h2").agg(F.min("row").alias("node"))
    nodes = freeze(nodes, "nodes")
    # texts of their own stay where they are until it is known which of them meet others
    heads = nodes.select(F.col("node").alias("row"))
    banded = rows.select("row", "units", "bands").join(heads, "row", "left_semi")
    banded = banded.select(F.explode("bands").alias("band"), F.col("row").alias("node"), F.col("units").alias("node_units"))
    shared = banded.groupBy("band").agg(F.min("node").alias("other"), F.count("*").alias("n")).filter("n > 1")
    members = freeze(banded.join(shared.select("band", "other"), "band"), "buckets")
    met = members.filter("node != other").select("node", "other", "node_units").distinct()
    units = rows.select(F.col("row").alias("other"), F.col("units").alias("other_units"))
    tested = freeze(_close(met.join(units, "other"), similarity), "tested")
    wanted = freeze(members.select("node").distinct(), "bucket-nodes")
    able = bit_filter(wanted, "node")
    few = rows.select("row", "elements") if able is None else rows.select("row", "elements").filter(able("row"))
    elements_path, elements = stored(few.select(F.col("row").alias("node"), "elements").join(wanted, "node", "left_semi"), "elements")
    links = _verified(tested, elements, similarity)
    roots = components(links)
    for turn in range(_TURNS):
        more = _close(_met_across(members.select("band", "node", "node_units"), roots, turn), similarity)
        more = freeze(more.join(tested, ["a", "b"], "left_anti"), "met-again")
        if more.isEmpty():
            break
        tested = tested.unionByName(more)
        links = links.unionByName(_verified(more, elements, similarity))
        roots = components(links)
    mixed = freeze(_across(members.select("band", "node"), roots).select("node", "root").distinct(), "mixed")
    if not mixed.isEmpty():
        pairs = _close(_prefix_pairs(freeze(mixed.join(elements, "node"), "open"), similarity), similarity)
        pairs = freeze(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = _verified(pairs, elements, similarity)
        if not found.isEmpty():
            roots = components(links.union(found))
    named = nodes.join(roots, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("root"))
    placed = freeze(rows.select("id", "row", "h1", "h2").join(named, ["h1", "h2"]).drop("h1", "h2"), "placed")
    for path in (signatures_path, elements_path):  # larger than all others; what follows reads ``placed`` only
        discard(source.sparkSession, path)
    first = F.min(F.struct(F.col("id.doc").isNull().alias("last"), F.col("id.doc").alias("doc"), "row"))
    kept = placed.groupBy("root").agg(first.alias("first")).select("root", "first.doc", F.col("first.row").alias("kept_row"))
    joined = placed.join(kept.withColumnRenamed("doc", "class_id"), "root")
    return joined.select(
        F.col("id.doc").alias(doc), *[F.col(f"id.{c}") for c in extra], "class_id", (F.col("row") == F.col("kept_row")).alias("kept")
    )
