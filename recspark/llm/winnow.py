"""Benchmark decontamination by winnowed fingerprints.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. A window
is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
window. Of the hashes of all ``gram``-word grams, each run of ``window - gram + 1``
consecutive ones keeps its smallest (the last of equal ones). As the choice depends on
nothing but the run, two texts that share a window share its fingerprint, so no
shared window is missed. Documents keep the windows whose fingerprint occurs in the
benchmark; each such hit is extended to its whole window, and windows meet in an
equi-join on 128-bit hashes. Items shorter than a window are fingerprints themselves.

Documents and items with null or empty text have no words: such a document is
clean, such an item never occurs. Every input row gets one result row, also repeated
rows and rows with a null id; repeated items count once per distinct item id, a
null item id is left out of the list and of the count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm import text as T
from recspark.session import freeze

WINDOW = 10
GRAM = 6
#: Fingerprints of the benchmark are sent to the tasks up to this number (8 bytes each);
#: beyond it documents keep all windows and the join alone decides.
MAX_SENT = 4_000_000

#: Bits of the filter for each fingerprint sent.
_FILTER_BITS = 16

_WINDOW_TYPE = "struct<at:int,words:int,h1:bigint,h2:bigint>"


def _winnowed(grams: np.ndarray, whole: np.ndarray, run: int) -> np.ndarray:
    """For each position: the smallest gram of the ``run`` from there on; needs ``whole`` to be true to count."""
    n = max(0, len(grams) - run + 1)
    best = grams[:n].copy()
    for j in range(1, run):
        np.minimum(best, grams[j : j + n], out=best)
    return best


class Known:
    """A sorted set of fingerprints behind a bit filter, which most others do not pass."""

    def __init__(self, prints: np.ndarray, bits: np.ndarray | None = None):
        self.prints = prints
        size = max(10, int(len(prints) * _FILTER_BITS).bit_length())
        self.shift = np.uint64(64 - size)
        if bits is None:
            there = np.zeros(1 << size, bool)
            there[self._places(prints)] = True
            bits = np.packbits(there, bitorder="little")
        self.bits = bits

    def _places(self, prints: np.ndarray) -> np.ndarray:
        # the smallest hashes of windows crowd at the low end, so they are spread again
        return (prints * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def which(self, prints: np.ndarray) -> np.ndarray:
        """Numbers of the fingerprints that are in the set."""
        at = self._places(prints)
        passed = np.flatnonzero((self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
        if not len(self.prints):
            return passed[:0]
        place = np.minimum(np.searchsorted(self.prints, prints[passed]), len(self.prints) - 1)
        return passed[self.prints[place] == prints[passed]]


def _windows_of(data: np.ndarray, offsets: np.ndarray, window: int, gram: int, lengths: tuple[int, ...], known):
    """(row, word position, words, h1, h2) of the windows with known fingerprints, and the words per row.

    ``lengths`` are the numbers of words below ``window`` to look for as well; ``known`` is None for all.
    """
    w = T.words(data, offsets)
    second = T.span_hashes(T.FOLD[data], w.start, w.end, seed=1)
    rows = len(offsets) - 1
    counts = T.row_counts(w.row, rows)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    found = []
    for size in (*lengths, window):
        whole = T.within_row(w.row, size)
        if size == window:
            prints = _winnowed(T.grams(w.hash, gram), whole, window - gram + 1)[: len(whole)]
        else:
            prints = T.grams(w.hash, size)
        at = np.flatnonzero(whole)
        if known is not None:
            at = at[known.which(prints[at])]
        if not len(at):
            continue
        index = at[:, None] + np.arange(size)
        h1, h2 = T.grams(w.hash[index].reshape(-1), size)[::size], T.grams(second[index].reshape(-1), size)[::size]
        row = w.row[at]
        found.append((row, at - first[row], np.full(len(at), size), h1.view(np.int64), h2.view(np.int64), prints[at]))
    if not found:
        empty = np.zeros(0, np.int64)
        return (empty,) * 5 + (np.zeros(0, np.uint64),), counts
    joined = tuple(np.concatenate(part) for part in zip(*found, strict=True))
    order = np.argsort(joined[0], kind="stable")
    return tuple(part[order] for part in joined), counts


def _item_windows(window: int, gram: int):
    """Arrow map over (item_id, text): one row per window, an item of fewer words as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in T.slices(batch.column(1)):
                w = T.words(data, offsets)
                counts = T.row_counts(w.row, len(offsets) - 1)
                lengths = tuple(sorted({int(c) for c in counts if 0 < c < window}))
                (row, _, size, h1, h2, prints), _ = _windows_of(data, offsets, window, gram, lengths, None)
                mine = size == np.minimum(counts[row], window)
                ids = batch.column(0).slice(low, len(counts)).take(pa.array(row[mine]))
                columns = [ids, *(pa.array(x[mine]) for x in (size, h1, h2)), pa.array(prints[mine].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "words", "h1", "h2", "print"])

    return run


def _document_windows(window: int, gram: int, lengths: tuple[int, ...], known):
    """Arrow map over (id, text): one row per document with its words and its windows with known fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = None if known is None else Known(*known.value)
        for batch in batches:
            for low, data, offsets in T.slices(batch.column(1)):
                (row, at, size, h1, h2, _), counts = _windows_of(data, offsets, window, gram, lengths, prints)
                parts = [pa.array(at, pa.int32()), pa.array(size, pa.int32()), pa.array(h1), pa.array(h2)]
                entries = pa.StructArray.from_arrays(parts, names=["at", "words", "h1", "h2"])
                ends = np.concatenate([[0], np.cumsum(T.row_counts(row, len(counts)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), entries)
                ids = batch.column(0).slice(low, len(counts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts), lists], names=["id", "n_words", "windows"])

    return run


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item, words, h1, h2, print) of every distinct window of every item."""
    kind = benchmark.schema[item].dataType.simpleString()
    made = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).mapInArrow(
        _item_windows(window, gram), f"item {kind}, words bigint, h1 bigint, h2 bigint, print bigint"
    )
    return freeze(made.filter("item is not null").distinct(), "benchmark-windows")


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    max_sent: int = MAX_SENT,
) -> DataFrame:
    """Per document row: its id, n_words, ``spans`` (from, to: merged hit words), n_hit, ``items`` (sorted as strings)."""
    spark = documents.sparkSession
    windows = benchmark_windows(benchmark, item, item_text, window, gram)
    lengths = tuple(sorted(r["words"] for r in windows.filter(F.col("words") < window).select("words").distinct().collect()))
    prints = windows.select("print").distinct()
    known = None
    if prints.count() <= max_sent:
        values = prints.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)
        made = Known(np.sort(values))  # the filter is made once and sent along
        known = spark.sparkContext.broadcast((made.prints, made.bits))
    kind = documents.schema[doc].dataType.simpleString()
    mapped = documents.select(F.col(doc).alias("id"), F.col(text).alias("text")).mapInArrow(
        _document_windows(window, gram, lengths, known), f"id {kind}, n_words bigint, windows array<{_WINDOW_TYPE}>"
    )
    rows = freeze(mapped.withColumn("_row", F.monotonically_increasing_id()), "document-windows")
    candidates = rows.filter(F.size("windows") > 0).select("_row", F.explode("windows").alias("w")).select("_row", "w.*")
    classes = windows.select("words", "h1", "h2").distinct()
    hits = freeze(candidates.join(classes, ["words", "h1", "h2"]), "hits")
    spans = hits.groupBy("_row").agg(F.sort_array(F.collect_set(F.struct("at", "words"))).alias("found"))
    # a window reaches from ``at`` to ``at + words``; sorted windows merge into spans one after another
    merge = F.aggregate(
        "found",
        F.expr("cast(array() as array<struct<from:int,to:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["to"] >= x["at"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["from"].alias("from"),
                        F.greatest(F.get(done, F.size(done) - 1)["to"], x["at"] + x["words"]).alias("to"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["at"].alias("from"), (x["at"] + x["words"]).alias("to"))))),
    )
    spans = spans.select("_row", merge.alias("spans"))
    held = hits.select("_row", "words", "h1", "h2").distinct().join(windows.select("item", "words", "h1", "h2"), ["words", "h1", "h2"])
    items = held.select("_row", F.col("item").cast("string").alias("item")).groupBy("_row").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["to"] - s["from"])
    return (
        rows.select("_row", F.col("id").alias(doc), "n_words")
        .join(spans, "_row", "left")
        .join(items, "_row", "left")
        .select(
            doc,
            "n_words",
            F.coalesce("spans", F.expr("cast(array() as array<struct<from:int,to:int>>)")).alias("spans"),
            F.coalesce(n_hit, F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )
