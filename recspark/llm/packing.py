"""Packing of tokenised documents into sequences by a configuration linear program.

A document is its token ids and an end id. Only a document longer than a sequence is
cut: its pieces are whole sequences, but for the first, which takes what is left over.
How many pieces there are of each length is all the plan needs, and that histogram has
no more entries than a sequence has tokens. A configuration says how many pieces of each
length share one sequence. The linear program over all configurations (cover every
length as often as it occurs, with as few sequences as possible) is solved by
multiplicative weights: lengths covered less weigh more, and a knapsack dynamic program
finds the heaviest configurations for the weights. Steps are rounded down to whole
sequences. Rounds go on while a full sequence can be made of what is not covered yet; the
rest, about a hundredth, is filled by best fit, on counts as well. Pieces of one length are interchangeable:
they are numbered, task by task, and the plan says for each number which sequence and
offset it has. No piece is moved for that.

A null or empty text is the end id alone. Rows are packed one by one, so a repeated row
or id is packed as often as it occurs; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.window import Window

from recspark.llm import text as T
from recspark.session import freeze

SEQUENCE = 2048
END_ID = 0
_CACHED_WORDS = 300_000
#: Share of a length that one step covers at most.
_STEP = 0.1
#: How a length's weight grows with the length, and how fast it falls as the length is covered.
_SETTINGS = ((1.1, 0.5), (1.02, 0.2), (1.3, 0.1))
#: A plan within this share of the least possible number of sequences is not tried to be bettered.
_NEAR = 1.0005


def _ranked(path: str):
    """The same byte-level vocabulary for a faster byte-pair encoder, or None if it isn't one.

    That encoder merges the pair of lowest id first. This is what the file says if its tokens
    past the single bytes are numbered in the order of its merges.
    """
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    before, model = stored.get("pre_tokenizer") or {}, stored.get("model", {})
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if not plain or stored.get("normalizer") or model.get("type") != "BPE":
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocabulary = model["vocab"]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    # single bytes are written as printable characters: themselves where they are, else from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(pairs)}
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Fixed value: the pre-tokenising pattern of byte-level byte-pair encoders.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The byte-level pre-tokeniser never joins what stands before a single space or line feed
    with what follows, as long as the neighbours are no white space themselves; a
    space goes with the word after it. So words are encoded once and kept. A text with
    other white space is encoded as a whole, and so is one that holds an added token of the file, such as an end mark.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.ranked = _ranked(path)
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed_bytes = array("I", [self.line_feed]).tobytes()
        self.missing_first: set[str] = set()
        self.missing_spaced: set[str] = set()
        self.first: dict[str, bytes] = {}  # words at the start of a line
        self.spaced: dict[str, bytes] = {}  # words after a space, which goes with them

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Words without a line feed, encoded in one call as lines of one text."""
        if not words:
            return []
        text = "\n".join(words)
        if self.ranked:
            ids = np.array(self.ranked.encode_ordinary(text), dtype="<u4")
        else:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.concatenate([[-1], np.flatnonzero(ids == self.line_feed), [len(ids)]])
        return [ids[a + 1 : b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.spaced) > _CACHED_WORDS:
            self.first.clear()
            self.spaced.clear()
        found = [self._known(t) for t in texts]
        if self.missing_first or self.missing_spaced:
            firsts, spaced = list(self.missing_first), list(self.missing_spaced)
            # a piece with white space of its own, or an empty one, may belong together with its neighbours
            odd = {w for w in (*firsts, *spaced) if w.split() != [w]}
            if odd:
                firsts, spaced = ([w for w in x if w not in odd] for x in (firsts, spaced))
            ids = self._word_ids(firsts + [" " + w for w in spaced])
            self.first.update(zip(firsts, ids, strict=False))
            self.spaced.update(zip(spaced, ids[len(firsts) :], strict=True))
            self.missing_first.clear()
            self.missing_spaced.clear()
        for i, known in enumerate(found):
            if known is None:
                again = self._known(texts[i])
                found[i] = self._ids([texts[i]])[0] if again is None else again
        self.missing_first.clear()
        self.missing_spaced.clear()
        return found

    def _known(self, text: str) -> bytes | None:
        """Ids of a text of known words; else None, and its unknown words are noted."""
        if not text:
            return b""
        if any(token in text for token in self.added):
            return None
        first, spaced = self.first.get, self.spaced.get
        lines, whole = [], True
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            begun, ids = first(head), list(map(spaced, rest))
            if begun is None:
                self.missing_first.add(head)
                whole = False
            if None in ids:
                self.missing_spaced.update([w for w, x in zip(rest, ids, strict=True) if x is None])
                whole = False
            elif whole:
                lines.append(begun + b"".join(ids))
        return self.feed_bytes.join(lines) if whole else None


def _pieces(path: str, length: int, end_id: int, keep_ids: bool):
    """Arrow map over (id, text): one row per piece, with its number among equally long pieces of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        seen: Counter[int] = Counter()
        task = TaskContext.get().partitionId()
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(low, 256).to_pylist()]
                rows: list[tuple] = []
                ids: list[bytes] = []
                for at, encoded in enumerate(encoder.encode(texts)):
                    encoded += end
                    n = len(encoded) // 4
                    start = 0
                    for piece in range(-(-n // length)):
                        stop = n - length * (-(-n // length) - 1 - piece)
                        part = encoded[4 * start : 4 * stop]
                        size = stop - start
                        rows.append((at, piece, start, size, zlib.crc32(part), seen[size]))
                        seen[size] += 1
                        if keep_ids:
                            ids.append(part)
                        start = stop
                columns = list(zip(*rows, strict=True))
                made = [batch.column(0).slice(low, 256).take(pa.array(columns[0]))]
                made += [pa.array(c, t) for c, t in zip(columns[1:], _PIECE_TYPES, strict=True)]
                made.append(pa.array([task] * len(rows), pa.int32()))
                names = ["id", "piece", "start", "length", "ids_crc32", "nth", "task"]
                if keep_ids:
                    made.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(made, names=names)
        del encoder
        T.give_back()

    return run


_PIECE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def priced(lengths: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """Knapsack by dynamic programming: the greatest weight of pieces that fit 0, 1, ... ``size`` tokens. ``lengths`` ascend."""
    best = np.zeros(size + 1)
    fitting = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for room in range(1, size + 1):
        j = fitting[room]
        best[room] = max(best[room - 1], (weights[:j] + best[room - lengths[:j]]).max(initial=0.0))
    return best


def configuration(seed: int, lengths: np.ndarray, weights: np.ndarray, left: np.ndarray, best: np.ndarray, size: int) -> tuple[dict[int, int], int]:
    """The heaviest sequence that holds a piece of length number ``seed``, as length number -> how many, and its free tokens.

    It is read back from the dynamic program; no more copies are taken than are left.
    """
    config, room = {seed: 1}, size - int(lengths[seed])
    while room > 0:
        j = int(np.searchsorted(lengths, room, side="right"))
        value = np.where(weights[:j] > 0, weights[:j] + best[room - lengths[:j]], 0.0)
        for i, n in config.items():
            if i < j and n >= left[i]:
                value[i] = 0.0
        if not value.any():
            break
        i = int(value.argmax())
        config[i] = config.get(i, 0) + 1
        room -= int(lengths[i])
    return config, room


def program(lengths: np.ndarray, counts: np.ndarray, size: int, power: float, rate: float) -> tuple[dict[tuple, int], np.ndarray]:
    """Full configurations with numbers of sequences, and what of the histogram they leave.

    Multiplicative weights: a length weighs less the more of it is covered. Each round prices all configurations with one
    dynamic program and reads one of them back for every length that is not covered. A step covers at most ``_STEP`` of a
    length and is rounded down to whole sequences, at least one. Columns are kept between rounds: what a later round
    finds again is added up. Rounds go on until all lengths are covered or no full configuration is left.
    """
    left, pool, moved = counts.copy(), {}, True
    while moved and left.any():
        weights = np.where(left > 0, (lengths / size) ** power * np.exp(-rate * (1 - left / counts)), 0.0)
        best, moved = priced(lengths, weights, size), False
        for seed in np.flatnonzero(left)[::-1]:
            if not left[seed]:
                continue
            config, room = configuration(int(seed), lengths, np.where(left > 0, weights, 0.0), left, best, size)
            if room:
                continue
            most = min(left[i] // n for i, n in config.items())
            step = int(min(most, max(1, _STEP * min(counts[i] / n for i, n in config.items()))))
            for i, n in config.items():
                left[i] -= n * step
            key = tuple(sorted(config.items()))
            pool[key] = pool.get(key, 0) + step
            moved = True
    return pool, left


def best_fit(left: Counter, size: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, of counted pieces: equally filled sequences are handled as one group."""
    groups: dict[int, list[list]] = {}
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            room = min((r for r, g in groups.items() if r >= length and g), default=None)
            if room is None:
                per = size // length
                whole, rest = divmod(n, per)
                for made, k in ((whole, per), (1, rest)):
                    if made and k:
                        groups.setdefault(size - length * k, []).append([{length: k}, made])
                break
            config, bins = groups[room].pop()
            per = room // length
            full = min(bins, n // per)
            rest = n - full * per if full < bins and n - full * per < per else 0
            for made, k in ((full, per), (1 if rest else 0, rest)):
                if made:
                    more = dict(config)
                    more[length] = more.get(length, 0) + k
                    groups.setdefault(room - length * k, []).append([more, made])
            n -= full * per + rest
            unused = bins - full - (1 if rest else 0)
            if unused:
                groups.setdefault(room, []).append([config, unused])
    return [(c, n) for g in groups.values() for c, n in g]


class Plan(NamedTuple):
    made: list[tuple[dict[int, int], int]]  # (length -> how many, sequences like that)
    programmed: float  # share of the pieces that the program placed, the rest being placed by best fit


def planned(histogram: dict[int, int], size: int = SEQUENCE) -> Plan:
    """A plan that holds the histogram exactly: of the programs of ``_SETTINGS`` the first that is near the bound, else the best."""
    counted = {n: c for n, c in histogram.items() if c > 0}
    whole = counted.pop(size, 0)
    done = [({size: 1}, whole)] if whole else []
    if not counted:
        return Plan(done, 1.0)
    lengths = np.array(sorted(counted), dtype=np.int64)
    counts = np.array([counted[int(n)] for n in lengths], dtype=np.int64)
    fewest = -(-int((lengths * counts).sum()) // size)
    found: list[tuple[int, Plan]] = []
    for power, rate in _SETTINGS:
        pool, left = program(lengths, counts, size, power, rate)
        made = [({int(lengths[i]): n for i, n in config}, x) for config, x in pool.items()]
        made += best_fit(Counter({int(n): int(c) for n, c in zip(lengths, left, strict=True) if c}), size)
        share = 1 - int(left.sum()) / (int(counts.sum()) + whole)
        found.append((sum(x for _, x in made), Plan(done + made, share)))
        if found[-1][0] <= fewest * _NEAR:
            break
    return min(found, key=lambda f: (f[0], -f[1].programmed))[1]


def plan(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """(length -> how many, sequences like that); together they hold the histogram exactly."""
    return planned(histogram, size).made


def slots(made: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first number, sequence of the first, pieces per sequence, offset of the first), sorted."""
    rows = []
    following: Counter[int] = Counter()
    sequence = 0
    for pieces, bins in made:
        offset = 0
        for length, n in pieces.items():
            rows.append((length, following[length], sequence, n, offset))
            following[length] += n * bins
            offset += length * n
        sequence += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


_PLACE = ST.StructType([ST.StructField("sequence_id", ST.LongType()), ST.StructField("offset", ST.LongType())])


def _place_of(table: np.ndarray):
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        size, nth = length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False)
        wide = np.int64(1) << np.int64(48)
        row = table[np.searchsorted(table[:, 0] * wide + table[:, 1], size * wide + nth, side="right") - 1]
        k = nth - row[:, 1]
        made = [pa.array(row[:, 2] + k // row[:, 3]), pa.array(row[:, 4] + (k % row[:, 3]) * size)]
        return pa.StructArray.from_arrays(made, names=["sequence_id", "offset"])

    return F.arrow_udf(place, _PLACE)


def tokenized(
    documents: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", length: int = SEQUENCE,
    end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, nth, task[, ids: little-endian unsigned 32-bit]), frozen."""
    kind = documents.schema[doc].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, nth bigint, task int"
    mapped = documents.select(F.col(doc).alias("id"), F.col(text).alias("text")).mapInArrow(
        _pieces(tokenizer, length, end_id, keep_ids), schema + (", ids binary" if keep_ids else "")
    )
    return freeze(mapped, "pieces")


def packed(
    documents: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", length: int = SEQUENCE,
    end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; the ids themselves where ``keep_ids``."""
    pieces = tokenized(documents, tokenizer, doc, text, length, end_id, keep_ids)
    counted = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = freeze(counted.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    place = _place_of(slots(plan(histogram, length)))
    placed = (
        pieces.join(bases.drop("n"), ["task", "length"])
        .withColumn("_place", place(F.col("length"), F.col("base") + F.col("nth")))
        .withColumns({"sequence_id": F.col("_place.sequence_id"), "offset": F.col("_place.offset")})
    )
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if keep_ids else [])
    return placed.select(F.col("id").alias(doc), *columns)
