"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

* Tokens are runs of letters and digits in lower case. A token's log-odds say how much
  likelier a document with it is toxic, with Dirichlet priors: the rate of a token is shrunk towards
  that of its longest prefix, this one's towards the next shorter prefix, and so on to the rate
  of all tokens. Rates come from labelled documents, each counting once per token.
* Every token scores its log-odds less a constant, so that ordinary text drifts down. One
  linear scan (Ruzzo and Tompa) finds all maximal segments: no one can be extended or cut
  without losing score, and they do not overlap.
* In clean text the best segment of n tokens follows an extreme-value law,
  P(S >= x) = 1 - exp(-K n exp(-lambda x)). K and lambda are fitted to the best segments of labelled clean
  documents that took no part in the rates. A segment is a significant passage if that
  probability is under ``SIGNIFICANT``. The evidence of the r best segments together, for every r up to all of a text, follows from
  the sum statistic of Karlin and Altschul; the strongest evidence is the document's, and a
  logistic curve over it, fitted on the same rows, gives the score.

Rates and curve are fitted on at most about ``sample_rows`` labelled documents. Only the text is
scored, whole. A null or empty text has no evidence and gets the lowest score. Without labelled
rows of both kinds every score is 0. Repeated rows get equal scores; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from recspark.llm import text as T
from recspark.llm.labels import labelled_sample, labelled_texts
from recspark.session import freeze

SAMPLE_ROWS = 20_000
#: Bytes of the prefixes that a token's rate is shrunk towards, shortest first.
PREFIXES = (4, 6)
PRIOR = 8.0
DRIFT = 0.5
#: Standard errors taken off a positive log-odds.
CAUTION = 1.0
#: Least number of documents of a token in the table, raised until it has at most MAX_UNITS rows.
LEAST_DOCUMENTS = 2
MAX_UNITS = 1 << 20
SIGNIFICANT = 0.01


class Model(NamedTuple):
    units: np.ndarray  # sorted hashes of tokens and prefixes
    toxic: np.ndarray  # toxic documents of each
    all: np.ndarray  # documents of each
    rate: float
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    intercept: float = 0.0
    slope: float = 1.0


def _units(data: np.ndarray, w: T.Words) -> Iterator[np.ndarray]:
    """Per level, shortest prefix first: the hash of each token's prefix, or of the whole token if it is no longer."""
    for size in PREFIXES:
        end = np.minimum(w.end, w.start + size)
        yield np.where(w.end - w.start > size, T.span_hashes(data, w.start, end, seed=size), np.uint64(0))
    yield w.hash


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map over (label, text): documents and toxic documents of each unit, added up per slice."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for low, data, offsets in T.slices(batch.column(1), prepare=T.lower):
            w = T.words(data, offsets, fold=False)
            pairs = []
            for unit in _units(data, w):
                there = unit != 0
                pairs.append(np.unique(np.stack([unit[there], w.row[there].astype(np.uint64)]), axis=1))
            unit, row = np.concatenate(pairs, axis=1)
            toxic = label[low + row.astype(np.int64)]
            unit, at, n = np.unique(unit, return_inverse=True, return_counts=True)
            toxic = np.bincount(at, weights=toxic, minlength=len(unit)).astype(np.int64)
            columns = [pa.array(unit.view(np.int64)), pa.array(toxic), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "toxic", "n"])


def token_scores(model: Model, data: np.ndarray, w: T.Words) -> np.ndarray:
    """Log-odds of each token over the rate of all, less the drift."""
    _, at, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    few = T.Words(w.start[at], w.end[at], w.row[at], w.hash[at])
    rate = np.full(len(at), model.rate)
    seen = np.full((2, len(at)), PRIOR) * np.array([[model.rate], [1 - model.rate]])
    for unit in _units(data, few):
        place = np.minimum(np.searchsorted(model.units, unit), len(model.units) - 1)
        known = model.units[place] == unit
        toxic, n = np.where(known, model.toxic[place], 0), np.where(known, model.all[place], 0)
        seen = np.where(known, np.stack([toxic + PRIOR * rate, n - toxic + PRIOR * (1 - rate)]), seen)
        rate = np.where(known, seen[0] / (n + PRIOR), rate)
    odds = np.log(rate / (1 - rate)) - np.log(model.rate / (1 - model.rate))
    doubt = CAUTION * np.sqrt(1 / seen[0] + 1 / seen[1])
    return (np.where(odds > 0, np.maximum(odds - doubt, 0), odds) - DRIFT)[inverse]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(from, to, score) of all maximal scoring segments in order, in linear time.

    Only runs of positive scores are looked at. Each is a candidate with the running totals
    before and after it. Going back, a candidate joins the nearest one that began lower, if
    the total has not been higher in between; links to that nearest one are kept, so that no
    candidate is passed twice.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    breaks = np.flatnonzero(np.diff(positive) > 1) + 1
    first = positive[np.concatenate([[0], breaks])]
    last = positive[np.concatenate([breaks - 1, [len(positive) - 1]])] + 1
    stack: list[list] = []  # from, to, total before, total after, position of the nearest candidate that began lower
    for begin, end in zip(first.tolist(), last.tolist(), strict=True):
        low, high = total[begin], total[end]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append([begin, end, low, high, j])
                break
            begin, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(b, e, float(h - l)) for b, e, l, h, _ in stack]


def segments_of(model: Model, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(words, segments) of each row of a slice."""
    w = T.words(data, offsets, fold=False)
    scores = token_scores(model, data, w) if len(w.hash) else np.zeros(0)
    ends = np.concatenate([[0], np.cumsum(T.row_counts(w.row, len(offsets) - 1))])
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield b - a, maximal_segments(scores[a:b])


def evidence(best: list[list[float]], words: np.ndarray, scale: float, log_k: float) -> np.ndarray:
    """Minus log of the least tail probability over the r best segments, r = 1, 2, ... up to all of a text."""
    counts = np.array([len(x) for x in best], dtype=np.int64)
    starts = np.cumsum(counts) - counts
    scores = np.array([s for x in best for s in x], dtype=np.float64)
    normal = scale * scores - log_k - np.repeat(np.log(np.maximum(words, 1)), counts)
    most = int(counts.max(initial=0))
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, most + 1)))])
    out = np.zeros(len(best))
    total = np.zeros(len(best))
    left = np.arange(len(best))
    for r in range(1, most + 1):
        left = left[counts[left] >= r]
        total[left] += normal[starts[left] + r - 1]
        now = total[left]
        if r == 1:
            minus_log = -np.log(-np.expm1(-np.exp(-np.clip(now, -30, 600))) + 1e-300)
        else:
            tail = now - (r - 1) * np.log(np.maximum(now, 1.0)) + log_factorial[r] + log_factorial[r - 1]
            minus_log = np.where(now > r, tail - np.log(r), 0.0)
        out[left] = np.fmax(out[left], minus_log)
    return out


def _best_of(segments: list[tuple[int, int, float]]) -> list[float]:
    return sorted((s for _, _, s in segments), reverse=True)


def _best_segments(model):
    """Arrow map over (label, text): words and the segments' scores, best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*model.value)
        for batch in batches:
            for low, data, offsets in T.slices(batch.column(1), prepare=T.lower):
                made = [(n, _best_of(s)) for n, s in segments_of(fitted, data, offsets)]
                columns = [
                    batch.column(0).slice(low, len(made)),
                    pa.array([n for n, _ in made], pa.int64()),
                    pa.array([s for _, s in made], pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "words", "best"])

    return run


def _strengths(scale: float, log_k: float):
    """Arrow map over (label, words, best): the evidence of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strength = evidence(batch.column(2).to_pylist(), batch.column(1).to_numpy(), scale, log_k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(strength)], names=["label", "strength"])

    return run


def fit_extremes(best: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """lambda and log K of the best segments in clean texts, by the moments of lambda S - log n."""
    use = ~np.isnan(best) & (words > 0)
    if use.sum() < 10 or np.std(best[use]) < 1e-6:
        return 1.0, 0.0
    s, log_n = best[use], np.log(words[use])
    scale = np.pi / np.sqrt(6) / np.std(s)
    for _ in range(50):
        # S = (log n + log K + G) / lambda with G of mean 0.5772 and deviation pi / sqrt(6)
        scale = 0.5 * scale + 0.5 * np.pi / np.sqrt(6) / max(np.std(s - log_n / scale), 1e-6)
    return float(scale), float(np.mean(scale * s - log_n) - 0.5772156649)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, slightly ridged, by Newton's method."""
    design = np.stack([np.ones(len(x)), x], axis=1)
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def train(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", doc: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Rates from two thirds of the sampled rows, extreme values and curve from the other third."""
    spark = documents.sparkSession
    texts = labelled_texts(documents, labelled_sample(labels, label, sample_rows, doc), doc, text)
    held = F.col("draw") % 3 == 0
    counted = texts.filter(~held).select(F.col("label").cast("int"), "text").mapInArrow(_count_units, "unit bigint, toxic bigint, n bigint")
    units = counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).persist()
    try:
        sums = units.agg(F.sum("toxic"), F.sum("n")).first()
        if not sums[0] or sums[0] == sums[1]:
            return None
        sizes = sorted((r["n"], r["count"]) for r in units.groupBy(F.least("n", F.lit(1000)).alias("n")).count().collect())
        least, rows = LEAST_DOCUMENTS, sum(c for n, c in sizes if n >= LEAST_DOCUMENTS)
        while rows > MAX_UNITS:
            rows -= sum(c for n, c in sizes if n == least)
            least += 1
        kept = units.filter(F.col("n") >= least).toArrow()
    finally:
        units.unpersist()
    hashes = kept["unit"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    model = Model(hashes[order], kept["toxic"].to_numpy()[order], kept["n"].to_numpy()[order], sums[0] / sums[1])
    if not len(hashes):
        return None
    sent = spark.sparkContext.broadcast(tuple(model))
    rows = texts.filter(held).select(F.col("label").cast("int"), "text")
    seen = freeze(rows.mapInArrow(_best_segments(sent), "label int, words bigint, best array<double>"), "segments")
    first = seen.select("label", "words", F.coalesce(F.get("best", 0), F.lit(float("nan"))).alias("best")).toArrow()
    best, words, toxic = (first[c].to_numpy() for c in ("best", "words", "label"))
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    scale, log_k = fit_extremes(best[toxic == 0], words[toxic == 0])
    curve = seen.mapInArrow(_strengths(scale, log_k), "label int, strength double").toArrow()
    intercept, slope = fit_curve(curve["strength"].to_numpy(), curve["label"].to_numpy())
    return model._replace(scale=scale, log_k=log_k, intercept=intercept, slope=slope)


_PASSAGE = ST.StructType([ST.StructField(n, t) for n, t in (("from", ST.LongType()), ("to", ST.LongType()), ("p", ST.DoubleType()))])
_SCORED = ST.StructType(
    [
        ST.StructField("score", ST.DoubleType()),
        ST.StructField("evidence", ST.DoubleType()),
        ST.StructField("passages", ST.ArrayType(_PASSAGE)),
    ]
)


def scorer(spark, model: Model | None):
    """Column function from a text to score, evidence and significant passages (words from, to; p)."""
    sent = spark.sparkContext.broadcast(tuple(model) if model else None)

    def score(column: pa.Array) -> pa.Array:
        if sent.value is None:
            rows = [{"score": 0.0, "evidence": 0.0, "passages": []}] * len(column)
            return pa.array(rows, _ARROW)
        fitted = Model(*sent.value)
        parts = [pa.array([], _ARROW)]
        for _, data, offsets in T.slices(column, prepare=T.lower):
            best, words, passages = [], [], []
            for n, found in segments_of(fitted, data, offsets):
                best.append(_best_of(found))
                words.append(n)
                p = [-np.expm1(-np.exp(min(30.0, fitted.log_k + np.log(max(n, 1)) - fitted.scale * s))) for _, _, s in found]
                passages.append([{"from": b, "to": e, "p": float(q)} for (b, e, _), q in zip(found, p, strict=True) if q < SIGNIFICANT])
            strength = evidence(best, np.array(words), fitted.scale, fitted.log_k)
            score = 1 / (1 + np.exp(-np.clip(fitted.intercept + fitted.slope * strength, -30, 30)))
            made = [pa.array(score), pa.array(strength), pa.array(passages, _ARROW.field("passages").type)]
            parts.append(pa.StructArray.from_arrays(made, names=["score", "evidence", "passages"]))
        return pa.concat_arrays(parts)

    return F.arrow_udf(score, _SCORED)


_ARROW = pa.struct(
    [
        ("score", pa.float64()),
        ("evidence", pa.float64()),
        ("passages", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("p", pa.float64())]))),
    ]
)
