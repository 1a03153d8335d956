"""Language of a document from several pieces of evidence, fused by Bayes' rule.

The posterior of a language is its prior on the document's host, times the likelihood
of the text, of the language declared in the markup (or by the source) and of the
suffix of the address.

* Text: naive Bayes over hashed 4-byte grams of the lower-cased letters. Grams overlap and
  depend on each other, so n of them count as min(n, 8 sqrt(n)). Counted over all documents. A
  gram that a language never shows is no likelier in it than in all languages together, so that
  odd texts do not go to languages with few documents.
* Declared language and suffix: how often each occurs with the languages that the text alone
  makes clear, smoothed.
* Host: language counts of hosts, smoothed towards those of their domain, these towards
  all documents, by grouped aggregation over all documents.

The languages are all that are declared on any text with a gram, however rare; the text model has
2^16 numbers (256 KB) for each. ``min_share`` leaves out languages declared on a smaller share of the
documents with a declared language. A document declared in a language without a model is
undecided: it gets no language and is kept if its text has letters.

A document is ``kept`` if a language was found and it is the declared one, if none is
declared, or if it is undecided. A text without letters (null and empty ones too) has no language and is not kept.
Null evidence of any kind is left out. Repeated rows get equal results. In an empty
table, or where nothing is declared, no language is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from recspark.llm import text as T
from recspark.session import freeze

BUCKETS = 1 << 16
MIN_SHARE = 0.0
CLEAR = 0.9
_LETTERS = T.UPPER | T.LOWER | (np.arange(256) >= 128)
_SPACED = np.where(_LETTERS, np.arange(256), 32).astype(np.uint8)
_PRIOR = 20.0
_PART = 1 << 14  # grams of a text that are scored at once
_DENSE = 64  # languages whose gram counts a task holds at once
_LOOPED = 16  # up to so many languages are scored one by one, more of them text by text


def gram_buckets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, letters of each row, row, bucket) of the grams of slices of a text column."""
    for low, data, offsets in T.slices(column, prepare=T.lower):
        spaced = _SPACED[data]
        letters = np.diff(np.concatenate([[0], np.cumsum(spaced != 32)])[offsets])
        keep = np.ones(len(spaced), bool)
        keep[1:] = (spaced[1:] != 32) | (spaced[:-1] != 32)
        ends = np.concatenate([[0], np.cumsum(keep)])[offsets]
        kept = spaced[keep].astype(np.uint32)
        n = max(0, len(kept) - 3)
        value = kept[:n] | kept[1 : n + 1] << 8 | kept[2 : n + 2] << 16 | kept[3 : n + 3] << 24
        row = np.searchsorted(ends, np.arange(len(kept)), side="right") - 1
        whole = row[:n] == row[3 : n + 3]
        bucket = (value[whole] * np.uint32(2654435761)) >> np.uint32(16)
        yield low, letters, row[:n][whole], bucket.astype(np.int64)


def primary(code: Column) -> Column:
    """Language part of a code like ``en-GB``; null if blank."""
    part = F.lower(F.trim(F.split(code, "[-_]")[0]))
    return F.when(part != "", part)


def suffix_of(host: Column) -> Column:
    """Last label of a host name, null if it has only one."""
    return F.when(host.contains("."), F.lower(F.element_at(F.split(host, r"\."), -1)))


def domain_of(host: Column) -> Column:
    """Last two labels of a host name, null if it has only one."""
    return F.when(host.contains("."), F.regexp_extract(F.lower(host), r"([^.]+\.[^.]+)$", 1))


def _count_grams(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {name: i for i, name in enumerate(languages)}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            own = np.array([code.get(x, -1) for x in batch.column(0).to_pylist()], dtype=np.int64)
            for low, letters, row, bucket in gram_buckets(batch.column(1)):
                held = own[low : low + len(letters)]
                present = np.unique(held[held >= 0])
                for some in (present[i : i + _DENSE] for i in range(0, len(present), _DENSE)):
                    rank = np.full(len(languages) + 1, -1)  # the last one is that of rows without a language
                    rank[some] = np.arange(len(some))
                    at = rank[held[row]]
                    known = at >= 0
                    place = at[known] * BUCKETS + bucket[known]
                    made = np.bincount(place, minlength=len(some) * BUCKETS).reshape(-1, BUCKETS)
                    if len(totals.keys() | set(some.tolist())) > _DENSE:
                        yield _counted(totals)
                        totals = {}
                    for i, language in enumerate(some.tolist()):
                        totals[language] = totals[language] + made[i] if language in totals else made[i]
        yield _counted(totals)

    return run


def _counted(totals: dict[int, np.ndarray]) -> pa.RecordBatch:
    table = np.array(list(totals.values()), np.int64).reshape(-1, BUCKETS)
    at, bucket = np.nonzero(table)
    language = np.array(list(totals), np.int64)[at]
    columns = [pa.array(language, pa.int32()), pa.array(bucket, pa.int32()), pa.array(table[at, bucket])]
    return pa.RecordBatch.from_arrays(columns, names=["language", "bucket", "n"])


_SCORE = ST.StructType(
    [
        ST.StructField("evidence", ST.ArrayType(ST.FloatType())),
        ST.StructField("n_letters", ST.LongType()),
        ST.StructField("best", ST.IntegerType()),
        ST.StructField("sure", ST.FloatType()),
    ]
)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _score(model):
    """Tempered log likelihoods of a text under each language."""

    def score(column: pa.Array) -> pa.Array:
        table = model.value
        by_bucket = np.ascontiguousarray(table.T) if table.shape[0] > _LOOPED else None
        out = np.zeros((len(column), table.shape[0]))
        grams, letters = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        for low, own, row, bucket in gram_buckets(column):
            rows = len(own)
            letters[low : low + rows] = own
            grams[low : low + rows] = np.bincount(row, minlength=rows)
            if by_bucket is None:
                for i in range(table.shape[0]):
                    out[low : low + rows, i] = np.bincount(row, weights=table[i, bucket], minlength=rows)
            else:
                ends = np.searchsorted(row, np.arange(rows + 1))
                for i in range(rows):
                    for a in range(ends[i], ends[i + 1], _PART):
                        out[low + i] += by_bucket[bucket[a : min(a + _PART, ends[i + 1])]].sum(axis=0, dtype=np.float64)
        n = np.maximum(grams, 1)
        out *= (np.minimum(n, 8 * np.sqrt(n)) / n)[:, None]
        out -= out.max(axis=1, keepdims=True)
        made = [
            T.lists(out.astype(np.float32).reshape(-1), np.full(len(out), out.shape[1]), pa.float32()),
            pa.array(letters),
            pa.array(out.argmax(axis=1).astype(np.int32)),
            pa.array(_softmax(out).max(axis=1).astype(np.float32)),
        ]
        return pa.StructArray.from_arrays(made, names=_SCORE.names)

    return F.arrow_udf(score, _SCORE)


_FUSED = ST.StructType([ST.StructField("language", ST.IntegerType()), ST.StructField("posterior", ST.DoubleType())])


def _fuse(n: int):
    def fuse(evidence: pa.Array, prior: pa.Array, declared: pa.Array, suffix: pa.Array) -> pa.Array:
        total = np.zeros((len(evidence), n))
        for column, is_log in ((evidence, True), (prior, False), (declared, False), (suffix, False)):
            there = np.flatnonzero(~np.asarray(column.is_null()))
            values = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(len(there), n)
            total[there] += values if is_log else np.log(values)
        posterior = _softmax(total)
        made = [pa.array(posterior.argmax(axis=1).astype(np.int32)), pa.array(posterior.max(axis=1))]
        return pa.StructArray.from_arrays(made, names=_FUSED.names)

    return F.arrow_udf(fuse, _FUSED)


def _language_counts(clear: DataFrame, by: list[str], n: int) -> DataFrame:
    """Documents of each language by key, as one array."""
    sums = [F.sum((F.col("best") == i).cast("double")) for i in range(n)]
    return clear.groupBy(*by).agg(F.array(*sums).alias("counts"))


def _smoothed(counts: str, parent: str, weight: float = _PRIOR) -> Column:
    """(counts + weight * parent) / (their sum): the parent's shares count as ``weight`` documents."""
    total = F.aggregate(F.col(counts), F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + weight * p) / (total + weight))


def languages_of(df: DataFrame, declared: Column, min_share: float = MIN_SHARE) -> list[str]:
    """Declared languages, those with at least ``min_share`` of the documents, in alphabetical order."""
    counted = df.select(primary(declared).alias("l")).filter("l is not null").groupBy("l").count()
    n = counted.agg(F.sum("count")).first()[0] or 0
    return sorted(r["l"] for r in counted.filter(F.col("count") >= min_share * n).collect())


def text_model(df: DataFrame, text: Column, declared: Column, languages: list[str]) -> tuple[list[str], np.ndarray]:
    """The languages with any gram, and the log probability of each gram bucket in each, add-half smoothed.

    A gram that a language does not show gets the probability in all languages together if that is smaller.
    """
    mapped = df.select(primary(declared).alias("l"), text.alias("t")).mapInArrow(
        _count_grams(languages), "language int, bucket int, n bigint"
    )
    counted = mapped.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    language, bucket, n = (counted[c].to_numpy() for c in ("language", "bucket", "n"))
    shown = np.unique(language) if len(language) else np.arange(len(languages))
    together = np.bincount(bucket, weights=n, minlength=BUCKETS) + 0.5
    together = np.log(together / together.sum())
    sums = np.bincount(language, weights=n, minlength=len(languages))[shown] + 0.5 * BUCKETS
    table = np.minimum(together, np.log(0.5 / sums)[:, None]).astype(np.float32)
    at = np.searchsorted(shown, language)
    table[at, bucket] = np.log((n + 0.5) / sums[at])
    return [languages[i] for i in shown], table


def identify(
    df: DataFrame, text: Column | None = None, declared: Column | None = None, host: Column | None = None,
    suffix: Column | None = None, keys: list[str] | None = None, min_share: float = MIN_SHARE,
) -> DataFrame:
    """``keys`` of every row with ``declared``, ``language``, ``posterior``, ``n_letters`` and ``kept``.

    ``suffix`` defaults to that of the host; a host without dots has none.
    """
    spark = df.sparkSession
    text = F.col("text") if text is None else text
    declared = F.col("lang") if declared is None else declared
    host = F.col("source") if host is None else host
    suffix = suffix_of(host) if suffix is None else suffix
    keys = keys or ["doc_id"]
    held = F.struct(*keys).alias("_key")
    languages = languages_of(df, declared, min_share)
    n = len(languages)
    if not n:
        none = df.select(*keys, primary(declared).alias("declared"))
        return none.withColumns(
            {"language": F.lit(None).cast("string"), "posterior": F.lit(0.0), "n_letters": F.lit(0).cast("bigint"), "kept": F.lit(False)}
        )
    languages, table = text_model(df, text, declared, languages)
    n = len(languages)
    model = spark.sparkContext.broadcast(table)
    scored = df.select(
        held, primary(declared).alias("declared"), F.lower(host).alias("host"), F.lower(suffix).alias("suffix"), _score(model)(text).alias("_s")
    )
    scored = freeze(scored.select("_key", "declared", "host", "suffix", "_s.*").withColumn("domain", domain_of(F.col("host"))), "evidence")
    clear = scored.filter((F.col("sure") >= CLEAR) & (F.col("n_letters") > 0))
    counts = clear.agg(*[F.coalesce(F.sum((F.col("best") == i).cast("double")), F.lit(0.0)) for i in range(n)]).first()
    total = sum(counts)
    everywhere = F.array(*[F.lit((c + 1) / (total + n)) for c in counts])
    domains = _language_counts(clear.filter("domain is not null"), ["domain"], n)
    domains = domains.withColumn("_all", everywhere).select("domain", _smoothed("counts", "_all").alias("of_domain"))
    hosts = _language_counts(clear.filter("host is not null"), ["host", "domain"], n).join(domains, "domain", "left")
    hosts = hosts.withColumn("_parent", F.coalesce("of_domain", everywhere)).select("host", _smoothed("counts", "_parent").alias("prior"))

    def likelihood(column: str, name: str) -> DataFrame:
        """How probable each value of a column is in each language, half a document of every value added."""
        seen = _language_counts(clear.filter(F.col(column).isNotNull()), [column], n)
        values = [F.sum(F.col("counts")[i]).alias(f"t{i}") for i in range(n)]
        sums = seen.agg(F.count("*").alias("values"), *values).first()
        shares = [(F.col("counts")[i] + 0.5) / ((sums[f"t{i}"] or 0.0) + 0.5 * (sums["values"] + 1)) for i in range(n)]
        return freeze(seen.select(column, F.array(*shares).alias(name)), name)

    joined = (
        scored.join(freeze(hosts, "hosts"), "host", "left")
        .join(likelihood("declared", "of_declared"), "declared", "left")
        .join(likelihood("suffix", "of_suffix"), "suffix", "left")
        .withColumn("prior", F.coalesce("prior", everywhere))
    )
    fused = joined.withColumn("_f", _fuse(n)("evidence", "prior", "of_declared", "of_suffix"))
    undecided = F.col("declared").isNotNull() & ~F.col("declared").isin(languages)
    found = (F.col("n_letters") > 0) & ~undecided
    name = F.array(*[F.lit(x) for x in languages])[F.col("_f.language")]
    out = fused.select(
        "_key.*",
        "declared",
        F.when(found, name).alias("language"),
        F.when(found, F.col("_f.posterior")).otherwise(0.0).alias("posterior"),
        "n_letters",
    )
    agrees = F.col("declared").isNull() | (F.col("declared") == F.col("language"))
    kept = F.when(undecided, F.col("n_letters") > 0).otherwise(F.col("language").isNotNull() & agrees)
    return out.withColumn("kept", F.coalesce(kept, F.lit(False)))
