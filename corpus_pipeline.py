"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order. A stage takes the session, the documents that its
predecessor kept and the folder of the other tables; all but the last return the columns of
documents, the last one row per piece of a sequence. ``run`` writes what a stage returns to the shared
folder and reads it again for the next one.

Every stage handles null ids and texts, repeated rows and extra columns. Verdicts come back to the rows by two 64-bit
hashes of id, text, language and source; a bit filter of the keys keeps texts where they are, but for those that it holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import dartminhash, langid, packing, toxicity, winnow
from recspark.llm.queries import tokenizer_path
from recspark.llm.tables import bit_filter
from recspark.session import freeze

_KEY = "_corpus_row_key"
#: Rows that tasks hand to Python at once. Whole texts are long: ten thousand of them, Spark's default, are held several
#: times over, by Spark, on the way and by Python.
_ROWS_AT_ONCE = "2000"
_TOXIC = 0.5


def _keyed(docs: DataFrame) -> DataFrame:
    """With a hash of what a verdict may depend on; null and empty differ."""
    parts = [x for c in ("doc_id", "text", "lang", "source") for x in (F.col(c), F.col(c).isNull())]
    return docs.withColumn(_KEY, F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b")))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of keyed documents whose key was not rejected. A text travels only where a bit filter holds its key for one of them."""
    gone = freeze(rejected.select(_KEY).distinct(), "rejected")
    able = bit_filter(gone, _KEY)
    if able is None:
        return docs.join(gone, _KEY, "left_anti")
    return docs.filter(~able(_KEY)).unionByName(docs.filter(able(_KEY)).join(gone, _KEY, "left_anti"))


def _among(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of keyed documents whose key is one of frozen ``keys``, texts travelling as in ``_without``."""
    able = bit_filter(keys, _KEY)
    return (docs if able is None else docs.filter(able(_KEY))).join(keys, _KEY, "left_semi")


def _in_small_batches(spark: SparkSession) -> None:
    """For the rest of the session, as a stage is not run before it is written."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _ROWS_AT_ONCE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, learnt from all labels of the folder."""
    _in_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = toxicity.scorer(spark, toxicity.train(docs, labels))
    return docs.filter(score("text")["score"] < _TOXIC)


def keep_declared_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the language that they are declared to be in, and those with a language but none declared."""
    _in_small_batches(spark)
    keyed = _keyed(docs)
    found = langid.identify(keyed, keys=[_KEY])
    return _without(keyed, found.filter(~F.col("kept"))).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id; of rows that are alike, one."""
    _in_small_batches(spark)
    keyed = _keyed(docs)
    found = dartminhash.classes(keyed, extra=[_KEY])
    by_key = freeze(found.groupBy(_KEY).agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "verdicts")
    several = freeze(by_key.filter("kept and n > 1").select(_KEY), "several")
    out = _without(keyed, by_key.filter("not kept or n > 1"))
    if not several.isEmpty():
        out = out.unionByName(_among(keyed, several).dropDuplicates([_KEY]))
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    _in_small_batches(spark)
    keyed = _keyed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = winnow.contamination(keyed, benchmark, doc=_KEY)
    return _without(keyed, found.filter("n_hit > 0")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _in_small_batches(spark)
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_declared_language),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Learnt scores and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
