"""Stages of the pipeline on a small table, against plain Python."""

from __future__ import annotations

import collections
import random

import corpus_pipeline
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _score double"


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    words = {l: [f"{p}{a}{b}" for a in v for b in v] for l, p, v in (("en", "th", "aeiou"), ("fr", "eau", "éèêàù"))}
    text = lambda l, n: " ".join(rng.choice(words[l]) + rng.choice(["", "s", "r", "n"]) for _ in range(n))
    item = text("en", 14)
    rows, labels, gone = [], [], {}
    for i in range(240):
        l = ("en", "fr")[i % 2]
        toxic = i % 6 == 0
        t = text(l, 60) + (" vileword horridword vileword" if toxic else "") + " " + text(l, 20)
        rows.append((i, t, l, "src", len(t), 0.0))
        labels.append((i, int(toxic)))
        if toxic:
            gone[i] = "toxic"
    clean = [r for r in rows if r[0] not in gone]
    near = clean[5][1].split()
    near[30] = "edited"
    rows += [(1000, clean[3][1], clean[3][2], "src", 1, 0.0), (1001, " ".join(near), clean[5][2], "src", 1, 0.0), clean[7], clean[7]]
    rows += [(1002, text("fr", 80), "en", "src", 1, 0.0), (1003, text("en", 30) + " " + item + " " + text("en", 30), "en", "src", 1, 0.0)]
    rows += [(1004, None, "en", "src", 0, 0.0), (None, text("en", 50), "en", None, 1, 0.0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if at < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out{at}")
        docs = spark.read.parquet(f"{tmp_path}/out{at}")
        kept[name] = collections.Counter(r.doc_id for r in docs.collect())
    first = kept["toxicity"]
    assert not any(first[i] for i in gone) and sum(first.values()) == len(rows) - len(gone)
    second = kept["language ID"]
    assert first - second == collections.Counter({1002: 1, 1004: 1})
    third = kept["MinHash near-dedup"]
    assert second - third == collections.Counter({1000: 1, 1001: 1, clean[7][0]: 2})
    assert third - kept["benchmark decontamination"] == collections.Counter({1003: 1})
    assert set(kept["best-fit packing"]) == set(kept["benchmark decontamination"])


def test_texts_of_documents_that_stay_do_not_travel(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    keyed = corpus_pipeline._keyed(docs.union(docs.filter("doc_id < 10")))
    joined, join = [], type(keyed).join

    def counted(self, other, *args):
        if "text" in self.columns:
            joined.append(self.count())
        return join(self, other, *args)

    monkeypatch.setattr(type(keyed), "join", counted)
    out = corpus_pipeline._without(keyed, keyed.filter("doc_id % 50 = 0"))
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i in [*range(4000), *range(10)] if i % 50)
    some = corpus_pipeline._among(keyed, keyed.filter("doc_id % 100 = 7").select(corpus_pipeline._KEY))
    assert sorted(r.doc_id for r in some.collect()) == sorted(i for i in [*range(4000), 7] if i % 100 == 7)
    assert len(joined) == 2 and max(joined) < 1000
    assert corpus_pipeline._without(keyed, keyed.filter("false")).count() == 4010
