"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import codes, credentials, dartminhash, extract, langid, packing, quality, rules, toxicity, urlfilter, warc, winnow, zonemaps
from recspark.llm.labels import held_out

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query):
    REGISTRY[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_warc_index(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages)
    found = warc.look_up(spark, archive, pages)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op2_language_id(spark, sf_dir):
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "declared", "language", F.round("posterior", 6).alias("posterior"), "kept")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op3_best_fit_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@register
def op4_dart_minhash(spark, sf_dir):
    return dartminhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op5_decontamination(spark, sf_dir):
    found = winnow.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    judged = urlfilter.judge(pages.select("page_id", "url"), urlfilter.listed_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register
def op7_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    main_text = extract.extractor(spark, extract.train(pages))
    found = pages.select("page_id", "url", main_text("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@register
def op8_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 4, 2))
    score = quality.scorer(spark, quality.train(documents, labels))
    scored = documents.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@register
def op9_quality_rules(spark, sf_dir):
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register
def op10_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0))
    score = toxicity.scorer(spark, toxicity.train(documents, labels))
    scored = documents.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), score("text")["score"].alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register
def op11_vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


@register
def op12_centroid_clustering(spark, sf_dir):
    return zonemaps.cluster(table(spark, sf_dir, "embeddings"))


@register
def op13_secret_scan(spark, sf_dir):
    return credentials.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)
