"""Registered queries of the pipeline operators: ``(spark, sf_dir) -> DataFrame``.

Each query applies one operator with its production parameters to the whole
table and derives its digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import audit as _audit
from emporia.llm import bpe as _bpe
from emporia.llm import decontam as _decontam
from emporia.llm import hnsw as _hnsw
from emporia.llm import language as _language
from emporia.llm import licenses as _licenses
from emporia.llm import pii as _pii
from emporia.llm import quality as _quality
from emporia.llm import shards as _shards
from emporia.llm import simhash as _simhash
from emporia.llm import suffixes as _suffixes
from emporia.llm import toxicity as _toxicity
from emporia.llm import variants as _variants
from emporia.llm.common import bucket, prepare
from emporia.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels with crc32(doc_id) mod 3 = 1 are held out."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    model = _quality.fit_quality(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    held_out = F.coalesce(bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return _quality.score_quality(docs, model).select("doc_id", held_out, "score", "predicted")


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, at most 3 bits)."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    found = _simhash.simhash_components(docs, radius=3, words=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register("op9_decontam")
def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item whose question and answer it contains."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    found = _decontam.find_leaks(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", F.explode("items").alias("item_id"))


def word_bpe_path() -> str:
    """Where the public word-level BPE tokenizer lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded text of every document."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    found = _bpe.encode_digests(docs, word_bpe_path())
    return found.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256")


#: Key of the registered query; a real run brings its own secret.
PII_KEY = b"emporia surrogate key"


@register("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its entities replaced by surrogates, and how many there were."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return _pii.pseudonymise(docs, PII_KEY, count="n_entities")


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@register("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with crc32(doc_id) mod 4 = 2 are held out."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text", "lang")
    model = _language.fit_language(docs)
    held_out = F.coalesce(bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    found = _language.predict_language(docs.drop("lang"), model)
    return found.select("doc_id", held_out, "lang_pred", "score")


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document; labels with crc32(doc_id) mod 5 = 0 are held out."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    model = _toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    held_out = F.coalesce(bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return _toxicity.score_toxicity(docs, model).select("doc_id", held_out, "severity", "grade", "toxic")


@register("op4_licenses", _licenses.scan_sql())
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document's passages state, by Dice over word bigrams."""
    return _licenses.scan_licenses(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op5_shards")
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-order shards of all documents; one row for each sequence with its slot and digest."""
    import public_tokenizers

    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    _, found = _shards.materialise(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                   end=50256, key=b"emporia training order")
    return found.select("slot", "shard", "byte_offset", "n_tokens", "sha256",
                        F.expr("transform(docs, d -> d.doc_id)").alias("doc_ids"))


@register("op7_hnsw")
def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding (cosine 0.95 or more)."""
    found = _hnsw.link_embeddings(read_table(prepare(spark), sf_dir, "embeddings", "vec_id", "embedding"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@register("op12_filter_audit", _audit.audit_sql())
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    docs = read_table(prepare(spark), sf_dir, "documents", "doc_id", "text", "lang")
    return _audit.audit_filters(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@register("op13_variants")
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, form and root."""
    return _variants.group_variants(read_table(prepare(spark), sf_dir, "documents", "doc_id", "text"))


@register("op11_suffix_dedup")
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that start in an earlier one."""
    found = _suffixes.remove_repeats(read_table(prepare(spark), sf_dir, "documents", "doc_id", "text"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
