"""Corpus pipeline: documents to token ids through five operators of emporia.llm.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept; ``run`` writes every stage's result as Parquet under the shared
checkpoint folder and reads it back as the next one's ``docs``, so a lost
executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import bpe, decontam, pii, quality, simhash
from emporia.llm.common import prepare, staged
from emporia.llm.queries import PII_KEY, word_bpe_path
from emporia.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1; the model learns from these documents."""
    prepare(spark)
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = quality.score_quality(docs, model, score="__score", predicted="__predicted")
    return scored.where("__predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, at most 3 bits): the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs, radius=3, words=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    found = decontam.find_leaks(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"), name="__items")
    return found.where(F.size("__items") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for their entities; ``n_chars`` follows the text."""
    prepare(spark)
    found = pii.pseudonymise(docs, PII_KEY)
    return found.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else found


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and a digest of the text that they decode to."""
    prepare(spark)
    found = bpe.encode(docs.select("doc_id", "text"), word_bpe_path())
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii surrogates", pii_stage),
    ("bpe encoding and decoding", bpe_stage),
]

#: No stage but the last could be said in SQL; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
