"""From raw documents to packed training sequences: reject junk, drop near copies, redact secrets, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelane.llm import ngram_join, packing, quality, secret_scan
from mergelane.llm.queries import BLANK_WORDS
from mergelane.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = quality.scored(docs, model, "__scores").filter(F.col("__scores")[2] >= quality.THRESHOLD)
    return good.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles of a similarity from 0.8 on link."""
    return ngram_join.first_of_each(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    found = secret_scan.scan(docs)
    secrets = found.filter("secret").select("doc_id", "value")
    return secret_scan.redact(docs, secrets).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, measured in words, in bins of the permitted lengths."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(BLANK_WORDS))
    return packing.pack(docs.select("doc_id", words.alias("words")), "words")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scan", secret_scan_stage),
    ("best-fit packing", best_fit_packing),
]

# A trained classifier decides what stays, so SQL cannot say which rows come out.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
