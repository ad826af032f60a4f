"""Token counts by source, language and tokenizer version, maintained by deltas.

Changes to documents become signed rows: an insert adds a document and its tokens, a delete takes
them back, a revised count adds the difference. A batch of changes is summed per key and committed
as one partition of the rollup table, named by its batch id. Totals are the sums over all batches.

Committing a batch again, after a failure or by mistake, replaces its own partition by the same
rows, so every batch counts once. Sums are formed before the shuffle; a key that most rows share
costs one row a task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, batch string"


def counted(docs: DataFrame, tokenizers: Mapping[str, Column]) -> DataFrame:
    """One row per document and tokenizer version: source, lang, tokenizer, tokens.

    `tokenizers`: version -> number of tokens, as an expression over the columns of `docs`; null counts
    as 0. A document is read once for all of them.
    """
    counts = F.array(*[
        F.struct(F.lit(version).alias("tokenizer"), F.coalesce(n.cast("long"), F.lit(0).cast("long")).alias("tokens"))
        for version, n in tokenizers.items()
    ])
    return docs.select(docs["source"], docs["lang"], F.explode(counts).alias("c")).select(
        "source", "lang", "c.tokenizer", "c.tokens"
    )


def _signed(rows: DataFrame, docs: int, tokens: Column) -> DataFrame:
    return rows.select(*KEYS, F.lit(docs).cast("long").alias("docs"), tokens.cast("long").alias("tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    """Signed rows of new documents, from source, lang, tokenizer, tokens."""
    return _signed(counts, 1, F.col("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Signed rows that take documents back which were inserted with these counts."""
    return _signed(counts, -1, -F.col("tokens"))


def revisions(counts: DataFrame) -> DataFrame:
    """Signed rows of documents whose count changed under the same version: ``old_tokens`` and ``tokens``."""
    return _signed(counts, 0, F.col("tokens") - F.col("old_tokens"))


def commit(store: str, batch: str, changes: DataFrame) -> None:
    """Sum signed rows (see `inserts`, `deletes`, `revisions`) and write them as the batch's partition.

    `store` is a folder that all executors share. A batch committed before is replaced as a whole, so
    the same changes may be committed again at any time. Null sources, languages and versions are
    keys of their own; null tokens count as 0. A batch without
    changes adds nothing. Batch ids are names: letters, digits, - and _.
    """
    if not batch or not all(c.isalnum() or c in "-_" for c in batch):
        raise ValueError(f"no name for a batch: {batch!r}")
    sums = changes.groupBy(*KEYS).agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    )
    # A batch without rows would leave its old partition as it was, so every batch gets a row of zeros.
    spark = changes.sparkSession
    nothing = spark.range(1).select(
        *[F.lit(None).cast("string").alias(k) for k in KEYS], *[F.lit(0).cast("long").alias(c) for c in ("docs", "tokens")]
    )
    rows = sums.unionByName(nothing).withColumn("batch", F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(store)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """source, lang, tokenizer, docs, tokens over all committed batches; keys that came to nothing are left out."""
    rows = spark.read.schema(SCHEMA).parquet(store)
    sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return sums.filter("docs <> 0 OR tokens <> 0")


def batches(spark: SparkSession, store: str) -> DataFrame:
    """The committed batches and their sums over all keys."""
    rows = spark.read.schema(SCHEMA).parquet(store)
    return rows.groupBy("batch").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def compact(spark: SparkSession, store: str, new_store: str, batch: str) -> None:
    """Write the totals of `store` into another one, as its batch `batch`."""
    commit(new_store, batch, totals(spark, store))
