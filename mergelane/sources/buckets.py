"""Tables in buckets of their keys: an upsert rewrites only the buckets that it touches.

A table is a folder. ``data/version=<id>/__bucket=<n>`` holds the rows of a bucket as some upsert left them, ``commits`` one
small file for each upsert, which names the version of every bucket. Readers go by the newest commit alone, and Spark
moves a finished file into place at the end of a job: until the commit is there, a stopped upsert has changed
nothing, and from then on everything. Files of untouched buckets are neither read nor written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergelane.operators.mapping import conform
from mergelane.operators.upsert import merge_upsert

_COMMIT = "number long, schema string, keys array<string>, buckets int, versions array<string>"


def _newest(spark: SparkSession, path: str) -> dict:
    """The newest commit, as a dictionary."""
    try:
        commits = spark.read.schema(_COMMIT).json(f"{path}/commits")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"{path} is no table in buckets") from failure
    found = commits.orderBy(F.desc("number")).limit(2).collect()
    if len(found) == 2 and found[0]["number"] == found[1]["number"]:
        raise RuntimeError(f"{path}: two upserts committed number {found[0]['number']} at the same time")
    return found[0].asDict()


def _commit(spark: SparkSession, path: str, commit: dict) -> None:
    row = spark.createDataFrame([tuple(commit[f.name] for f in T.StructType.fromDDL(_COMMIT))], _COMMIT)
    row.coalesce(1).write.mode("append").json(f"{path}/commits")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; rows with null keys have one as well."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> str:
    """Write rows by their bucket as a version of its own; returns its id."""
    version = uuid.uuid4().hex
    # A column name of its own, as tables may have a column called bucket.
    placed = df.withColumn("__bucket", _bucket(keys, buckets))
    placed.write.partitionBy("__bucket").parquet(f"{path}/data/version={version}")
    return version


def create_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """A new table of the rows of `df` in a folder that holds none yet.

    Choose so many buckets that one is what a task can rewrite; it stays the same for the table's life.
    """
    spark = df.sparkSession
    version = _write(df, path, keys, buckets)
    _commit(spark, path, {
        "number": 0, "schema": df.schema.json(), "keys": list(keys), "buckets": buckets,
        "versions": [version] * buckets,
    })


def _read(spark: SparkSession, path: str, commit: dict, only: Sequence[int] | None = None) -> DataFrame:
    """The rows of some buckets, or of all, as a commit names them."""
    schema = T.StructType.fromJson(json.loads(commit["schema"]))
    parts = []
    for version in sorted(set(commit["versions"])):
        held = [b for b, v in enumerate(commit["versions"]) if v == version and (only is None or b in only)]
        if held:
            placed = T.StructType([*schema.fields, T.StructField("__bucket", T.IntegerType())])
            # The folders of other buckets are pruned, not read.
            rows = spark.read.schema(placed).parquet(f"{path}/data/version={version}")
            parts.append(rows.filter(F.col("__bucket").isin(held)).drop("__bucket"))
    out = spark.createDataFrame([], schema)
    for part in parts:
        out = out.unionAll(part)
    return out


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest commit."""
    return _read(spark, path, _newest(spark, path))


def upsert_buckets(path: str, source: DataFrame, update_cols: Sequence[str]) -> list[int]:
    """Merge `source` into the table by its keys (see `merge_upsert`); returns the buckets that were rewritten.

    Only buckets with a key of `source` are read and written. Two upserts at a time are an error that the next reader
    sees, not a silent loss. `source` is computed several times, so pass a table.
    """
    spark = source.sparkSession
    commit = _newest(spark, path)
    keys, buckets = commit["keys"], commit["buckets"]
    touched = sorted(r[0] for r in source.select(_bucket(keys, buckets)).distinct().collect())
    if not touched:
        return []
    old = _read(spark, path, commit, touched)
    merged = conform(merge_upsert(old, source, keys, update_cols), old.schema)
    version = _write(merged, path, keys, buckets)
    versions = [version if b in touched else v for b, v in enumerate(commit["versions"])]
    _commit(spark, path, {**commit, "number": commit["number"] + 1, "versions": versions})
    return touched
