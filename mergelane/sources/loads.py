"""Append-only tables of committed loads.

A table is a folder: ``data/version=<id>`` holds the rows of a load, ``commits`` one small file for each load. Readers go by the
commits, which Spark moves into place at the end of a job: a load that was stopped before its commit is not there.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_COMMIT = "number long, version string, rows long"


def committed(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(number, version, rows) of every load, the oldest first; empty where there is no table yet."""
    try:
        rows = spark.read.schema(_COMMIT).json(f"{path}/commits").collect()
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = sorted(tuple(r) for r in rows)
    if [n for n, *_ in found] != list(range(len(found))):
        raise RuntimeError(f"{path}: two loads were committed at the same time")
    return found


def read_loads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed loads, in one scan."""
    folders = [f"{path}/data/version={version}" for _, version, _ in committed(spark, path)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def append_load(df: DataFrame, path: str, number: int) -> None:
    """Write `df` and commit it as load `number`, the count of loads that its rows were made from.

    Two loads made from the same ones are an error that the next reader sees.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path}/data/version={version}"
    df.write.parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).count()
    spark.createDataFrame([(number, version, rows)], _COMMIT).coalesce(1).write.mode("append").json(f"{path}/commits")
