"""A log of requests to a provider: answers that survive its failures, and restarts that ask only what is open.

The log is a folder of Parquet files, one row for every key and attempt. Keys are asked in portions; each portion is
appended when it is done, so a stop loses one portion at most. A batch that fails is asked again in halves, so that one bad
key costs its own answer only, which is logged with the error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergelane.session import materialize, shared_folder

KEYS = ["api_name", "payload_string"]
# Keys of one portion, and of one call to the provider.
PORTION = 100_000
BATCH = 100
# Keys of a task that asks, unless the number of tasks is given: by bytes, Spark would make few tasks of small keys.
TASK_KEYS = 4_000
# Keys of a task that writes portions, at most.
SLICE = 500_000


def log_schema(answer: T.StructType) -> T.StructType:
    """The columns of a log whose answers have those of `answer`."""
    own = "attempt int, status string, error string, asked_at timestamp"
    keys = [T.StructField(k, T.StringType()) for k in KEYS]
    return T.StructType([*keys, *T.StructType.fromDDL(own).fields, *answer.fields])


def read_log(spark: SparkSession, path: str, answer: T.StructType) -> DataFrame:
    """All rows of a log; none if there is no log yet."""
    schema = log_schema(answer)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _ask(provider: Callable[[pd.DataFrame], pd.DataFrame], batch: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    """The batch with answers, status and error; a failing one is asked again in halves."""
    keys, given, failed, errors, open_ = batch[KEYS], [], [], [], [(0, len(batch))]
    while open_:
        start, end = open_.pop()
        try:
            given.append(provider(keys.iloc[start:end])[[*KEYS, *names]])
        except Exception as failure:  # whatever a provider raises is an outcome to be logged
            if end - start == 1:
                failed.append(start)
                errors.append(f"{type(failure).__name__}: {failure}")
            else:
                half = start + (end - start) // 2
                open_ += [(half, end), (start, half)]
    # Put together once a batch: a frame for every half would cost more than the calls.
    parts = [pd.concat(given).assign(status="ok", error=None)] if given else []
    if failed:
        parts.append(keys.iloc[failed].assign(**dict.fromkeys(names), status="error", error=errors))
    return pd.concat(parts)


def _in_portions(open_: DataFrame, portions: int, portion: int) -> DataFrame:
    """`open_` with its ``__portion``, written in a folder for each, so that a portion reads nothing of the others."""
    spark, path = open_.sparkSession, f"{shared_folder(open_.sparkSession)}/portions-{uuid.uuid4().hex}"
    slices = -(-portion // SLICE)
    numbered = open_.withColumn("__portion", F.pmod(F.xxhash64(*KEYS), F.lit(portions)).cast("int"))
    sliced = numbered.repartition(portions * slices, "__portion", F.pmod(F.hash(*KEYS), F.lit(slices)))
    sliced.write.partitionBy("__portion").parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)


def ask_open(
    questions: DataFrame, provider: Callable[[pd.DataFrame], pd.DataFrame], answer: T.StructType, path: str, now: datetime,
    tasks: int | None = None, portion: int = PORTION, batch_rows: int = BATCH,
) -> None:
    """Ask the provider for all keys of `questions` that the log at `path` has no answer for, and log what comes back.

    Each distinct key is asked once, and once more for each half of a failing batch it is in; keys whose last attempt failed are asked again by the next call.
    Null keys are keys as well. What is open is found out and written once; `portion` keys at a time are asked and appended. A task that Spark repeats asks its keys again.
    """
    spark = questions.sparkSession
    names = answer.names
    before = read_log(spark, path, answer).groupBy(*KEYS).agg(
        F.max("attempt").alias("__attempt"), F.max((F.col("status") == "ok").cast("int")).alias("__done")
    )
    same = [F.col(f"q.{k}").eqNullSafe(F.col(f"l.{k}")) for k in KEYS]
    known = questions.select(*KEYS).distinct().alias("q").join(before.alias("l"), same[0] & same[1], "left")
    open_ = materialize(known.filter(F.coalesce("__done", F.lit(0)) == 0).select(
        *[f"q.{k}" for k in KEYS], (F.coalesce("__attempt", F.lit(0)) + 1).cast("int").alias("attempt")
    ), "open")
    rows = open_.count()
    portions = max(1, -(-rows // portion))
    # Asked in one go or from folders of their own: no portion finds out again what is open.
    numbered = _in_portions(open_, portions, portion) if portions > 1 else open_.withColumn("__portion", F.lit(0))
    tasks = tasks or max(1, -(-rows // (portions * TASK_KEYS)))
    schema = log_schema(answer)
    returned = T.StructType([f for f in schema.fields if f.name != "asked_at"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start : start + batch_rows]
                answered = _ask(provider, part, names).merge(part, on=KEYS, how="left")
                yield answered[returned.names]

    for n in range(portions):
        mine = numbered.filter(F.col("__portion") == n).drop("__portion").repartition(tasks, *KEYS)
        asked = mine.mapInPandas(run, returned).withColumn("asked_at", F.lit(now))
        asked.select(*schema.names).write.mode("append").parquet(path)


def answers(log: DataFrame) -> DataFrame:
    """One row a key that has an answer: its first one."""
    rest = [c for c in log.columns if c not in KEYS]
    first = log.filter("status = 'ok'").groupBy(*KEYS).agg(F.min_by(F.struct(*rest), F.struct("attempt", "asked_at")).alias("r"))
    return first.select(*KEYS, "r.*")


def failures(log: DataFrame) -> DataFrame:
    """One row a key that has no answer yet: its last error."""
    last = log.groupBy(*KEYS).agg(
        F.max_by(F.struct("attempt", "error", "asked_at"), "attempt").alias("r"), F.max((F.col("status") == "ok").cast("int")).alias("done")
    )
    return last.filter("done = 0").select(*KEYS, "r.*")
