"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "mergelane", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SCALE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    All executors must share it, so a session without the setting gets a folder in its warehouse,
    which they share too; never one of a single machine's temporary folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return folder.rstrip("/")


# With it, Spark removes the shuffle files of a job at its end, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# For wide rows with keys of hexadecimal digits, which the usual codec keeps at their length.
DENSE = "zstd"
# The tables that are emptied at the end of the innermost `settle`.
_scratch: ContextVar[list[DataFrame] | None] = ContextVar("scratch", default=None)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, tag: str, codec: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives lost executors.

    The written files also give the optimizer a true size for the next join. Shuffle files of the job go at its end. Results may
    still read the table, so it stays until `discard`. `codec` compresses its files, or else the session's codec.
    """
    return materialize_parts([df], tag, codec)


def materialize_parts(parts: Iterable[DataFrame], tag: str, codec: str | None = None) -> DataFrame:
    """One table of `parts`, all of the same columns, which are written one after the other, each with shuffle files of its own."""
    folder, paths = "", []
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        folder = folder or f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
        paths.append(f"{folder}-{len(paths)}" if paths else folder)
        with _shuffles_removed(spark):
            df.write.parquet(paths[-1], compression=codec)
    table = spark.read.schema(schema).parquet(*paths)
    table.__dict__["_written"] = True
    if (tables := _scratch.get()) is not None:
        tables.append(table)
    return table


def stored(df: DataFrame, tag: str) -> DataFrame:
    """`df` itself if it is a table that `materialize` wrote, or else what `materialize` makes of it."""
    return df if df.__dict__.get("_written") else materialize(df, tag)


def settle(build: Callable[[], DataFrame], tag: str) -> DataFrame:
    """The rows of `build()`, written as `materialize` does it, densely; the tables that were written inside are emptied then.

    Nothing but the result of `build` may read those tables.
    """
    token = _scratch.set([])
    try:
        df = build()
        written = _scratch.get()
    finally:
        _scratch.reset(token)
    result = materialize(df, tag, DENSE)
    for table in written:
        discard(table)
    return result


def discard(table: DataFrame) -> None:
    """Empty a table that `materialize` wrote, and that nothing will read any more."""
    if table.__dict__.get("_written") is False:
        return  # emptied before
    table.__dict__["_written"] = False
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema]
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        table.sparkSession.range(0).coalesce(1).select(*columns).write.mode("overwrite").parquet(folder)
