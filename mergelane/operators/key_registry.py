"""Dense, stable number keys for describing columns, kept in a table.

Unlike a hash of the columns, two entities never get the same key, and an entity keeps its key in every later load.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelane.operators.lookups import lookup
from mergelane.session import discard, materialize
from mergelane.sources.loads import append_load, committed, read_loads

# monotonically_increasing_id holds the partition above these bits, and the row's number in it below them.
_ROW_BITS = 33


def read_keys(spark: SparkSession, path: str, like: DataFrame, columns: Sequence[str], key: str = "entity_id") -> DataFrame:
    """The registry: `columns`, with the types that they have in `like`, and `key`."""
    described = ", ".join(f"`{c}` {like.schema[c].dataType.simpleString()}" for c in columns)
    return read_loads(spark, path, f"{described}, `{key}` long")


def register_keys(df: DataFrame, columns: Sequence[str], path: str, key: str = "entity_id") -> int:
    """Give every new combination of `columns` the next free number, from 1; returns how many were new.

    Null is a value like others. New combinations are written once, and numbered by the counts of the partitions they
    were written from: one row a partition comes to the driver, and no task sees all of them. A load that is stopped leaves
    nothing and takes no numbers; repeating a load adds nothing.
    """
    spark = df.sparkSession
    loads = committed(spark, path)
    known = read_keys(spark, path, df, columns, key)
    same = [df[c].eqNullSafe(known[c]) for c in columns]
    found = df.select(*columns).distinct() if not loads else df.join(known, same, "left_anti").select(*columns).distinct()
    new = materialize(found.withColumn("__row", F.monotonically_increasing_id()), "new-keys")
    part = F.shiftright("__row", _ROW_BITS)
    counts = sorted(tuple(r) for r in new.groupBy(part.alias("part")).count().collect())
    if counts:
        used = sum(rows for *_, rows in loads)
        before = accumulate((n for _, n in counts), initial=used + 1)
        offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "__part long, __before long")
        placed = lookup(new.withColumn("__part", part), offsets, ["__part"], ["__before"])
        number = F.col("__before") + F.col("__row").bitwiseAND((1 << _ROW_BITS) - 1)
        append_load(placed.select(*columns, number.alias(key)), path, len(loads))
    discard(new)
    return sum(n for _, n in counts)


def with_keys(df: DataFrame, columns: Sequence[str], path: str, key: str = "entity_id") -> DataFrame:
    """`df` with the key of its `columns`; null where they were never registered."""
    return lookup(df, read_keys(df.sparkSession, path, df, columns, key), list(columns), [key], null_safe=True)
