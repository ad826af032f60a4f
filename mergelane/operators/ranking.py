"""One row per key, distinct entities, group counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergelane.operators.lookups import lookup


def top_n(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first `n` rows per key, numbered in `rank`.

    Spark prunes each map task to `n` rows per key before the shuffle (WindowGroupLimit), so a key
    that holds a third of the table sends n rows per task, not a third of the table. `order` has
    to be total, or the pick may change from run to run.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def latest_per_key(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], rank: str | None = None
) -> DataFrame:
    """The first row per key under `order`; keeps the (constant) rank column if it is named."""
    top = top_n(df, keys, order, 1, rank or "__rank")
    return top if rank else top.drop("__rank")


def with_count(df: DataFrame, keys: Sequence[str], name: str = "match_count") -> DataFrame:
    """Every row with the size of its key group (null keys form one group).

    Counted by a partial aggregate and joined back, so that no task has to hold a whole group.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return lookup(df, counts, list(keys), [name], null_safe=True)


def distinct_entities(df: DataFrame, cols: Sequence[str], fallback: dict[str, str] | None = None) -> DataFrame:
    """Distinct rows over `cols`; ``fallback={a: b}`` fills a null `a` from `b` first."""
    fills = {a: F.coalesce(F.col(a), F.col(b)) for a, b in (fallback or {}).items()}
    return df.select(*[fills.get(c, F.col(c)).alias(c) for c in cols]).distinct()
