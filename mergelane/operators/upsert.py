"""Upsert of rows into a table, as a new DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelane.operators.lookups import lookup


def unique_rows(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """`df` reduced to `keys` and `cols`; the job fails when a key without nulls comes twice."""
    row = F.struct(*cols)
    grouped = df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(row).alias("__row")
    )
    twice = F.raise_error(F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys))))
    row = F.when(F.col("__n") == 1, F.col("__row")).otherwise(twice.cast(df.select(row).schema[0].dataType))
    return grouped.select(*keys, row.alias("__row"))


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """The rows of `target` after merging `source` into it.

    Matched rows take `update_cols` from the source and keep the rest; unmatched source rows are
    inserted with the columns they share with the target (others null). A null key matches nothing,
    so such rows are inserted. Two source rows with the same key fail the job, as MERGE does.

    The result is a new DataFrame: write it with `write_version` when the target is a table.
    """
    updates = unique_rows(source, keys, update_cols).withColumns({
        "__new": F.col("__row"), "__matched": F.lit(True)
    })
    kept = lookup(target, updates, list(keys), ["__new", "__matched"])
    changes = {
        c: F.when(F.col("__matched"), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in update_cols
    }
    kept = kept.withColumns(changes).select(*target.columns)

    # Only keys that the source has are made distinct, so a small source moves no row of a large target.
    known = target.select(*keys).join(source.select(*keys).distinct(), list(keys), "left_semi").distinct()
    inserts = source.join(known, list(keys), "left_anti")
    shared = {c.lower() for c in source.columns}
    inserts = inserts.select(*[
        (F.col(f.name) if f.name.lower() in shared else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema
    ])
    return kept.unionByName(inserts)
