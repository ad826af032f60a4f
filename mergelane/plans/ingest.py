"""From partner files to one golden table."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from mergelane.functions.text import clean_path
from mergelane.operators.mapping import GOLDEN_SCHEMA, Spec, conform, map_columns
from mergelane.sources.files import read_csv_layout
from mergelane.sources.tables import list_tables, union_tables


def ingest_partner(
    spark: SparkSession,
    path: str,
    mapping: Mapping[str, Spec],
    csv: Mapping[str, object] | None = None,
    schema: str = GOLDEN_SCHEMA,
) -> DataFrame:
    """All files of one partner, brought to `schema`.

    `mapping` is as for `map_columns`, over normalised header names and ``full_file_path``; the path
    itself is kept in readable form. `csv` has the layout options of `read_csv_layout`. The date may
    be mapped to ``full_file_path``, for partners who write it into file names only.
    """
    raw = read_csv_layout(spark, path, **(csv or {}))
    return map_columns(raw, {"full_file_path": clean_path("full_file_path"), **mapping}, schema)


def consolidate(spark: SparkSession, database: str, schema: str = GOLDEN_SCHEMA, skip_unreadable: bool = False) -> DataFrame:
    """The tables of all partners as one, in `schema`.

    Tables that cannot be read are an error; with `skip_unreadable` they are left out, with a warning
    that names them.
    """
    union, unreadable = union_tables(spark, list_tables(spark, database), schema)
    if unreadable and not skip_unreadable:
        raise ValueError(f"cannot read {', '.join(unreadable)}")
    if unreadable:
        warnings.warn(f"left out, as they cannot be read: {', '.join(unreadable)}", stacklevel=2)
    return conform(union, schema)
