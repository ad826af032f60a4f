"""Ingest audit: what was read from where, with row and column counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelane.functions.text import clean_output_path

# What is logged per file and section.
AUDIT = (
    "source_path string, sheet_name string, output_path string, row_count int, column_count int, "
    "timestamp timestamp, runstarttime timestamp"
)


def ingest_audit(
    df: DataFrame,
    run_start: datetime,
    now: datetime,
    path: str = "full_file_path",
    section: str | None = None,
    output_path: str | None = None,
    ignore: Sequence[str] = (),
    sources: DataFrame | None = None,
) -> DataFrame:
    """One audit row per source path and section of `df`.

    `sources` lists what was read (the same path, section and output columns, one row each): a file or
    section without rows then has a row of its own, with a count of 0. The column count leaves out the
    path, section and `ignore` columns, which the reader added.
    """
    added = {path, section, output_path, *ignore}
    width = sum(c not in added for c in df.columns)
    sheet = F.col(section) if section else F.lit(None).cast("string")
    keys = [
        F.col(path).alias("source_path"), sheet.alias("sheet_name"),
        clean_output_path(F.col(output_path or path)).alias("output_path"),
    ]
    rows = df.select(*keys, F.lit(1).alias("__n"))
    if sources is not None:
        rows = rows.unionByName(sources.select(*keys, F.lit(0).alias("__n")))
    counts = rows.groupBy("source_path", "sheet_name", "output_path").agg(F.sum("__n").cast("int").alias("row_count"))
    return counts.withColumns({
        "column_count": F.lit(width), "timestamp": F.lit(now), "runstarttime": F.lit(run_start),
    })
