"""Catalog tables: discovery, writing, comments, views, and new versions of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergelane.operators.mapping import empty_table, union_by_name
from mergelane.operators.upsert import merge_upsert
from mergelane.session import materialize


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Qualified names of the tables of `database`, sorted; temporary views are left out."""
    tables = spark.catalog.listTables(database)
    return sorted(f"{database}.{t.name}" for t in tables if not t.isTemporary)


def union_tables(
    spark: SparkSession, names: Sequence[str], schema: str | T.StructType | None = None
) -> tuple[DataFrame, list[str]]:
    """The union of the named tables, and the names that could not be resolved.

    Resolving a table reads metadata only; empty tables need no check, they add no rows. Without any
    readable table the result is an empty table of `schema`.
    """
    frames, missing = [], []
    for name in names:
        try:
            frames.append(spark.table(name))
        except AnalysisException:
            missing.append(name)
    if frames:
        return union_by_name(frames), missing
    return empty_table(spark, schema or "wholesaler_name string"), missing


def write_table(df: DataFrame, name: str, mode: str = "overwrite", merge_schema: bool = False) -> None:
    """Overwrite or append.

    Appended columns that the table lacks are an error, or with `merge_schema` are added to it, null in
    its old rows. Columns that `df` lacks are null in the new rows.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    if mode != "append" or not spark.catalog.tableExists(name):
        df.write.mode(mode).saveAsTable(name)
        return
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new and not merge_schema:
        raise ValueError(f"{name} has no columns {[f.name for f in new]}; add them with merge_schema")
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    current = spark.table(name)
    union_by_name([current.limit(0), df]).select(*current.columns).write.insertInto(name)


def recover_table(spark: SparkSession, name: str) -> None:
    """Undo or finish a `write_version` of `name` that was stopped; does nothing otherwise."""
    fresh, old = f"{name}__new", f"{name}__old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")


def write_version(df: DataFrame, name: str) -> None:
    """Replace table `name` by `df`, also when `df` reads `name`.

    The rows go to a table of their own first, so a lost job leaves the old table untouched; only the
    finished table takes over the name, with the description, properties, and column comments of the old one. A stop
    between any two statements keeps the old or the new
    rows whole: the next write, or `recover_table`, puts the old table back in place if its name is free.

    A partitioned table is overwritten in place instead, from rows written before, as the partitions that a catalog lists
    do not follow a renaming. A stop while files are put in place then needs the same call again.
    """
    spark = df.sparkSession
    fresh, old = f"{name}__new", f"{name}__old"
    recover_table(spark, name)
    known = spark.catalog.tableExists(name)
    columns = spark.catalog.listColumns(name) if known else []
    if any(c.isPartition for c in columns):
        _overwrite(df, name, "static")
        return
    df.write.saveAsTable(fresh)
    if known:
        _describe_like(spark, name, fresh, {c.name: c.description for c in columns if c.description})
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _describe_like(spark: SparkSession, name: str, fresh: str, comments: Mapping[str, str]) -> None:
    """Give table `fresh` the description and properties of table `name`, and the comments of columns that it has."""
    has = {c.lower() for c in spark.table(fresh).columns}
    kept = {c: text for c, text in comments.items() if c.lower() in has}
    description = spark.catalog.getTable(name).description
    if description or kept:
        describe_table(spark, fresh, description or "", kept)
    properties = [(r["key"], r["value"]) for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()]
    own = [(k, v) for k, v in properties if not k.startswith(("spark.sql.", "transient_")) and k != "comment"]
    if own:
        listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in own)
        spark.sql(f"ALTER TABLE {fresh} SET TBLPROPERTIES ({listed})")


def _overwrite(df: DataFrame, name: str, mode: str) -> None:
    """Overwrite a partitioned table: all of it ("static"), or the partitions that `df` has rows of ("dynamic")."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    rows = materialize(df.select(*spark.table(name).columns), "overwrite")
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(key, before)


def upsert_table(name: str, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """Merge `source` into table `name` (see `merge_upsert`); returns the table, which keeps its whole definition.

    A partitioned table has those partitions overwritten that hold a key of `source`, or take a row of it; the others
    are left as they are. Its partition columns are no `update_cols`, as a row would leave its partition. A stop while files are put in place
    leaves each partition old or new; the same upsert once more completes it. Other tables get a next version.
    """
    spark = source.sparkSession
    recover_table(spark, name)
    target = spark.table(name)
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not partitions:
        write_version(merge_upsert(target, source, keys, update_cols), name)
        return spark.table(name)
    if moved := set(partitions) & set(update_cols):
        raise ValueError(f"{name} is partitioned by {sorted(moved)}, which cannot be updated")
    has = {c.lower() for c in source.columns}
    kinds = {f.name: f.dataType for f in target.schema}
    given = [(F.col(p) if p.lower() in has else F.lit(None)).cast(kinds[p]).alias(p) for p in partitions]
    holding = target.join(source.select(*keys).distinct(), list(keys), "left_semi").select(*partitions)
    touched = holding.unionByName(source.select(*given)).distinct().toDF(*[f"__{p}" for p in partitions])
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__{p}")) for p in partitions])
    _overwrite(merge_upsert(target.join(touched, same, "left_semi"), source, keys, update_cols), name, "dynamic")
    return spark.table(name)


def ensure_table(spark: SparkSession, name: str, schema: str | T.StructType) -> DataFrame:
    """The table, created empty with `schema` if it does not exist."""
    recover_table(spark, name)
    empty_table(spark, schema).write.mode("ignore").saveAsTable(name)
    return spark.table(name)


def append_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows, then new ones; columns matched by name, those one side lacks are null."""
    return union_by_name([old, new])


def register_view(df: DataFrame, name: str) -> DataFrame:
    """`df` under a name SQL can use; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column comments, kept by ``saveAsTable``."""
    unknown = set(comments) - set(df.columns)
    if unknown:
        raise ValueError(f"comments for missing columns: {sorted(unknown)}")
    for name, text in comments.items():
        df = df.withMetadata(name, {"comment": text})
    return df


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe_table(spark: SparkSession, name: str, text: str, comments: Mapping[str, str] | None = None) -> None:
    """Set the description of a table and comments of its columns."""
    spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(text)}")
    for column, comment in (comments or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT {_quoted(comment)}")
