"""Mapping differing layouts to one schema: headers, column specs, union, conform."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a target column is filled from: a source column, candidates in order, an expression, or nothing.
Spec = Union[str, Sequence[str], Column, None]

# The schema all partner sales are brought to.
GOLDEN_SCHEMA = (
    "wholesaler_id string, customer_address string, customer_city string, customer_postal_code string, "
    "customer_country string, customer_name string, customer_number string, product_number string, "
    "article_name string, EAN string, total_amount double, UOM string, wholesaler_name string, "
    "vat_number string, date string, full_file_path string, owner_name string, run_id bigint"
)


def to_schema(schema: str | T.StructType | Mapping[str, str]) -> T.StructType:
    """A StructType from DDL text, from a {name: type} dict, or as it is."""
    if isinstance(schema, T.StructType):
        return schema
    if isinstance(schema, Mapping):
        schema = ", ".join(f"`{name}` {kind}" for name, kind in schema.items())
    return T.StructType.fromDDL(schema)


def header_name(raw: str) -> str:
    """A header cell as a column name: lower case, blanks, dots and hyphens as '_', colons dropped."""
    return re.sub(r"[ .\-\n]", "_", raw.strip().lower().replace(":", ""))


def header_names(raw: Sequence[str | None]) -> list[str]:
    """Names for a whole header: empty cells become ``unnamed_<position>``, repeats get ``_1``, ``_2``, …"""
    seen: dict[str, int] = {}
    taken: set[str] = set()
    out = []
    for position, cell in enumerate(raw):
        base = header_name(cell or "") or f"unnamed_{position}"
        name = base
        while name in taken:
            seen[base] = seen.get(base, 0) + 1
            name = f"{base}_{seen[base]}"
        taken.add(name)
        out.append(name)
    return out


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*header_names(df.columns))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def map_columns(
    df: DataFrame, mapping: Mapping[str, Spec], schema: str | T.StructType | Mapping[str, str]
) -> DataFrame:
    """Bring `df` to `schema`, each column filled as `mapping` says; one projection.

    A list of candidates takes the first non-null among those `df` has, in list order; names match
    without regard to case. A target that is not mapped, mapped to None, or whose candidates are
    all missing becomes a typed null. A single missing name is an error in the mapping and raises.
    """
    present = {c.lower(): c for c in df.columns}

    def source(target: str, spec: Spec) -> Column:
        if spec is None:
            return F.lit(None)
        if isinstance(spec, Column):
            return spec
        if isinstance(spec, str):
            if spec.lower() not in present:
                raise ValueError(f"{target}: no column {spec!r} among {df.columns}")
            return _quoted(present[spec.lower()])
        found = [_quoted(present[s.lower()]).cast("string") for s in spec if s.lower() in present]
        return F.coalesce(*found) if found else F.lit(None)

    fields = to_schema(schema).fields
    unknown = set(mapping) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"mapped columns outside the schema: {sorted(unknown)}")
    return df.select(
        *[_as_type(source(f.name, mapping.get(f.name)), f.dataType).alias(f.name) for f in fields]
    )


def _as_type(col: Column, kind: T.DataType) -> Column:
    return col.cast(kind) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else col.try_cast(kind)


def conform(df: DataFrame, schema: str | T.StructType | Mapping[str, str]) -> DataFrame:
    """Exactly the columns of `schema`, in order and type.

    Missing columns become typed nulls, values that do not cast become null, and extra columns go.
    A null in a NOT NULL column fails the job when the row is read.
    """
    present = {c.lower(): c for c in df.columns}
    out = []
    for field in to_schema(schema).fields:
        name = present.get(field.name.lower())
        value = _as_type(_quoted(name) if name else F.lit(None), field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"null in NOT NULL column {field.name}")).cast(field.dataType)
            value = F.coalesce(value, missing)
        out.append(value.alias(field.name))
    return df.select(*out)


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column one input lacks is null there."""
    if not dfs:
        raise ValueError("nothing to union; use union_conform for an empty result")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def empty_table(spark: SparkSession, schema: str | T.StructType | Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame([], to_schema(schema))


def union_conform(
    spark: SparkSession, dfs: Sequence[DataFrame], schema: str | T.StructType | Mapping[str, str]
) -> DataFrame:
    """Union of any number of inputs, brought to `schema`; no input gives an empty table."""
    if not dfs:
        return empty_table(spark, schema)
    return conform(union_by_name(dfs), schema)
