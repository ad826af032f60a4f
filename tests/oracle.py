"""Row-by-row comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
}


def compare(df, con, sql: str) -> list[str]:
    """What differs: column names, types, or rows; empty when nothing does."""
    result = con.execute(sql)
    expected_types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    rows = result.fetchall()
    actual_types = dict(df.dtypes)
    problems = []
    if actual_types != expected_types:
        different = {k: (actual_types.get(k), expected_types.get(k)) for k in {*actual_types, *expected_types}
                     if actual_types.get(k) != expected_types.get(k)}
        problems.append(f"columns (ours, expected): {different}")
    names = sorted(expected_types)
    if set(names) != set(actual_types):
        return problems
    order = [list(expected_types).index(n) for n in names]
    expected = Counter(tuple(_plain(r[i]) for i in order) for r in rows)
    actual = Counter(tuple(_plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if actual != expected:
        problems.append(
            f"{sum(actual.values())} rows, expected {sum(expected.values())}; columns {names}; only ours: "
            f"{list((actual - expected).items())[:3]}; only expected: {list((expected - actual).items())[:3]}"
        )
    return problems
