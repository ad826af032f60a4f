"""Left lookups into tables with one row per key, safe against hot keys on the left."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergelane.functions.text import strip_leading_zeros

# A join key is a name both sides have, or a (left, right) pair of names or expressions.
Key = str | tuple[Column | str, Column | str]


def key_columns(on: Sequence[Key]) -> list[tuple[Column, Column]]:
    """`on` as (left, right) expression pairs."""
    pairs = []
    for key in on:
        a, b = (key, key) if isinstance(key, str) else key
        pairs.append((F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b))
    return pairs


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[Key],
    cols: Sequence[str],
    right_filter: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Every row of `left` with `cols` of its row in `right`, or nulls; never more rows than `left`.

    `right` must have one row per key (see `pick_one`). `right_filter` limits `right` as a one-sided
    ON condition would. `null_safe` lets null keys meet.

    One left join at any size: Catalyst and AQE broadcast a small `right`, and AQE splits the partition of a hot key of
    `left`. Null keys, which find nothing, are dealt over all tasks.
    """
    taken = [c for c in cols if c in left.columns]
    if taken:
        raise ValueError(f"columns {taken} are on the left already; rename them first")
    if right_filter is not None:
        right = right.filter(right_filter)
    return _left_join(left, right, on, cols, null_safe)


def _left_join(left: DataFrame, right: DataFrame, on: Sequence[Key], cols: Sequence[str], null_safe: bool) -> DataFrame:
    pairs = key_columns(on)
    names = [f"__k{i}" for i in range(len(pairs))]
    keyed = left.withColumns({n: l for (l, _), n in zip(pairs, names)})
    dim = right.select(*[r.alias(f"__r{n}") for (_, r), n in zip(pairs, names)], *cols)
    if not null_safe and any(keyed.schema[n].nullable for n in names):
        # Rows with a null key find nothing, so they are dealt over all tasks rather than to the one that has the nulls. The
        # other rows have a zero on both sides; on the right it comes of the key, as the optimizer takes literals out of a join.
        plain = [f.name for f in left.schema if isinstance(f.dataType, (T.StringType, T.NumericType, T.DatetimeType))]
        any_null = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
        keyed = keyed.withColumn("__spread", F.when(any_null, F.xxhash64(*[F.col(f"`{c}`") for c in plain])).otherwise(F.lit(0).cast("long")))
        dim = dim.withColumn("__r__spread", F.xxhash64(f"__r{names[0]}").bitwiseAND(F.lit(0).cast("long")))
        names = [*names, "__spread"]
    return keyed.join(dim, _meets(names, "__r", null_safe), "left").select(*left.columns, *cols)


def _meets(names: Sequence[str], tag: str, null_safe: bool) -> Column:
    pairs = [(F.col(n), F.col(tag + n)) for n in names]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def pick_one(right: DataFrame, on: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """One row per key of a lookup table: the first under `order`. Rows with a null key go.

    Doing this to the table before the join, rather than to the joined rows after it, avoids the
    fan-out and makes the pick the same in every run.
    """
    keyed = right.withColumns({f"__p{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(on)})
    names = [f"__p{i}" for i in range(len(on))]
    ranked = keyed.dropna(subset=names).withColumn(
        "__rank", F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    )
    return ranked.filter("__rank = 1").drop("__rank", *names)


def pick_one_lookup(
    left: DataFrame, right: DataFrame, on: Sequence[Key], cols: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Left lookup that keeps one match per left row: the first row of `right` under `order`."""
    keys = [r for _, r in key_columns(on)]
    return lookup(left, pick_one(right, keys, order), on, cols)


def zero_key_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    cols: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Left lookup on ids compared without leading zeros.

    Ids of zeros only are equal to each other, as the bare text comparison has it. With `order` the
    right side is reduced to one row per stripped key; without it every match gives a row.
    """
    on = [(strip_leading_zeros(a), strip_leading_zeros(b)) for a, b in pairs]
    if order is not None:
        return pick_one_lookup(left, right, on, cols, order)
    return join_all(left, right, on, cols)


def join_all(
    left: DataFrame, right: DataFrame, on: Sequence[Key], cols: Sequence[str], right_filter: Column | None = None
) -> DataFrame:
    """Left join that keeps every match; `right_filter` is a one-sided ON condition.

    AQE splits the partition of a hot key of the left. Null keys are dealt over all tasks.
    """
    if right_filter is not None:
        right = right.filter(right_filter)
    return _left_join(left, right, on, cols, False)


def priority_lookup(
    left: DataFrame, paths: Sequence[tuple[DataFrame, Sequence[Key]]], cols: Sequence[str]
) -> DataFrame:
    """Look `cols` up along several paths; per column the first path with a value wins.

    Each column falls back on its own. Every path needs one row per key.
    """
    out = left
    for i, (right, on) in enumerate(paths):
        renamed = right.withColumnsRenamed({c: f"__v{i}_{c}" for c in cols})
        keys = [(l, _renamed(r, cols, i)) for l, r in (k if isinstance(k, tuple) else (k, k) for k in on)]
        out = lookup(out, renamed, keys, [f"__v{i}_{c}" for c in cols])
    best = {c: F.coalesce(*[F.col(f"__v{i}_{c}") for i in range(len(paths))]) for c in cols}
    return out.select(*[F.col(c) for c in left.columns if c not in cols], *[v.alias(c) for c, v in best.items()])


def _renamed(key: Column | str, cols: Sequence[str], i: int) -> Column | str:
    if isinstance(key, str) and key in cols:
        return f"__v{i}_{key}"
    return key
