"""The enrichment loop: what a month's budget allows is asked, kept in a table, and read back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame

from mergelane.operators.enrichment import (
    CACHE_KEYS,
    CACHE_SCHEMA,
    CACHE_VALUES,
    Provider,
    attach_cached,
    cache_rows,
    enrich,
    select_for_enrichment,
)
from mergelane.sources.tables import ensure_table, upsert_table


def enrichment_round(
    rows: DataFrame,
    cache_table: str,
    provider: Provider,
    schema: str,
    budget: int,
    now: datetime,
    order: Sequence[Column | str],
    retry: bool = True,
    tasks: int | None = None,
    log: str | None = None,
) -> DataFrame:
    """`rows` with place id and url as cached after this round.

    The first rows, by `order`, whose payload has no cached answer are asked, as many as the month's
    `budget` still allows; their answers are upserted into `cache_table`, which is created if need be.
    A round after a stop asks only what the table does not hold, and with `log`, a folder for the log of requests, nothing
    that was answered before the stop. `rows` need the columns of a
    customer and of `address_payload`.
    """
    cache = ensure_table(rows.sparkSession, cache_table, CACHE_SCHEMA)
    asked = select_for_enrichment(rows, cache, budget, now, order, retry)
    answers = cache_rows(enrich(asked, provider, schema, now, tasks, log))
    after = upsert_table(cache_table, answers, CACHE_KEYS, CACHE_VALUES)
    return attach_cached(rows, after)
