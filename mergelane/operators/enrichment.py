"""Enrichment through a keyed provider: payloads, a cache of answers, a monthly budget."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergelane.functions.dates import since_month_start
from mergelane.functions.text import as_column, mask_query_param
from mergelane.operators import requests
from mergelane.operators.lookups import lookup
from mergelane.operators.upsert import merge_upsert
from mergelane.session import shared_folder

# The table of answers.
CACHE_SCHEMA = (
    "business_partner_name string, business_partner_country string, business_partner_postal_code string, "
    "business_partner_address string, business_partner_city string, payload string, api_name string, "
    "api_url_masked string, browser_url string, place_id string, google_api_raw_json string, "
    "api_execution_timestamp timestamp"
)
CACHE_KEYS = ["api_name", "payload"]
CACHE_VALUES = ["place_id", "browser_url", "google_api_raw_json", "api_url_masked", "api_execution_timestamp"]
# The identity columns of a customer and their names in the table of answers.
PARTNER_COLUMNS = {
    "customer_name": "business_partner_name",
    "customer_country": "business_partner_country",
    "customer_postal_code": "business_partner_postal_code",
    "customer_address": "business_partner_address",
    "customer_city": "business_partner_city",
}

# A provider gets api_name and payload_string and returns both plus the columns of its schema.
Provider = Callable[[pd.DataFrame], pd.DataFrame]


def address_payload(
    df: DataFrame,
    region: Column | str,
    lines: Sequence[Column | str],
    locality: Column | str,
    postal_code: Column | str,
    api_name: str,
    api_url: Column | None = None,
) -> DataFrame:
    """`df` with ``payload`` (nested address), ``payload_string`` (its JSON), ``api_name``, ``api_url``.

    Null address lines are left out; other null parts do not show in the JSON.
    """
    address = F.struct(
        as_column(region).alias("regionCode"),
        F.array_compact(F.array(*[as_column(c) for c in lines])).alias("addressLines"),
        as_column(locality).alias("locality"),
        as_column(postal_code).alias("postalCode"),
    )
    payload = F.struct(address.alias("address"))
    return df.withColumns({
        "payload": payload,
        "payload_string": F.to_json(payload),
        "api_name": F.lit(api_name),
        "api_url": api_url if api_url is not None else F.lit(None).cast("string"),
    })


def attach_cached(
    df: DataFrame, cache: DataFrame, cols: Sequence[str] = ("browser_url", "place_id")
) -> DataFrame:
    """`df` with the cached answer of its (payload, api); columns of the same name are replaced.

    The cache has one row per key. A hash of the long payload text leads the join keys.
    """
    on = [
        (F.xxhash64("payload_string"), F.xxhash64("payload")),
        (F.col("payload_string"), F.col("payload")),
        (F.col("api_name"), F.col("api_name")),
    ]
    return lookup(df.drop(*cols), cache, on, list(cols))


def calls_this_month(cache: DataFrame, now: datetime) -> DataFrame:
    """One row, ``used``: answers fetched since the first of the month of `now`."""
    return cache.select(F.count_if(since_month_start("api_execution_timestamp", now)).alias("used"))


def select_for_enrichment(
    df: DataFrame, cache: DataFrame, budget: int, now: datetime, order: Sequence[Column | str], retry: bool = True
) -> DataFrame:
    """The first rows, by `order`, without an answer: as many as the month's budget still allows.

    `order` should be total. With `retry`, a cached answer without a place id counts as missing.
    Runs one job that counts the calls of this month.
    """
    left = max(budget - calls_this_month(cache, now).first().used, 0)
    known = cache.withColumn("__cached", F.lit(True))
    with_answer = attach_cached(df, known, ["browser_url", "place_id", "__cached"])
    open_rows = F.col("place_id").isNull() if retry else F.col("__cached").isNull()
    return with_answer.filter(open_rows).drop("__cached").orderBy(*order).limit(left)


def enrich(
    df: DataFrame, provider: Provider, schema: str, now: datetime, tasks: int | None = None, log: str | None = None
) -> DataFrame:
    """`df` with the answers of `provider`: the columns of `schema` plus ``api_execution_timestamp``.

    Every distinct (api_name, payload_string) without an answer in the log of requests is asked once, in batches, by
    `tasks` tasks at a time (by the number of keys if unset). What comes back is appended to the log at once, failures
    too, so that whatever reads the result, however often, asks nobody again, and a provider that fails for one key loses
    no other answer: that key's are null. `log` is the folder of the log, which later calls go on with; without it
    the log is one in the shared folder for this call alone. Columns of the same names are replaced.
    """
    answer = T.StructType.fromDDL(schema)
    path = log or f"{shared_folder(df.sparkSession)}/requests-{uuid.uuid4().hex}"
    requests.ask_open(df, provider, answer, path, now, tasks)
    found = read_answers(df.sparkSession, path, answer)
    cols = [*answer.names, "api_execution_timestamp"]
    return lookup(df.drop(*cols), found, requests.KEYS, cols, null_safe=True)


def read_answers(spark: SparkSession, path: str, answer: T.StructType) -> DataFrame:
    """One row for each key of a log of requests: its answer, or nulls, and when it was given, or asked for in vain."""
    log = requests.read_log(spark, path, answer)
    given = requests.answers(log).select(*requests.KEYS, *answer.names, F.col("asked_at").alias("api_execution_timestamp"))
    vain = requests.failures(log).select(
        *requests.KEYS, *[F.lit(None).cast(f.dataType).alias(f.name) for f in answer.fields],
        F.col("asked_at").alias("api_execution_timestamp"),
    )
    return given.unionByName(vain)


def cache_rows(enriched: DataFrame, url_param: str = "key") -> DataFrame:
    """Enriched customers as rows for the cache, the secret in the url masked; one row per key."""
    names = {**PARTNER_COLUMNS, "payload_string": "payload"}
    flat = enriched.drop("payload").withColumnsRenamed(names)
    cols = [f.name for f in T.StructType.fromDDL(CACHE_SCHEMA)]
    rows = flat.withColumn("api_url_masked", mask_query_param("api_url", url_param)).select(*cols)
    identity = [c for c in cols if c not in CACHE_KEYS]
    return rows.groupBy(*CACHE_KEYS).agg(F.min(F.struct(*identity)).alias("r")).select(*CACHE_KEYS, "r.*").select(*cols)


def update_cache(cache: DataFrame, enriched: DataFrame) -> DataFrame:
    """The cache after one round: known keys get new answers, new keys are inserted."""
    return merge_upsert(cache, cache_rows(enriched), CACHE_KEYS, CACHE_VALUES)
