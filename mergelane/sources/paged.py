"""Paged JSON lists to tables, and the log of the requests that fetched them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What is logged per request.
REQUEST_LOG = (
    "url string, payload string, status_code int, request_time timestamp, request_duration float, error string"
)


def _items(payload: str, schema: str) -> Column:
    """The list ``value`` of a page. A page that does not parse, or has no list, fails the job."""
    page = F.from_json(payload, f"struct<value: array<{schema}>>", {"mode": "FAILFAST"})
    text = F.coalesce(F.left(F.col(payload), F.lit(80)), F.lit("null"))
    problem = F.raise_error(F.concat(F.lit("no list of items in the page "), text))
    return F.when(page["value"].isNotNull(), page["value"]).otherwise(problem.cast(f"array<{schema}>"))


def column_map(df: DataFrame, payload: str) -> dict[str, str]:
    """{display name: internal name} from the columns page of a list; one row per list column.

    As many rows as the list has columns come to the driver. A page that does not parse is an error.
    """
    items = _items(payload, "struct<displayName: string, name: string>")
    rows = df.select(F.explode(items).alias("c")).select("c.displayName", "c.name").distinct().collect()
    return {r.displayName: r.name for r in rows}


def json_pages_to_table(
    df: DataFrame, payload: str, mapping: Mapping[str, str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Item pages, one JSON text per row, to one row per item.

    `mapping` is {output column: field name}; fields an item lacks are null, other fields are
    dropped, all values are text, and the columns come sorted by name behind those of `keep`. A page
    that does not parse, is null or has no list of items fails the job; `unreadable_pages` finds them.
    """
    items = df.select(*keep, F.explode(_items(payload, _ITEM)).alias("item"))
    fields = F.col("item.fields")
    return items.select(*keep, *[_field(fields, mapping[n]).alias(n) for n in sorted(mapping)])


_ITEM = "struct<fields: map<string, string>>"


def unreadable_pages(df: DataFrame, payload: str) -> DataFrame:
    """The rows of `df` whose page does not parse, is null or has no list of items."""
    page = F.from_json(payload, f"struct<value: array<{_ITEM}>>")
    return df.filter(page["value"].isNull())


def _field(fields: Column, name: str) -> Column:
    return F.try_element_at(fields, F.lit(name))


def next_page(payload: Column | str) -> Column:
    """The link to the following page, null on the last one."""
    return F.try_element_at(F.from_json(payload, "map<string, string>"), F.lit("@odata.nextLink"))


def failed_request(spark: SparkSession, message: str) -> DataFrame:
    """The log row of a request that never got an answer: status -1 and the error text."""
    return spark.createDataFrame([(None, None, -1, None, None, message)], REQUEST_LOG)
