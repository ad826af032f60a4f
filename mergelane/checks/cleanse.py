"""Dates, countries, VAT numbers, EAN codes, ids, urls.

Messy text is written from clean columns, so the SQL side knows the truth without parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.checks.registry import Tables, query
from mergelane.functions import dates, text
from mergelane.operators.mapping import GOLDEN_SCHEMA, map_columns
from mergelane.plans.sales import clean_sales


def by_turn(key: Column | str, *variants: Column | None) -> Column:
    """Variant number `key` modulo their count."""
    turn = F.pmod(F.col(key) if isinstance(key, str) else key, F.lit(len(variants)))
    out = F.when(turn == 0, variants[0])
    for i, v in enumerate(variants[1:], 1):
        out = out.when(turn == i, F.lit(None) if v is None else v)
    return out


def _as(pattern: str) -> Column:
    return F.date_format("o_orderdate", pattern)


def messy_dates() -> Column:
    quarter = F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"))
    return by_turn(
        "o_orderkey",
        _as("yyyy-MM-dd"), _as("dd/MM/yyyy"), _as("MM_yy"), _as("MM_yyyy"), _as("M/yyyy"), _as("dd_MM_yyyy"),
        F.concat(_as("yyyy"), F.lit("_"), quarter), F.concat(F.lower(quarter), F.lit("_"), _as("yyyy")),
        _as("d-MMM-yyyy"), _as("yyyyMMdd"), _as("yyyy-MM-dd HH:mm:ss"), _as("yyyy-MM-dd HH:mm:ss.SSS"),
        _as("d.M.yyyy"), F.concat(F.lit(" "), _as("yyyy-M-d")), F.lit("13_2020"), F.lit("soon"),
    )


MESSY_DATES_SQL = """
CASE o_orderkey % 16
  WHEN 2 THEN last_day(make_date(2000 + CAST(year(o_orderdate) AS INTEGER) % 100, CAST(month(o_orderdate) AS INTEGER), 1))
  WHEN 3 THEN last_day(o_orderdate) WHEN 4 THEN last_day(o_orderdate)
  WHEN 6 THEN CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
  WHEN 7 THEN CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
  WHEN 14 THEN NULL WHEN 15 THEN NULL
  ELSE CAST(o_orderdate AS DATE) END
"""


@query(f"SELECT o_orderkey, {MESSY_DATES_SQL} AS day FROM orders")
def parse_dates(t: Tables) -> DataFrame:
    raw = t.orders.select("o_orderkey", messy_dates().alias("day"))
    return raw.withColumn("day", dates.parse_mixed_date("day"))


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 16 IN (7, 12) THEN NULL ELSE {MESSY_DATES_SQL} END AS day FROM orders")
def parse_dates_strict(t: Tables) -> DataFrame:
    """Lower-case quarters and dotted dates are no dates in strict parity."""
    raw = t.orders.select("o_orderkey", messy_dates().alias("day"))
    return raw.withColumn("day", dates.parse_mixed_date("day", strict_parity=True))


@query("""
SELECT o_orderkey,
  CASE o_orderkey % 7
    WHEN 0 THEN strftime(o_orderdate, '%d_%m_%Y') WHEN 1 THEN 'Q' || quarter(o_orderdate) || '_' || year(o_orderdate)
    WHEN 2 THEN year(o_orderdate) || '_q' || quarter(o_orderdate) WHEN 3 THEN strftime(o_orderdate, '%m_%Y')
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d 00:00') WHEN 5 THEN '' ELSE NULL END AS found,
  CASE o_orderkey % 7
    WHEN 0 THEN CAST(o_orderdate AS DATE)
    WHEN 1 THEN CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
    WHEN 2 THEN CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
    WHEN 3 THEN last_day(o_orderdate) WHEN 4 THEN CAST(o_orderdate AS DATE) ELSE NULL END AS day
FROM orders
""")
def path_dates(t: Tables) -> DataFrame:
    quarter = F.quarter("o_orderdate").cast("string")
    value = by_turn(
        "o_orderkey",
        F.concat(F.lit("dbfs:/volumes/in/sales_"), _as("dd_MM_yyyy"), F.lit("_final.csv")),
        F.concat(F.lit("/volumes/in/Q"), quarter, F.lit("_"), _as("yyyy"), F.lit("/list.csv")),
        F.concat(F.lit("abfss://datalake/"), _as("yyyy"), F.lit("_q"), quarter, F.lit(".csv")),
        F.concat(F.lit("volumes/"), _as("MM_yyyy"), F.lit(".csv")),
        _as("yyyy-MM-dd 00:00"),
        F.lit("/volumes/in/nothing.csv"),
        F.lit("other/01_02_2023.csv"),
    )
    rows = t.orders.select("o_orderkey", value.alias("day"))
    return dates.parse_date_or_path(rows.withColumn("found", dates.extract_path_date("day")), "day")


def messy_country() -> Column:
    named = F.concat(F.lit(" N"), F.col("c_nationkey").cast("string"), F.lit(" "))
    return by_turn(
        "c_nationkey",
        F.lit("België"), F.lit("Nederland"), F.lit(" Duitsland "), F.lit("Frankrijk"), F.lit("belgie"), named, None,
    )


MESSY_COUNTRY_SQL = """
CASE c_nationkey % 7 WHEN 0 THEN 'BE' WHEN 1 THEN 'NL' WHEN 2 THEN 'Duitsland' WHEN 3 THEN 'FR' WHEN 4 THEN 'belgie'
  WHEN 5 THEN 'N' || c_nationkey ELSE NULL END
"""


@query(f"SELECT c_custkey, {MESSY_COUNTRY_SQL} AS country FROM customer")
def normalize_country(t: Tables) -> DataFrame:
    raw = t.customer.select("c_custkey", messy_country().alias("country"))
    return raw.withColumn("country", text.normalize_country("country"))


def messy_vat() -> Column:
    digits = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    return by_turn(
        "c_custkey",
        F.concat(F.lit("BE "), F.substring(digits, 1, 4), F.lit("."), F.substring(digits, 5, 6)),
        F.concat(F.lit("be"), digits),
        F.concat(F.lit("BTW "), digits),
        F.concat(F.lit("BE"), F.substring(digits, 7, 4)),
        F.concat(F.lit("vat NL"), digits, F.lit("B-01")),
        None,
        F.lit("00.000.000"),
    )


MESSY_VAT_SQL = f"""
CASE WHEN c_custkey = 0 THEN NULL ELSE
  CASE c_custkey % 7
    WHEN 0 THEN 'BE' || lpad(CAST(c_custkey AS VARCHAR), 10, '0')
    WHEN 1 THEN coalesce({MESSY_COUNTRY_SQL}, '') || lpad(CAST(c_custkey AS VARCHAR), 10, '0')
    WHEN 2 THEN coalesce({MESSY_COUNTRY_SQL}, '') || lpad(CAST(c_custkey AS VARCHAR), 10, '0')
    WHEN 4 THEN 'NL' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') || 'B01'
    ELSE NULL END END
"""


@query(f"SELECT c_custkey, {MESSY_VAT_SQL} AS vat FROM customer")
def normalize_vat(t: Tables) -> DataFrame:
    raw = t.customer.select("c_custkey", messy_vat().alias("vat"), messy_country().alias("country"))
    return raw.select("c_custkey", text.normalize_vat("vat", text.normalize_country("country")).alias("vat"))


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS id FROM part")
def strip_float(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    raw = by_turn("p_partkey", F.concat(key, F.lit(".0")), F.concat(F.lit("  "), key, F.lit(".0 ")), key)
    return t.part.select("p_partkey", text.strip_float_suffix(raw).alias("id"))


@query("""
SELECT p_partkey, CASE p_partkey % 6
    WHEN 4 THEN CAST(90071992547409911 + p_partkey AS VARCHAR) WHEN 5 THEN NULL
    ELSE CAST(5410321000000 + p_partkey AS VARCHAR) END AS ean
FROM part
""")
def normalize_ean(t: Tables) -> DataFrame:
    code = F.lit(5410321000000) + F.col("p_partkey")
    raw = by_turn(
        "p_partkey",
        code.cast("string"),
        code.cast("double").cast("string"),
        F.concat(code.cast("string"), F.lit(".0")),
        F.concat(F.lit(" "), text.number_text(code)),
        (F.lit(90071992547409911) + F.col("p_partkey")).cast("string"),
        F.when(F.col("p_partkey") % 4 == 1, "").otherwise("none"),
    )
    return t.part.select("p_partkey", text.normalize_ean(raw).alias("ean"))


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_id FROM orders")
def date_key(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.date_key("o_orderdate").alias("day_id"))


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE c_name END AS c_name, c_mktsegment FROM customer
""")
def blank_to_null(t: Tables) -> DataFrame:
    name = by_turn(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")), F.lit("   "), F.lit(""), F.col("c_name")
    )
    raw = t.customer.select("c_custkey", name.alias("c_name"), F.rpad("c_mktsegment", 20, " ").alias("c_mktsegment"))
    return text.blank_columns_to_null(raw)


@query("""
SELECT c_custkey, sha256(concat_ws('_', c_name, CAST(c_nationkey AS VARCHAR), nullif(c_mktsegment, 'BUILDING'))) AS text_key,
  sha256('{"c0":"' || c_name || '","c1":"' || c_nationkey || '","c2":'
         || CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}') AS json_key
FROM customer
""")
def entity_key(t: Tables) -> DataFrame:
    cols = [F.col("c_name"), F.col("c_nationkey"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))]
    return t.customer.select(
        "c_custkey", text.entity_key(cols, "text").alias("text_key"), text.entity_key(cols).alias("json_key")
    )


@query("SELECT page_id, regexp_replace(url, '\\b(page=)[^&#]+', '\\1***', 'g') AS url FROM pages")
def mask_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.mask_query_param("url", "page").alias("url"))


@query("""
SELECT c_custkey, 'Shop & Co ' || c_custkey AS shop, CAST(c_custkey AS VARCHAR) AS number, '' AS no_number,
       CAST(9000 + c_nationkey AS VARCHAR) AS postal
FROM customer
""")
def split_fields(t: Tables) -> DataFrame:
    client = F.concat(F.lit("Shop & Co "), "c_custkey", F.lit("/"), "c_custkey")
    code = F.concat(F.lit("B-"), (F.lit(9000) + F.col("c_nationkey")).cast("string"))
    return t.customer.select(
        "c_custkey", text.split_composite(client, 1).alias("shop"), text.split_composite(client, 2).alias("number"),
        text.split_composite("c_name", 2).alias("no_number"), text.strip_prefix(code).alias("postal"),
    )


@query(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS product_number, CAST(o_custkey AS VARCHAR) AS customer_number,
       CASE WHEN c.country IS NULL THEN NULL ELSE c.country END AS customer_country, c.vat AS vat_number,
       CAST(9000 + c_nationkey AS VARCHAR) AS customer_postal_code, CAST(5410321000000 + o_custkey AS VARCHAR) AS EAN,
       {MESSY_DATES_SQL} AS date, o_totalprice AS total_amount
FROM orders JOIN (SELECT *, {MESSY_COUNTRY_SQL} AS country, {MESSY_VAT_SQL} AS vat FROM customer) c ON o_custkey = c_custkey
""")
def clean_golden(t: Tables) -> DataFrame:
    raw = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    code = F.lit(5410321000000) + F.col("o_custkey")
    golden = map_columns(
        raw,
        {
            "product_number": F.concat("o_orderkey", F.lit(".0")),
            "customer_number": F.concat(F.lit(" "), "o_custkey", F.lit(".0")),
            "customer_country": messy_country(),
            "vat_number": messy_vat(),
            "customer_postal_code": F.concat((F.lit(9000) + F.col("c_nationkey")).cast("string"), F.lit(".0 ")),
            "EAN": code.cast("double").cast("string"),
            "date": messy_dates(),
            "total_amount": "o_totalprice",
        },
        GOLDEN_SCHEMA,
    )
    return clean_sales(golden).select(
        "product_number", "customer_number", "customer_country", "vat_number", "customer_postal_code", "EAN", "date",
        "total_amount",
    )
