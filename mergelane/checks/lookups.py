"""Lookups, unit conversion, views, and the sales flow from text to report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelane.checks.cleanse import MESSY_DATES_SQL, messy_dates
from mergelane.checks.registry import Tables, query
from mergelane.operators import lookups, quantity, ranking
from mergelane.operators.mapping import GOLDEN_SCHEMA, map_columns
from mergelane.plans import sales, views


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, p_name, p_retailprice
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def zero_key_join(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        F.lpad(F.col("l_partkey").cast("string"), 18, "0").alias("article"),
    )
    parts = t.part.select(F.col("p_partkey").cast("string").alias("material"), "p_name", "p_retailprice")
    return lookups.zero_key_join(lines, parts, [("article", "material")], ["p_name", "p_retailprice"]).drop("article")


@query("""
SELECT o_orderkey, o_custkey, c_name, c_acctbal
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'
""")
def left_join_on_filter(t: Tables) -> DataFrame:
    return lookups.lookup(
        t.orders.select("o_orderkey", "o_custkey"), t.customer, [("o_custkey", "c_custkey")], ["c_name", "c_acctbal"],
        right_filter=F.col("c_mktsegment") == "BUILDING",
    )


@query("""
WITH first_line AS (
  SELECT l_partkey AS pk, l_suppkey AS sk, l_orderkey AS first_order, l_extendedprice AS first_price
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, first_order, first_price
FROM lineitem LEFT JOIN first_line ON l_partkey = pk AND l_suppkey = sk
""")
def pick_one_lookup(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    records = t.lineitem.select(
        F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), F.col("l_orderkey").alias("first_order"),
        F.col("l_extendedprice").alias("first_price"), F.col("l_linenumber").alias("line"),
    )
    return lookups.pick_one_lookup(
        lines, records, [("l_partkey", "pk"), ("l_suppkey", "sk")], ["first_order", "first_price"],
        order=[F.asc("first_order"), F.asc("line"), F.asc("first_price")],
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       coalesce(CASE WHEN m2.p_type <> 'ECONOMY' THEN m2.p_retailprice END, m1.p_retailprice) AS p_retailprice,
       coalesce(CASE WHEN m2.p_type <> 'ECONOMY' THEN nullif(m2.p_size, 7) END, nullif(m1.p_size, 7)) AS p_size
FROM lineitem LEFT JOIN part m2 ON l_partkey = m2.p_partkey LEFT JOIN part m1 ON l_suppkey = m1.p_partkey
""")
def priority_lookup(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    parts = t.part.select("p_partkey", "p_retailprice", F.nullif("p_size", F.lit(7)).alias("p_size"), "p_type")
    trusted = parts.filter(F.col("p_type") != "ECONOMY")
    return lookups.priority_lookup(
        lines,
        [(trusted, [("l_partkey", "p_partkey")]), (parts, [("l_suppkey", "p_partkey")])],
        ["p_retailprice", "p_size"],
    )


def _factors(t: Tables) -> DataFrame:
    """Two units per part; every third part has an EAN, shared by both rows."""
    key = F.col("p_partkey")
    part = t.part.select("p_partkey", "p_size", F.explode(F.array(F.lit("KG"), F.lit("CS"))).alias("muom_unit_id"))
    numerator = F.when(F.col("muom_unit_id") == "KG", F.col("p_size")).otherwise(F.col("p_size") * 12)
    return part.select(
        F.lpad(key.cast("string"), 18, "0").alias("muom_material_id"),
        "muom_unit_id",
        F.pmod(key, F.lit(7)).cast("decimal(38,18)").alias("muom_denominator_qty"),
        numerator.cast("decimal(38,18)").alias("muom_numerator_qty"),
        F.when(key % 3 == 0, F.concat(F.lit("00"), (F.lit(5410321000000) + key).cast("string")))
        .alias("muom_eanupc_id"),
    )


def _units(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Units per line status from the line items, and their texts in two languages."""
    flag = F.col("l_returnflag")
    seen = t.lineitem.select(F.col("l_linestatus").alias("wholesaler_name"), flag.alias("uom")).distinct()
    converted = F.when(F.col("uom") == "A", "kilo").when(F.col("uom") == "N", "case").otherwise("none")
    units = seen.withColumn("converted_uom", converted)
    texts = seen.select(F.explode(F.array(F.lit("EN"), F.lit("NL"))).alias("language"), converted.alias("converted_uom"))
    internal = F.when(F.col("converted_uom") == "kilo", "KG").when(F.col("converted_uom") == "case", "CS")
    texts = texts.distinct().withColumn("muom_unit_id", F.when(F.col("language") == "EN", internal).otherwise("XX"))
    return units, texts


# In SQL the EAN row of a part is its CS row: the first by material and unit.
_FACTORS_SQL = """
factors AS (
  SELECT p_partkey AS fk, u AS unit, CAST(p_partkey % 7 AS DOUBLE) AS den,
         CAST(CASE WHEN u = 'KG' THEN p_size ELSE p_size * 12 END AS DOUBLE) AS num, p_partkey % 3 = 0 AS has_ean
  FROM part, (VALUES ('KG'), ('CS')) AS v(u)),
units AS (SELECT * FROM (VALUES ('A', 'kilo', 'KG'), ('N', 'case', 'CS'), ('R', 'none', NULL)) AS v(uom, converted, unit))
"""


@query(f"""
WITH {_FACTORS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CASE WHEN e.fk IS NOT NULL THEN CAST(e.fk AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS article,
       units.converted AS converted_uom, units.unit AS muom_unit_id, coalesce(e.den, a.den) AS denominator,
       coalesce(e.num, a.num) AS numerator, l_quantity * coalesce(e.num, a.num) / nullif(coalesce(e.den, a.den), 0) AS kgl
FROM lineitem LEFT JOIN units ON l_returnflag = units.uom
LEFT JOIN factors e ON e.fk = l_suppkey * 5 AND e.unit = 'CS' AND e.has_ean
LEFT JOIN factors a ON a.fk = l_partkey AND a.unit = units.unit
""")
def uom_convert(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_partkey").cast("string").alias("article"),
        (F.lit(5410321000000) + F.col("l_suppkey") * 5).cast("string").alias("EAN"),
        F.col("l_quantity").alias("total_amount"), F.col("l_returnflag").alias("UOM"),
        F.col("l_linestatus").alias("wholesaler_name"),
    )
    # The article path needs ids as the EAN path returns them, which a zero-only id would not be.
    out = quantity.convert_quantity(lines, _factors(t), quantity.unit_map(*_units(t)), "article", out="kgl")
    article = F.when(F.col("article") == "", "0").otherwise(F.col("article"))
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", article.alias("article"),
        "converted_uom", "muom_unit_id", F.col("muom_denominator_qty").cast("double").alias("denominator"),
        F.col("muom_numerator_qty").cast("double").alias("numerator"), "kgl",
    )


@query("""
SELECT c_custkey, c_mktsegment, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS customers FROM customer
""")
def group_count(t: Tables) -> DataFrame:
    counted = ranking.with_count(t.customer, ["c_nationkey", "c_mktsegment"], "customers")
    return counted.select("c_custkey", "c_mktsegment", "customers")


@query("""
SELECT DISTINCT o_custkey, o_orderstatus, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END,
       CAST(year(o_orderdate) AS VARCHAR)) AS label
FROM orders
""")
def distinct_entities(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_custkey", "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("label"),
        F.year("o_orderdate").cast("string").alias("owner"),
    )
    return ranking.distinct_entities(rows, ["o_custkey", "o_orderstatus", "label"], fallback={"label": "owner"})


@query("""
SELECT event_id, user_id, event_type, value, 1 AS rn FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) = 1
""")
def v_latest_per_key(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "event_type", "value")
    return ranking.latest_per_key(events, ["user_id"], [F.desc_nulls_last("value"), F.asc("event_id")], rank="rn")


@query("""
SELECT o_orderkey, o_custkey, lpad(o_orderpriority, 10, '0') AS priority, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, lpad(o_orderpriority, 10, '0') ORDER BY o_totalprice DESC, o_orderkey) = 1
""")
def v_dedup_composite(t: Tables) -> DataFrame:
    top = ranking.latest_per_key(
        t.orders, ["o_custkey", views.padded_id("o_orderpriority")], [F.desc("o_totalprice"), F.asc("o_orderkey")]
    )
    return views.renamed(top, {
        "o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "priority": views.padded_id("o_orderpriority"),
        "o_totalprice": "o_totalprice",
    })


@query("""
SELECT lpad(CAST(p_partkey AS VARCHAR), 18, '0') AS "Part Id", CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END
  AS "Part Id Trimmed", CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END || ' ' || p_name AS "Key + Part",
  p_brand AS "Brand" FROM part
""")
def v_part_label(t: Tables) -> DataFrame:
    parts = t.part.withColumn("id", F.lpad(F.col("p_partkey").cast("string"), 18, "0"))
    return views.labelled_dimension(parts, "id", "p_name", {"Brand": "p_brand"}, "Part")


# --- the whole sales flow --------------------------------------------------------------------------


def _golden_sales(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    as_text = lambda c: F.col(c).cast("string")
    return map_columns(
        lines,
        {
            "wholesaler_id": F.lpad(as_text("l_suppkey"), 7, "0"),
            "customer_number": F.concat(F.lit("  "), as_text("o_custkey"), F.lit(".0")),
            "product_number": F.concat(as_text("l_partkey"), F.lit(".0")),
            "article_name": "o_orderpriority",
            "EAN": F.concat((F.lit(5410321000000) + F.col("l_suppkey") * 5).cast("string"), F.lit(".0")),
            "total_amount": "l_quantity",
            "UOM": ["unit", "l_returnflag"],
            "wholesaler_name": "l_linestatus",
            "date": messy_dates(),
            "full_file_path": F.concat(F.lit("volumes/in/lines "), as_text("l_linenumber"), F.lit(".csv")),
        },
        GOLDEN_SCHEMA,
    )


def _accounts(t: Tables) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    return t.supplier.select(
        F.lpad(key, 10, "0").alias("c4cu_account_id"), F.concat(F.lit("0"), key).alias("c4cu_customer_id")
    )


def _material_records(t: Tables) -> DataFrame:
    """Which partner calls which material what; several materials per name where prices differ."""
    return t.lineitem.select(
        F.lpad(F.col("l_partkey").cast("string"), 18, "0").alias("cumi_customermaterialnumber_id"),
        F.lpad(F.col("l_suppkey").cast("string"), 10, "0").alias("cumi_customernumber_id"),
        F.concat(F.lit("M"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("cumi_material_id"),
    )


def _sales_sql(tail: str) -> str:
    return f"""
WITH {_FACTORS_SQL},
records AS (SELECT l_partkey AS pk, l_suppkey AS sk, 'M' || lpad(CAST(min(l_orderkey) AS VARCHAR), 12, '0') AS material
            FROM lineitem GROUP BY ALL),
flow AS (
SELECT CAST(o_custkey AS VARCHAR) AS "Id at Wholesaler", o_orderpriority AS "Article Name",
  CAST(5410321000000 + l_suppkey * 5 AS VARCHAR) AS "Ean", l_quantity AS "Amount Sale UoM", l_linestatus AS "Wholesaler Name",
  {MESSY_DATES_SQL} AS "Date", 'volumes/in/lines ' || l_linenumber || '.csv' AS "Full File Path",
  'lines ' || l_linenumber AS "Sharepoint File Name", records.material AS "Cumi Material Id",
  CASE WHEN e.fk IS NOT NULL THEN CASE WHEN e.fk = 0 THEN '' ELSE CAST(e.fk AS VARCHAR) END
       ELSE lpad(CAST(l_partkey AS VARCHAR), 18, '0') END AS "Cumi Customermaterialnumber Id",
  units.converted AS "VDM Uom", l_returnflag AS "Wholesaler UOM", coalesce(e.den, a.den) AS "Muom Denominator qty",
  coalesce(e.num, a.num) AS "Muom Nominator qty",
  l_quantity * coalesce(e.num, a.num) / nullif(coalesce(e.den, a.den), 0) AS "Sellout Kgl Qty",
  lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS "Wholesaler Id",
  CAST(o_custkey AS VARCHAR) || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS "Id at Wholesaler + Wholesaler Id"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN records ON l_partkey = pk AND l_suppkey = sk
LEFT JOIN units ON l_returnflag = units.uom
LEFT JOIN factors e ON e.fk = l_suppkey * 5 AND e.unit = 'CS' AND e.has_ean
LEFT JOIN factors a ON a.fk = l_partkey AND a.unit = units.unit)
{tail}
"""


def _sales_fact(t: Tables) -> DataFrame:
    cleaned = sales.clean_sales(_golden_sales(t))
    return sales.enrich_sales(cleaned, _accounts(t), _material_records(t), *_units(t), _factors(t))


@query(_sales_sql("""SELECT *, CAST(strftime("Date", '%Y%m%d') AS INTEGER) AS "Serivce Render Date" FROM flow"""))
def v_sales(t: Tables) -> DataFrame:
    """The flagship: raw text to golden rows, cleaned, enriched along six lookups, renamed."""
    view = views.sales_view(_sales_fact(t))
    doubles = ["Muom Denominator qty", "Muom Nominator qty"]
    return view.withColumns({c: F.col(c).cast("double") for c in doubles})


@query(_sales_sql("""
SELECT "Wholesaler Id" AS wholesaler_id, "VDM Uom" AS unit, count(*) AS sales,
       CAST(round(sum("Sellout Kgl Qty")) AS BIGINT) AS kgl FROM flow GROUP BY ALL
"""))
def quantity_by_partner(t: Tables) -> DataFrame:
    """Base-unit quantity per wholesaler and unit: the question the sales fact is made for."""
    fact = _sales_fact(t)
    return fact.groupBy("wholesaler_id", F.col("converted_uom").alias("unit")).agg(
        F.count(F.lit(1)).alias("sales"), F.round(F.sum("KgL")).cast("bigint").alias("kgl")
    )
