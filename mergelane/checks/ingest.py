"""Sources, mapping, union, conform, audit."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mergelane.checks.registry import Tables, query
from mergelane.functions import text
from mergelane.operators import mapping
from mergelane.session import shared_folder
from mergelane.sources import audit, files, paged, paged_source, tables

_PARTNER = "origin string, name string, nation string, balance double, segment string, remark string"


@query("""
SELECT 'buyer' AS origin, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_acctbal AS balance,
       c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS remark FROM customer
UNION ALL
SELECT 'seller', s_name, CAST(s_nationkey AS VARCHAR), s_acctbal, NULL, NULL FROM supplier
""")
def map_columns(t: Tables) -> DataFrame:
    shared = {
        "name": ["C_NAME", "s_name"], "nation": ["s_nationkey", "c_nationkey"], "balance": ["c_acctbal", "s_acctbal"],
        "segment": ["c_mktsegment"], "remark": None,
    }
    buyers = mapping.map_columns(t.customer, {**shared, "origin": F.lit("buyer")}, _PARTNER)
    sellers = mapping.map_columns(t.supplier, {**shared, "origin": F.lit("seller")}, _PARTNER)
    return buyers.unionByName(sellers)


@query("""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
""")
def union_by_name(t: Tables) -> DataFrame:
    buyers = t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "c_mktsegment")
    sellers = t.supplier.selectExpr("s_nationkey AS nation", "s_name AS NAME", "s_suppkey AS id", "s_acctbal")
    return mapping.union_by_name([buyers, sellers])


@query("""
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS amount,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
       o_orderstatus AS status, CAST(NULL AS INTEGER) AS remark
FROM orders
""")
def golden_conform(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderstatus").alias("STATUS"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("amount"),
        F.when(F.col("o_orderpriority") == "5-LOW", "later").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("day"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.lit("unused").alias("extra"),
    )
    return mapping.conform(raw, "id bigint, amount bigint, day date, status string, remark int")


@query("""
SELECT 'allow' AS rule, doc_id, source FROM documents WHERE source IN ('src1', 'src2') AND contains(text, 'the')
UNION ALL SELECT 'deny', doc_id, source FROM documents WHERE source NOT IN ('src7', 'src14')
UNION ALL SELECT 'one', doc_id, source FROM documents WHERE source = 'src3'
""")
def section_filter(t: Tables) -> DataFrame:
    docs = t.documents
    allowed = files.select_sections(docs, "source", allow=["src1", "src2"], deny=["src1"])
    parts = {
        "allow": allowed.filter(F.col("text").contains("the")),
        "deny": files.select_sections(docs, "source", deny=["src7", "src14"]),
        "one": files.select_sections(docs, "source", allow="src3"),
    }
    return mapping.union_by_name([p.select(F.lit(n).alias("rule"), "doc_id", "source") for n, p in parts.items()])


def _paths(t: Tables) -> DataFrame:
    escaped = F.concat(
        F.lit("dbfs:/data%20in//"), F.regexp_replace("url", "https?://", ""), F.lit("/Sheet 1%3E"), "page_id", F.lit("-a b.csv")
    )
    return t.pages.select("page_id", escaped.alias("path"))


_PATH_SQL = """
'dbfs:/data%20in//' || regexp_replace(url, 'https?://', '') || '/Sheet 1%3E' || page_id || '-a b.csv'
"""


@query(f"""
SELECT page_id, replace(replace(replace(replace(p, 'dbfs:', ''), '%20', ' '), '%3E', '>'), ' ', '_') AS path,
       replace(replace(p, '//', '/'), ' ', '_') AS output_path
FROM (SELECT page_id, {_PATH_SQL} AS p FROM pages)
""")
def clean_path(t: Tables) -> DataFrame:
    return _paths(t).select(
        "page_id", text.clean_path("path").alias("path"), text.clean_output_path("path").alias("output_path")
    )


@query("""
SELECT page_id, 'Sheet_1%3E' || page_id || '_a_b' AS stem, 'Sheet 1%3E' || page_id || '-a b' AS name FROM pages
""")
def file_stem(t: Tables) -> DataFrame:
    return _paths(t).select("page_id", text.file_stem("path").alias("stem"), text.file_name("path").alias("name"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS "K value", CAST(NULL AS VARCHAR) AS "Absent",
       CAST(NULL AS VARCHAR) AS "Type" FROM events
UNION ALL
SELECT event_id, NULL, NULL, event_type FROM events
""")
def json_flatten(t: Tables) -> DataFrame:
    page = F.concat(
        F.lit('{"@odata.context": "x", "value": [{"id": 1, "fields": '), "props",
        F.lit('}, {"fields": {"type_": "'), "event_type", F.lit('", "other": 1}}]}'),
    )
    pages = t.events.select("event_id", page.alias("payload"))
    names = {"Type": "type_", "K value": "k", "Absent": "nowhere"}
    return paged.json_pages_to_table(pages, "payload", names, keep=("event_id",))


_RUN = datetime(2024, 5, 17, 12, 0)


def _audit(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("file", F.concat(F.lit("in//"), "o_orderpriority", F.lit(".csv")))
    found = audit.ingest_audit(rows, _RUN, _RUN, path="file", section="o_orderstatus")
    return found.withColumns({"timestamp": F.to_date("timestamp"), "runstarttime": F.to_date("runstarttime")})


_AUDIT_SQL = """
SELECT 'in//' || o_orderpriority || '.csv' AS source_path, o_orderstatus AS sheet_name,
       'in/' || replace(o_orderpriority, ' ', '_') || '.csv' AS output_path, CAST(count(*) AS INTEGER) AS row_count,
       CAST(5 AS INTEGER) AS column_count, DATE '2024-05-17' AS "timestamp", DATE '2024-05-17' AS runstarttime
FROM orders GROUP BY ALL
"""


@query(_AUDIT_SQL)
def ingest_audit(t: Tables) -> DataFrame:
    return _audit(t)


@query(f"""
WITH a AS ({_AUDIT_SQL}),
b AS (SELECT 'lines.csv' AS source_path, CAST(NULL AS VARCHAR) AS sheet_name, 'lines.csv' AS output_path,
             CAST(count(*) AS INTEGER) AS row_count, CAST(11 AS INTEGER) AS column_count,
             DATE '2024-06-01' AS "timestamp", DATE '2024-05-17' AS runstarttime FROM lineitem)
SELECT * FROM a UNION ALL SELECT * FROM b
""")
def append_rows(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("full_file_path", F.lit("lines.csv"))
    later = audit.ingest_audit(lines, _RUN, datetime(2024, 6, 1))
    later = later.withColumns({"timestamp": F.to_date("timestamp"), "runstarttime": F.to_date("runstarttime")})
    return tables.append_rows(_audit(t), later)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "number", c_name || ';' || chr(10) || c_mktsegment AS "name",
       CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation, 'nation ' || c_nationkey AS full_file_path
FROM customer
""")
def csv_layout(t: Tables) -> DataFrame:
    """Customers as csv files, one a nation, of two layouts, with separators and line breaks inside quotes."""
    even = F.col("c_nationkey") % 2 == 0
    key, name, nation = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string")
    placed = t.customer.withColumn("at", 2 * F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))
    at = F.col("at")
    first = F.when(even, F.concat(key, F.lit(';"'), name, F.lit(";"))).otherwise(F.concat(F.lit('"'), name, F.lit(";")))
    second = F.concat("c_mktsegment", F.lit('";'), F.when(even, nation).otherwise(key))
    file = F.concat(F.lit("nation "), nation).alias("full_file_path")
    line = lambda at, text: F.struct(at.cast("long").alias("line_no"), text.alias("line"))
    rows = placed.select(file, F.explode(F.array(line(at - 1, first), line(at, second))).alias("l"))
    headers = t.customer.select(
        file, line(F.lit(0), F.when(even, "Number;Name;Nation").otherwise("name;NUMBER")).alias("l")
    ).distinct()
    lines = rows.unionByName(headers).select("full_file_path", "l.*")
    return files.parse_csv_lines(lines, sep=";", multi_line=True).select("number", "name", "nation", "full_file_path")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS "key", 'says "' || o_orderpriority || '"' || chr(10) || chr(10) || o_orderdate AS "note" FROM orders
""")
def csv_quoted_breaks(t: Tables) -> DataFrame:
    """Orders written as csv files whose cells hold quotes and line breaks, and read back in blocks."""
    path = f"{shared_folder(t.spark)}/csv-{uuid.uuid4().hex}"
    quoted = F.concat(
        F.col("o_orderkey"), F.lit(',"says ""'), F.col("o_orderpriority"), F.lit('""\n\n'), F.col("o_orderdate"), F.lit('"')
    )
    t.orders.select(quoted).write.option("lineSep", "\n").text(f"{path}/rows")
    # Text files have no header line of their own: the first line of each is its header here.
    rows = files.read_lines(t.spark, f"{path}/rows", number_all=True).withColumn("line_no", F.col("line_no") + 1)
    header = rows.select("full_file_path", F.lit("key,note").alias("line"), F.lit(0).cast("long").alias("line_no")).distinct()
    return files.parse_csv_lines(rows.unionByName(header), multi_line=True).select("key", "note")


@query("SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Customers written as csv and read back with a schema."""
    path = f"{shared_folder(t.spark)}/csv-{uuid.uuid4().hex}"
    t.customer.select("c_custkey", "c_name", "c_acctbal", "c_nationkey").write.option("header", True).csv(path)
    return files.read_csv(t.spark, path, "c_custkey long, c_name string, c_acctbal double, c_nationkey int")


@query("""
SELECT c_custkey AS "key", c_name AS "name", c_nationkey AS nation, CAST(NULL AS DOUBLE) AS balance FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, NULL, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 2 = 1
""")
def merged_schema(t: Tables) -> DataFrame:
    """Parquet files of two schemas in one folder, read as one table."""
    path = f"{shared_folder(t.spark)}/merged-{uuid.uuid4().hex}"
    key, nation = F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation")
    even = t.customer.filter("c_custkey % 2 = 0").select(key, F.col("c_name").alias("name"), nation)
    odd = t.customer.filter("c_custkey % 2 = 1").select(key, nation, F.col("c_acctbal").alias("balance"))
    even.write.parquet(path)
    odd.write.mode("append").parquet(path)
    return files.read_parquet(t.spark, path, merge_schema=True).select("key", "name", "nation", "balance")


@query("SELECT n_nationkey AS \"nation_key\", n_name AS \"nation_name\", n_regionkey AS \"unnamed_2\", n_regionkey AS \"nation_key_1\" FROM nation")
def normalized_headers(t: Tables) -> DataFrame:
    raw = t.nation.select(
        F.col("n_nationkey").alias("Nation.Key"), F.col("n_name").alias(" Nation-Name: "), F.col("n_regionkey").alias(" "),
        F.col("n_regionkey").alias("nation key"),
    )
    return mapping.normalize_headers(raw)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS "name", NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, s_acctbal FROM supplier
""")
def union_conform(t: Tables) -> DataFrame:
    """Two sources with other columns and types, brought to one schema; columns outside of it go."""
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return mapping.union_conform(t.spark, [customers, suppliers], "id string, name string, balance double")


@query("""
SELECT 'row' AS kind, c_custkey AS "key", CASE WHEN c_custkey % 2 = 0 THEN c_name END AS "name",
       CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS balance FROM customer
UNION ALL SELECT 'view', c_nationkey, CAST(count(*) AS VARCHAR), CAST(count(*) FILTER (c_custkey % 2 = 1) AS DOUBLE) FROM customer GROUP BY ALL
UNION ALL SELECT 'table', 0, * FROM (VALUES ('even: customers of even number; key: number', 2.0), ('new: ; ', 0.0), ('odd: ; ', 1.0))
""")
def table_catalog(t: Tables) -> DataFrame:
    """Tables made, appended, upserted, described and found again; read by name, as one, and through a view."""
    spark, name = t.spark, f"catalog_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    cols = [F.col("c_custkey").cast("long").alias("key"), F.col("c_nationkey").cast("int").alias("nation")]
    even = t.customer.filter("c_custkey % 2 = 0").select(*cols, F.col("c_name").alias("name"))
    odd = t.customer.filter("c_custkey % 2 = 1").select(*cols, F.col("c_acctbal").alias("balance"))
    tables.write_table(tables.with_comments(even.filter("nation < 12").withColumn("name", F.lit("old")), {"key": "number"}), f"{name}.even")
    tables.describe_table(spark, f"{name}.even", "customers of even number")
    tables.write_table(even.filter("nation >= 12"), f"{name}.even", mode="append")
    tables.upsert_table(f"{name}.even", even.filter("nation < 12"), ["key"], ["name"])
    tables.write_table(odd, f"{name}.odd")
    tables.ensure_table(spark, f"{name}.new", "key long, extra string")
    found = tables.list_tables(spark, name)
    both, missing = tables.union_tables(spark, [*found, f"{name}.none"])
    if missing != [f"{name}.none"]:
        raise AssertionError(f"tables not found: {missing}")
    tables.register_view(both, f"{name}_all")
    counted = spark.sql(f"SELECT nation, count(*) AS n, count(balance) AS odd FROM {name}_all GROUP BY nation")
    listed = []
    for table in found:
        rows, short = spark.table(table), table.rsplit(".", 1)[1]
        about = [c.description for c in spark.catalog.listColumns(table) if c.description]
        texts = f"{short}: {spark.catalog.getTable(table).description or ''}; {''.join(f'key: {x}' for x in about)}"
        # 2 for a table of even keys, 1 for one of odd keys, 0 for an empty one.
        kinds = rows.agg(F.max(F.when(F.col("key") % 2 == 0, 2.0).otherwise(1.0))).first()[0] or 0.0
        listed.append((texts, kinds))
    described = spark.createDataFrame(listed, "name string, balance double")
    rows = both.select(F.lit("row").alias("kind"), "key", "name", "balance")
    views = counted.select(
        F.lit("view").alias("kind"), F.col("nation").cast("long").alias("key"), F.col("n").cast("string").alias("name"),
        F.col("odd").cast("double").alias("balance"),
    )
    return rows.unionByName(views).unionByName(described.select(F.lit("table").alias("kind"), F.lit(0).cast("long").alias("key"), "name", "balance"))


_PAGE_ITEMS = 100


@query("""
SELECT 'customer' AS list, CAST(c_custkey AS VARCHAR) AS "key", c_name AS "name" FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation
""")
def paged_lists(t: Tables) -> DataFrame:
    """Three lists, written as files of a page each, fetched from link to link."""
    root = f"{shared_folder(t.spark)}/pages-{uuid.uuid4().hex}"
    named = [("customer", t.customer, "c_custkey", "c_name"), ("supplier", t.supplier, "s_suppkey", "s_name"),
             ("nation", t.nation, "n_nationkey", "n_name")]
    items = None
    for list_name, table, key, name in named:
        fields = F.create_map(F.lit("ID"), F.col(key).cast("string"), F.lit("Title"), F.col(name))
        part = table.select(
            F.lit(list_name).alias("list"), F.floor(F.col(key) / _PAGE_ITEMS).alias("page"), F.struct(fields.alias("fields")).alias("item")
        )
        items = part if items is None else items.unionByName(part)
    pages = items.groupBy("list", "page").agg(F.collect_list("item").alias("value"))
    following = F.lead("page").over(Window.partitionBy("list").orderBy("page"))
    link = F.concat(F.lit(f"{root}/list="), F.col("list"), F.lit("/page="), following)
    body = F.to_json(F.struct("value", link.alias("@odata.nextLink")))
    pages.select("list", "page", body.alias("payload")).write.partitionBy("list", "page").text(root)
    first = [f"{root}/list={n}/page=0" for n, *_ in named]
    fetched = paged_source.read_paged(t.spark, paged_source.fetch_file, first)
    fetched = fetched.select(F.regexp_extract("list", "list=(\\w+)", 1).alias("list"), "payload")
    return paged.json_pages_to_table(fetched, "payload", {"key": "ID", "name": "Title"}, keep=("list",))
