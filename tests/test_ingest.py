from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mergelane.operators import mapping
from mergelane.sources import audit, files, paged, tables


def test_header_names():
    raw = ["Klantnr.", "Artikelnr. leverancier", None, "c/postal livraison", "Désignation", "Klnaam", "klnaam", "Naam:"]
    assert mapping.header_names(raw) == [
        "klantnr_", "artikelnr__leverancier", "unnamed_2", "c/postal_livraison", "désignation", "klnaam", "klnaam_1", "naam",
    ]


def test_header_names_avoid_taken_ones():
    assert mapping.header_names(["a", "a_1", "a", "a"]) == ["a", "a_1", "a_2", "a_3"]


def test_normalize_headers(spark):
    assert mapping.normalize_headers(spark.createDataFrame([(1, 2)], "`Post code` int, `Post-code` int")).columns == [
        "post_code", "post_code_1",
    ]


def test_map_columns_specs(spark):
    df = spark.createDataFrame([("x", None, "7,5"), (None, "y", "2")], "Staden string, unnamed_3 string, total string")
    out = mapping.map_columns(
        df,
        {"customer_city": ["gone", "staden", "UNNAMED_3"], "total_amount": "total", "wholesaler_id": F.lit("12"),
         "customer_name": None, "EAN": ["gone"]},
        mapping.GOLDEN_SCHEMA,
    )
    assert out.columns[0] == "wholesaler_id" and len(out.columns) == 18
    rows = out.select("customer_city", "total_amount", "wholesaler_id", "customer_name", "EAN", "vat_number").collect()
    assert rows == [("x", None, "12", None, None, None), ("y", 2.0, "12", None, None, None)]
    with pytest.raises(ValueError, match="no column 'nope'"):
        mapping.map_columns(df, {"EAN": "nope"}, mapping.GOLDEN_SCHEMA)
    with pytest.raises(ValueError, match="outside the schema"):
        mapping.map_columns(df, {"eann": "total"}, mapping.GOLDEN_SCHEMA)


def test_conform(spark):
    df = spark.createDataFrame([("1", "x"), ("a", "y")], "B string, extra string")
    out = mapping.conform(df, "a date, b int")
    assert out.dtypes == [("a", "date"), ("b", "int")]
    assert out.collect() == [(None, 1), (None, None)]
    with pytest.raises(Exception, match="NOT NULL column b"):
        mapping.conform(df, "b int NOT NULL").collect()


def test_union_conform(spark):
    a = spark.createDataFrame([(1, "x")], "id int, Name string")
    b = spark.createDataFrame([("y", 2.5), ("y", 2.5)], "name string, v double")
    out = mapping.union_conform(spark, [a, b], "id bigint, name string, v double")
    assert sorted(out.collect(), key=str) == sorted([(1, "x", None), (None, "y", 2.5), (None, "y", 2.5)], key=str)
    assert mapping.union_conform(spark, [], {"id": "bigint"}).schema.simpleString() == "struct<id:bigint>"


def test_csv_with_schema_and_without(spark, tmp_path):
    (tmp_path / "u.csv").write_text("title,n\na,1\nb,2\n")
    assert files.read_csv(spark, str(tmp_path)).dtypes == [("title", "string"), ("n", "int")]
    assert files.read_csv(spark, str(tmp_path), "title string, n double").collect() == [("a", 1.0), ("b", 2.0)]


def layout(spark, path, **options):
    out = files.read_csv_layout(spark, str(path), **options)
    rows = out.withColumn("full_file_path", F.substring_index("full_file_path", "/", -1)).collect()
    return out.columns, sorted((tuple(r) for r in rows), key=str)


def test_csv_layout_header_row_encoding_and_bad_lines(spark, tmp_path):
    body = "Report\r\n\r\nAdres,Klantnr.,Désignation\r\nstraat 1,12,\"café, crème\"\r\n\r\nstraat 2,13\r\ntoo,many,cells,here\r\n"
    (tmp_path / "a.csv").write_bytes(body.encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("x\n\nklantnr.,Extra\n14,e\n".encode("latin-1"))
    columns, rows = layout(spark, tmp_path, header_row=2, encoding="ISO-8859-1")
    assert sorted(columns) == sorted(["adres", "klantnr_", "désignation", "extra", "full_file_path"])
    pick = [columns.index(c) for c in ("adres", "klantnr_", "désignation", "extra", "full_file_path")]
    assert sorted((tuple(r[i] for i in pick) for r in rows), key=str) == sorted(
        [("straat 1", "12", "café, crème", None, "a.csv"), ("straat 2", "13", None, None, "a.csv"),
         (None, "14", None, "e", "b.csv")], key=str,
    )
    with pytest.raises(Exception, match="more cells than the header"):
        layout(spark, tmp_path, header_row=2, encoding="ISO-8859-1", on_bad="fail")
    with pytest.raises(ValueError, match="no file"):
        layout(spark, tmp_path, header_row=50, on_short="skip")


def test_csv_layout_names_files_without_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("preamble\nid,name\n1,x\n")
    (tmp_path / "short.csv").write_text("one line only\n")
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="empty.csv|short.csv"):
        layout(spark, tmp_path, header_row=1)
    assert layout(spark, tmp_path, header_row=1, on_short="skip")[1] == [("1", "x", "a.csv")]


def test_csv_layout_with_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"long\nname"\n1,"two\nlines, ""quoted"""\n2,plain\n\n3,"a\n\nb"\n')
    columns, rows = layout(spark, tmp_path, multi_line=True)
    assert columns == ["id", "long_name", "full_file_path"]
    assert [r[:2] for r in rows] == [("1", 'two\nlines, "quoted"'), ("2", "plain"), ("3", "a\n\nb")]


def test_csv_layout_reads_large_files_in_blocks(spark, tmp_path):
    lines = ["preamble", "id;name"] + [f"{i};name {i}" for i in range(20000)]
    (tmp_path / "big.csv").write_text("\n".join(lines))
    (tmp_path / "small.csv").write_text("preamble\nname;id\nn;-1\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        out = files.read_csv_layout(spark, str(tmp_path), header_row=1, sep=";")
        assert out.rdd.getNumPartitions() > 5
        assert out.agg(F.count("*"), F.sum("id"), F.min("name")).first() == (20001, sum(range(20000)) - 1, "n")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_list_files_skips_folders(spark, tmp_path):
    for name in ("2023/a.csv", "2023/b.txt", "2023/OLD files/c.csv", "old.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    found = files.list_files(spark, str(tmp_path), "*.csv", ["Old"])
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == ["a.csv", "old.csv"]


def test_select_sections(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "s string")
    names = lambda d: sorted(str(r.s) for r in d.collect())
    assert names(files.select_sections(df, "s", allow=["A"], deny=["A"])) == ["A"]
    assert names(files.select_sections(df, "s", allow="B")) == ["B"]
    assert names(files.select_sections(df, "s", allow=[], deny="A")) == ["B", "None"]
    assert len(names(files.select_sections(df, "s"))) == 3


def test_paged_json(spark):
    columns = '{"value": [{"displayName": "Title", "name": "t_x"}, {"displayName": "A unit", "name": "u"}]}'
    pages = [
        '{"value": [{"fields": {"t_x": "a", "u": "KG", "z": 1}}, {"fields": {"t_x": "b"}}], "@odata.nextLink": "p2"}',
        '{"value": [{"fields": {"u": "ST"}}]}',
    ]
    names = paged.column_map(spark.createDataFrame([(columns,)], "p string"), "p")
    df = spark.createDataFrame([(p,) for p in pages], "p string")
    out = paged.json_pages_to_table(df, "p", names)
    assert out.columns == ["A unit", "Title"]
    assert sorted(out.collect(), key=str) == sorted([("KG", "a"), (None, "b"), ("ST", None)], key=str)
    assert [r.n for r in df.select(paged.next_page("p").alias("n")).collect()] == ["p2", None]
    assert paged.failed_request(spark, "timeout").first()[2:] == (-1, None, None, "timeout")


@pytest.mark.parametrize("bad", ['{"value": [{"fields": {"t": "a"', '{"values": []}', None, "<html>"])
def test_unreadable_pages_do_not_vanish(spark, bad):
    df = spark.createDataFrame([('{"value": [{"fields": {"t": "a"}}]}',), (bad,)], "p string")
    with pytest.raises(Exception, match="MALFORMED|no list of items|Malformed"):
        paged.json_pages_to_table(df, "p", {"T": "t"}).collect()
    assert [r.p for r in paged.unreadable_pages(df, "p").collect()] == [bad]
    assert paged.unreadable_pages(df.limit(1), "p").count() == 0


def test_audit_of_empty_sources(spark):
    df = spark.createDataFrame([("a", "s1", 1), ("a", "s1", 2)], "f string, s string, v int")
    read = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", "s1")], "f string, s string")
    run, now = datetime(2024, 1, 1), datetime(2024, 1, 2)
    found = audit.ingest_audit(df, run, now, path="f", section="s", sources=read).collect()
    assert sorted((r.source_path, r.sheet_name, r.row_count, r.column_count) for r in found) == [
        ("a", "s1", 2, 1), ("a", "s2", 0, 1), ("b", "s1", 0, 1),
    ]


def test_audit(spark):
    df = spark.createDataFrame([("a//b c", "s1", 1), ("a//b c", "s1", 2), ("d", "s2", 3)], "f string, s string, v int")
    run, now = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = audit.ingest_audit(df, run, now, path="f", section="s").collect()
    assert sorted(rows) == [("a//b c", "s1", "a/b_c", 2, 1, now, run), ("d", "s2", "d", 1, 1, now, run)]
    assert mapping.to_schema(audit.AUDIT).names == audit.ingest_audit(df, run, now, path="f").columns


def test_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze")
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    tables.write_table(a, "bronze.t_a")
    tables.write_table(b, "bronze.t_b")
    assert tables.list_tables(spark, "bronze") == ["spark_catalog.bronze.t_a", "spark_catalog.bronze.t_b"] or (
        tables.list_tables(spark, "bronze") == ["bronze.t_a", "bronze.t_b"]
    )
    both, missing = tables.union_tables(spark, ["bronze.t_a", "bronze.t_b", "bronze.t_none"])
    assert missing == ["bronze.t_none"]
    assert sorted(both.collect(), key=str) == sorted([(1, "x", None), (2, None, "y")], key=str)
    assert tables.union_tables(spark, ["bronze.t_none"])[0].columns == ["wholesaler_name"]

    tables.write_table(spark.createDataFrame([("z", 3)], "a string, id int"), "bronze.t_a", mode="append")
    tables.write_table(b, "bronze.t_a", mode="append", merge_schema=True)
    assert sorted(spark.table("bronze.t_a").collect(), key=str) == sorted(
        [(1, "x", None), (3, "z", None), (2, None, "y")], key=str
    )
    # A new version may be computed from the table it replaces.
    tables.write_version(spark.table("bronze.t_a").filter("id > 1").withColumn("id", F.col("id") * 10), "bronze.t_a")
    assert sorted(r.id for r in spark.table("bronze.t_a").collect()) == [20, 30]
    assert tables.list_tables(spark, "bronze")[-1].endswith("t_b")

    assert tables.ensure_table(spark, "bronze.t_new", "a int").count() == 0
    tables.write_table(spark.createDataFrame([(5,)], "a int"), "bronze.t_new", mode="append")
    assert tables.ensure_table(spark, "bronze.t_new", "a int").collect() == [(5,)]


def test_append_keeps_every_column(spark):
    name = "bronze.t_extra"
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze")
    tables.write_table(spark.createDataFrame([(1, "x")], "id int, a string"), name)
    more = spark.createDataFrame([(2, "y", 7)], "id int, a string, extra int")
    with pytest.raises(ValueError, match="extra"):
        tables.write_table(more, name, mode="append")
    assert spark.table(name).collect() == [(1, "x")]
    tables.write_table(more, name, mode="append", merge_schema=True)
    assert sorted(spark.table(name).collect()) == [(1, "x", None), (2, "y", 7)]
    spark.sql(f"DROP TABLE {name}")


class Stopped(Exception):
    pass


class Stopping:
    """A session that stops behind its n-th statement."""

    def __init__(self, spark, n):
        self.spark, self.left = spark, n

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def sql(self, text):
        out = self.spark.sql(text)
        self.left -= 1
        if not self.left:
            raise Stopped
        return out


class Frame:
    """A DataFrame that belongs to such a session."""

    def __init__(self, df, session):
        self.write, self.sparkSession = df.write, session


@pytest.mark.parametrize("n", range(1, 7))
def test_versions_survive_a_stop_behind_any_statement(spark, n):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze")
    name = f"bronze.t_stop{n}"
    ids = lambda *i: spark.createDataFrame([(x,) for x in i], "id int")
    tables.write_table(ids(1, 2), name)
    try:
        tables.write_version(Frame(ids(9), Stopping(spark, n)), name)
    except Stopped:
        pass
    tables.write_table(ids(3), name, mode="append")
    assert sorted(r.id for r in spark.table(name).collect()) in ([1, 2, 3], [3, 9])
    tables.write_version(spark.table(name).unionByName(ids(4)), name)
    assert sorted(r.id for r in spark.table(name).collect()) in ([1, 2, 3, 4], [3, 4, 9])
    assert [t.name for t in spark.catalog.listTables("bronze") if f"t_stop{n}_" in t.name] == []
    spark.sql(f"DROP TABLE {name}")


def test_comments_and_views(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    tables.write_table(tables.with_comments(df, {"a": "the 'first'"}), "commented")
    tables.describe_table(spark, "commented", "it's a table", {"b": "second"})
    assert {c.name: c.description for c in spark.catalog.listColumns("commented")} == {"a": "the 'first'", "b": "second"}
    assert spark.catalog.getTable("commented").description == "it's a table"
    with pytest.raises(ValueError):
        tables.with_comments(df, {"c": "x"})
    tables.register_view(df, "a_view")
    assert spark.sql("SELECT a + b AS s FROM a_view").first().s == 3


def test_quoted_breaks_over_block_ends(spark, tmp_path, monkeypatch):
    """Cells with breaks, quotes and blank lines in one large file, read by several tasks, in blocks of any size."""
    import csv
    import io
    import random

    rng = random.Random(5)
    cell = lambda: "".join(rng.choice(['a', 'b', '"', "\n", "x,y", " ", "\n\n"]) for _ in range(rng.randint(1, 9)))
    rows = [[str(i), f"<{cell()}>"] for i in range(4000)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([["id", "note"], *rows])
    (tmp_path / "big.csv").write_text(text.getvalue())
    (tmp_path / "small.csv").write_text('note,id\n"<one\n>",-1\n')
    expected = sorted([*map(tuple, rows), ("-1", "<one\n>")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        for lines in (1, 7, 65_536):
            monkeypatch.setattr(files, "BLOCK_LINES", lines)
            assert files.read_lines(spark, str(tmp_path), number_all=True).rdd.getNumPartitions() > 5
            out = files.read_csv_layout(spark, str(tmp_path), multi_line=True)
            assert sorted((r["id"], r["note"]) for r in out.collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_paged_source(spark):
    import json

    from mergelane.sources import paged_source

    def page(values, link=None):
        return json.dumps({"value": [{"fields": {"Id": v}} for v in values]} | ({"@odata.nextLink": link} if link else {}))

    pages = {
        "a/1": page("12", "a/2"), "a/2": page("3", "a/3"), "a/3": page(""),
        "b/1": page("4"), "c/1": page("5", "c/2"), "c/2": page("6", "c/1"), "d/1": page("7", "d/2"), "d/2": "no json",
    }

    def fetch(url):
        if url == "e/2":
            raise OSError("no answer")
        return (200, pages[url]) if url in pages else (404, "none")

    pages["e/1"] = page("8", "e/2")
    good = paged_source.read_paged(spark, fetch, ["a/1", "b/1"])
    assert good.rdd.getNumPartitions() == 2
    table = paged.json_pages_to_table(good, "payload", {"n": "Id"}, keep=("list", "page"))
    assert sorted(map(tuple, table.collect())) == [("a/1", 0, "1"), ("a/1", 0, "2"), ("a/1", 1, "3"), ("b/1", 0, "4")]
    log = paged_source.read_paged(spark, fetch, ["c/1", "d/1", "e/1", "f/1", "b/1"], on_error="log").collect()
    failed = {(r.url, r.status_code): r.error for r in log if r.error}
    assert set(failed) == {("c/2", 200), ("d/2", 200), ("e/2", -1), ("f/1", 404)}
    assert "circle" in failed["c/2", 200] and failed["e/2", -1] == "no answer"
    assert [r.page for r in log if r.url in ("c/2", "b/1")] == [1, 0]
    with pytest.raises(Exception, match="no answer"):
        paged_source.read_paged(spark, fetch, ["e/1"]).collect()
    assert paged_source.read_paged(spark, fetch, []).count() == 0
