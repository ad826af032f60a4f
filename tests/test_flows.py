import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mergelane import session
from mergelane.operators import enrichment, matching, upsert
from mergelane.operators.mapping import GOLDEN_SCHEMA, conform, empty_table
from mergelane.plans import customers, ingest, sales, views
from mergelane.session import shared_folder

NOW = datetime(2024, 5, 17, 12, 0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- upsert ----------------------------------------------------------------------------------------


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "x", "keep"), ("b", 2, None, "keep"), (None, 3, "n", "keep")], "k string, id int, v string, note string"
    )


def test_merge_upsert(spark, table):
    source = spark.createDataFrame([("a", "new", 9), ("c", "ins", 8), (None, "null", 7)], "k string, v string, extra int")
    out = upsert.merge_upsert(table, source, ["k"], ["v"])
    assert out.columns == table.columns
    assert rows(out) == sorted(
        [("a", 1, "new", "keep"), ("b", 2, None, "keep"), (None, 3, "n", "keep"), ("c", None, "ins", None),
         (None, None, "null", None)], key=str,
    )


def test_merge_upsert_twice_is_once(spark, table):
    source = spark.createDataFrame([("a", None), ("c", "ins")], "k string, v string")
    once = upsert.merge_upsert(table, source, ["k"], ["v"])
    assert rows(upsert.merge_upsert(once, source, ["k"], ["v"])) == rows(once)
    assert {r.k: r.v for r in once.collect()}["a"] is None


def test_merge_upsert_refuses_two_rows_per_key(spark, table):
    source = spark.createDataFrame([("a", "1"), ("a", "2")], "k string, v string")
    with pytest.raises(Exception, match="more than one source row"):
        upsert.merge_upsert(table, source, ["k"], ["v"]).collect()


# --- enrichment ------------------------------------------------------------------------------------


@pytest.fixture
def addresses(spark):
    people = spark.createDataFrame(
        [(1, "hit"), (2, "null place"), (3, "miss"), (4, "other api"), (5, "miss")], "id int, customer_name string"
    )
    people = people.withColumns({c: F.lit(None).cast("string") for c in enrichment.PARTNER_COLUMNS if c != "customer_name"})
    url = F.concat(F.lit("https://m/x?key=SECRET&id="), "id")
    return enrichment.address_payload(people, "customer_country", ["customer_name", "customer_address"], "customer_city",
                                      "customer_postal_code", "geo", url)


@pytest.fixture
def cache(spark):
    payload = '{{"address":{{"addressLines":["{}"]}}}}'.format
    made = [
        (payload("hit"), "geo", "place-1", datetime(2024, 5, 1)),
        (payload("null place"), "geo", None, datetime(2024, 4, 30)),
        (payload("other api"), "maps", "place-4", datetime(2024, 5, 2)),
    ]
    df = spark.createDataFrame(made, "payload string, api_name string, place_id string, api_execution_timestamp timestamp")
    return conform(df, enrichment.CACHE_SCHEMA)


def test_payload(addresses):
    first = addresses.filter("id = 1").first()
    assert first.payload_string == '{"address":{"addressLines":["hit"]}}'
    assert first.payload.address.addressLines == ["hit"] and first.payload.address.locality is None


def test_cache_and_budget(addresses, cache):
    found = {r.id: r.place_id for r in enrichment.attach_cached(addresses, cache).collect()}
    assert found == {1: "place-1", 2: None, 3: None, 4: None, 5: None}
    pick = lambda budget, **kw: [r.id for r in enrichment.select_for_enrichment(addresses, cache, budget, NOW, ["id"], **kw).collect()]
    assert enrichment.calls_this_month(cache, NOW).first().used == 2
    assert pick(5) == [2, 3, 4] and pick(4) == [2, 3] and pick(2) == [] and pick(0) == []
    assert pick(5, retry=False) == [3, 4, 5]


def test_enrichment_round(spark, addresses, cache, tmp_path):
    log = tmp_path / "asked"

    def provider(batch):
        with open(log, "a") as f:
            f.writelines(p + "\n" for p in batch["payload_string"])
        return batch.assign(place_id="p:" + batch["payload_string"].str.len().astype(str), browser_url=None, google_api_raw_json="{}")

    missing = enrichment.attach_cached(addresses, cache).filter("place_id IS NULL")
    schema = "place_id string, browser_url string, google_api_raw_json string"
    answered = enrichment.enrich(missing, provider, schema, NOW, tasks=2)
    assert answered.count() == 4 and answered.filter("place_id IS NULL").isEmpty()
    assert len(log.read_text().splitlines()) == 3, "each distinct payload is asked once"
    after = enrichment.update_cache(cache, answered)
    assert after.columns == cache.columns and after.count() == 5
    by_key = {(r.api_name, r.payload[-14:-4]): r for r in after.collect()}
    assert len(by_key) == 5
    new = after.filter("business_partner_name = 'miss'").first()
    assert new.api_url_masked.startswith("https://m/x?key=***&id=") and new.api_execution_timestamp == NOW
    assert rows(enrichment.update_cache(after, answered)) == rows(after)
    again = enrichment.attach_cached(addresses, after)
    assert again.filter("place_id IS NULL").isEmpty()


def test_provider_is_asked_once_per_payload(spark, tmp_path):
    log = tmp_path / "asked"

    def provider(batch):
        with open(log, "a") as f:
            f.writelines(p + "\n" for p in batch["payload_string"])
        return batch.assign(place_id="p", browser_url=None, google_api_raw_json="{}")

    people = spark.range(20).withColumn("customer_name", F.concat(F.lit("n"), "id"))
    people = people.withColumns({c: F.lit(None).cast("string") for c in enrichment.PARTNER_COLUMNS if c != "customer_name"})
    asked = enrichment.address_payload(people, "customer_country", ["customer_name"], "customer_city", "customer_postal_code", "geo")
    answered = enrichment.enrich(asked, provider, "place_id string, browser_url string, google_api_raw_json string", NOW)
    after = enrichment.update_cache(empty_table(spark, enrichment.CACHE_SCHEMA), answered)
    assert after.count() == 20 and after.filter("place_id IS NULL").isEmpty()
    assert len(log.read_text().splitlines()) == 20


def test_enrichment_loop(spark, tmp_path):
    """Rounds ask for what the table lacks, as far as the month's budget goes."""
    from mergelane.plans.enrichment import enrichment_round

    log = tmp_path / "asked"
    log.touch()

    def provider(batch):
        with open(log, "a") as f:
            f.writelines(p + "\n" for p in batch["payload_string"])
        return batch.assign(place_id="p", browser_url="u", google_api_raw_json="{}")

    people = spark.range(7).withColumn("customer_name", F.concat(F.lit("n"), F.col("id") % 6))
    people = people.withColumns({c: F.lit(None).cast("string") for c in enrichment.PARTNER_COLUMNS if c != "customer_name"})
    people = enrichment.address_payload(people, "customer_country", ["customer_name"], "customer_city", "customer_postal_code", "geo")
    schema = "place_id string, browser_url string, google_api_raw_json string"
    spark.sql("CREATE DATABASE IF NOT EXISTS loop")

    def run(budget, now=NOW):
        out = enrichment_round(people, "loop.cache", provider, schema, budget, now, ["id"])
        return out.filter("place_id IS NOT NULL").count(), len(log.read_text().splitlines())

    assert run(4) == (5, 4)  # n0 stands twice
    assert run(4) == (5, 4)
    assert run(4, datetime(2024, 6, 1)) == (7, 6)
    assert run(4, datetime(2024, 6, 2)) == (7, 6)
    spark.sql("DROP TABLE loop.cache")


# --- flows -----------------------------------------------------------------------------------------


def test_ingest_and_consolidate(spark, tmp_path, monkeypatch):
    one, two = tmp_path / "One 2023", tmp_path / "two"
    one.mkdir(), two.mkdir()
    (one / "Q1_2023 a.csv").write_bytes("junk\nKlantnr.;Adres;Prijs;Client\n12.0;Straat 1;2.5;Café/7\n".encode("latin-1"))
    (one / "Q2_2023 b.csv").write_bytes("junk\nAddress;Klantnr.;Prijs;Client\nRue 2;13.0;x;Bar/8\n".encode("latin-1"))
    (two / "all.csv").write_text("client,article,date\nA,5,2023-01-02\n")
    mapped = ingest.ingest_partner(
        spark, str(one),
        {"wholesaler_name": F.lit("one"), "customer_number": "klantnr_", "customer_address": ["adres", "address"],
         "total_amount": "prijs", "customer_name": F.substring_index("client", "/", 1), "date": "full_file_path"},
        csv={"header_row": 1, "sep": ";", "encoding": "latin1"},
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS partners")
    mapped.write.mode("overwrite").saveAsTable("partners.one")
    other = ingest.ingest_partner(
        spark, str(two), {"wholesaler_name": F.lit("two"), "customer_name": "client", "product_number": "article", "date": "date"}
    )
    other.write.mode("overwrite").saveAsTable("partners.two")
    golden = ingest.consolidate(spark, "partners")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "list_tables", lambda spark, database: ["partners.one", "partners.gone"])
        with pytest.raises(ValueError, match="partners.gone"):
            ingest.consolidate(spark, "partners")
        with pytest.warns(UserWarning, match="partners.gone"):
            assert ingest.consolidate(spark, "partners", skip_unreadable=True).count() == mapped.count()
    assert golden.schema.simpleString() == empty_table(spark, GOLDEN_SCHEMA).schema.simpleString()
    assert all(" " not in r.full_file_path for r in golden.collect())
    # The date comes out of the path: nothing but the file name says it.
    in_path = F.concat(F.lit("volumes/"), F.substring_index("date", "/", -1))
    clean = sales.clean_sales(golden.withColumn("date", F.when(F.col("date").contains("/"), in_path).otherwise(F.col("date"))))
    found = clean.select("wholesaler_name", "customer_number", "customer_address", "total_amount", "customer_name",
                         F.col("date").cast("string"))
    assert rows(found) == sorted(
        [("one", "12", "Straat 1", 2.5, "Café", "2023-03-31"), ("one", "13", "Rue 2", None, "Bar", "2023-06-30"),
         ("two", None, None, None, "A", "2023-01-02")], key=str,
    )


def test_sales_flow(spark):
    golden = conform(
        spark.createDataFrame(
            [("0012", " 7.0", "100.0", "5.410321000123E12", 10.0, "KAR", "w", "België", "BTW 0123456", "volumes/x/Q1_2023.csv",
              "volumes/x/Q1_2023.csv", "9000.0")],
            "wholesaler_id string, customer_number string, product_number string, ean string, total_amount double, uom string,"
            "wholesaler_name string, customer_country string, vat_number string, date string, full_file_path string,"
            "customer_postal_code string",
        ),
        GOLDEN_SCHEMA,
    )
    clean = sales.clean_sales(golden)
    row = clean.first()
    assert (row.EAN, row.vat_number, str(row.date), row.customer_postal_code) == ("5410321000123", "BE0123456", "2023-03-31", "9000")
    accounts = spark.createDataFrame([("12", "0055"), ("12", "0066")], "c4cu_account_id string, c4cu_customer_id string")
    records = spark.createDataFrame(
        [("00100", "55", "M2"), ("100", "055", "M1"), ("100", "66", "M0")],
        "cumi_customermaterialnumber_id string, cumi_customernumber_id string, cumi_material_id string",
    )
    units = spark.createDataFrame([("KAR", "karton", "w")], "uom string, converted_uom string, wholesaler_name string")
    texts = spark.createDataFrame([("karton", "EN", "CS")], "converted_uom string, language string, muom_unit_id string")
    factors = spark.createDataFrame(
        [("000100", "CS", 3.0, 2.0, None)],
        "muom_material_id string, muom_unit_id string, muom_numerator_qty double, muom_denominator_qty double, muom_eanupc_id string",
    )
    fact = sales.enrich_sales(clean, accounts, records, units, texts, factors)
    view = views.sales_view(fact).collect()
    assert len(view) == 1
    got = view[0].asDict()
    assert got["Cumi Material Id"] == "M1" and got["Sellout Kgl Qty"] == 15.0 and got["Serivce Render Date"] == 20230331
    assert got["Sharepoint File Name"] == "Q1_2023" and got["Id at Wholesaler + Wholesaler Id"] == "70012"


def test_sales_in_portions_are_the_same_sales(spark, monkeypatch):
    """More sales than are looked up at a time: portion by portion, with the shuffle files of one portion at a time."""
    sold = [
        (None if i % 11 == 0 else f"{i % 17}.0", f"54{i % 5}" if i % 3 else None, float(i), None if i % 13 == 0 else "KAR", f"0{i % 4}")
        for i in range(200)
    ]
    golden = conform(
        spark.createDataFrame(sold, "product_number string, ean string, total_amount double, uom string, wholesaler_id string"),
        GOLDEN_SCHEMA,
    ).withColumns({"wholesaler_name": F.lit("w"), "full_file_path": F.lit("volumes/x/Q1_2023.csv"), "date": F.lit("2023-03-31")})
    clean = sales.clean_sales(golden)
    accounts = spark.createDataFrame([(f"00{i}", f"7{i}") for i in range(3)], "c4cu_account_id string, c4cu_customer_id string")
    records = spark.createDataFrame(
        [(f"00{i}", f"07{k}", f"M{i + n}") for i in range(12) for k in range(3) for n in (0, 1)] + [(None, "70", "M")],
        "cumi_customermaterialnumber_id string, cumi_customernumber_id string, cumi_material_id string",
    )
    units = spark.createDataFrame([("KAR", "karton", "w")], "uom string, converted_uom string, wholesaler_name string")
    texts = spark.createDataFrame([("karton", "EN", "CS")], "converted_uom string, language string, muom_unit_id string")
    factors = spark.createDataFrame(
        [(f"000{i}", "CS", float(i), 2.0, f"54{i}" if i < 3 else None) for i in range(1, 9)],
        "muom_material_id string, muom_unit_id string, muom_numerator_qty double, muom_denominator_qty double, muom_eanupc_id string",
    )
    given = (clean, accounts, records, units, texts, factors)
    whole = sales.enrich_sales(*given)
    parts, write = [], sales.materialize_parts

    def counted(frames, *more):
        frames = list(frames)
        parts.extend(d.count() for d in frames)
        return write(frames, *more)

    monkeypatch.setattr(sales, "PORTION_SALES", 30)
    monkeypatch.setattr(sales, "materialize_parts", counted)
    fact = sales.enrich_sales(*given)
    assert fact.schema == whole.schema and fact.count() == 200
    assert len(parts) == 7 and sum(parts) == 200 and max(parts) < 100
    assert sorted(map(str, fact.collect())) == sorted(map(str, whole.collect()))
    assert fact.filter("cumi_material_id IS NOT NULL AND muom_numerator_qty IS NOT NULL").count() > 20


def customer(number, name, street, zip_, vat=None, wholesaler="w1", place=None):
    return (number, street, "Gent", zip_, "BE", name, None, wholesaler, vat, wholesaler, place)


@pytest.fixture
def identities(spark):
    people = [
        customer("1", "Bakkerij Jan", "Kerkstraat 1", "9000", vat="BE111111"),
        customer("1", "Bakkery Jan", "Kerkstraat 1", "9000", wholesaler="w2"),
        customer("2", "Jan", "Elders 5", "1000", vat="be111111"),
        customer("3", "Frituur", "Markt 2", "9000", vat="BE333333"),
        customer("4", "Snack", "Markt 3", "8000", place="p4"),
        customer("5", "Alone", "Nowhere", "7000"),
    ]
    df = spark.createDataFrame(people, ", ".join(f"{c} string" for c in (*customers.ENTITY_COLUMNS, "place_id")))
    keyed = df.withColumn("unique_id", F.concat_ws("/", "customer_number", "wholesaler_id"))
    return customers.match_internal(keyed)


@pytest.fixture
def crm(spark):
    raw = spark.createDataFrame(
        [("A1", "Other", "Belgium", "X", "1", "9000", "BE111111", None), ("A2", "Other", "Belgium", "X", "1", "9000", " be111111 ", ""),
         ("A3", "Frituur", "Belgium", "Markt", "2", "9000", "", "BE333333"), ("A4", "Frituur", "Belgium", "Markt", "2", "9000", "", ""),
         ("A5", "Alone", "France", "Nowhere", "", "7000", "", "")],
        "c4cu_account_id string, c4cu_account_desc string, c4cu_country_desc string, c4cu_streetaddress_id string,"
        "c4cu_housenumber_id string, c4cu_postalcode_id string, c4cu_vatregistration_id string, c4cu_taxnumber4_id string",
    ).withColumns({"c4cu_country_id": F.lit("BE"), "c4cu_city_id": F.lit(" ")})
    return customers.prepare_accounts(raw, "Belgium").withColumn("place_id", F.lit(None).cast("string"))


@pytest.fixture
def partners(spark):
    return customers.clean_relationships(spark.createDataFrame(
        [("00B4", "w1", "0004"), ("B9", "w9", "4")],
        "c4cu_businesspartner_id string, c4cu_businesspartner2_id string, c4cu_numberatwholesaler_id string",
    ))


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark):
    """The next table's come when this one's have gone; the setting is the session's own again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting, None)
    table = session.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert _shuffle_files(spark) <= before and spark.conf.get(setting, None) == was
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    parts = [spark.range(3).toDF("n"), spark.range(3, 5).toDF("n"), spark.range(0).toDF("n")]
    assert sorted(r.n for r in session.materialize_parts(parts, "parts").collect()) == [0, 1, 2, 3, 4]


def test_settle_empties_what_was_written_on_the_way(spark):
    inner = []

    def build():
        inner.append(session.materialize(spark.range(10), "inner"))
        inner.append(session.settle(lambda: session.materialize(inner[0].filter("id > 2"), "deep").filter("id > 3"), "middle"))
        return inner[-1].filter("id > 4")

    out = session.settle(build, "outer")
    assert sorted(r.id for r in out.collect()) == [5, 6, 7, 8, 9]
    left = [spark.read.parquet(*{f.rpartition("/")[0] for f in t.inputFiles()}).count() for t in inner]
    assert left == [0, 0]
    assert session.stored(out, "again") is out and session.stored(out.filter("id > 5"), "again") is not out


def test_customers_leave_one_table(spark, identities, crm, partners, tmp_path, monkeypatch):
    """Of all that is matched and clustered, what nothing reads any more is emptied; accounts are found by the rules' columns."""
    seen, write = [], matching.materialize
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(matching, "materialize", lambda df, tag, *more: seen.append((tag, df.columns)) or write(df, tag, *more))

    def held():
        return sorted(p.name.rpartition("-")[0] for p in tmp_path.iterdir() if spark.read.parquet(str(p)).count())

    own = customers.match_internal(identities.select(*customers.ENTITY_COLUMNS, "place_id", "unique_id"))
    assert held() == ["clustered"]
    linked = customers.link_accounts(own, crm, partners)
    assert held() == ["cluster-accounts", "clustered", "linked"]
    assert linked.count() >= own.count()
    winners = next(columns for tag, columns in seen if tag == "winners")
    assert "customer_city" not in winners and {"unique_id", "vat_number", "customer_postal_code"} <= {*winners}


@pytest.mark.parametrize("handler", ["best", "multiple"])
def test_rules_one_after_the_other_find_the_same(spark, identities, crm, handler):
    ids, own = matching.Ids("unique_id", "c4cu_account_id"), identities.select(*customers.ENTITY_COLUMNS, "place_id", "unique_id")
    whole, staged = (matching.apply_matching(own, crm, customers.EXTERNAL_RULES, ids, handler, staged=s) for s in (False, True))
    assert whole.columns == staged.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, staged.collect()))


def test_identity_flow(identities, crm, partners):
    clusters = {r.unique_id: r.dim_sellout_cust_id for r in identities.collect()}
    assert clusters == {"1/w1": "1/w1", "1/w2": "1/w1", "2/w1": "1/w1", "3/w1": "3/w1", "4/w1": "4/w1", "5/w1": "5/w1"}
    linked = customers.link_accounts(identities, crm, partners)
    found = {(r.unique_id, r.rule, r.direct_c4S_account_id, r.C4S_account_id, r.customer_number_Occurrence) for r in linked.collect()}
    vat, tax, partner = "ext_Tax_Number_4_match", "ext_vat_number_match", "ext_BPR_match"
    assert found == {
        ("1/w1", vat, "A1", "A1", 2), ("1/w1", vat, "A2", "A1", 2),
        ("2/w1", vat, "A1", "A1", 2), ("2/w1", vat, "A2", "A1", 2),
        ("1/w2", None, None, "A1", 2),
        # The tax number comes before the equal name and address of A4.
        ("3/w1", tax, "A3", "A3", 1),
        ("4/w1", partner, "B4", "B4", 1),
        ("5/w1", None, None, None, 0),
    }
    wide = customers.match_external(identities, crm, partners)
    cols = ["unique_id", "direct_c4S_account_id", "C4S_account_id", "customer_number_Occurrence"]
    assert set(map(tuple, wide.select(cols).collect())) == {(f[0], *f[2:]) for f in found}
    # Customer 3 meets A3 by its tax number and, side by side, A3 and A4 by name and address.
    assert wide.filter("unique_id = '3/w1'").count() == 2


def test_views(identities, crm, partners):
    linked = customers.link_accounts(identities, crm, partners)
    view = {r["Id at Wholesaler"]: (r["C4s Account Id"], r["Wholesaler Id"], r.rn) for r in views.customers_view(linked).collect()}
    assert view == {"1": ("00000000A1", "w1", 1), "2": ("00000000A1", "w1", 1), "3": ("00000000A3", "w1", 1),
                    "4": ("00000000B4", "w1", 1), "5": (None, "w1", 1)}
    dup = views.customers_with_duplicates_view(linked)
    assert sorted((r.dim_sellout_cust_id, str(r["C4s Account Id"]), r["Id at Wholesaler"]) for r in dup.collect()) == [
        ("1/w1", "00000000A1", "2"), ("1/w1", "00000000A2", "2"), ("1/w1", "None", "1"), ("3/w1", "00000000A3", "3"),
        ("4/w1", "00000000B4", "4"), ("5/w1", "None", "5"),
    ]


def test_entities(spark):
    raw = empty_table(spark, GOLDEN_SCHEMA).unionByName(spark.createDataFrame(
        [(None, "Own", "1"), (None, "Own", "1"), ("N", "Own", "1")], "customer_name string, owner_name string, customer_number string"
    ), allowMissingColumns=True)
    found = customers.customer_entities(raw)
    assert sorted(r.customer_name for r in found.collect()) == ["N", "Own"]
    assert found.select("unique_id").distinct().count() == 2


def test_materials_view(spark):
    cols = "mtrl_material_id string, mtrl_material_desc string, mtrl_materialgroup6_desc string, mtrl_materialtype_desc string," \
           "mtrl_businessline_desc string, mtrl_productfamily_desc string, mtrl_businessline_id string"  # fmt: skip
    row = views.materials_view(spark.createDataFrame([("0042", "Dough", "g", "t", "b", "f", "1")], cols)).first()
    assert row[:3] == ("0042", "42", "42 Dough") and row["ABC classification Id"] == "1"


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries().keys() >= e.oracle_sql().keys()"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Session:
        """A session without the setting."""

        conf = {"spark.sql.warehouse.dir": "file:/shared/warehouse/"}

    assert shared_folder(Session()) == "file:/shared/warehouse/_intermediate"
