from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mergelane.functions import dates, text


def values(spark, col, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.x for r in df.select("i", col(F.col("v")).alias("x")).orderBy("i").collect()]


DATE_CASES = [
    # text, default result, strict result
    ("2023-01-18", date(2023, 1, 18), date(2023, 1, 18)),
    ("2023-1-8", date(2023, 1, 8), date(2023, 1, 8)),
    ("01/05/2023", date(2023, 5, 1), date(2023, 5, 1)),
    ("1/5/2023", date(2023, 5, 1), None),
    ("01.05.2023", date(2023, 5, 1), None),
    ("05_23", date(2023, 5, 31), date(2023, 5, 31)),
    ("05_96", date(2096, 5, 31), date(2096, 5, 31)),
    ("12_2023", date(2023, 12, 31), date(2023, 12, 31)),
    ("5/2023", date(2023, 5, 31), date(2023, 5, 31)),
    ("5-2023", date(2023, 5, 31), date(2023, 5, 31)),
    ("05_01_2023", date(2023, 1, 5), date(2023, 1, 5)),
    ("2023_Q1", date(2023, 3, 31), date(2023, 3, 31)),
    ("Q1_2023", date(2023, 3, 31), date(2023, 3, 31)),
    ("xQ4_2023y", date(2023, 12, 31), date(2023, 12, 31)),
    ("q1_2023", date(2023, 3, 31), None),
    ("2023_q1", date(2023, 3, 31), None),
    ("05-Jan-23", date(2023, 1, 5), date(2023, 1, 5)),
    ("5-Jan-23", date(2023, 1, 5), date(2023, 1, 5)),
    ("05-Jan-2023", date(2023, 1, 5), date(2023, 1, 5)),
    ("5-Jan-2023", date(2023, 1, 5), date(2023, 1, 5)),
    ("20230105", date(2023, 1, 5), date(2023, 1, 5)),
    ("2025-02-26 00:00:00", date(2025, 2, 26), date(2025, 2, 26)),
    ("2025-02-26 13:01:02.123", date(2025, 2, 26), date(2025, 2, 26)),
    ("2025-02-26T13:01:02Z", date(2025, 2, 26), date(2025, 2, 26)),
    ("29_02_2023", None, None),
    ("13_2023", None, None),
    ("20231301", None, None),
    ("96", None, None),
    ("12:30", None, None),
    ("abc", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("strict", [False, True])
def test_parse_mixed_date(spark, strict):
    found = values(spark, lambda c: dates.parse_mixed_date(c, strict_parity=strict), [c[0] for c in DATE_CASES])
    assert found == [c[2 if strict else 1] for c in DATE_CASES]


def test_path_dates(spark):
    cases = [
        ("x/volumes/x/01_02_2023_f.csv", "01_02_2023", date(2023, 2, 1)),
        ("volumes/Q3_2024.csv", "Q3_2024", date(2024, 9, 30)),
        ("datalake/a/12_2023.csv", "12_2023", date(2023, 12, 31)),
        # The leftmost hit of this path is 23_01: month 23.
        ("volumes/2023_01.csv", "23_01", None),
        ("volumes/none.csv", "", None),
        ("2023-01-05 10:00", "2023-01-05 10:00", date(2023, 1, 5)),
        ("01/05/2023", None, date(2023, 5, 1)),
        ("elsewhere/Q3_2024.csv", None, date(2024, 9, 30)),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v string")
    df = df.withColumn("found", dates.extract_path_date("v"))
    rows = dates.parse_date_or_path(df, "v").orderBy("i").collect()
    assert [(r.found, r.v) for r in rows] == [c[1:] for c in cases]
    strict = dates.parse_date_or_path(df, "v", strict_parity=True).orderBy("i").collect()
    assert [r.v for r in strict] == [c[2] if i != 7 else None for i, c in enumerate(cases)]


@given(days=st.lists(st.dates(date(2000, 1, 1), date(2099, 12, 31)), min_size=1, max_size=30))
@settings(max_examples=5, deadline=None)
def test_formats_round_trip(spark, days):
    shown = [d.strftime(f) for d in days for f in ("%Y-%m-%d", "%d/%m/%Y", "%d_%m_%Y", "%Y%m%d", "%d-%b-%y", "%d-%b-%Y")]
    assert values(spark, dates.parse_mixed_date, shown) == [d for d in days for _ in range(6)]


def test_date_key_and_month_start(spark):
    assert values(spark, dates.date_key, [date(2023, 1, 5), None], "date") == [20230105, None]
    stamps = [datetime(2024, 4, 30, 23, 59), datetime(2024, 5, 1), datetime(2024, 5, 9), None]
    now = datetime(2024, 5, 17, 8)
    assert values(spark, lambda c: dates.since_month_start(c, now), stamps, "timestamp") == [False, True, True, None]


def test_country(spark):
    given_, expected = zip(("België", "BE"), (" Nederland ", "Nederland"), ("Duitsland", "DE"), ("XX", "XX"), (None, None))
    assert values(spark, text.normalize_country, given_) == list(expected)


VAT_CASES = [
    ("BE 0123.456.789", "BE0123456789"),
    ("be0123456789", "NL0123456789"),
    ("BTW 123456789", "NL123456789"),
    ("vat-fr 12 345", "NL12345"),
    ("0000000", None),
    ("1234", None),
    ("BE1234", None),
    ("", None),
    (None, None),
]


def test_vat(spark):
    given_, expected = zip(*VAT_CASES)
    assert values(spark, lambda c: text.normalize_vat(c, F.lit("NL")), given_) == list(expected)
    assert values(spark, lambda c: text.normalize_vat(c, F.lit(None).cast("string")), ["12345"]) == ["12345"]
    df = spark.createDataFrame([(i, v, "NL") for i, v in enumerate(given_)], "i int, vat string, land string")
    by_column = text.normalize_vat_column(df, "vat", "land").orderBy("i").collect()
    assert [r.vat for r in by_column] == list(expected)


def test_ids(spark):
    assert values(spark, text.strip_float_suffix, [" 123.0", "9000.0 ", "1.00", "12", None]) == ["123", "9000", "1.00", "12", None]
    assert values(spark, text.strip_leading_zeros, ["0012", "000", "a0", None]) == ["12", "", "a0", None]
    ean = ["5.410321000123E12", "5410321000123.0", "90071992547409931", "", "abc", None]
    assert values(spark, text.normalize_ean, ean) == ["5410321000123", "5410321000123", "90071992547409931", None, None, None]
    assert values(spark, text.number_text, [123456789.0, None], "double") == ["123456789", None]
    assert values(spark, text.strip_prefix, ["B-9000", "9000", None]) == ["9000", "9000", None]
    for part, expected in ((1, ["a/b", "", None]), (2, ["12", "", None])):
        assert values(spark, lambda c: text.split_composite(c, part), ["a/b/12", "plain", None]) == expected


def test_paths_and_urls(spark):
    assert values(spark, text.clean_path, ["dbfs:/a%20b/c%3Ed.csv"]) == ["/a_b/c>d.csv"]
    assert values(spark, text.clean_output_path, ["/a//b c.csv"]) == ["/a/b_c.csv"]
    assert values(spark, text.file_name, ["/a/b.c.csv", "x"]) == ["b.c", "x"]
    assert values(spark, text.file_stem, ["/a/My file-1.v2.xlsx", "x", ".csv"]) == ["My_file_1.v2", "x", ".csv"]
    urls = ["https://m/x?key=SECRET&x=1", "https://m/x?a=1&key=S", "https://m/x?monkey=S", None]
    expected = ["https://m/x?key=***&x=1", "https://m/x?a=1&key=***", "https://m/x?monkey=S", None]
    assert values(spark, text.mask_query_param, urls) == expected


def test_entity_keys(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a", "b", None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    keys = {m: [r.k for r in df.select(text.entity_key(["x", "y", "z"], m).alias("k")).collect()]
            for m in ("sha2", "text", "xxhash64", "murmur32")}
    # Joined text loses the place of a null, the JSON keeps it.
    assert keys["sha2"][0] != keys["sha2"][1] == keys["sha2"][2]
    assert keys["text"][0] == keys["text"][1]
    assert all(k >= 0 for k in keys["murmur32"])
    with pytest.raises(ValueError):
        text.entity_key(["x"], "crc")


def test_blank_columns(spark):
    df = spark.createDataFrame([(" a ", "  ", 1)], "a string, b string, n int")
    assert text.blank_columns_to_null(df).collect() == [("a", None, 1)]
