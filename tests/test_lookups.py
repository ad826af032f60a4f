from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from mergelane.operators import lookups, quantity, ranking


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@contextmanager
def conf(spark, **settings):
    settings = {f"spark.sql.{k}": v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(params=["broadcast", "shuffled"])
def join_form(request, spark):
    """A lookup gives the same rows whether its right side is broadcast or not."""
    if request.param == "broadcast":
        yield
    else:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        yield
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def skewed(spark):
    keys = ["hot"] * 50 + ["warm"] * 10 + ["mild"] * 5 + ["cold", "lost"] + [None] * 20
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string")


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame(
        [("hot", 1, "h"), ("warm", 2, None), ("cold", 3, "c"), ("mild", None, "m"), (None, 9, "null")],
        "k string, n int, t string",
    )


def test_lookup(join_form, skewed, dimension):
    out = lookups.lookup(skewed, dimension, ["k"], ["n", "t"])
    values = {"hot": (1, "h"), "warm": (2, None), "cold": (3, "c"), "mild": (None, "m")}
    expected = [(r.id, r.k, *values.get(r.k, (None, None))) for r in skewed.collect()]
    assert rows(out) == sorted(expected, key=str)


def test_lookup_null_safe_and_counts(join_form, skewed, dimension):
    out = lookups.lookup(skewed, dimension, ["k"], ["n"], null_safe=True)
    assert out.filter("k IS NULL").select("n").distinct().collect() == [(9,)]
    assert out.count() == skewed.count()
    counted = ranking.with_count(skewed, ["k"])
    assert {(r.k, r.match_count) for r in counted.collect()} == {
        ("hot", 50), ("warm", 10), ("mild", 5), ("cold", 1), ("lost", 1), (None, 20),
    }


def test_lookup_filter_and_expressions(join_form, skewed, dimension):
    out = lookups.lookup(skewed, dimension, [(F.upper("k"), F.upper("k"))], ["n"], right_filter=F.col("n") < 2)
    assert {(r.k, r.n) for r in out.collect()} == {
        ("hot", 1), ("warm", None), ("mild", None), ("cold", None), ("lost", None), (None, None),
    }
    with pytest.raises(ValueError, match="on the left already"):
        lookups.lookup(skewed, dimension, ["k"], ["k"])


@pytest.mark.parametrize("hot", [7, None])
def test_hot_keys_are_split(spark, hot):
    """However many keys are hot, or null: AQE cuts their partitions, as the lookup is a plain left join."""
    key = F.when(F.col("id") % 4 > 0, F.lit(hot).cast("long")).otherwise(F.col("id") % 2000)
    left = spark.range(0, 400_000, 1, 4).withColumn("k", key)
    left = left.withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    settings = {
        "autoBroadcastJoinThreshold": "-1", "adaptive.autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.enabled": "true",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "adaptive.skewJoin.skewedPartitionFactor": "2",
        "adaptive.advisoryPartitionSizeInBytes": "200k",
    }
    with conf(spark, **settings):
        out = lookups.lookup(left, right, ["k"], ["v"])
        # All columns are used, so that the shuffled rows have their size.
        used = F.count_if(F.length("text") + F.coalesce("v", F.lit(0)) >= 0).alias("count")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).agg(used).collect()]
    assert sum(sizes) == 400_000 and max(sizes) < 150_000


@pytest.mark.parametrize(("name", "scans", "exchanges"), [("v_sales", 8, 23), ("uom_convert", 5, 15), ("cluster_occurrence", 4, 10)])
def test_chained_lookups_read_each_table_once(spark, name, scans, exchanges):
    """Plans grow with the number of lookups, not with a power of it."""
    import __spark_entry__ as driver

    with conf(spark, **NO_BROADCAST):
        plan = driver.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        executed = driver.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= scans
    assert executed.count("Exchange hashpartitioning") <= exchanges


def test_zero_key_join(join_form, spark):
    left = spark.createDataFrame([("007", 1), ("0", 2), ("8", 3), (None, 4)], "a string, i int")
    right = spark.createDataFrame([("7", "x"), ("07", "y"), ("00", "z"), (None, "n")], "b string, v string")
    every = lookups.zero_key_join(left, right, [("a", "b")], ["v"])
    assert rows(every) == sorted([("007", 1, "x"), ("007", 1, "y"), ("0", 2, "z"), ("8", 3, None), (None, 4, None)], key=str)
    one = lookups.zero_key_join(left, right, [("a", "b")], ["v"], order=[F.desc("v")])
    assert rows(one) == sorted([("007", 1, "y"), ("0", 2, "z"), ("8", 3, None), (None, 4, None)], key=str)


def test_priority_lookup_falls_back_per_column(join_form, spark):
    left = spark.createDataFrame([("e1", "a1"), ("e2", "a1"), (None, "a2"), ("e3", None)], "ean string, art string")
    by_ean = spark.createDataFrame([("e1", 1, None), ("e3", 3, 30)], "e string, num int, den int")
    by_art = spark.createDataFrame([("a1", 7, 70), ("a2", None, 80)], "a string, num int, den int")
    out = lookups.priority_lookup(left, [(by_ean, [("ean", "e")]), (by_art, [("art", "a")])], ["num", "den"])
    assert rows(out) == sorted(
        [("e1", "a1", 1, 70), ("e2", "a1", 7, 70), (None, "a2", None, 80), ("e3", None, 3, 30)], key=str
    )


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", None), ("b", 2), (None, 5)], "k string, v int")
    top = ranking.latest_per_key(df, ["k"], [F.desc_nulls_last("v")], rank="rn")
    assert rows(top) == sorted([("a", 3, 1), ("b", 2, 1), (None, 5, 1)], key=str)
    assert rows(ranking.latest_per_key(df, ["k"], [F.asc_nulls_first("v")])) == sorted([("a", None), ("b", 2), (None, 5)], key=str)
    people = spark.createDataFrame([(None, "o", 1), ("o", "x", 1), ("n", None, 2)], "name string, owner string, c int")
    assert rows(ranking.distinct_entities(people, ["name", "c"], {"name": "owner"})) == [("n", 2), ("o", 1)]


def test_convert_quantity(join_form, spark):
    sales = spark.createDataFrame(
        [(1, "w", "KAR", "17", "555", 10.0), (2, "w", "KAR", "17", None, 10.0), (3, "w", "KAR", "0018", "0", 4.0),
         (4, "w", "???", "17", None, 1.0), (5, "v", "KAR", "17", "666", 2.0), (6, "w", "KG", "99", "777", 3.0)],
        "id int, wholesaler_name string, UOM string, article string, EAN string, total_amount double",
    )
    units = quantity.unit_map(
        spark.createDataFrame([("w", "KAR", "karton"), ("w", "KG", "kilo"), ("w", "KG", "kilo")],
                              "wholesaler_name string, uom string, converted_uom string"),
        spark.createDataFrame([("karton", "EN", "CS"), ("karton", "NL", "XX"), ("kilo", "NL", "KG")],
                              "converted_uom string, language string, muom_unit_id string"),
    )
    factors = spark.createDataFrame(
        [("0017", "CS", 2.0, 1.0, None), ("18", "CS", 5.0, 0.0, None), ("0042", "KG", 3.0, 2.0, "00555"),
         ("43", "KG", 9.0, 1.0, "555"), ("44", "KG", 7.0, None, "666")],
        "muom_material_id string, muom_unit_id string, muom_numerator_qty double, muom_denominator_qty double, muom_eanupc_id string",
    )
    out = quantity.convert_quantity(sales, factors, units, "article")
    found = {r.id: (r.article, r.muom_unit_id, r.KgL) for r in out.collect()}
    assert found == {
        1: ("42", "CS", 15.0),     # the EAN row wins, the first of two, and names the material
        2: ("17", "CS", 20.0),     # article and unit
        3: ("0018", "CS", None),   # denominator 0
        4: ("17", None, None),     # unknown unit
        5: ("44", None, None),     # EAN row without denominator
        6: ("99", None, None),     # unit text in another language only
    }


def test_plans_of_lookups(spark):
    """A small dimension is broadcast, top-1 is pruned before the shuffle, scans read what is used."""
    folder = "/root/testdata/sf0.01"
    lines, parts = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "part"))
    out = lookups.lookup(lines.select("l_partkey", "l_quantity"), parts, [("l_partkey", "p_partkey")], ["p_size"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
    top = ranking.latest_per_key(lines, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey")])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_null_keys_are_dealt_over_the_tasks(spark):
    """Rows whose key is null find nothing, and do not meet in one task."""
    left = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("int")).alias("key"), F.lit(None).cast("string").alias("more"))
    right = spark.range(0, 4000, 20).select(F.col("id").alias("key_id"), (F.col("id") + 1).alias("found"))
    with conf(spark, **NO_BROADCAST, **{"adaptive.coalescePartitions.enabled": "false"}):
        out = lookups.lookup(left, right, [("key", "key_id")], ["found"])
        rows_by_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert out.filter("found IS NOT NULL").agg(F.count("*"), F.sum(F.col("found") - F.col("id"))).first()[:] == (200, 200)
        both = lookups.join_all(left, right, [("key", "key_id"), ("more", F.lit("x"))], ["found"])
        assert both.filter("found IS NULL").count() == 4000
    assert sum(rows_by_task) == 4000 and max(rows_by_task) < 1000
