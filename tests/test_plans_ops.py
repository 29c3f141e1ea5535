"""Silver, contract, partitioned writes and relational-path edge cases."""

import datetime as dt
import os

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.operators.landing import write_partitioned
from ingot.operators.lineage import add_lineage
from ingot.operators.merge import insert_only_merge, read_table
from ingot.operators.quality import contract_check, schema_diff, split_quarantine
from ingot.plans.relational import consolidate, land_tables
from ingot.plans.silver import explode_array, flatten, to_silver
from ingot.session import new_workspace
from ingot.sources.documents import raw_documents


def test_flatten_and_explode_outer(spark):
    df = spark.createDataFrame([(1, ("a", (1.5,)), ["x", "y"]), (2, None, [])],
                               "id int, imdb struct<t:string, v:struct<r:double>>, genres array<string>")
    flat = flatten(df)
    assert flat.columns == ["id", "imdb_t", "imdb_v_r", "genres"]
    rows = sorted(tuple(r) for r in explode_array(flat, "genres").collect())
    assert rows == [(1, "a", 1.5, "x"), (1, "a", 1.5, "y"), (2, None, None, None)]


def test_to_silver_keeps_latest_version(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("k", t1, ("old",), ["a"]), ("k", t2, ("new",), ["b", "c"])],
                               "_source_id string, _ingestion_timestamp timestamp, doc struct<v:string>, tags array<string>")
    out = to_silver(df, explode=["tags"]).collect()
    assert sorted((r.doc_v, r.tags) for r in out) == [("new", "b"), ("new", "c")]


def test_schema_diff_and_contract(spark):
    actual = StructType.fromDDL("a int, b string, extra double")
    expected = StructType.fromDDL("a bigint, b string, c date")
    assert sorted(schema_diff(actual, expected)) == sorted([
        ("a", "type", "bigint", "int"), ("c", "missing", "date", None), ("extra", "unexpected", None, "double")])
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    got = {r.rule: r.violations for r in contract_check(df, {"a_set": F.col("a").isNotNull(),
                                                             "b_is_x": F.col("b") == "x"}).collect()}
    assert got == {"a_set": 1, "b_is_x": 2}   # NULL counts as a violation
    ok, bad = split_quarantine(df, F.col("a").isNull())  # condition marks the rows to quarantine
    assert (ok.count(), bad.count()) == (2, 1)


def test_salted_partitioned_write_spreads_hot_day(spark, ws):
    df = spark.range(0, 4000).select(F.lit("2024-01-01").alias("day"), F.col("id"))
    # tiny data: AQE would merge the salted partitions back (at scale they
    # exceed the advisory size and stay apart)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_partitioned(df, ws, "day", salt_key="id", salt_buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(f"{ws}/day=2024-01-01".replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) >= 2
    assert spark.read.parquet(ws).count() == 4000


def test_land_tables_isolates_errors_and_consolidate_skips(spark, ws):
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    bad = spark.createDataFrame([(1,)], "id int").select(F.col("id"), F.col("id").alias("id"))  # duplicate column
    at = dt.datetime(2026, 8, 1, 9, 0, tzinfo=dt.timezone.utc)
    m = {r.source_table: r for r in land_tables(spark, {"good": good, "bad": bad}, f"{ws}/landing", "r1", at).collect()}
    assert m["good"].status == "OK" and m["good"].row_count == 1 and m["good"].file_size_bytes > 0
    assert m["bad"].status == "ERRO" and m["bad"].error
    s = {r.table_name: r for r in consolidate(spark, f"{ws}/landing", ["good", "absent"], at.date(), at.date(),
                                              f"{ws}/bronze", {"good": ["id"]}).collect()}
    assert s["good"].status == "OK" and (s["good"].linhas_lidas, s["good"].linhas_bronze) == (1, 1)
    assert s["absent"].status == "SKIP"


def test_raw_documents_limit(spark):
    src = spark.range(0, 100).withColumnRenamed("id", "_id")
    assert raw_documents(src, "_id", limit=7).count() == 7
    assert raw_documents(src, "_id", condition=F.col("_id") >= 90).count() == 10


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abcdef")), st.integers(0, 9)), min_size=1, max_size=12))
def test_merge_twice_adds_only_null_keys(spark, rows):
    ws = new_workspace(spark, "prop")
    now = dt.datetime(2024, 2, 1)
    batch = add_lineage(spark.createDataFrame(rows, "_id string, v int"), "_id", "r", "full", now)
    first = insert_only_merge(spark, batch, f"{ws}/t")
    second = insert_only_merge(spark, batch, f"{ws}/t")
    assert first == len(rows)
    assert second == sum(1 for k, _ in rows if k is None)
    keys = read_table(spark, f"{ws}/t").where(F.col("_source_id").isNotNull())
    assert keys.count() == sum(1 for k, _ in rows if k is not None)


def test_range_salted_write_spreads_hot_day_without_tuning(spark, ws):
    df = spark.range(0, 4000).select(F.when(F.col("id") < 3000, "2024-01-01").otherwise("2024-01-02").alias("day"),
                                     F.col("id"))
    write_partitioned(df, ws, "day", salt_key="id")
    hot = [f for f in os.listdir(f"{ws}/day=2024-01-01".replace("file:", "")) if f.endswith(".parquet")]
    assert len(hot) >= 2
    assert spark.read.parquet(ws).count() == 4000


def test_partitions_for_grows_with_input(spark):
    from ingot.session import partitions_for
    small = spark.range(10)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(small) == base
    assert partitions_for(small, bytes_per_partition=1) >= base


def test_partitions_grow_with_the_files_of_a_join(spark, ws):
    from ingot.session import estimated_bytes, partitions_for
    spark.range(20000).write.parquet(f"{ws}/a")
    spark.range(20000).withColumnRenamed("id", "k").write.parquet(f"{ws}/b c")
    a, b = spark.read.parquet(f"{ws}/a"), spark.read.parquet(f"{ws}/b c")
    both = a.join(b, a.id == b.k)
    assert estimated_bytes(both) == estimated_bytes(a) + estimated_bytes(b) > 100_000
    assert partitions_for(both, bytes_per_partition=10_000) == -(-estimated_bytes(both) // 10_000) > 10
    assert estimated_bytes(spark.range(5)) == 0
