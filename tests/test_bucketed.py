"""Bronze as a bucketed catalogue table: insert-only merge, evolution at any
depth, delete by key, compaction, recovery of a forgotten catalogue."""

import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.schemas import conform, loses, merge_schemas, merge_types
from ingot.operators import bucketed
from ingot.operators.bucketed import BucketedTable
from ingot.session import path_exists

SCHEMA = "_source_id string, v int, _ingestion_date date"


@pytest.fixture()
def t(spark, ws):
    return BucketedTable(f"t_{uuid.uuid4().hex[:8]}", "movies", f"{ws}/bronze/movies", buckets=4)


def batch(spark, rows, day="2024-02-01"):
    return spark.createDataFrame(rows, "_source_id string, v int").withColumn("_ingestion_date", F.lit(day).cast("date"))


def rows(spark, t):
    return sorted(((r._source_id, r.v) for r in bucketed.read(spark, t).collect()), key=repr)


def test_insert_only_with_duplicates_and_null_keys(spark, t):
    m = bucketed.insert_new(spark, batch(spark, [("a", 1), ("b", 2), ("b", 3), (None, 4)]), t)
    assert (m.written, m.duplicate_groups) == (4, 1)
    m = bucketed.insert_new(spark, batch(spark, [("b", 9), ("c", 5), ("c", 6), (None, 7)], "2024-02-02"), t,
                            observe={"top": F.max("v")})
    assert (m.written, m.duplicate_groups, m.observed) == (3, 1, {"top": 7})
    assert bucketed.insert_new(spark, batch(spark, [("a", 0), (None, 8)]), t, null_keys=False).written == 0
    assert rows(spark, t) == sorted([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5), ("c", 6), (None, 7)], key=repr)


def test_the_target_is_not_shuffled(spark, t):
    bucketed.insert_new(spark, batch(spark, [(f"k{i}", i) for i in range(200)]), t)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = bucketed.batch_keys(batch(spark, [(f"k{i}", i) for i in range(150, 300)]), t)
        df = bucketed.new_keys(spark, keys, t, ("k150", "k299"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == 100
    target_side = plan[plan.index("FileScan parquet"):]
    line = next(x for x in plan.splitlines() if "FileScan parquet" in x)
    assert "Bucketed: true" in line and "PushedFilters" in line and "GreaterThanOrEqual(_source_id" in line
    above = plan.splitlines()[:plan.splitlines().index(line)]
    # from the join down to the scan: sort, filter, project, no exchange
    join = max(i for i, x in enumerate(above) if "SortMergeJoin" in x)
    depth = lambda x: re.search(r"[A-Z*(]", x).start()                               # noqa: E731
    side = []
    for x in reversed(above[join + 1:]):
        if depth(x) <= depth(above[join]) + 3:
            side.append(x)
            break
        side.append(x)
    assert side and not any("Exchange" in x for x in side), plan
    assert target_side


def test_hot_key_and_files_by_bucket(spark, t):
    many = [("hot", i) for i in range(400)] + [(f"k{i}", i) for i in range(200)]
    assert bucketed.insert_new(spark, batch(spark, many).repartition(6), t).written == 600
    assert bucketed.insert_new(spark, batch(spark, many), t).written == 0
    files = {r[0] for r in bucketed.read(spark, t).select(F.input_file_name()).distinct().collect()}
    assert {re.search(r"_(\d{5})\.", f).group(1) for f in files} <= {f"{i:05d}" for i in range(4)}


def test_a_forgotten_catalogue_comes_back_from_the_files(spark, t):
    bucketed.insert_new(spark, batch(spark, [("a", 1)]), t)
    assert bucketed.buckets_of(spark, t) == 4
    spark.sql(f"DROP TABLE {t.name}")
    assert not bucketed.exists(spark, t) and bucketed.buckets_of(spark, t) == 4
    assert bucketed.ensure(spark, t) and rows(spark, t) == [("a", 1)]
    assert bucketed.insert_new(spark, batch(spark, [("a", 2), ("b", 3)]), t).written == 1
    assert not bucketed.ensure(spark, BucketedTable(t.schema, "nothing", f"{t.path}_none"))


def test_delete_rewrites_only_its_partitions_and_keeps_buckets(spark, t):
    bucketed.insert_new(spark, batch(spark, [("a", 1), ("b", 2), (None, 3)], "2024-02-01"), t)
    bucketed.insert_new(spark, batch(spark, [("c", 4)], "2024-02-02"), t)
    bucketed.insert_new(spark, batch(spark, [("d", 5)], "2024-02-03"), t)
    untouched = {r[0] for r in bucketed.read(spark, t).where("_ingestion_date = '2024-02-03'").select(F.input_file_name()).collect()}
    gone = spark.createDataFrame([("b",), ("c",), ("zz",), (None,)], "_source_id string")
    assert bucketed.delete_keys(spark, t, gone) == 2
    assert rows(spark, t) == sorted([("a", 1), (None, 3), ("d", 5)], key=repr)
    assert not path_exists(spark, f"{t.path}/_ingestion_date=2024-02-02")
    assert untouched == {r[0] for r in bucketed.read(spark, t).where("_ingestion_date = '2024-02-03'")
                         .select(F.input_file_name()).collect()}
    assert bucketed.delete_keys(spark, t, gone) == 0
    assert bucketed.insert_new(spark, batch(spark, [("b", 8), ("a", 9)], "2024-02-04"), t).written == 1


def test_compaction_keeps_rows_and_bounds_files(spark, t):
    for i in range(4):
        bucketed.insert_new(spark, batch(spark, [(f"k{i}{j}", j) for j in range(8)]), t)
    want = rows(spark, t)
    assert bucketed.compact(spark, t, ["2024-02-01"]) <= 4
    assert rows(spark, t) == want
    assert bucketed.insert_new(spark, batch(spark, [("k00", 1), ("new", 2)]), t).written == 1


OLD = ("_source_id string, s struct<a:int,deep:struct<x:string>>, l array<struct<n:int>>, m map<string,struct<p:int>>, "
       "_ingestion_date date")
NEW = ("_source_id string, s struct<b:string,a:int,deep:struct<y:int,x:string>>, l array<struct<n:int,extra:double>>, "
       "m map<string,struct<p:int,q:string>>, top string, _ingestion_date date")


def test_fields_grow_at_any_depth(spark, t):
    import datetime as dt
    day = dt.date(2024, 2, 1)
    first = spark.createDataFrame([("a", (1, ("x1",)), [(1,), (2,)], {"k": (5,)}, day), ("n", None, None, None, day)], OLD)
    second = spark.createDataFrame([("b", ("B", 2, (9, "x2")), [(3, 0.5)], {"k": (6, "q")}, "T", day),
                                    ("a", ("late", 7, (1, "z")), [], {}, "T", day)], NEW)
    third = first.select(F.lit("c").alias("_source_id"), *first.columns[1:]).where("s IS NOT NULL")
    for df in (first, second, third):
        bucketed.insert_new(spark, df, t)
    got = {r._source_id: r for r in bucketed.read(spark, t).collect()}
    assert set(got) == {"a", "n", "b", "c"}
    assert got["a"].s.asDict(True) == got["c"].s.asDict(True) == {"a": 1, "deep": {"x": "x1", "y": None}, "b": None}
    assert got["b"].s.asDict(True) == {"a": 2, "deep": {"x": "x2", "y": 9}, "b": "B"}
    assert [x.asDict() for x in got["a"].l] == [{"n": 1, "extra": None}, {"n": 2, "extra": None}]
    assert [x.asDict() for x in got["b"].l] == [{"n": 3, "extra": 0.5}]
    assert got["a"].m["k"].asDict() == {"p": 5, "q": None} and got["b"].m["k"].asDict() == {"p": 6, "q": "q"}
    assert got["n"].s is None and got["a"].top is None and got["b"].top == "T"


def test_values_that_do_not_convert_are_rescued_whole(spark, t):
    import datetime as dt
    day = dt.date(2024, 2, 1)
    bucketed.insert_new(spark, spark.createDataFrame([("a", (1,), None, day)],
                                                     "_source_id string, s struct<a:int>, _rescued_data string, _ingestion_date date"), t)
    odd = spark.createDataFrame([("b", ("7", 1), None, day), ("c", ("x", 2), None, day)],
                                "_source_id string, s struct<a:string,z:int>, _rescued_data string, _ingestion_date date")
    bucketed.insert_new(spark, odd, t)
    got = {r._source_id: r for r in bucketed.read(spark, t).collect()}
    assert got["b"].s.asDict() == {"a": 7, "z": 1} and got["b"]._rescued_data is None
    assert got["c"].s.asDict() == {"a": None, "z": 2} and '\\"a\\":\\"x\\"' in got["c"]._rescued_data


def test_merged_types():
    ddl = T.StructType.fromDDL
    merged = merge_schemas(ddl(OLD), ddl(NEW))
    assert merged.simpleString() == (
        "struct<_source_id:string,s:struct<a:int,deep:struct<x:string,y:int>,b:string>,l:array<struct<n:int,extra:double>>,"
        "m:map<string,struct<p:int,q:string>>,_ingestion_date:date,top:string>")
    assert merge_schemas(merged, ddl(OLD)) == merged == merge_schemas(merged, merged)
    assert merge_types(T.IntegerType(), T.StringType()) == T.IntegerType()
    assert merge_types(T.NullType(), T.StringType()) == T.StringType()
    assert merge_schemas(ddl("Name string"), ddl("name string, b int")).names == ["Name", "b"]
    assert merge_schemas(None, ddl("a int")) == ddl("a int") == merge_schemas(ddl("a int"), None)


def test_conform_and_loses(spark):
    have, want = T.StructType.fromDDL("a string, l array<string>, z int"), T.StructType.fromDDL("l array<int>, a int")
    df = spark.createDataFrame([((("1", ["2", "3"], None),)), ((("x", ["2"], None),)), ((("1", ["y"], None),)), ((("1", None, 4),)),
                                ((None,))], T.StructType([T.StructField("v", have)]))
    got = df.select(conform(F.col("v"), have, want).alias("c"), loses(F.col("v"), have, want).alias("x")).collect()
    assert [r.x for r in got] == [False, True, True, True, False]
    assert got[0].c.asDict() == {"l": [2, 3], "a": 1} and got[4].c is None
