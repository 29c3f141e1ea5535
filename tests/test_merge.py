import datetime as dt

import pytest

from pyspark.sql import functions as F

from ingot.operators.lineage import add_lineage
from ingot.operators.merge import (delete_keys, insert_only_merge, latest_per_key, latest_per_key_window,
                                   read_table, row_hash)

NOW = dt.datetime(2024, 2, 1)


def _batch(spark, rows, run="r1", ddl="_id string, v int"):
    return add_lineage(spark.createDataFrame(rows, ddl), "_id", run, "full", NOW)


def test_insert_only_keeps_matched_rows_untouched(spark, ws):
    t = f"{ws}/t"
    assert insert_only_merge(spark, _batch(spark, [("1", 1), ("2", 2)]), t) == 2
    assert insert_only_merge(spark, _batch(spark, [("2", 20), ("3", 30)], "r2"), t) == 1
    got = {r["_id"]: r["v"] for r in read_table(spark, t).collect()}
    assert got == {"1": 1, "2": 2, "3": 30}


def test_null_keys_never_match_and_batch_duplicates_all_inserted_once(spark, ws):
    t = f"{ws}/t"
    b = [(None, 1), ("d", 2), ("d", 3)]
    assert insert_only_merge(spark, _batch(spark, b), t) == 3
    assert insert_only_merge(spark, _batch(spark, b, "r2"), t) == 1  # only the NULL key again
    assert read_table(spark, t).where(F.col("_source_id") == "d").count() == 2


def test_run_twice_equals_run_once(spark, ws):
    t = f"{ws}/t"
    rows = [(str(i), i) for i in range(50)]
    insert_only_merge(spark, _batch(spark, rows), t)
    assert insert_only_merge(spark, _batch(spark, rows, "r2"), t) == 0
    assert read_table(spark, t).count() == 50


def test_schema_evolution_and_type_change_rescued(spark, ws):
    t = f"{ws}/t"
    insert_only_merge(spark, _batch(spark, [("1", 1)]), t)
    b2 = _batch(spark, [("2", "x", "new"), ("3", "7", None)], "r2", "_id string, v string, extra string")
    assert insert_only_merge(spark, b2, t) == 2
    got = {r["_id"]: r for r in read_table(spark, t).collect()}
    assert got["2"]["v"] is None and '"v":"x"' in got["2"]["_rescued_data"]
    assert got["3"]["v"] == 7 and got["2"]["extra"] == "new"
    assert got["1"]["extra"] is None


def test_delete_keys_rewrites_only_affected_partition(spark, ws):
    t = f"{ws}/t"
    insert_only_merge(spark, _batch(spark, [("1", 1), ("2", 2)]), t)
    keys = spark.createDataFrame([("1",)], "_source_id string")
    assert delete_keys(spark, t, keys) == 1
    assert [r["_id"] for r in read_table(spark, t).collect()] == ["2"]


def test_latest_per_key_is_deterministic_under_ties_and_groups_nulls(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), (None, 5, "p"), (None, 6, "q")],
                               "k string, ts int, payload string")
    got = {r["k"]: (r["ts"], r["payload"]) for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {"a": (1, "y"), None: (6, "q")}
    win = {r["k"]: (r["ts"], r["payload"]) for r in latest_per_key_window(df, ["k"], ["ts"]).collect()}
    assert win == got


def test_latest_per_key_with_map_and_variant_payload_keeps_aggregate_plan(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"y": 2})], "k string, ts int, m map<string,int>") \
        .withColumn("v", F.parse_json(F.to_json(F.struct("ts"))))
    out = latest_per_key(df, ["k"], ["ts"])
    r = out.first()
    assert r["m"] == {"y": 2} and F is not None and out.select(F.to_json("v")).first()[0] == '{"ts":2}'
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan
    intkeys = spark.createDataFrame([("a", 1, {1: 1}), ("a", 2, {2: 2})], "k string, ts int, m map<int,int>")
    assert latest_per_key(intkeys, ["k"], ["ts"]).first()["m"] == {2: 2}   # window fallback


def test_row_hash_distinguishes_null_positions(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    h = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert h[0] != h[1]


def test_ensure_table_bootstraps_once(spark, ws):
    from pyspark.sql.types import StructType
    from ingot.operators.merge import ensure_table, refresh_table
    schema = StructType.fromDDL("_source_id string, v int, _ingestion_date date")
    assert ensure_table(spark, "bronze_boot", f"{ws}/boot", schema) is True
    assert ensure_table(spark, "bronze_boot", f"{ws}/boot", schema) is False
    assert spark.table("bronze_boot").count() == 0
    insert_only_merge(spark, _batch(spark, [("1", 1)]), f"{ws}/boot")
    refresh_table(spark, "bronze_boot")
    assert spark.table("bronze_boot").count() == 1


def test_stored_schema_tracks_evolution(spark, ws):
    from ingot.operators.merge import stored_schema
    t = f"{ws}/t"
    insert_only_merge(spark, _batch(spark, [("1", 1)]), t)
    assert "extra" not in stored_schema(spark, t).fieldNames()
    insert_only_merge(spark, _batch(spark, [("2", 2, "e")], "r2", "_id string, v int, extra string"), t)
    schema = stored_schema(spark, t)
    assert schema.fieldNames()[:2] == ["_id", "v"] and "extra" in schema.fieldNames()
    assert read_table(spark, t).where(F.col("extra") == "e").count() == 1


def test_merge_reads_the_batch_once(spark, ws):
    from ingot.operators.merge import insert_only_rows
    old = spark.createDataFrame([("k1", 1), ("k2", 2)], "_source_id string, v int")
    old.write.parquet(f"{ws}/old")
    spark.createDataFrame([("k2", 9), (None, 8), ("k3", 7)], "_source_id string, v int").write.parquet(f"{ws}/new")
    rows = insert_only_rows(spark.read.parquet(f"{ws}/new"), spark.read.parquet(f"{ws}/old"), key_range=("k2", "k3"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in rows.collect()) == [7, 8]
    assert plan.count("FileScan") == 2 and "GreaterThanOrEqual(_source_id,k2)" in plan


def test_latest_per_key_group_rows_both_plans(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"y": 2}), ("b", 5, {"z": 0})],
                               "k string, ts int, m map<string,int>")
    win = {r.k: (r.ts, r.n) for r in latest_per_key(df, ["k"], ["ts"], group_rows="n").collect()}
    agg = {r.k: (r.ts, r.n) for r in latest_per_key(df.drop("m"), ["k"], ["ts"], group_rows="n").collect()}
    assert win == agg == {"a": (2, 2), "b": (5, 1)}


def test_compact_partitions_keeps_rows(spark, ws):
    import os
    from ingot.operators.merge import compact_partitions
    t = f"{ws}/t"
    for i in range(4):
        insert_only_merge(spark, _batch(spark, [(f"k{i}-{j}", j) for j in range(5)], f"r{i}"), t)
    part = f"{t}/_ingestion_date=2024-02-01".replace("file:", "")
    before = [f for f in os.listdir(part) if f.endswith(".parquet")]
    rows_before = sorted(tuple(r) for r in read_table(spark, t).select("_id", "v").collect())
    assert compact_partitions(spark, t, ["2024-02-01"]) == 1 < len(before)
    assert sorted(tuple(r) for r in read_table(spark, t).select("_id", "v").collect()) == rows_before
    assert not [n for n in os.listdir(t.replace("file:", "")) if n.startswith(("_staging", "_replaced"))]


def test_overwrite_snapshot_can_rebuild_from_itself(spark, ws):
    import os
    from ingot.operators.merge import overwrite_snapshot
    t = f"{ws}/snap"
    overwrite_snapshot(spark.createDataFrame([(1,), (2,), (2,)], "x int"), t)
    overwrite_snapshot(spark.read.parquet(t).distinct(), t)   # reads the path it replaces
    assert sorted(r.x for r in spark.read.parquet(t).collect()) == [1, 2]
    assert sorted(os.listdir(ws.replace("file:", ""))) == ["snap"]


def test_row_hash_does_not_collide(spark):
    df = spark.createDataFrame([("a#b", "c"), ("a", "b#c"), (None, "x"), ("\\N", "x")], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 4


@pytest.mark.parametrize("fail_at", [1, 2])
def test_a_failed_swap_leaves_the_old_table(spark, ws, monkeypatch, fail_at):
    from ingot.operators import merge
    spark.range(3).write.parquet(f"{ws}/t")
    real, calls = merge._move, []

    def move(fs, src, dst):
        calls.append(dst)
        if len(calls) == fail_at:
            raise OSError("no rename")
        real(fs, src, dst)

    monkeypatch.setattr(merge, "_move", move)
    with pytest.raises(OSError):
        merge.overwrite_snapshot(spark.range(9), f"{ws}/t")
    assert spark.read.parquet(f"{ws}/t").count() == 3


def test_a_crash_between_the_renames_can_be_undone(spark, ws):
    from ingot.operators import merge
    spark.range(3).withColumn("d", F.lit("x")).write.partitionBy("d").parquet(f"{ws}/t")
    p, fs = merge._fs_path(spark, f"{ws}/t/d=x")
    aside, _ = merge._fs_path(spark, f"{ws}/t/_replaced/x")
    fs.mkdirs(aside.getParent())
    merge._move(fs, p, aside)
    spark.range(1).withColumn("d", F.lit("y")).write.mode("append").partitionBy("d").parquet(f"{ws}/t")
    assert spark.read.parquet(f"{ws}/t").count() == 1      # hidden from readers
    assert merge.restore_partitions(spark, f"{ws}/t", "d") == 1
    assert spark.read.parquet(f"{ws}/t").count() == 4


def test_a_cut_off_schema_file_is_not_an_error(spark, ws):
    from ingot.operators import merge
    spark.range(3).write.parquet(f"{ws}/t")
    open(f"{ws}/t/_schema.json", "w").close()
    assert read_table(spark, f"{ws}/t").count() == 3
    merge.store_schema(spark, f"{ws}/t", spark.range(1).schema)
    assert merge.stored_schema(spark, f"{ws}/t") == spark.range(1).schema
