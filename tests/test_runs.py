"""End-to-end runs: the three mandatory executions, replay, quality
statuses and the reference/default watermark rules."""

import datetime as dt
import itertools

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.config import CollectionConfig, RunConfig
from ingot.operators.control import ControlLog
from ingot.operators.merge import read_table
from ingot.plans.bronze import landing_to_bronze, process_collection, replay_from_watermark, run_all

T0 = dt.datetime(2024, 1, 1)


def clock():
    c = itertools.count()
    return lambda: dt.datetime(2024, 2, 1) + dt.timedelta(minutes=next(c))


def _src(spark, rows):
    return spark.createDataFrame(rows, "_id string, lastupdated timestamp_ntz, v int")


def _rows(n, start=0):
    return [(f"k{i:04d}", T0 + dt.timedelta(hours=i), i) for i in range(start, start + n)]


def _cfg(ws, mode="incremental", rule="default", **kw):
    c = CollectionConfig("movies", mode, "_id", "lastupdated", "date", **kw)
    return RunConfig(base_dir=ws, collections=(c,), batch_size=7, watermark_rule=rule), c


def test_three_mandatory_executions(spark, ws):
    cfg, coll = _cfg(ws)
    control = ControlLog(spark, cfg.control_path)
    ck = clock()
    r1 = process_collection(spark, cfg, coll, _src(spark, _rows(20)), control, clock=ck)
    r2 = process_collection(spark, cfg, coll, _src(spark, _rows(20)), control, clock=ck)
    r3 = process_collection(spark, cfg, coll, _src(spark, _rows(22)), control, clock=ck)
    assert (r1["qtd_lida_origem"], r1["qtd_gravada_destino"], r1["status"]) == (20, 20, "SUCCESS")
    assert (r2["qtd_lida_origem"], r2["qtd_gravada_destino"], r2["status"]) == (0, 0, "SUCCESS")
    assert (r3["qtd_lida_origem"], r3["qtd_gravada_destino"], r3["status"]) == (2, 2, "SUCCESS")
    assert r2["watermark_final"] == r1["watermark_final"] == "2024-01-01T19:00:00.000000"
    bronze = read_table(spark, f"{cfg.bronze_dir}/movies")
    assert bronze.count() == 22 and bronze.select("_source_id").distinct().count() == 22
    assert control.read().count() == 3


def test_landing_pages_bounded(spark, ws):
    cfg, coll = _cfg(ws, mode="full")
    control = ControlLog(spark, cfg.control_path)
    process_collection(spark, cfg, coll, _src(spark, _rows(30)), control, run_id="run1", clock=clock())
    files = spark.read.text(f"{cfg.landing_dir}/movies/run1").select(
        F.input_file_name().alias("f"), F.get_json_object("value", "$._id").alias("k"))
    per = files.groupBy("f").agg(F.count("k").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")) \
        .orderBy("lo").collect()
    assert all(r["n"] <= 7 for r in per) and sum(r["n"] for r in per) == 30
    assert all(a["hi"] < b["lo"] for a, b in zip(per, per[1:]))  # disjoint, ordered key ranges


def test_replay_brings_back_exactly_the_deleted_row(spark, ws):
    cfg, coll = _cfg(ws)
    src = _src(spark, _rows(10))
    ck = clock()
    process_collection(spark, cfg, coll, src, ControlLog(spark, cfg.control_path), clock=ck)
    keys = spark.createDataFrame([("k0009",)], "_source_id string")
    rec = replay_from_watermark(spark, cfg, coll, src, keys, "2024-01-01T05:00:00", ck)
    assert (rec["qtd_lida_origem"], rec["qtd_gravada_destino"]) == (4, 1)
    assert read_table(spark, f"{cfg.bronze_dir}/movies").count() == 10


def test_stuck_window_reference_vs_default(spark, ws):
    rows = _rows(5) + [(None, T0 + dt.timedelta(hours=2, minutes=30), 99)]
    for rule, expect_status in (("reference", "PARTIAL"), ("default", "SUCCESS")):
        cfg, coll = _cfg(f"{ws}/{rule}", rule=rule)
        control = ControlLog(spark, cfg.control_path)
        ck = clock()
        recs = [process_collection(spark, cfg, coll, _src(spark, rows), control, clock=ck) for _ in range(3)]
        bronze = read_table(spark, f"{cfg.bronze_dir}/movies")
        nulls = bronze.where(F.col("_source_id").isNull()).count()
        assert [r["status"] for r in recs] == [expect_status] * 3
        if rule == "reference":
            # watermark never moves, the window is re-read and the NULL row re-inserted each time
            assert [r["qtd_lida_origem"] for r in recs] == [6, 6, 6] and nulls == 3
        else:
            assert [r["qtd_lida_origem"] for r in recs] == [6, 0, 0] and nulls == 0
            assert "quarantined_null_ids=1" in recs[0]["mensagem_erro"]
            assert spark.read.parquet(f"{cfg.quarantine_dir}/movies").count() == 1


def test_duplicates_in_batch_reported(spark, ws):
    cfg, coll = _cfg(ws, mode="full", rule="reference")
    rows = _rows(3) + [("k0001", T0, 5)]
    rec = process_collection(spark, cfg, coll, _src(spark, rows), ControlLog(spark, cfg.control_path), clock=clock())
    assert rec["status"] == "PARTIAL" and "duplicados_no_lote=1" in rec["mensagem_erro"]
    assert rec["qtd_gravada_destino"] == 4


def test_failure_isolated_and_message_cut(spark, ws):
    good = CollectionConfig("good", "full", "_id")
    bad = CollectionConfig("bad", "incremental", "_id", "missing_field", None)
    cfg = RunConfig(base_dir=ws, collections=(bad, good))
    src = _src(spark, _rows(3))
    out = {r["collection"]: r for r in run_all(spark, cfg, {"bad": src, "good": src}, clock()).collect()}
    assert out["bad"]["status"] == "FAILED" and len(out["bad"]["mensagem_erro"]) <= 1000
    assert out["good"]["status"] == "SUCCESS" and out["good"]["qtd_gravada_destino"] == 3


def test_unknown_mode_rejected():
    import pytest
    with pytest.raises(ValueError):
        CollectionConfig("x", "weekly").validate()


def test_no_landing_paths_is_zero_and_table_untouched(spark, ws):
    res = landing_to_bronze(spark, [], "c", "_id", "r", "full", f"{ws}/bronze/c")
    assert (res.rows_read, res.rows_written) == (0, 0)


def test_parallel_run_all_matches_sequential(spark, ws):
    colls = tuple(CollectionConfig(n, "full", "_id") for n in ("a", "b", "c"))
    src = _src(spark, _rows(12))
    seq = run_all(spark, RunConfig(base_dir=f"{ws}/s", collections=colls), {n: src for n in "abc"}, clock())
    par = run_all(spark, RunConfig(base_dir=f"{ws}/p", collections=colls), {n: src for n in "abc"}, clock(),
                  parallelism=3)
    pick = lambda df: [(r.collection, r.status, r.qtd_gravada_destino) for r in df.collect()]
    assert pick(seq) == pick(par) == [(n, "SUCCESS", 12) for n in "abc"]


def test_compressed_unordered_landing_loads_the_same(spark, ws):
    c = CollectionConfig("movies", "full", "_id")
    cfg = RunConfig(base_dir=ws, collections=(c,), batch_size=5, ordered_pages=False, landing_compression="gzip")
    rec = process_collection(spark, cfg, c, _src(spark, _rows(17)), ControlLog(spark, cfg.control_path),
                             run_id="gz", clock=clock())
    assert (rec["qtd_lida_origem"], rec["qtd_gravada_destino"]) == (17, 17)
    import os
    names = os.listdir(f"{cfg.landing_dir}/movies/gz".replace("file:", ""))
    assert any(n.endswith(".json.gz") for n in names)


def test_summary_report_sorted(spark):
    from ingot.plans.relational import summary_report
    df = spark.createDataFrame([("b", "OK"), ("a", "SKIP"), ("a", "OK")], "table_name string, status string")
    assert [tuple(r) for r in summary_report(df).collect()] == [("a", "OK"), ("b", "OK"), ("a", "SKIP")]


def test_load_config_projection_becomes_exclusion():
    from ingot.config import load_config
    cfg = load_config('''{"batch_size": 500, "reconciliation_threshold_pct_default": 1.0,
      "collections": [{"name": "users", "mode": "full", "projection": {"password": 0},
                       "reconciliation_threshold_pct": 0.0},
                      {"name": "movies", "mode": "incremental", "watermark_field": "lastupdated",
                       "watermark_type": "string"}]}''', base_dir="/x")
    users, movies = cfg.collections
    assert users.exclude == ("password",) and cfg.threshold_for(users) == 0.0
    assert cfg.threshold_for(movies) == 1.0 and cfg.batch_size == 500


def test_stream_second_run_sees_only_new_files_third_sees_none(spark, ws):
    from ingot.streaming.file_ingest import ingest_available
    from conftest import write_lines
    schema = StructType.fromDDL("_id string, v int")
    write_lines(f"{ws}/landing", ['{"_id":"1","v":1}', '{"_id":"2","v":2}'], "a.jsonl")
    args = (spark, f"{ws}/landing", schema, f"{ws}/bronze", f"{ws}/ckpt", "_id")
    assert ingest_available(*args) == 2
    write_lines(f"{ws}/landing", ['{"_id":"2","v":20}', '{"_id":"3","v":"bad"}'], "b.jsonl")
    assert ingest_available(*args) == 1
    assert ingest_available(*args) == 0
    rows = {r._id: r for r in read_table(spark, f"{ws}/bronze").collect()}
    assert rows["2"].v == 2 and rows["3"].v is None and '"v":"bad"' in rows["3"]._rescued_data


def test_dedup_batch_keeps_latest_duplicate(spark, ws):
    c = CollectionConfig("movies", "full", "_id", "lastupdated", "date")
    cfg = RunConfig(base_dir=ws, collections=(c,), dedup_batch=True)
    rows = _rows(3) + [("k0001", T0 + dt.timedelta(days=5), 77)]
    rec = process_collection(spark, cfg, c, _src(spark, rows), ControlLog(spark, cfg.control_path), clock=clock())
    assert rec["qtd_gravada_destino"] == 3 and "duplicates_in_batch=1" in rec["mensagem_erro"]
    got = {r._id: r.v for r in read_table(spark, f"{cfg.bronze_dir}/movies").collect()}
    assert got == {"k0000": 0, "k0001": 77, "k0002": 2}


def test_parallel_relational_landing_and_consolidation(spark, ws):
    from ingot.plans.relational import consolidate, land_tables
    at = dt.datetime(2026, 8, 1, 9, 0, tzinfo=dt.timezone.utc)
    tables = {f"t{i}": spark.createDataFrame([(j, f"v{j}") for j in range(i + 1)], "id int, v string")
              for i in range(4)}
    m = land_tables(spark, tables, f"{ws}/landing", "r", at, parallelism=4).collect()
    assert sorted((r.source_table, r.status, r.row_count) for r in m) == [(f"t{i}", "OK", i + 1) for i in range(4)]
    s = consolidate(spark, f"{ws}/landing", list(tables), at.date(), at.date(), f"{ws}/bronze",
                    {t: ["id"] for t in tables}, parallelism=4).collect()
    assert sorted((r.table_name, r.status, r.linhas_bronze) for r in s) == [(f"t{i}", "OK", i + 1) for i in range(4)]


def test_reference_watermark_comes_from_inserted_rows(spark, ws):
    """Q3: rows read but already in bronze do not move the reference
    watermark; the default rule takes the max over rows read."""
    for rule, expected in (("reference", "2024-01-01T04:00:00.000000"), ("default", "2024-01-01T09:00:00.000000")):
        cfg, coll = _cfg(f"{ws}/{rule}", rule=rule)
        control = ControlLog(spark, cfg.control_path)
        ck = clock()
        process_collection(spark, cfg, coll, _src(spark, _rows(5)), control, clock=ck)
        # same keys re-delivered with newer times: read, but not inserted
        later = [(k, t + dt.timedelta(hours=5), v) for k, t, v in _rows(5)]
        rec = process_collection(spark, cfg, coll, _src(spark, later), control, clock=ck)
        assert rec["qtd_gravada_destino"] == 0
        assert rec["watermark_final"] == expected, rule


def test_numeric_watermark_compares_as_numbers(spark, ws):
    c = CollectionConfig("versions", "incremental", "_id", "ver", None)
    cfg = RunConfig(base_dir=ws, collections=(c,))
    control = ControlLog(spark, cfg.control_path)
    ck = clock()
    src = lambda n: spark.createDataFrame([(f"k{i}", i) for i in range(n)] + [("nover", None)],
                                          "_id string, ver long")
    r1 = process_collection(spark, cfg, c, src(11), control, clock=ck)
    assert (r1["status"], r1["qtd_lida_origem"], r1["watermark_final"]) == ("SUCCESS", 11, "10")
    r2 = process_collection(spark, cfg, c, src(13), control, clock=ck)
    assert (r2["qtd_lida_origem"], r2["qtd_gravada_destino"], r2["watermark_final"]) == (2, 2, "12")


def test_command_line_runs_configured_collections(spark, ws, capsys):
    import json
    from ingot.__main__ import main
    _src(spark, _rows(4)).write.parquet(f"{ws}/src/movies")
    cfg_path = f"{ws}/cfg.json".replace("file:", "")
    with open(cfg_path, "w") as fh:
        json.dump({"collections": [{"name": "movies", "mode": "incremental", "watermark_field": "lastupdated",
                                    "watermark_type": "date"},
                                   {"name": "missing", "mode": "full"}]}, fh)
    code = main(["--config", cfg_path, "--base-dir", f"{ws}/run", "--source", f"movies={ws}/src/movies"], spark)
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert code == 1   # the collection without a source FAILED
    got = {r["collection"]: (r["status"], r["qtd_gravada_destino"]) for r in out}
    assert got == {"movies": ("SUCCESS", 4), "missing": ("FAILED", 0)}


def test_a_value_that_is_no_time_never_becomes_the_watermark(spark, ws):
    cfg, coll = _cfg(ws)
    control = ControlLog(spark, cfg.control_path)
    ck = clock()
    text = "_id string, lastupdated string, v int"
    first = [("a", "2024-01-05T00:00:00", 1), ("b", "n/a", 2), ("c", "2024-01-05 00:00:00.5", 3)]
    r = process_collection(spark, cfg, coll, spark.createDataFrame(first, text), control, clock=ck)
    assert r["watermark_final"] == "2024-01-05 00:00:00.5" and r["status"] == "SUCCESS"
    assert "unreadable_watermarks=1" in r["mensagem_erro"]
    later = first + [("d", "2024-06-01T00:00:00", 4)]
    r = process_collection(spark, cfg, coll, spark.createDataFrame(later, text), control, clock=ck)
    assert r["qtd_gravada_destino"] == 1 and r["watermark_final"] == "2024-06-01T00:00:00"


def test_quarantine_is_not_filled_twice(spark, ws):
    cfg, coll = _cfg(ws, mode="full")
    control = ControlLog(spark, cfg.control_path)
    rows = [("a", T0, 1), (None, T0, 2)]
    for _ in range(2):
        process_collection(spark, cfg, coll, _src(spark, rows), control, clock=clock())
    assert read_table(spark, f"{cfg.quarantine_dir}/movies").count() == 1


def test_a_source_that_fails_to_load_is_logged(spark, ws):
    cfg, _ = _cfg(ws)

    def broken():
        raise RuntimeError("no such collection")

    run_all(spark, cfg, {"movies": broken}, clock=clock())
    logged = ControlLog(spark, cfg.control_path).read().collect()
    assert [(r.status, r.mensagem_erro) for r in logged] == [("FAILED", "no such collection")]
