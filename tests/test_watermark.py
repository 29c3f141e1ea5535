import datetime as dt

from pyspark.sql import functions as F

from ingot.operators.control import ControlLog, last_success_watermarks
from ingot.operators.filters import incremental_filter


def _ids(df, cond):
    return sorted(r[0] for r in df.where(cond).select("id").collect())


def test_typed_bound_is_strict_and_pushed_down(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, None)],
                               "id int, ts timestamp_ntz")
    assert _ids(df, incremental_filter(df, "ts", "2024-01-01T00:00:00", "date")) == [2]


def test_text_watermark_compares_as_time_across_separators(spark):
    df = spark.createDataFrame([(1, "2015-08-26 00:03:50.133000000"), (2, "2015-08-26 00:03:50.133000001"),
                                (3, "2015-08-26 09:00:00"), (4, None)], "id int, lastupdated string")
    bound = "2015-08-26T00:03:50.133"
    # same instant is not newer; one nanosecond later is; text order would have said otherwise
    assert _ids(df, incremental_filter(df, "lastupdated", bound, "string")) == [2, 3]


def test_plain_string_watermark(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a")], "id int, w string")
    assert _ids(df, incremental_filter(df, "w", "a", None)) == [1]


def test_last_watermark_ignores_partial_failed_and_full(spark, ws):
    log = ControlLog(spark, f"{ws}/control")
    t = dt.datetime(2024, 1, 1)
    rows = []
    for i, (status, lt, wm) in enumerate([("SUCCESS", "incremental", "w1"), ("PARTIAL", "incremental", "w2"),
                                          ("FAILED", "incremental", "w3"), ("SUCCESS", "full", "w4")]):
        rows.append(dict(_ingestion_id=str(i), collection="c", load_type=lt, watermark_inicial=None,
                         watermark_final=wm, qtd_lida_origem=0, qtd_gravada_destino=0,
                         start_time=t + dt.timedelta(minutes=i), end_time=t + dt.timedelta(minutes=i),
                         duracao_seg=0.0, status=status, mensagem_erro=None))
    log.log(rows)
    assert log.last_watermark("c") == "w1"
    assert log.last_watermark("other") is None
    assert last_success_watermarks(log.read()).count() == 1


def test_control_log_compacts_a_collection_folder(spark, ws):
    import os
    log = ControlLog(spark, f"{ws}/control", compact_after_files=3)
    t = dt.datetime(2024, 1, 1)
    for i in range(5):
        log.log([dict(_ingestion_id=str(i), collection="c", load_type="incremental", watermark_inicial=None,
                      watermark_final=f"w{i}", qtd_lida_origem=i, qtd_gravada_destino=i,
                      start_time=t + dt.timedelta(minutes=i), end_time=t + dt.timedelta(minutes=i),
                      duracao_seg=0.0, status="SUCCESS", mensagem_erro=None)])
    folder = f"{ws}/control/collection=c".replace("file:", "")
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) <= 3
    assert log.read().count() == 5 and log.last_watermark("c") == "w4"
    assert not [n for n in os.listdir(f"{ws}/control".replace("file:", "")) if n.startswith("_")]


def test_control_log_collection_names_round_trip(spark, ws):
    log = ControlLog(spark, f"{ws}/control")
    t = dt.datetime(2024, 1, 1)
    for name in ("a b/c", "x=y%z", "plain"):
        log.log([dict(_ingestion_id=name, collection=name, load_type="incremental", watermark_inicial=None,
                      watermark_final="w-" + name, qtd_lida_origem=1, qtd_gravada_destino=1, start_time=t,
                      end_time=t, duracao_seg=0.0, status="SUCCESS", mensagem_erro=None)])
    assert sorted(r.collection for r in log.read().collect()) == ["a b/c", "plain", "x=y%z"]
    assert log.last_watermark("x=y%z") == "w-x=y%z"
