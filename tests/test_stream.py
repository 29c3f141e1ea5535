"""The file stream: epochs applied once, schema versions, quarantine and
control rows."""

import datetime as dt
import os

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import write_lines
from ingot.operators.control import ControlLog
from ingot.operators.merge import read_table
from ingot.streaming import file_ingest
from ingot.streaming.file_ingest import ingest_available, query_id, state_dir
from ingot.streaming.ledger import EpochLedger, SchemaLog

SCHEMA = StructType([StructField("_id", StringType()), StructField("v", IntegerType())])
LINES = ['{"_id":"1","v":1}', '{"_id":"2","v":2}', '{"_id":null,"v":3}', '{"v":4}', '{"v":4}']
NOW = dt.datetime(2024, 2, 1)


def local(path):
    return path.replace("file://", "").replace("file:", "")


def uncommit(checkpoint, epoch=0):
    """As if the query had stopped before the checkpoint's commit."""
    for name in (f"{epoch}", f".{epoch}.crc"):
        p = f"{local(checkpoint)}/commits/{name}"
        if os.path.exists(p):
            os.remove(p)


def run(spark, ws, control=None, schema=SCHEMA, **kw):
    return ingest_available(spark, f"{ws}/landing", schema, f"{ws}/bronze", f"{ws}/ckpt", "_id", now=NOW,
                            control=control, collection="movies", **kw)


def state(spark, ws):
    bronze = sorted((r._id, r.v) for r in read_table(spark, f"{ws}/bronze").collect())
    held = sorted(r.v for r in read_table(spark, f"{ws}/bronze_quarantine").collect())
    return bronze, held


@pytest.mark.parametrize("lost", ["commit", "commit and done", "all of the ledger"])
def test_an_epoch_that_comes_again_adds_nothing(spark, ws, lost):
    control = ControlLog(spark, f"{ws}/control")
    write_lines(local(f"{ws}/landing"), LINES, "a.jsonl")
    assert run(spark, ws, control) == 2
    want = state(spark, ws)
    assert want == ([("1", 1), ("2", 2)], [3, 4, 4])
    uncommit(f"{ws}/ckpt")
    folder = f"{local(state_dir(f'{ws}/ckpt'))}/epochs/{query_id(spark, f'{ws}/ckpt')}"
    if lost != "commit":
        os.remove(f"{folder}/{0:012d}.done")
    if lost.startswith("all"):
        os.remove(f"{folder}/{0:012d}.begun")
    assert run(spark, ws, control) == 0
    assert state(spark, ws) == want
    rows = control.read().collect()
    expected = 2 if lost.startswith("all") else 1     # without its ledger the attempt is a run of its own
    assert len(rows) == expected
    assert (rows[0].qtd_lida_origem, rows[0].status) == (5, "SUCCESS")
    assert "quarantined_null_ids=3" in rows[0].mensagem_erro


def test_a_stop_between_merge_and_control_row_keeps_the_counts(spark, ws, monkeypatch):
    control = ControlLog(spark, f"{ws}/control")
    write_lines(local(f"{ws}/landing"), LINES, "a.jsonl")

    class Stopped(ControlLog):
        def log(self, records):
            raise RuntimeError("executor of the driver is gone")

    with pytest.raises(Exception, match="gone"):
        run(spark, ws, Stopped(spark, f"{ws}/control"))
    before = state(spark, ws)
    assert control.read().count() == 0
    run(spark, ws, control)
    assert state(spark, ws) == before
    rows = control.read().collect()
    assert [(r.qtd_lida_origem, r.qtd_gravada_destino) for r in rows] == [(5, 2)]


def test_a_new_checkpoint_is_a_new_query(spark, ws):
    write_lines(local(f"{ws}/landing"), LINES, "a.jsonl")
    run(spark, ws)
    first = query_id(spark, f"{ws}/ckpt")
    assert ingest_available(spark, f"{ws}/landing", SCHEMA, f"{ws}/bronze", f"{ws}/ckpt2", "_id", now=NOW) == 0
    assert query_id(spark, f"{ws}/ckpt2") != first
    assert state(spark, ws) == ([("1", 1), ("2", 2)], [3, 4, 4])


def test_schema_versions_grow_and_old_rows_stay_readable(spark, ws):
    write_lines(local(f"{ws}/landing"), ['{"_id":"1","d":{"x":1}}'], "a.jsonl")
    run(spark, ws, schema=None)
    write_lines(local(f"{ws}/landing"), ['{"_id":"2","d":{"x":2,"y":"new"},"l":[{"z":1}]}'], "b.jsonl")
    run(spark, ws, schema=None)
    run(spark, ws, schema=StructType.fromDDL("_id string"))      # adds nothing: no version
    log = SchemaLog(spark, state_dir(f"{ws}/ckpt"))
    assert log.versions() == [1, 2]
    assert log.read(1).simpleString() == "struct<_id:string,d:struct<x:bigint>>"
    assert log.current()[1].simpleString() == "struct<_id:string,d:struct<x:bigint,y:string>,l:array<struct<z:bigint>>>"
    rows = {r._id: r for r in read_table(spark, f"{ws}/bronze").collect()}
    assert rows["1"].d.asDict() == {"x": 1, "y": None} and rows["2"].d.asDict() == {"x": 2, "y": "new"}
    assert rows["1"].l is None and rows["2"].l[0].z == 1 and rows["2"]._rescued_data is None


def test_ledger_states_and_pruning(spark, ws, monkeypatch):
    from ingot.streaming import ledger as module
    monkeypatch.setattr(module, "KEEP_EPOCHS", 2)
    ledger = EpochLedger(spark, ws, "q")
    assert not ledger.is_done(0) and ledger.result(0) is None
    assert ledger.begin(0, {"run_id": "a"}) == ({"run_id": "a"}, False)
    assert ledger.begin(0, {"run_id": "b"}) == ({"run_id": "a"}, True)
    for e in range(6):
        ledger.finish(e, {"n": e})
    assert [ledger.is_done(e) for e in range(6)] == [False, False, False, True, True, True]
    assert ledger.result(5) == {"n": 5} and not EpochLedger(spark, ws, "other").is_done(5)


def test_stream_into_a_bucketed_table(spark, ws):
    import uuid
    from ingot.operators.bucketed import BucketedTable, read
    t = BucketedTable(f"t_{uuid.uuid4().hex[:8]}", "movies", f"{ws}/bronze", buckets=2)
    write_lines(local(f"{ws}/landing"), LINES, "a.jsonl")
    assert run(spark, ws, table=t) == 2
    write_lines(local(f"{ws}/landing"), ['{"_id":"2","v":9}', '{"_id":"3","v":5}'], "b.jsonl")
    assert run(spark, ws, table=t, max_files_per_trigger=1) == 1
    assert sorted((r._id, r.v) for r in read(spark, t).collect()) == [("1", 1), ("2", 2), ("3", 5)]
    assert file_ingest.state_dir("/a/b/") == "/a/b_state"
