"""Incremental file ingestion with a checkpoint (M1).

New JSON-line files in the landing folder are picked up by a file
stream; each micro-batch gets lineage and goes through the same load as a
collection run: staged once, rows with a NULL key quarantined, the others
merged insert-only, one control row. ``availableNow`` processes what has
arrived and stops, so the same code serves scheduled runs.
``max_files_per_trigger`` bounds each micro-batch.

A micro-batch that comes again changes nothing (:mod:`ingot.streaming.ledger`):
if it was done it is skipped; if its first attempt stopped midway, its
run id and load time are the same again, keyed rows match, quarantined rows
match by content, and its control row is written once, with the rows of both
attempts. The schema is kept in versions beside the checkpoint.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.config import DEFAULT_THRESHOLD_PCT
from ingot.functions.json import infer_json_schema
from ingot.functions.rescue import parse_json_lines
from ingot.operators.bucketed import BucketedTable
from ingot.operators.control import ControlLog
from ingot.operators.lineage import add_lineage, utc_now
from ingot.operators.quality import reconcile_status
from ingot.plans.bronze import current_bronze, load_rows
from ingot.sources.landing import read_landing_text
from ingot.streaming.ledger import EpochLedger, SchemaLog, read_text


def parsed_stream(spark: SparkSession, landing_dir: str, schema: StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of typed landing rows plus the rescue column."""
    r = spark.readStream.format("text").option("pathGlobFilter", "*.json*")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    text = r.load(landing_dir).where(F.length(F.trim("value")) > 0)
    return parse_json_lines(text, schema, "value", rescue=True)


def state_dir(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_state"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in the checkpoint: the same after every restart."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def apply_epoch(spark: SparkSession, batch: DataFrame, epoch: int, ledger: EpochLedger, collection: str,
                id_field: str, load_type: str, target_path: str, quarantine_path: str,
                table: BucketedTable | None = None, control: ControlLog | None = None,
                schema_version: int | None = None, now: _dt.datetime | None = None,
                clock=utc_now) -> int:
    """One micro-batch, at most once. Returns the rows it put into bronze,
    0 if it was done before."""
    if ledger.is_done(epoch):
        return 0
    start = now or clock()
    begun, again = ledger.begin(epoch, {"run_id": f"stream-{ledger.folder.rsplit('/', 1)[1]}-{epoch}",
                                        "start": start.isoformat(), "schema_version": schema_version})
    run_id, start = begun["run_id"], _dt.datetime.fromisoformat(begun["start"])
    rows = add_lineage(batch, id_field, run_id, load_type, start)
    load = load_rows(spark, rows, collection, target_path, table, current_bronze(spark, target_path, table),
                     quarantine_path=quarantine_path)
    written = load.rows_written
    if again:
        # the first attempt's rows carry this run's id
        bronze = current_bronze(spark, target_path, table)
        written = 0 if bronze is None else bronze.where(F.col("_ingestion_id") == run_id).count()
    status, message, _ = reconcile_status(load.rows_read, load.rows_read, DEFAULT_THRESHOLD_PCT, 0, 0.0, 0)
    notes = [f"{name}={n}" for name, n in (("quarantined_null_ids", load.quarantined),
                                           ("duplicates_in_batch", load.duplicate_groups)) if n]
    if control is not None and not (again and control.has(collection, run_id)):
        end = now or clock()
        control.log([dict(_ingestion_id=run_id, collection=collection, load_type=load_type, watermark_inicial=None,
                          watermark_final=None, qtd_lida_origem=load.rows_read, qtd_gravada_destino=written,
                          start_time=start, end_time=end, duracao_seg=(end - start).total_seconds(), status=status,
                          mensagem_erro="; ".join([m for m in [message] if m] + notes) or None)])
    ledger.finish(epoch, {"run_id": run_id, "rows_read": load.rows_read, "rows_written": written,
                          "quarantined": load.quarantined, "schema_version": schema_version})
    return load.rows_written


def ingest_available(spark: SparkSession, landing_dir: str, schema: StructType | None, target_path: str,
                     checkpoint: str, id_field: str, load_type: str = "incremental",
                     now: _dt.datetime | None = None, max_files_per_trigger: int | None = None,
                     collection: str | None = None, quarantine_path: str | None = None,
                     table: BucketedTable | None = None, control: ControlLog | None = None) -> int:
    """Process every file that arrived since the last run, then stop.
    Returns the rows written by this call.

    ``schema`` may add fields to the schema kept beside the checkpoint;
    without one they are inferred from all lines of the landing folder. Rows
    with a NULL key go to ``quarantine_path`` (``{target_path}_quarantine``
    by default)."""
    collection = collection or target_path.rstrip("/").rsplit("/", 1)[-1]
    quarantine_path = quarantine_path or f"{target_path.rstrip('/')}_quarantine"
    log = SchemaLog(spark, state_dir(checkpoint))
    version, pinned = log.evolve(schema if schema is not None
                                 else infer_json_schema(spark, read_landing_text(spark, landing_dir)))
    stream = parsed_stream(spark, landing_dir, pinned, max_files_per_trigger)
    written = []

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        ledger = EpochLedger(spark, state_dir(checkpoint), query_id(spark, checkpoint))
        written.append(apply_epoch(spark, batch, epoch, ledger, collection, id_field, load_type, target_path,
                                   quarantine_path, table, control, version, now))

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(written)
