"""Landing → bronze load and the per-collection run.

Per collection run:
  1. watermark from the control log (incremental mode only),
  2. filtered + projected scan of the source, landed as key-ordered
     JSON-line pages (counted by an observation on the write),
  3. landing scan with the pinned schema and rescue column, lineage; the
     typed rows are staged, and key metrics, key range and the new
     watermark are observed on that write,
  4. insert-only merge of the staged rows into the bronze table (written
     rows observed on the write), reconciliation, one control row.
Only bounded scalars (counts, the watermark, the key range) come back to
the driver; nothing row-sized does.
"""

from __future__ import annotations

import datetime as _dt
import logging
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.config import (DEFAULT_WATERMARK_START, ERROR_MESSAGE_LIMIT, FAILED, SUCCESS, CollectionConfig,
                          RunConfig)
from ingot.functions.json import infer_json_schema
from ingot.functions.rescue import RESCUE_COLUMN
from ingot.functions.scalars import normalise_types
from ingot.functions.schemas import merge_schemas
from ingot.operators import bucketed
from ingot.operators.bucketed import BucketedTable
from ingot.operators.control import ControlLog
from ingot.operators.filters import incremental_filter, watermark_rank
from ingot.operators.landing import write_landing_pages
from ingot.operators.lineage import LINEAGE_COLUMNS, add_lineage, utc_now
from ingot.operators.merge import PARTITION_COLUMN, delete_keys, insert_only_merge, latest_per_key, read_table, \
    row_hash, table_exists
from ingot.operators.quality import reconcile_status
from ingot.sources.documents import scan_collection
from ingot.session import metrics_of, new_workspace, partitions_for, remove
from ingot.sources.landing import read_landing, read_landing_text


logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    rows_read: int
    rows_written: int
    duplicate_groups: int
    pct_null: float
    null_keys: int = 0
    quarantined: int = 0
    max_watermark_read: str | None = None
    max_watermark_written: str | None = None
    unreadable_watermarks: int = 0


def target_business_schema(target: DataFrame | None) -> StructType | None:
    """The bronze table's document columns (lineage and rescue removed)."""
    if target is None:
        return None
    skip = set(LINEAGE_COLUMNS) | {RESCUE_COLUMN}
    return StructType([f for f in target.schema.fields if f.name not in skip])


CONTENT_HASH = "_content_hash"


def quarantine_rows(rows: DataFrame, path: str) -> None:
    """Append rows to the quarantine unless a row of the same content is
    there: a batch that is read again adds nothing."""
    spark = rows.sparkSession
    content = [c for c in rows.columns if c not in LINEAGE_COLUMNS and c != PARTITION_COLUMN]
    rows = rows.withColumn(CONTENT_HASH, row_hash(content))
    if table_exists(spark, path):
        there = read_table(spark, path)
        if CONTENT_HASH in there.columns:
            rows = rows.join(there.select(CONTENT_HASH), CONTENT_HASH, "left_anti")
    rows.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)


def bronze_table(spark: SparkSession, cfg: RunConfig, name: str, source: DataFrame) -> BucketedTable | None:
    """The collection's catalogue table, where the run names a schema."""
    if not cfg.bronze_schema:
        return None
    table = BucketedTable(cfg.bronze_schema, name, f"{cfg.bronze_dir}/{name}", buckets=cfg.bronze_buckets or 1)
    if cfg.bronze_buckets is None:
        table = replace(table, buckets=bucketed.buckets_of(spark, table) or partitions_for(source))
    return table


def current_bronze(spark: SparkSession, target_path: str, table: BucketedTable | None) -> DataFrame | None:
    """The collection's bronze table, if there is one yet."""
    if table is not None:
        return bucketed.read(spark, table) if bucketed.ensure(spark, table) else None
    return read_table(spark, target_path) if table_exists(spark, target_path) else None


def landing_to_bronze(spark: SparkSession, landing_paths: str | list[str] | None, collection: str,
                      id_field: str, run_id: str, load_type: str, target_path: str,
                      now: _dt.datetime | None = None, schema: StructType | None = None,
                      watermark_field: str | None = None, quarantine_path: str | None = None,
                      source_label: str | None = None, merge_options: dict | None = None,
                      dedup_batch: bool = False, watermark_type: str | None = None,
                      table: BucketedTable | None = None) -> LoadResult:
    """Load one run's landing files into the bronze table (C1). No paths →
    zero result and the table is untouched. With ``quarantine_path`` rows
    whose key is NULL go there instead of bronze (they could never match
    and would be re-inserted on every run). ``table`` names a bucketed
    catalogue table; without it bronze is the path table ``target_path``.

    The text is read and parsed once: typed rows are staged, and the counts,
    the key range and the watermark are observed on that write. Duplicates,
    quarantine and merge read the staged columns they need."""
    if not landing_paths:
        return LoadResult(0, 0, 0, 0.0)
    now = now or utc_now()
    target = current_bronze(spark, target_path, table)
    pinned = merge_schemas(target_business_schema(target), schema)
    if pinned is None:
        pinned = infer_json_schema(spark, read_landing_text(spark, landing_paths))
    raw = read_landing(spark, landing_paths, pinned)
    kwargs = {"source_path": source_label} if source_label else {}
    enriched = add_lineage(raw, id_field, run_id, load_type, now, **kwargs)

    return load_rows(spark, enriched, collection, target_path, table, target, watermark_field, watermark_type,
                     quarantine_path, dedup_batch, merge_options)


def load_rows(spark: SparkSession, enriched: DataFrame, collection: str, target_path: str,
              table: BucketedTable | None, target: DataFrame | None, watermark_field: str | None = None,
              watermark_type: str | None = None, quarantine_path: str | None = None, dedup_batch: bool = False,
              merge_options: dict | None = None) -> LoadResult:
    """Typed rows with lineage into bronze: staged once, measured on that
    write, quarantined, merged."""
    # the watermark is the max of the typed value (numbers compare as
    # numbers), turned into text only at the end
    has_wm = bool(watermark_field) and watermark_field in enriched.columns
    value = F.col(f"`{watermark_field}`") if has_wm else F.lit(None).cast("string")
    wm = watermark_rank(value, watermark_type)
    seen = Observation(f"staged_{uuid.uuid4().hex[:8]}")
    staging = f"{new_workspace(spark, 'staged')}/{collection}"
    enriched.observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("_source_id").isNull()).alias("nulls"),
        F.min("_source_id").alias("lo"), F.max("_source_id").alias("hi"),
        F.count_if(value.isNotNull() & wm.isNull()).alias("odd"), F.max(wm).getField("text").alias("wm")) \
        .write.parquet(staging)
    s = metrics_of(seen)
    total, nulls = int(s.get("total") or 0), int(s.get("nulls") or 0)
    pct_null = round(nulls / total * 100, 4) if total else 0.0
    staged = spark.read.schema(enriched.schema).parquet(staging)

    to_write, quarantined = staged, 0
    if quarantine_path and nulls:
        quarantine_rows(staged.where(F.col("_source_id").isNull()), quarantine_path)
        to_write, quarantined = staged.where(F.col("_source_id").isNotNull()), nulls

    dups = None
    if table is None or dedup_batch:
        dups = staged.where(F.col("_source_id").isNotNull()).groupBy("_source_id").agg(F.count(F.lit(1)).alias("n")) \
            .agg(F.count_if(F.col("n") > 1)).first()[0]
    if dedup_batch and dups:
        order = [watermark_field] if watermark_field and watermark_field in to_write.columns else []
        keyed = to_write.where(F.col("_source_id").isNotNull())
        to_write = latest_per_key(keyed, ["_source_id"], order) \
            .unionByName(to_write.where(F.col("_source_id").isNull()))

    watch = {"wm_written": F.max(wm).getField("text")}
    if table is not None:
        merged = bucketed.insert_new(spark, to_write, table, (s.get("lo"), s.get("hi")),
                                     null_keys=bool(nulls) and not quarantined, observe=watch)
        written, observed = merged.written, merged.observed
        dups = merged.duplicate_groups if dups is None else dups
    else:
        observed = {}
        written = insert_only_merge(spark, to_write, target_path, "_source_id", (PARTITION_COLUMN,),
                                    key_range=(s.get("lo"), s.get("hi")), target=target, observe=watch,
                                    observed=observed, **(merge_options or {}))
    remove(spark, staging)
    wm_written = observed.get("wm_written") if written else None
    # all NULL keys are one group
    return LoadResult(total, written, int(dups) + (nulls > 1), pct_null, nulls, quarantined, s.get("wm"), wm_written,
                      int(s.get("odd") or 0))


Clock = Callable[[], _dt.datetime]


def process_collection(spark: SparkSession, cfg: RunConfig, coll: CollectionConfig, source: DataFrame,
                       control: ControlLog, run_id: str | None = None, clock: Clock = utc_now) -> dict:
    """One collection run (C3); any error inside becomes a FAILED control
    row with the message cut to 1000 characters, and the log write itself
    cannot stop the caller."""
    run_id = run_id or str(uuid.uuid4())
    start = clock()
    status, message = SUCCESS, None
    wm_start = None
    wm_final = None
    read_n = written_n = 0
    try:
        coll.validate()
        cond = None
        if coll.mode == "incremental":
            wm_start = control.last_watermark(coll.name) or DEFAULT_WATERMARK_START
            cond = incremental_filter(source, coll.watermark_field, wm_start, coll.watermark_type)
        wm_final = wm_start
        scan = scan_collection(source, cond, coll.exclude)
        landing = f"{cfg.landing_dir}/{coll.name}/{run_id}"
        ext = write_landing_pages(scan, landing, coll.id_field, cfg.batch_size, ordered=cfg.ordered_pages,
                                  collection=coll.name, compression=cfg.landing_compression)
        read_n = ext.docs
        reference = cfg.watermark_rule == "reference"
        load = landing_to_bronze(
            spark, landing if ext.docs else None, coll.name, coll.id_field, run_id, coll.mode,
            f"{cfg.bronze_dir}/{coll.name}", now=clock(), schema=normalise_types(scan).schema,
            watermark_field=coll.watermark_field,
            quarantine_path=None if reference else f"{cfg.quarantine_dir}/{coll.name}",
            source_label=cfg.source_path_label, dedup_batch=cfg.dedup_batch,
            watermark_type=coll.watermark_type, table=bronze_table(spark, cfg, coll.name, source))
        written_n = load.rows_written
        threshold = cfg.threshold_for(coll)
        if reference:
            status, message, _ = reconcile_status(ext.docs, load.rows_read, threshold,
                                                  load.null_keys, load.pct_null, load.duplicate_groups)
        else:
            # quality findings are reported; only divergence blocks the watermark
            status, message, div = reconcile_status(ext.docs, load.rows_read, threshold, 0, 0.0, 0)
            notes = []
            if load.quarantined:
                notes.append(f"quarantined_null_ids={load.quarantined}")
            if load.duplicate_groups:
                notes.append(f"duplicates_in_batch={load.duplicate_groups}")
            if load.unreadable_watermarks:
                notes.append(f"unreadable_watermarks={load.unreadable_watermarks}")
            if notes:
                message = "; ".join([m for m in [message] if m] + notes)
        if coll.mode == "incremental" and coll.watermark_field and ext.docs > 0:
            new_wm = load.max_watermark_written if reference else load.max_watermark_read
            wm_final = new_wm if new_wm is not None else wm_start
    except Exception as exc:  # isolation boundary of one collection
        status, message = FAILED, str(exc)[:ERROR_MESSAGE_LIMIT]
        logger.error("collection %s failed: %s", coll.name, message)
    end = clock()
    record = dict(_ingestion_id=run_id, collection=coll.name, load_type=coll.mode,
                  watermark_inicial=wm_start, watermark_final=wm_final,
                  qtd_lida_origem=int(read_n), qtd_gravada_destino=int(written_n),
                  start_time=start, end_time=end, duracao_seg=(end - start).total_seconds(),
                  status=status, mensagem_erro=message)
    try:
        control.log([record])
    except Exception as exc:  # a log failure must not stop the next collections
        logger.error("control log write failed for %s: %s", coll.name, exc)
    return record


Sources = Mapping[str, DataFrame | Callable[[], DataFrame]]


def run_all(spark: SparkSession, cfg: RunConfig, sources: Sources, clock: Clock = utc_now,
            run_ids: Mapping[str, str] | None = None, parallelism: int = 1) -> DataFrame:
    """All configured collections (C4); one failure does not stop the
    others. Returns this run's control rows in configuration order.

    ``parallelism`` > 1 submits that many collections at once from driver
    threads; their Spark jobs then share the cluster (collections write
    disjoint tables and separate control-log files, so they do not
    interfere). 1 keeps the original one-after-another order."""
    cfg.validate()
    control = ControlLog(spark, cfg.control_path)

    def one(coll: CollectionConfig) -> dict:
        try:
            src = sources[coll.name]
            src = src() if callable(src) else src
        except Exception as exc:
            now = clock()
            record = dict(_ingestion_id=(run_ids or {}).get(coll.name) or str(uuid.uuid4()), collection=coll.name,
                          load_type=coll.mode, watermark_inicial=None, watermark_final=None, qtd_lida_origem=0,
                          qtd_gravada_destino=0, start_time=now, end_time=now, duracao_seg=0.0,
                          status=FAILED, mensagem_erro=str(exc)[:ERROR_MESSAGE_LIMIT])
            try:
                control.log([record])
            except Exception as log_exc:
                logger.error("control log write failed for %s: %s", coll.name, log_exc)
            return record
        return process_collection(spark, cfg, coll, src, control, (run_ids or {}).get(coll.name), clock)

    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            records = list(pool.map(one, cfg.collections))
    else:
        records = [one(c) for c in cfg.collections]
    from ingot.operators.control import CONTROL_COLUMNS, CONTROL_SCHEMA
    return spark.createDataFrame([tuple(r[c] for c in CONTROL_COLUMNS) for r in records], CONTROL_SCHEMA)


def replay_from_watermark(spark: SparkSession, cfg: RunConfig, coll: CollectionConfig, source: DataFrame,
                          keys: DataFrame, watermark: str, clock: Clock = utc_now) -> dict:
    """Controlled replay (C9): delete the given keys from bronze (K10), log a
    control row that moves the watermark back (K11), run the collection
    again. Exactly the deleted rows (newer than ``watermark``) come back;
    everything else already present is skipped by the insert-only merge."""
    control = ControlLog(spark, cfg.control_path)
    table = bronze_table(spark, cfg, coll.name, source)
    if table is not None:
        bucketed.ensure(spark, table)
        bucketed.delete_keys(spark, table, keys)
    else:
        delete_keys(spark, f"{cfg.bronze_dir}/{coll.name}", keys, "_source_id")
    control.insert(f"replay-{uuid.uuid4().hex[:8]}", coll.name, "incremental", None, watermark,
                   SUCCESS, "manual watermark for replay", when=clock())
    return process_collection(spark, cfg, coll, source, control, clock=clock)
