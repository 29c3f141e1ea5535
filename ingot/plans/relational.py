"""Relational path: batch landing with a manifest, then date-range
consolidation into deduplicated bronze snapshots (C6, C7).

Each table is counted while it is written (an observation on the write),
so landing reads the source once. Consolidation reads the day folders of
the range with schema merge, sanitises names, keeps the latest row per
key and overwrites the bronze snapshot, counting rows read and kept in
the same job.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ingot.config import ERRO, MESSAGE_LIMIT_SUMMARY, OK, SKIP
from ingot.functions.names import sanitize_columns, split_columns
from ingot.operators.control import MANIFEST_SCHEMA, SUMMARY_SCHEMA
from ingot.operators.landing import dated_dir
from ingot.operators.lineage import add_audit
from ingot.operators.merge import latest_per_key, overwrite_snapshot
from ingot.session import list_dir
from ingot.sources.files import dated_paths

AUDIT_ORDER_COLUMN = "_ingested_at"


def _parallel_map(fn, items, parallelism: int) -> list:
    """``map`` over driver threads when ``parallelism`` > 1; each item's
    Spark jobs then run side by side on the cluster."""
    if parallelism > 1 and len(items) > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            return list(pool.map(fn, items))
    return [fn(i) for i in items]


def land_tables(spark: SparkSession, tables: Mapping[str, DataFrame], base: str, run_id: str,
                ingested_at: _dt.datetime, source: dict | None = None, add_audit_cols: bool = True,
                single_file_max_rows: int | None = None, parallelism: int = 1) -> DataFrame:
    """Land each table as Parquet in its day folder and return the manifest
    rows (C6). ``ingested_at`` is an aware time; its date picks the folder.
    One table failing gives an ERRO row and the others go on. Tables write
    disjoint folders, so ``parallelism`` > 1 lands several at once."""
    source = source or {}
    day = ingested_at.date()

    def one(name: str) -> tuple:
        t0 = time.time()
        path = dated_dir(base, name, day)
        before = {n for n, _, _, _ in list_dir(spark, path)}
        try:
            df = add_audit(tables[name], run_id, name, ingested_at, add_audit_cols)
            obs = Observation(f"land_{name}_{uuid.uuid4().hex[:6]}")
            df = df.observe(obs, F.count(F.lit(1)).alias("n"))
            w = df.write.mode("append")
            if single_file_max_rows:
                w = w.option("maxRecordsPerFile", single_file_max_rows)
            w.parquet(path)
            n = int(obs.get.get("n", 0) or 0)
            new = [(fn, full, size) for fn, full, d, size in list_dir(spark, path)
                   if not d and fn not in before and fn.endswith(".parquet")]
            size = sum(s for _, _, s in new)
            file_name = ",".join(fn for fn, _, _ in new)
            return (run_id, ingested_at.isoformat(), source.get("catalog"), source.get("schema"),
                    source.get("database"), name, OK, n, file_name, path, size,
                    round(time.time() - t0, 2), "")
        except Exception as exc:
            return (run_id, ingested_at.isoformat(), source.get("catalog"), source.get("schema"),
                    source.get("database"), name, ERRO, None, None, path, None,
                    round(time.time() - t0, 2), str(exc)[:MESSAGE_LIMIT_SUMMARY])

    return spark.createDataFrame(_parallel_map(one, sorted(tables), parallelism), MANIFEST_SCHEMA)


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Append the batch's manifest rows with schema evolution (K8)."""
    manifest.coalesce(1).write.mode("append").option("mergeSchema", "true").parquet(path)


def deduplicate(df: DataFrame, keys: list[str] | None, order_column: str = AUDIT_ORDER_COLUMN,
                group_rows: str | None = None) -> DataFrame:
    """Latest row per key (W1 + U1). Key = declared key, else all business
    columns. The audit order column is ISO text with an offset, so it is
    read as an instant before ordering; the remaining columns break ties
    so the survivor is deterministic even without the order column."""
    _, business = split_columns(df)
    keys = keys or business
    if order_column in df.columns:
        ordered = df.withColumn("__order_ts", F.try_to_timestamp(F.col(order_column)))
        out = latest_per_key(ordered, keys, ["__order_ts"], group_rows=group_rows)
        return out.drop("__order_ts")
    return latest_per_key(df, keys, [], group_rows=group_rows)


def summary_report(summary: DataFrame) -> DataFrame:
    """Summary / manifest rows for display: by status, then table."""
    table_col = "table_name" if "table_name" in summary.columns else "source_table"
    return summary.orderBy("status", table_col)


def consolidate(spark: SparkSession, base: str, tables: list[str], start: _dt.date, end: _dt.date,
                bronze_base: str, primary_keys: Mapping[str, list[str]] | None = None,
                parallelism: int = 1) -> DataFrame:
    """Landing → bronze consolidation over a date range (C7): statuses OK,
    SKIP (no files in range) or ERRO per table; returns the summary."""
    primary_keys = primary_keys or {}

    def one(name: str) -> tuple:
        target = f"{bronze_base.rstrip('/')}/{name}"
        try:
            paths = dated_paths(spark, base, name, start, end)
            if not paths:
                return (name, SKIP, 0, 0, 0, target, "")
            raw = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(*paths)
            n_files = len(raw.inputFiles())
            raw = sanitize_columns(raw)
            # rows read = sum of the per-key group sizes, observed with the
            # rows kept in the write stage itself (exact under task re-runs)
            obs = Observation(f"dedup_{name}_{uuid.uuid4().hex[:6]}")
            dedup = deduplicate(raw, primary_keys.get(name), group_rows="__group_rows")
            dedup = dedup.observe(obs, F.count(F.lit(1)).alias("kept"),
                                  F.coalesce(F.sum("__group_rows"), F.lit(0)).alias("read"))
            overwrite_snapshot(dedup.drop("__group_rows"), target)
            return (name, OK, n_files, int(obs.get["read"]), int(obs.get["kept"]), target, "")
        except Exception as exc:
            return (name, ERRO, 0, 0, 0, target, str(exc)[:MESSAGE_LIMIT_SUMMARY])

    return spark.createDataFrame(_parallel_map(one, sorted(tables), parallelism), SUMMARY_SCHEMA)
