"""Registered queries that write and read state: control log and its
reports, manifests, relational landing and consolidation, CSV and payload
landing, table inventory, date-range scans, replay, streaming
(C3-C9, K1-K11, S4, S7-S9, S12, S13, T1, T3, T5-T7, A5, A6, A10, M1, M3, M6).

Every query derives its input from the supplied tables (whole tables;
"runs" and "manifest rows" are projections of ``events``), writes into a
fresh folder under the shared checkpoint directory, and returns what it
reads back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.config import CollectionConfig
from ingot.functions.scalars import iso_text
from ingot.operators.control import (ControlLog, daily_manifest, daily_observability, failed_runs,
                                     last_runs, last_success_watermarks, status_counts, accumulated_reconcile)
from ingot.operators.landing import write_partitioned
from ingot.operators.merge import read_table
from ingot.operators.ordering import top_n
from ingot.plans.bronze import process_collection, replay_from_watermark, run_all
from ingot.plans.exploration import explore
from ingot.plans.relational import append_manifest, consolidate, land_tables
from ingot.queries.common import iso_sql, run_config, table, ticking_clock
from ingot.session import new_workspace
from ingot.sources.files import list_tables, read_csv, read_partition_range, read_payloads, table_files

Q: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ runs from events
# Each event stands for one run of the collection named by its type; its
# value is the run's duration. These rules only shape test data.
INCREMENTAL_TYPES = ("click", "view", "purchase")


def events_as_control(ev: DataFrame) -> DataFrame:
    status = (F.when(F.col("value") < 5, "FAILED").when(F.col("value") < 10, "PARTIAL")
              .otherwise("SUCCESS"))
    return ev.select(
        F.lpad(F.col("event_id").cast("string"), 8, "0").alias("_ingestion_id"),
        F.col("event_type").alias("collection"),
        F.when(F.col("event_type").isin(*INCREMENTAL_TYPES), "incremental").otherwise("full").alias("load_type"),
        F.lit(None).cast("string").alias("watermark_inicial"),
        iso_text(F.col("ts")).alias("watermark_final"),
        F.col("user_id").cast("long").alias("qtd_lida_origem"),
        F.col("user_id").cast("long").alias("qtd_gravada_destino"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.expr("timestampadd(SECOND, CAST(floor(value) AS INT), ts)").cast("timestamp").alias("end_time"),
        F.col("value").alias("duracao_seg"),
        status.alias("status"),
        F.when(status == "FAILED", F.concat(F.lit("error "), F.col("event_id").cast("string"))).alias("mensagem_erro"))


_CONTROL_SQL = f"""control AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 8, '0') AS _ingestion_id, event_type AS collection,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'incremental' ELSE 'full' END AS load_type,
         {iso_sql('ts')} AS watermark_final, CAST(user_id AS BIGINT) AS qtd_lida_origem,
         CAST(user_id AS BIGINT) AS qtd_gravada_destino, ts AS start_time,
         ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time, value AS duracao_seg,
         CASE WHEN value < 5 THEN 'FAILED' WHEN value < 10 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
  FROM events)"""


def events_as_manifest(ev: DataFrame) -> DataFrame:
    erro = F.col("event_type") == "error"
    return ev.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.concat(iso_text(F.col("ts")), F.lit("-03:00")).alias("ingested_at"),
        F.lit("src").alias("source_catalog"), F.lit("public").alias("source_schema"),
        F.lit("db").alias("source_database"), F.col("event_type").alias("source_table"),
        F.when(erro, "ERRO").otherwise("OK").alias("status"),
        F.when(~erro, F.col("user_id").cast("long")).alias("row_count"),
        F.concat(F.col("event_type"), F.lit(".parquet")).alias("file_name"),
        F.concat(F.lit("/landing/"), F.col("event_type")).alias("file_path"),
        F.floor(F.col("value") * 10000).cast("long").alias("file_size_bytes"),
        F.col("value").alias("duration_sec"),
        F.when(erro, F.lit("failure")).otherwise(F.lit("")).alias("error"))


_MANIFEST_SQL = f"""manifest AS (
  SELECT {iso_sql('ts')} || '-03:00' AS ingested_at, event_type AS source_table,
         CASE WHEN event_type = 'error' THEN 'ERRO' ELSE 'OK' END AS status,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS BIGINT) END AS row_count,
         CAST(floor(value * 10000) AS BIGINT) AS file_size_bytes,
         CASE WHEN event_type = 'error' THEN 'failure' ELSE '' END AS error
  FROM events)"""


@register("control_last_runs", f"""
WITH {_CONTROL_SQL}
SELECT collection, status, qtd_lida_origem, qtd_gravada_destino, watermark_final,
       {iso_sql('start_time')} AS start_time, _ingestion_id
FROM control ORDER BY start_time DESC, _ingestion_id ASC LIMIT 7""")
def control_last_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Newest seven runs (T6); the limit is the report."""
    out = last_runs(events_as_control(table(spark, sf, "events")), 7)
    return out.withColumn("start_time", iso_text(F.col("start_time")))


@register("last_watermark", f"""
WITH {_CONTROL_SQL}
SELECT collection, watermark_final, {iso_sql('end_time')} AS end_time FROM (
  SELECT *, row_number() OVER (PARTITION BY collection ORDER BY end_time DESC, start_time DESC,
                                watermark_final DESC, _ingestion_id DESC) AS rn
  FROM control WHERE status = 'SUCCESS' AND load_type = 'incremental')
WHERE rn = 1""")
def last_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Persisted watermark of every collection at once."""
    out = last_success_watermarks(events_as_control(table(spark, sf, "events")))
    return out.withColumn("end_time", iso_text(F.col("end_time")))


@register("newest_rows", f"""
SELECT event_id, {iso_sql('ts')} AS ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 3""")
def newest_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Top-3 newest rows (T5)."""
    ev = table(spark, sf, "events")
    return top_n(ev, [F.col("ts").desc(), F.col("event_id").desc()], 3) \
        .select("event_id", iso_text(F.col("ts")).alias("ts"))


@register("failed_runs", f"""
WITH {_MANIFEST_SQL}
SELECT ingested_at, source_table, error FROM manifest WHERE status = 'ERRO'
ORDER BY ingested_at DESC, source_table ASC LIMIT 50""")
def failed_runs_q(spark: SparkSession, sf: str) -> DataFrame:
    """Failed manifest rows, newest first, last 50."""
    return failed_runs(events_as_manifest(table(spark, sf, "events")), 50)


@register("manifest_daily", f"""
WITH {_MANIFEST_SQL}
SELECT CAST(CAST(substr(ingested_at, 1, 10) AS DATE) AS VARCHAR) AS dia, count(*) AS arquivos,
       CAST(sum(row_count) AS BIGINT) AS linhas, round(sum(file_size_bytes) / 1024 / 1024, 2) AS mb
FROM manifest WHERE status = 'OK' GROUP BY 1""")
def manifest_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rollup of OK manifest rows (A10)."""
    out = daily_manifest(events_as_manifest(table(spark, sf, "events")))
    return out.withColumn("dia", F.col("dia").cast("string"))


@register("status_counts", f"""
WITH {_MANIFEST_SQL}
SELECT status, count(*) AS n, CAST(coalesce(sum(row_count) FILTER (WHERE status = 'OK'), 0) AS BIGINT) AS ok_rows
FROM manifest GROUP BY status""")
def status_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    return status_counts(events_as_manifest(table(spark, sf, "events")))


@register("observability_daily", f"""
WITH {_CONTROL_SQL}
SELECT CAST(CAST(start_time AS DATE) AS VARCHAR) AS day, collection, count(*) AS runs,
       count(*) FILTER (WHERE status = 'FAILED') AS failures,
       count(*) FILTER (WHERE status = 'PARTIAL') AS partials,
       round(count(*) FILTER (WHERE status = 'FAILED') / count(*), 4) AS failure_rate,
       round(sum(duracao_seg), 2) AS total_duration_sec,
       CAST(sum(qtd_lida_origem) AS BIGINT) AS rows_read, CAST(sum(qtd_gravada_destino) AS BIGINT) AS rows_written
FROM control GROUP BY ALL""")
def observability_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Volume, duration and failure rate per day and collection (M3)."""
    out = daily_observability(events_as_control(table(spark, sf, "events")))
    # the total of two-decimal durations is exact in any engine; a mean can
    # sit on a rounding tie that engines break differently
    return out.drop("avg_duration_sec").withColumn("day", F.col("day").cast("string"))


# ------------------------------------------------------------ S8, S7, M7
RANGE_START, RANGE_END = "2024-01-10", "2024-01-12"


@register("date_range_scan", f"""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_date, {iso_sql('ts')} AS ts FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'""")
def date_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed by day (range-partitioned on day and id, so a hot day
    is spread over several writers), then a date range read with
    partition pruning."""
    ws = new_workspace(spark, "by-day")
    ev = table(spark, sf, "events").withColumn("ingest_date", F.to_date("ts"))
    write_partitioned(ev, ws, "ingest_date", salt_key="event_id")
    out = read_partition_range(spark, ws, "ingest_date", RANGE_START, RANGE_END)
    return out.select("event_id", F.col("ingest_date").cast("string").alias("ingest_date"),
                      iso_text(F.col("ts")).alias("ts"))


# ------------------------------------------------------------ S12, X1
@register("csv_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Table landed as CSV, read back with header and inferred types."""
    ws = new_workspace(spark, "csv")
    table(spark, sf, "nation").write.mode("overwrite").option("header", "true").csv(f"{ws}/nation")
    return read_csv(spark, f"{ws}/nation")


@register("csv_scan_schema", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_scan_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Same file set read with an explicit schema (inference off)."""
    ws = new_workspace(spark, "csv")
    table(spark, sf, "nation").write.mode("overwrite").option("header", True).csv(f"{ws}/nation")
    return read_csv(spark, f"{ws}/nation", "n_nationkey int, n_name string, n_regionkey int")


# ------------------------------------------------------------ S13
@register("payload_rows", "SELECT r_regionkey AS region_key, r_name AS name FROM region")
def payload_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each row landed as its own multi-line JSON payload file, then read
    back as rows."""
    ws = new_workspace(spark, "payloads")
    r = table(spark, sf, "region")
    doc = F.to_json(F.struct(F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("name")))
    pretty = F.regexp_replace(F.regexp_replace(doc, r"^\{", "{\n  "), r",\"", ",\n  \"")
    r.select(pretty.alias("value"), F.col("r_regionkey").alias("payload")) \
        .write.mode("overwrite").partitionBy("payload").text(ws)
    return read_payloads(spark, ws, "region_key int, name string").select("region_key", "name")


# ------------------------------------------------------------ K2, S3, T4
SAMPLE_SIZE = 100


@register("sample_export", f"""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT {SAMPLE_SIZE}""")
def sample_export(spark: SparkSession, sf: str) -> DataFrame:
    """First documents in key order exported one JSON file each, then read
    back (K2); the limit is the feature (a sample)."""
    from ingot.operators.landing import export_sample
    ws = new_workspace(spark, "sample")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").orderBy("o_orderkey")
    export_sample(o, ws, SAMPLE_SIZE, one_file_per_doc=True)
    return spark.read.schema("o_orderkey long, o_custkey long, o_orderstatus string").json(ws)


# ------------------------------------------------------------ S9, K4, T3
INVENTORY = ("region", "nation", "supplier", "customer", "part")


@register("table_inventory", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS has_files FROM {t}" for t in INVENTORY))
def table_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Tables landed in one folder, discovered from the folder (S9), with
    row counts and landed file facts (K4)."""
    ws = new_workspace(spark, "inventory")
    for t in INVENTORY:
        table(spark, sf, t).write.mode("overwrite").parquet(f"{ws}/{t}")
    names = list_tables(spark, ws)
    counts = None
    for n in names:
        c = spark.read.parquet(f"{ws}/{n}").agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
            .withColumn("table_name", F.lit(n))
        counts = c if counts is None else counts.unionByName(c)
    files = table_files(spark, ws).groupBy("table_name").agg(
        (F.sum("file_size_bytes") > 0).alias("has_files"))
    return counts.join(files, "table_name", "left").orderBy("table_name") \
        .select("table_name", "row_count", "has_files")


# ------------------------------------------------------------ S4, S10, S11, S14
CATALOG_TABLES = ("region", "nation", "supplier", "customer")


@register("catalog_tables", "\nUNION ALL\n".join(
    f"SELECT 'ingot_{t}' AS table_name, count(*) AS row_count FROM {t}" for t in CATALOG_TABLES))
def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables registered in the session catalogue, listed sorted by name
    (S4, S10) and read by name (S11, S14) for their row counts."""
    from ingot.sources.tables import list_catalog_tables, read_catalog_table
    for t in CATALOG_TABLES:
        table(spark, sf, t).createOrReplaceTempView(f"ingot_{t}")
    names = [r.table_name for r in list_catalog_tables(spark).collect() if r.table_name.startswith("ingot_")]
    counts = None
    for n in names:
        c = read_catalog_table(spark, n).agg(F.count(F.lit(1)).cast("long").alias("row_count")) \
            .select(F.lit(n).alias("table_name"), "row_count")
        counts = c if counts is None else counts.unionByName(c)
    return counts


# ------------------------------------------------------------ C6, K3, K8, P7
RELATIONAL = ("region", "nation", "customer", "supplier", "part", "orders")
LANDED_AT = _dt.datetime(2026, 8, 1, 10, 0, 0, tzinfo=_dt.timezone(_dt.timedelta(hours=-3)))


@register("relational_landing", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS source_table, 'OK' AS status, count(*) AS row_count, true AS has_file, "
    f"'{LANDED_AT.isoformat()}' AS ingested_at FROM {t}" for t in RELATIONAL))
def relational_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Relational tables landed with audit columns in their day folder; the
    manifest is appended and read back (C6, K3, K8)."""
    ws = new_workspace(spark, "relational")
    tables = {t: table(spark, sf, t) for t in RELATIONAL}
    manifest = land_tables(spark, tables, f"{ws}/landing", "run-fixed", LANDED_AT,
                           {"catalog": "src", "schema": "public", "database": "db"})
    append_manifest(manifest, f"{ws}/manifest")
    back = spark.read.parquet(f"{ws}/manifest")
    return back.select("source_table", "status", "row_count",
                       (F.col("file_size_bytes") > 0).alias("has_file"), "ingested_at")


# ------------------------------------------------------------ C7, S7, K6, W1
DAY1 = _dt.datetime(2026, 8, 1, 10, 0, 0, tzinfo=_dt.timezone(_dt.timedelta(hours=-3)))
DAY2 = _dt.datetime(2026, 8, 2, 9, 0, 0, tzinfo=_dt.timezone.utc)
SPLIT_OLD, SPLIT_NEW = "1999-01-01", "1998-01-01"


def _land_two_days(spark: SparkSession, sf: str, ws: str) -> None:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    day1 = o.where(F.col("o_orderdate") < F.lit(SPLIT_OLD).cast("timestamp_ntz"))
    day2 = o.where(F.col("o_orderdate") >= F.lit(SPLIT_NEW).cast("timestamp_ntz")) \
        .withColumn("o_orderstatus", F.concat(F.col("o_orderstatus"), F.lit("2")))
    land_tables(spark, {"orders": day1}, f"{ws}/landing", "run-day1", DAY1)
    land_tables(spark, {"orders": day2}, f"{ws}/landing", "run-day2", DAY2)


@register("consolidate_dedup", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, _ingested_at FROM (
  SELECT o_orderkey, o_custkey, o_orderstatus, '{DAY1.isoformat()}' AS _ingested_at FROM orders
  WHERE o_orderdate < TIMESTAMP '{SPLIT_OLD}'
    AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT_NEW}')
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus || '2', '{DAY2.isoformat()}' FROM orders
  WHERE o_orderdate >= TIMESTAMP '{SPLIT_NEW}')""")
def consolidate_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Two landing days overlapping on one year of orders (times with
    different UTC offsets); the consolidated bronze keeps the latest
    landing of every key (C7)."""
    ws = new_workspace(spark, "consolidate")
    _land_two_days(spark, sf, ws)
    consolidate(spark, f"{ws}/landing", ["orders"], DAY1.date(), DAY2.date(), f"{ws}/bronze",
                {"orders": ["o_orderkey"]})
    return spark.read.parquet(f"{ws}/bronze/orders") \
        .select("o_orderkey", "o_custkey", F.col("o_orderstatus"), "_ingested_at")


@register("consolidate_summary", f"""
SELECT 'customer' AS table_name, 'SKIP' AS status, 0 AS arquivos_gt0, CAST(0 AS BIGINT) AS linhas_lidas,
       CAST(0 AS BIGINT) AS linhas_bronze
UNION ALL
SELECT 'orders', 'OK', 1,
       (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_OLD}')
       + (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT_NEW}'),
       (SELECT count(*) FROM orders)""")
def consolidate_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Consolidation summary: OK with rows read/kept, SKIP without files."""
    ws = new_workspace(spark, "consolidate")
    _land_two_days(spark, sf, ws)
    s = consolidate(spark, f"{ws}/landing", ["orders", "customer"], DAY1.date(), DAY2.date(),
                    f"{ws}/bronze", {"orders": ["o_orderkey"]})
    return s.select("table_name", "status", (F.col("arquivos") > 0).cast("int").alias("arquivos_gt0"),
                    "linhas_lidas", "linhas_bronze")


# ------------------------------------------------------------ C3, C4, C5, K5, K7, K9
# The event types, each run as its own collection.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _type_sources(ev: DataFrame) -> dict:
    return {t: ev.where(F.col("event_type") == t) for t in EVENT_TYPES}


@register("control_run_rows", f"""
WITH per AS (SELECT event_type, count(*) AS n, max({iso_sql('ts')}) AS wm FROM events GROUP BY event_type)
SELECT 1 AS run, event_type AS collection, 'incremental' AS load_type, 'SUCCESS' AS status,
       n AS qtd_lida_origem, n AS qtd_gravada_destino, '1970-01-01T00:00:00' AS watermark_inicial,
       wm AS watermark_final FROM per
UNION ALL
SELECT 2, event_type, 'incremental', 'SUCCESS', 0, 0, wm, wm FROM per""")
def control_run_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every event type run as an incremental collection, twice: the first
    run reads everything, the second finds nothing newer than the
    persisted watermark (C3, C4, C5)."""
    colls = [CollectionConfig(t, "incremental", id_field="event_id", watermark_field="ts",
                              watermark_type="date") for t in EVENT_TYPES]
    cfg = run_config(spark, "runs", colls)
    ev = table(spark, sf, "events")
    clock = ticking_clock()
    r1 = run_all(spark, cfg, _type_sources(ev), clock, parallelism=len(EVENT_TYPES)).withColumn("run", F.lit(1))
    r2 = run_all(spark, cfg, _type_sources(ev), clock, parallelism=len(EVENT_TYPES)).withColumn("run", F.lit(2))
    both = r1.unionByName(r2)
    return both.select("run", "collection", "load_type", "status", "qtd_lida_origem", "qtd_gravada_destino",
                       "watermark_inicial", "watermark_final")


# ------------------------------------------------------------ M6
DELIVERY_BOUNDS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


@register("accumulated_reconcile", """
SELECT 'events' AS collection, CAST(3 AS BIGINT) AS runs, count(*) AS total_read, count(*) AS total_written,
       count(*) AS bronze_rows, CAST(0 AS BIGINT) AS difference FROM events""")
def accumulated_reconcile_q(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries of events; the accumulated control figures are
    checked against the bronze table (M6)."""
    coll = CollectionConfig("events", "full", id_field="event_id")
    cfg = run_config(spark, "accumulated", [coll])
    control = ControlLog(spark, cfg.control_path)
    ev = table(spark, sf, "events")
    a, b = [F.lit(x).cast("timestamp_ntz") for x in DELIVERY_BOUNDS]
    clock = ticking_clock()
    for part in (ev.where(F.col("ts") < a), ev.where((F.col("ts") >= a) & (F.col("ts") < b)), ev.where(F.col("ts") >= b)):
        process_collection(spark, cfg, coll, part, control, clock=clock)
    bronze = read_table(spark, f"{cfg.bronze_dir}/events").agg(F.count(F.lit(1)).cast("long").alias("bronze_rows")) \
        .withColumn("collection", F.lit("events"))
    return accumulated_reconcile(control.read(), bronze) \
        .select("collection", "runs", "total_read", "total_written", "bronze_rows", "difference")


# ------------------------------------------------------------ C9, K10, K11
@register("replay_from_watermark", f"""
SELECT event_id, {iso_sql('ts')} AS ts, CAST(1 AS BIGINT) AS copies FROM events""")
def replay_from_watermark_q(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental load, then the newest row is deleted from bronze and the
    watermark moved back before it; the re-run brings exactly that row
    back, so the final table holds every event once (C9)."""
    coll = CollectionConfig("events", "incremental", id_field="event_id", watermark_field="ts",
                            watermark_type="date")
    cfg = run_config(spark, "replay", [coll])
    control = ControlLog(spark, cfg.control_path)
    ev = table(spark, sf, "events")
    clock = ticking_clock()
    process_collection(spark, cfg, coll, ev, control, clock=clock)
    bronze_path = f"{cfg.bronze_dir}/events"
    newest = top_n(read_table(spark, bronze_path), [F.col("ts").desc(), F.col("_source_id").desc()], 3) \
        .select("_source_id", "ts").collect()
    keys = spark.createDataFrame([(newest[0]["_source_id"],)], "_source_id string")
    rec = replay_from_watermark(spark, cfg, coll, ev, keys, newest[-1]["ts"], clock)
    if rec["qtd_gravada_destino"] != 1:
        raise RuntimeError(f"replay wrote {rec['qtd_gravada_destino']} rows, expected 1")
    out = read_table(spark, bronze_path).groupBy("event_id", "ts").agg(F.count(F.lit(1)).alias("copies"))
    return out


# ------------------------------------------------------------ C8
@register("exploration_path", """
SELECT 'k' AS column_name, 'bigint' AS data_type, count(k) AS count,
       round(100.0 * (count(*) - count(k)) / count(*), 4) AS pct_null, avg(k) AS mean,
       stddev_samp(k) AS stddev, CAST(min(k) AS VARCHAR) AS min, CAST(max(k) AS VARCHAR) AS max
FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def exploration_path(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON bodies: inferred schema, expansion, selection, profile."""
    raw = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("_id"), F.col("props").alias("body"))
    ex = explore(raw, {"k": "k"}, {"k": "int"}, F.col("k").isNull(), "k missing", "events.props",
                 F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return ex.profile


# ------------------------------------------------------------ M1
STREAM_SPLIT = "2024-01-15 00:00:00"


@register("stream_file_ingest", f"""
SELECT event_id, {iso_sql('ts')} AS ts, event_type, 'stream' AS _load_type FROM events""")
def stream_file_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of JSON-line files picked up by two ``availableNow``
    runs of a checkpointed file stream; each run merges only new files."""
    from ingot.functions.scalars import normalise_types
    from ingot.streaming.file_ingest import ingest_available
    ws = new_workspace(spark, "stream")
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    split = F.lit(STREAM_SPLIT).cast("timestamp_ntz")
    schema = normalise_types(ev).schema
    now = _dt.datetime(2024, 2, 1)
    for i, part in enumerate((ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split))):
        normalise_types(part).write.mode("overwrite").option("maxRecordsPerFile", 2000) \
            .json(f"{ws}/landing/delivery={i}")
        ingest_available(spark, f"{ws}/landing", schema, f"{ws}/bronze", f"{ws}/checkpoint", "event_id",
                         load_type="stream", now=now)
    return read_table(spark, f"{ws}/bronze").select("event_id", "ts", "event_type", "_load_type")


QUERIES = Q
ORACLES = SQL
