"""Run-control log, persisted watermark, manifest and their reports
(C5, K7-K9, K11, T1, T6, T7, A4, A5, A6, A10, M3, M6).

The control log is an append-only path table with a fixed schema; it
grows by one row per collection per run. Reports are DataFrame functions,
so they run the same on the real log or on any frame of the same shape.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ingot.config import ERRO, FAILED, OK, PARTIAL, SUCCESS
from ingot.operators.merge import restore_aside, swap_in
from ingot.operators.ordering import top_n
from ingot.session import list_dir

# Column names and types of the control table.
CONTROL_SCHEMA = """
    _ingestion_id       STRING,
    collection          STRING,
    load_type           STRING,
    watermark_inicial   STRING,
    watermark_final     STRING,
    qtd_lida_origem     BIGINT,
    qtd_gravada_destino BIGINT,
    start_time          TIMESTAMP,
    end_time            TIMESTAMP,
    duracao_seg         DOUBLE,
    status              STRING,
    mensagem_erro       STRING
"""

# Column names and types of the ingestion manifest.
MANIFEST_SCHEMA = (
    "run_id string, ingested_at string, source_catalog string, source_schema string, "
    "source_database string, source_table string, status string, row_count bigint, "
    "file_name string, file_path string, file_size_bytes bigint, duration_sec double, error string"
)

# Consolidation summary columns.
SUMMARY_SCHEMA = ("table_name string, status string, arquivos int, linhas_lidas bigint, "
                  "linhas_bronze bigint, target_table string, error string")

CONTROL_COLUMNS = [c.split()[0] for c in CONTROL_SCHEMA.strip().split(",\n")]


def _escape_partition_value(v: str) -> str:
    """Folder-safe partition value (``%XX`` for anything unusual), the
    escaping Spark's partition discovery reverses on read."""
    return "".join(ch if ch.isalnum() or ch in "_.-" else "".join(f"%{b:02X}" for b in ch.encode()) for ch in v)


class ControlLog:
    """Append-only run log with the persisted high-water mark.

    Layout: one Hive partition folder per collection. Each append writes
    into its collection's folder only, so collections running at the same
    time never share a commit folder, and a watermark lookup reads one
    collection's files (partition pruning)."""

    COMPACT_AFTER_FILES = 64

    def __init__(self, spark: SparkSession, path: str, compact_after_files: int | None = None):
        self.spark = spark
        self.path = path
        self.compact_after_files = compact_after_files or self.COMPACT_AFTER_FILES
        self.ensure()

    def ensure(self) -> None:
        """Create the table folder if absent (K9)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)

    def read(self) -> DataFrame:
        return self.spark.read.schema(CONTROL_SCHEMA).parquet(self.path).select(*CONTROL_COLUMNS)

    def log(self, records: list[dict]) -> None:
        """Append typed rows (K7); the explicit schema types all-null columns."""
        by_coll: dict[str, list] = {}
        for r in records:
            by_coll.setdefault(r.get("collection"), []).append(tuple(r.get(c) for c in CONTROL_COLUMNS))
        for coll, rows in by_coll.items():
            folder = self._folder(coll)
            restore_aside(self.spark, self._aside(coll), folder)
            self.spark.createDataFrame(rows, CONTROL_SCHEMA).drop("collection").coalesce(1) \
                .write.mode("append").parquet(folder)
            if self._file_count(folder) > self.compact_after_files:
                self.compact_collection(coll)

    def _folder(self, collection: str | None) -> str:
        return f"{self.path}/collection={_escape_partition_value(collection or '__HIVE_DEFAULT_PARTITION__')}"

    def _file_count(self, folder: str) -> int:
        return sum(1 for n, _, d, _ in list_dir(self.spark, folder) if not d and n.endswith(".parquet"))

    def compact_collection(self, collection: str) -> None:
        """Rewrite one collection's log folder as a single file. The new
        file is written to a staging folder and swapped in; a folder that a
        crash left aside is put back by the next log or lookup."""
        folder = self._folder(collection)
        rows = self.spark.read.schema(CONTROL_SCHEMA).parquet(self.path) \
            .where(F.col("collection") == collection).drop("collection")
        staging = f"{self.path}/_compact_{uuid.uuid4().hex[:12]}"
        rows.coalesce(1).write.mode("overwrite").parquet(staging)
        swap_in(self.spark, staging, folder, self._aside(collection))

    def _aside(self, collection: str | None) -> str:
        """Where a collection's old folder waits during compaction."""
        return f"{self.path}/_replaced/{_escape_partition_value(collection or '__HIVE_DEFAULT_PARTITION__')}"

    def insert(self, _ingestion_id: str, collection: str, load_type: str, watermark_inicial: str | None,
               watermark_final: str | None, status: str = SUCCESS, message: str | None = None,
               when: _dt.datetime | None = None) -> None:
        """Literal control row (K11), e.g. to replay from an older watermark."""
        when = when or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self.log([dict(_ingestion_id=_ingestion_id, collection=collection, load_type=load_type,
                       watermark_inicial=watermark_inicial, watermark_final=watermark_final,
                       qtd_lida_origem=0, qtd_gravada_destino=0, start_time=when, end_time=when,
                       duracao_seg=0.0, status=status, mensagem_erro=message)])

    def last_watermark(self, collection: str) -> str | None:
        """Watermark of the latest successful incremental run."""
        restore_aside(self.spark, self._aside(collection), self._folder(collection))
        r = last_success_watermarks(self.read().where(F.col("collection") == collection)).first()
        return r.watermark_final if r else None

    def has(self, collection: str, ingestion_id: str) -> bool:
        """Whether a run has a row already."""
        restore_aside(self.spark, self._aside(collection), self._folder(collection))
        rows = self.read().where((F.col("collection") == collection) & (F.col("_ingestion_id") == ingestion_id))
        return not rows.isEmpty()

    def compact(self, target: str) -> None:
        """Copy the log into ``target`` with one file per collection (the
        live log gains one small file per run). Switching the log to the
        compacted folder is the caller's step; a folder being read is
        never overwritten."""
        self.read().repartition("collection").write.mode("overwrite").partitionBy("collection").parquet(target)


def last_success_watermarks(control: DataFrame) -> DataFrame:
    """Per collection, ``watermark_final`` of the newest (by ``end_time``)
    SUCCESS incremental row (T1 for all collections at once). The pick is
    a ``max`` over a struct, so ties on ``end_time`` resolve by start
    time, then watermark, then id — never arbitrarily."""
    ok = control.where((F.col("status") == SUCCESS) & (F.col("load_type") == "incremental"))
    best = F.max(F.struct("end_time", "start_time", "watermark_final", "_ingestion_id"))
    return ok.groupBy("collection").agg(best.alias("b")) \
        .select("collection", F.col("b.watermark_final").alias("watermark_final"),
                F.col("b.end_time").alias("end_time"))


def last_runs(control: DataFrame, n: int = 7) -> DataFrame:
    """Newest ``n`` runs (T6), chosen columns, stable tie-break."""
    return top_n(control, [F.col("start_time").desc(), F.col("_ingestion_id").asc()], n) \
        .select("collection", "status", "qtd_lida_origem", "qtd_gravada_destino", "watermark_final",
                "start_time", "_ingestion_id")


def failed_runs(manifest: DataFrame, n: int | None = None) -> DataFrame:
    """Failed rows newest first."""
    out = manifest.where(F.col("status") == ERRO).select("ingested_at", "source_table", "error")
    order = [F.col("ingested_at").desc(), F.col("source_table").asc()]
    return top_n(out, order, n) if n else out.orderBy(*order)


def status_counts(frame: DataFrame, status_col: str = "status", rows_col: str = "row_count",
                  ok_value: str = OK) -> DataFrame:
    """Count per status plus the row total of OK entries, null → 0 (A5, A6),
    in one pass."""
    return frame.groupBy(status_col).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.coalesce(F.sum(F.when(F.col(status_col) == ok_value, F.col(rows_col))), F.lit(0))
        .cast("long").alias("ok_rows"))


# Column names of the daily manifest rollup.
ROLLUP_DAY, ROLLUP_FILES, ROLLUP_ROWS, ROLLUP_MB = "dia", "arquivos", "linhas", "mb"


def daily_manifest(manifest: DataFrame) -> DataFrame:
    """Daily rollup of OK manifest rows: files, rows, MB (2 places), newest
    day first (A10)."""
    return (manifest.where(F.col("status") == OK)
            .groupBy(F.to_date(F.col("ingested_at")).alias(ROLLUP_DAY))
            .agg(F.count(F.lit(1)).cast("long").alias(ROLLUP_FILES),
                 F.sum("row_count").cast("long").alias(ROLLUP_ROWS),
                 F.round(F.sum("file_size_bytes") / 1024 / 1024, 2).alias(ROLLUP_MB))
            .orderBy(F.col(ROLLUP_DAY).desc()))


def daily_observability(control: DataFrame) -> DataFrame:
    """Per day and collection: runs, failures, failure rate, mean and total
    duration, rows read and written (M3)."""
    return (control.groupBy(F.to_date("start_time").alias("day"), "collection")
            .agg(F.count(F.lit(1)).cast("long").alias("runs"),
                 F.count_if(F.col("status") == FAILED).cast("long").alias("failures"),
                 F.count_if(F.col("status") == PARTIAL).cast("long").alias("partials"),
                 F.round(F.count_if(F.col("status") == FAILED) / F.count(F.lit(1)), 4).alias("failure_rate"),
                 F.avg("duracao_seg").alias("avg_duration_sec"),
                 F.round(F.sum("duracao_seg"), 2).alias("total_duration_sec"),
                 F.sum("qtd_lida_origem").cast("long").alias("rows_read"),
                 F.sum("qtd_gravada_destino").cast("long").alias("rows_written")))


def run_overlap(control: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Per collection: most runs active at one time, time with two or more
    active, idle time between the first and the last mark, its number of
    gaps and the longest (M3), in microseconds.

    A sweep over start and end marks, without a join of runs with runs. Marks
    of one instant are summed before the shuffle. A running count over a
    collection would sort it in one task, so it is kept in two levels: sums
    of whole time buckets first (as many rows as the span has buckets), then
    inside each bucket from its predecessors' sum on. A run without an end is
    active to the last mark; one that ends before it starts has no length."""
    end = F.when(F.col("end_time") < F.col("start_time"), F.col("start_time")).otherwise(F.col("end_time"))
    marks = control.where(F.col("start_time").isNotNull()).select("collection", F.inline(F.array(
        F.struct(F.unix_micros(F.col("start_time")).alias("t"), F.lit(1).alias("d")),
        F.struct(F.unix_micros(end).alias("t"), F.lit(-1).alias("d"))))).where(F.col("t").isNotNull())
    at = marks.groupBy("collection", "t").agg(F.sum("d").alias("d")) \
        .withColumn("bucket", F.floor(F.col("t") / F.lit(bucket_seconds * 1_000_000)).cast("long"))
    order = Window.partitionBy("collection").orderBy("bucket")
    sums = at.groupBy("collection", "bucket").agg(F.sum("d").alias("net"), F.min("t").alias("first")) \
        .withColumn("base", F.coalesce(F.sum("net").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("after", F.lead("first").over(order)).drop("net", "first")
    inside = Window.partitionBy("collection", "bucket").orderBy("t")
    spans = at.join(sums, ["collection", "bucket"]) \
        .withColumn("active", F.col("base") + F.sum("d").over(inside)) \
        .withColumn("us", F.coalesce(F.lead("t").over(inside), F.col("after")) - F.col("t"))
    idle = (F.col("active") == 0) & F.col("us").isNotNull()
    return spans.groupBy("collection").agg(
        F.max("active").cast("long").alias("most_active"),
        F.coalesce(F.sum(F.when(F.col("active") >= 2, F.col("us"))), F.lit(0)).cast("long").alias("overlap_us"),
        F.coalesce(F.sum(F.when(idle, F.col("us"))), F.lit(0)).cast("long").alias("idle_us"),
        F.count_if(idle).cast("long").alias("gaps"),
        F.coalesce(F.max(F.when(idle, F.col("us"))), F.lit(0)).cast("long").alias("longest_gap_us"))


def accumulated_reconcile(control: DataFrame, bronze_counts: DataFrame) -> DataFrame:
    """Accumulated source × target check per collection (M6): all rows
    reported read and written by non-failed runs against the rows the
    bronze table holds now."""
    runs = (control.where(F.col("status") != FAILED).groupBy("collection")
            .agg(F.count(F.lit(1)).cast("long").alias("runs"),
                 F.sum("qtd_lida_origem").cast("long").alias("total_read"),
                 F.sum("qtd_gravada_destino").cast("long").alias("total_written")))
    out = runs.join(bronze_counts, "collection", "full_outer")
    return out.withColumn("difference", F.coalesce(F.col("total_written"), F.lit(0))
                          - F.coalesce(F.col("bronze_rows"), F.lit(0)))


def watermark_of(rows: DataFrame, field: str) -> Column:
    """New watermark: max of the field as text (A4)."""
    return F.max(F.col(f"`{field}`")).cast("string")
