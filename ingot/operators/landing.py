"""Landing sinks (K1-K4, M7).

Key-paged JSONL landing is expressed as a range partitioning on the key
plus ``maxRecordsPerFile``: every file holds at most ``batch_size``
documents in key order and files cover disjoint key ranges. Each task
writes its own files, so landing is as parallel as the cluster.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ingot.config import DEFAULT_BATCH_SIZE
from ingot.functions.scalars import normalise_types
from ingot.session import list_dir, partitions_for


@dataclass(frozen=True)
class ExtractResult:
    collection: str
    path: str
    docs: int
    pages: int
    started_at: _dt.datetime | None = None
    finished_at: _dt.datetime | None = None

    def files(self, spark: SparkSession) -> DataFrame:
        """The landed pages (path, name, size) as a DataFrame, listed by
        Spark rather than collected into a driver list."""
        return landed_file_facts(spark, self.path, "*.json*")


def write_landing_pages(df: DataFrame, path: str, key: str | None, batch_size: int = DEFAULT_BATCH_SIZE,
                        ordered: bool = True, collection: str = "", compression: str = "none") -> ExtractResult:
    """Land documents as JSON lines (K1): values normalised to text as the
    source encoder does (X9), nulls kept, non-ASCII kept, at most
    ``batch_size`` documents per file. ``ordered`` range-partitions on the
    key and sorts inside each range (T2) — one shuffle; without it files
    keep the scan's order and no shuffle happens. ``compression`` (e.g.
    ``gzip``) shrinks the landing; pages are small, so files need not be
    splittable."""
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    norm = normalise_types(df)
    if ordered and key:
        # the row hash breaks ties inside one key, so a key holding a large
        # share of the rows is split over several ranges (and writer tasks)
        # while files stay in key order; it is deterministic, so a re-run
        # task lands the same rows
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in norm.columns])
        norm = norm.withColumn("__tie", tie) \
            .repartitionByRange(partitions_for(df), F.col(f"`{key}`"), F.col("__tie")) \
            .sortWithinPartitions(key, "__tie").drop("__tie")
    obs = Observation(f"landed_{collection or 'docs'}_{uuid.uuid4().hex[:8]}")
    norm = norm.observe(obs, F.count(F.lit(1)).alias("docs"))
    (norm.write.mode("overwrite").option("maxRecordsPerFile", batch_size)
     .option("ignoreNullFields", "false").option("compression", compression).json(path))
    docs = int(obs.get.get("docs", 0) or 0)
    pages = sum(1 for n, _, d, _ in list_dir(norm.sparkSession, path) if not d and ".json" in n)
    return ExtractResult(collection, path, docs, pages, started,
                         _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))


def landed_file_facts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Per landed file: path, name, size in bytes (K4). Read through the
    binary-file source with the content column pruned, so only file
    metadata is touched."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("file_path"),
                    F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                    F.col("length").alias("file_size_bytes")))


def dated_dir(base: str, table: str, day: _dt.date) -> str:
    """``{base}/{table}/YYYY/YYYY-MM/YYYY-MM-DD`` landing layout (K3)."""
    return f"{base.rstrip('/')}/{table}/{day:%Y}/{day:%Y-%m}/{day:%Y-%m-%d}"


def write_dated_parquet(df: DataFrame, base: str, table: str, day: _dt.date,
                        single_file: bool = False, max_records: int | None = None) -> str:
    """One table's run landed as Parquet under its day folder (K3). A single
    file only on request (small tables); large tables keep their tasks."""
    path = dated_dir(base, table, day)
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("append")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_col: str, salt_key: str | None = None,
                      salt_buckets: int | None = None, max_records: int | None = None,
                      mode: str = "append") -> None:
    """Destination file-count control (M7): rows are clustered by the
    partition column so each task writes few files. With ``salt_key`` the
    rows are range-partitioned on (partition column, salt key) into a
    count that grows with the input (or ``salt_buckets`` per value when
    given): a partition value holding a third of the data is spread over
    as many writer tasks as its size needs, a small one stays in one."""
    if salt_key and salt_buckets:
        salt = F.pmod(F.xxhash64(F.col(f"`{salt_key}`")), F.lit(salt_buckets))
        out = df.repartition(F.col(f"`{partition_col}`"), salt)
    elif salt_key:
        out = df.repartitionByRange(partitions_for(df), F.col(f"`{partition_col}`"), F.col(f"`{salt_key}`"))
    else:
        out = df.repartition(F.col(f"`{partition_col}`"))
    w = out.write.mode(mode).partitionBy(partition_col)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)


def export_sample(df: DataFrame, path: str, n: int, one_file_per_doc: bool = False) -> None:
    """Sample export (K2): the first ``n`` documents as JSON; one file per
    document only on demand."""
    w = df.limit(n).write.mode("overwrite").option("ignoreNullFields", "false")
    if one_file_per_doc:
        w = w.option("maxRecordsPerFile", 1)
    w.json(path)
