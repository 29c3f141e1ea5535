"""File-set sources.

Date ranges prune by partition value (Hive layout) or by the day segment
of the path; table discovery reads file metadata through Spark instead
of a driver-side walk of every file.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.operators.landing import dated_dir
from ingot.session import list_dir, path_exists


def read_parquet_merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Multi-file Parquet scan with schema merge."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def date_range(start: _dt.date, end: _dt.date) -> list[_dt.date]:
    """Inclusive list of days."""
    n = (end - start).days
    return [start + _dt.timedelta(days=i) for i in range(n + 1)]


def dated_paths(spark: SparkSession, base: str, table: str, start: _dt.date, end: _dt.date) -> list[str]:
    """Day folders of ``{base}/{table}/YYYY/YYYY-MM/YYYY-MM-DD`` between two
    dates, inclusive; absent days are skipped, other errors raise (S8).
    One folder per day, so the list is bounded by the range length."""
    return [d for d in (dated_dir(base, table, day) for day in date_range(start, end))
            if path_exists(spark, d)]


def read_date_range(spark: SparkSession, base: str, table: str, start: _dt.date, end: _dt.date) -> DataFrame | None:
    """Parquet of the day folders in range, schema-merged; files whose name
    starts with ``_`` or ``.`` are ignored by the reader. None when no day
    folder exists."""
    paths = dated_paths(spark, base, table, start, end)
    if not paths:
        return None
    return spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(*paths)


def read_partition_range(spark: SparkSession, path: str, column: str, start, end) -> DataFrame:
    """Hive-layout table filtered on its partition column: Spark lists and
    reads only the matching partition folders (partition pruning)."""
    return spark.read.parquet(path).where(F.col(column).between(F.lit(start), F.lit(end)))


def list_tables(spark: SparkSession, base: str) -> list[str]:
    """Table names = sub-folder names of the landing base, sorted."""
    return sorted(n for n, _, is_dir, _ in list_dir(spark, base) if is_dir and not n.startswith(("_", ".")))


def table_files(spark: SparkSession, base: str, glob: str = "*.parquet") -> DataFrame:
    """Per landed file: table (first folder under ``base``), path, size —
    listed by Spark's file index, content not read (S9, K4)."""
    root = base.rstrip("/")
    facts = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root).select("path", "length"))
    rel = F.regexp_extract("path", r"^.*?" + _escape(root.split("/")[-1]) + r"/([^/]+)/", 1)
    return facts.select(rel.alias("table_name"), F.col("path").alias("file_path"),
                        F.col("length").alias("file_size_bytes"))


def _escape(s: str) -> str:
    import re
    return re.escape(s)


# CSV options unless the call says otherwise.
CSV_DEFAULTS = {"header": True, "inferSchema": True, "sep": ",", "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV files with default options under the call's own (S12). A given
    schema replaces inference."""
    chosen = CSV_DEFAULTS | options | ({"inferSchema": False} if schema is not None else {})
    return spark.read.csv(path, schema=schema, **chosen)


def read_payloads(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Landed API payloads, one JSON document (possibly multi-line, or an
    array of documents) per file → rows (S13)."""
    r = spark.read.option("multiLine", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
