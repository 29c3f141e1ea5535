"""Table sources (S4, S10, S11, S14): parquet tables of a data folder,
catalogue tables and relational tables through Spark's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The supplied test tables.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """``{data_dir}/{name}.parquet`` — column pruning and filter pushdown
    reach the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Managed or federated table by name."""
    return spark.read.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 8,
              properties: dict | None = None) -> DataFrame:
    """Relational table read split into ``num_partitions`` key ranges so the
    source is read in parallel (S11 without a federated catalogue)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def list_catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of a schema sorted by name (S4, S10), as a DataFrame."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, table_type string, is_temporary boolean") \
        .orderBy("table_name")


def count_where(df: DataFrame, condition=None) -> int:
    """Source count with an optional filter."""
    return (df.where(condition) if condition is not None else df).count()


def count_frame(df: DataFrame, condition=None, label: str = "n") -> DataFrame:
    """Count as a one-row DataFrame, so it can be combined without an action."""
    src = df.where(condition) if condition is not None else df
    return src.agg(F.count(F.lit(1)).cast("long").alias(label))
