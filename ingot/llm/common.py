"""Helpers of the corpus operators: table access, written tables in the
shared folder, and connected components on DataFrames."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.session import new_workspace


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application,
    so that functions given to Spark import there whatever their path; and
    hand them texts in small batches, which bounds their memory."""
    sc = spark.sparkContext
    if sc.getConf().get(ARROW_ROWS) is None:
        spark.conf.set(ARROW_ROWS, "1000")
    if sc.getConf().get(ARROW_BYTES) is None:
        spark.conf.set(ARROW_BYTES, "4m")
    if any(f.startswith("ingot-code") for f in sc._python_includes):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ingot-code-"), "ingot-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def corpus_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared directory and read it
    back. It cuts lineage like ``checkpoint()`` does, in columnar form. Spark
    drops the shuffle files of steps that are over when the driver collects
    its garbage; asking for that here keeps them from piling up."""
    spark = df.sparkSession
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    path = f"{new_workspace(spark, label)}/t"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    spark = table.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._table_path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def distinct_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """At most ``n`` different values of a text column, under its name: those of
    the smallest hashes among about ``4 n`` rows. A value counts once however
    many rows hold it; nulls do not count."""
    h = F.xxhash64(column)
    among = min(1.0, 4 * n / max(1, df.count()))
    low = df.filter(F.col(column).isNotNull() & (F.pmod(h, F.lit(1 << 30)) < int(among * (1 << 30))))
    chosen = [r[0] for r in low.select(h.alias("h")).distinct().orderBy("h").limit(n).collect()]
    upto = chosen[-1] if chosen else -(1 << 63)
    return low.filter(h <= upto).groupBy(h).agg(F.min(column).alias(column)).select(column)


def distinct_sample(df: DataFrame, column: str, n: int) -> list[str]:
    """``distinct_values`` in order, at the driver: at most ``n`` texts."""
    return sorted(r[0] for r in distinct_values(df, column, n).collect())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``, the
    component being its smallest node.

    Each round hooks every node to the smallest node of its closed
    neighbourhood, follows those pointers to their roots by pointer jumping,
    and contracts the edges to the roots. Rounds and jumps are logarithmic,
    also for long chains; every step is a partially aggregated ``groupBy`` or
    an equi-join, so a hub with very many neighbours is never gathered."""
    spark = edges.sparkSession
    edges = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                    .filter("a <> b").distinct(), label)
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.min(F.least("a", "b")).alias("parent")), label)
        while True:
            to = up.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            nxt = written(up.join(to, "parent", "left")
                          .select("node", F.coalesce("grand", "parent").alias("parent"),
                                  (F.col("grand") < F.col("parent")).alias("moved")), label)
            moved = not nxt.filter("moved").isEmpty()
            up = nxt.drop("moved")
            if not moved:
                break
        levels.append(up)
        ra = up.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        rb = up.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        edges = written(edges.join(ra, "a").join(rb, "b").filter("ra <> rb")
                        .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), label)
    if not levels:
        return spark.createDataFrame([], "node long, component long")
    out = levels[-1].select("node", F.col("parent").alias("component"))
    for up in reversed(levels[:-1]):
        out = up.join(out.select(F.col("node").alias("parent"), "component"), "parent", "left") \
            .select("node", F.coalesce("component", "parent").alias("component"))
    return written(out, label)
