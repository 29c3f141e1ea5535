"""Ordered operators: global row numbers and key pages (S1 paging, T2),
top-k reports (T3, T5-T7).

A global row number must not pull the table through one task (a window
without ``partitionBy`` does). The scalable form range-partitions on the
key, numbers rows inside each range, and adds the row count of all
earlier ranges. The per-range counts table has one row per partition, a
bound set by the partition count, not by the data, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ingot.session import partitions_for, shared_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id in the upper 31 bits


def with_global_row_number(df: DataFrame, key: str, name: str = "row_number",
                           num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by key)`` computed without a single-task
    window. The ranged, numbered data is checkpointed to the shared
    checkpoint folder, so the ids cannot change if a task is re-run."""
    shared_dir(df.sparkSession)  # sets the checkpoint folder of the context
    ranged = df.repartitionByRange(num_partitions or partitions_for(df), F.col(key))
    ranged = ranged.sortWithinPartitions(key).withColumn("__mid", F.monotonically_increasing_id())
    ranged = ranged.checkpoint(eager=True)
    ranged = ranged.withColumns({
        "__pid": F.shiftright(F.col("__mid"), _LOCAL_BITS),
        "__local": F.col("__mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
    })
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per range partition: the window runs over a partition-count-sized table
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, F.col("__off") + F.col("__local") + 1) \
        .drop("__mid", "__pid", "__local", "__off")


def page_number(row_number: Column, page_size: int) -> Column:
    """1-based page of a 1-based row number: floor((rn - 1) / size) + 1."""
    return F.floor((row_number - 1) / F.lit(page_size)).cast("long") + 1


def key_pages(df: DataFrame, key: str, page_size: int) -> DataFrame:
    """What key-ordered paging with ``page_size`` documents per page yields:
    per page its number, document count and first/last key (S1, T2)."""
    numbered = with_global_row_number(df.select(key), key)
    return (numbered.withColumn("page", page_number(F.col("row_number"), page_size))
            .groupBy("page")
            .agg(F.count(F.lit(1)).cast("long").alias("n_docs"),
                 F.min(key).alias("first_key"), F.max(key).alias("last_key")))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Newest-first style report: ``orderBy(...).limit(n)`` plans as
    TakeOrderedAndProject (a per-task top-n, then a merge of n rows per
    task), never a full sort."""
    return df.orderBy(*order).limit(n)
