"""Content reconciliation (M6, C2): which keys differ between a source and
its copies, not only how many rows.

Each side is reduced to a digest for each bucket of keys: rows and two sums of
row hashes, exact and independent of order, so equal digests mean equal
multisets of rows (up to a collision of 128 bits). Digests are combined before
the shuffle; ``buckets`` rows a side leave it. Only rows of buckets that differ
are read again and compared key by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingot.functions.scalars import normalise_types

BUCKETS = 4096
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def row_text(columns: list[str]) -> Column:
    """A row as JSON, fields by name and NULLs kept: the same for a typed
    row and for one that was landed as JSON and read back."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def _hashed(side: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    rows = normalise_types(side.select(*dict.fromkeys([key, *columns])))
    text = row_text(columns)
    return rows.select(F.col(f"`{key}`").cast("string").alias("key"),
                       F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")) \
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


def digests(side: DataFrame, key: str, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n, sum1, sum2)``; the sums are decimals and cannot overflow."""
    wide = "decimal(20,0)"
    return _hashed(side, key, columns, buckets).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h1").cast(wide)).alias("sum1"), F.sum(F.col("h2").cast(wide)).alias("sum2"))


def differing_buckets(source: DataFrame, copies: dict[str, DataFrame], key: str, columns: list[str],
                      buckets: int = BUCKETS) -> list[int]:
    """Buckets in which a copy's digest is not the source's: at most
    ``buckets`` numbers."""
    sides = [source, *copies.values()]
    every = reduce(DataFrame.unionByName,
                   (digests(s, key, columns, buckets).withColumn("side", F.lit(i)) for i, s in enumerate(sides)))
    same = (F.count(F.lit(1)) == len(sides)) & (F.count_distinct("n", "sum1", "sum2") == 1)
    return [r[0] for r in every.groupBy("bucket").agg(same.alias("same")).where(~F.col("same")).select("bucket").collect()]


def content_diff(source: DataFrame, copies: dict[str, DataFrame], key: str, columns: list[str],
                 buckets: int = BUCKETS) -> DataFrame:
    """``(side, key, problem, n_source, n_copy)`` for every key of which a
    copy does not hold exactly the source's rows. Rows with a NULL key are one
    key."""
    odd = differing_buckets(source, copies, key, columns, buckets)
    inside = F.col("bucket").isin(odd) if odd else F.lit(False)

    def rows(side: DataFrame) -> DataFrame:
        return _hashed(side, key, columns, buckets).where(inside) \
            .groupBy("key", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))

    out = []
    for name, copy in copies.items():
        both = rows(source).withColumn("c", F.lit(0).cast("long")).withColumnRenamed("n", "s") \
            .unionByName(rows(copy).withColumn("s", F.lit(0).cast("long")).withColumnRenamed("n", "c"))
        per = both.groupBy("key", "h1", "h2").agg(F.sum("s").alias("s"), F.sum("c").alias("c")) \
            .groupBy("key").agg(F.sum("s").alias("n_source"), F.sum("c").alias("n_copy"),
                                F.count_if(F.col("s") != F.col("c")).alias("odd")).where("odd > 0")
        problem = F.when(F.col("n_copy") == 0, MISSING).when(F.col("n_source") == 0, EXTRA).otherwise(CHANGED)
        out.append(per.select(F.lit(name).alias("side"), "key", problem.alias("problem"), "n_source", "n_copy"))
    return reduce(DataFrame.unionByName, out)
