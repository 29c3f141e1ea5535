"""Kept state (M2, W1): the latest record per key and the validity intervals
of its versions, brought forward by each delivery instead of recomputed.

State lies in a fixed number of key buckets, one folder each. A delivery
rewrites the buckets its keys fall into and no other; what a bucket costs
depends on its own rows, not on the table's. New files are staged and swapped
in bucket by bucket, and applying a delivery again gives the same state, so a
run that stopped midway is simply repeated.

A key may hold a third of all rows: the latest record is a partial ``max`` over
structs, and intervals look at neighbours inside (key, time bucket) groups,
whose edges are joined from one small row for each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ingot.operators.content import row_text
from ingot.operators.merge import _replace_partitions, latest_per_key, restore_partitions, table_exists

BUCKET = "_bucket"
BUCKETS = 64
SPAN_SECONDS = 86_400


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int"))


def _bring_forward(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], buckets: int, merge) -> int:
    """Rewrites the touched buckets as ``merge(their rows, batch)``; returns
    how many they are."""
    rows = _bucketed(batch, keys, buckets)
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]     # at most ``buckets`` numbers
    if not touched:
        return 0
    held = None
    if table_exists(spark, path):
        restore_partitions(spark, path, BUCKET)
        held = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
    _replace_partitions(spark, path, BUCKET, touched, merge(held, rows).repartition(len(touched), BUCKET))
    return len(touched)


def apply_latest(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], order_by: list[str],
                 buckets: int = BUCKETS) -> int:
    """Latest record per key after this delivery: the greatest ``order_by``
    values, other columns breaking ties."""
    def merge(held, rows):
        both = rows if held is None else held.select(*rows.columns).unionByName(rows)
        return latest_per_key(both, [*keys, BUCKET], order_by)

    return _bring_forward(spark, path, batch, keys, buckets, merge)


def flagged_versions(versions: DataFrame, keys: list[str], at: str, payload: list[str], span: int = SPAN_SECONDS) -> DataFrame:
    """``(keys, payload, valid_from, valid_to, changed)``: one version for
    each key and instant (the greatest, where there are several). Those that
    differ from the one before them are ``changed`` and hold to the next such
    one; the others open no interval."""
    ks = [F.col(f"`{k}`") for k in keys]
    value = F.struct(*[F.col(f"`{c}`") for c in payload])
    one = versions.groupBy(*ks, F.col(f"`{at}`").alias("valid_from")).agg(F.max(value).alias("v")) \
        .withColumn("h", F.xxhash64(F.to_json("v", {"ignoreNullFields": "false"}))) \
        .withColumn("s", F.floor(F.unix_seconds(F.col("valid_from").cast("timestamp")) / span))
    inside = Window.partitionBy(*ks, "s").orderBy("valid_from")
    across = Window.partitionBy(*ks).orderBy("s")
    edge_keys = [k.alias(f"__e{i}") for i, k in enumerate(ks)] + [F.col("s").alias("__es")]

    def join_edges(rows, edges):
        on = [k.eqNullSafe(F.col(f"__e{i}")) for i, k in enumerate(ks)] + [F.col("s") == F.col("__es")]
        return rows.join(edges, on, "left").drop("__es", *[f"__e{i}" for i in range(len(ks))])

    last = one.groupBy(*ks, "s").agg(F.max_by("h", "valid_from").alias("h")) \
        .select(*edge_keys, F.lag("h").over(across).alias("edge"))
    before = F.when(F.row_number().over(inside) == 1, F.col("edge")).otherwise(F.lag("h").over(inside))
    marked = join_edges(one, last).withColumn("before", before) \
        .withColumn("changed", F.col("before").isNull() | (F.col("before") != F.col("h"))).drop("before", "edge")
    first = marked.where("changed").groupBy(*ks, "s").agg(F.min("valid_from").alias("f")) \
        .select(*edge_keys, F.lead("f").over(across).alias("edge"))
    # among the changed rows of a (key, time bucket) only these have a successor there
    among = Window.partitionBy(*ks, "s", "changed").orderBy("valid_from")
    until = F.when(F.col("changed"), F.coalesce(F.lead("valid_from").over(among), F.col("edge")))
    return join_edges(marked, first).withColumn("valid_to", until) \
        .select(*ks, *[F.col("v").getField(c).alias(c) for c in payload], "valid_from", "valid_to", "changed")


def intervals(versions: DataFrame, keys: list[str], at: str, payload: list[str], span: int = SPAN_SECONDS) -> DataFrame:
    """``(keys, payload, valid_from, valid_to)``: a version holds from its
    instant to the next different one, the last without an end."""
    return flagged_versions(versions, keys, at, payload, span).where("changed").drop("changed")


def apply_versions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], at: str, payload: list[str],
                   buckets: int = BUCKETS) -> int:
    """Validity intervals after this delivery. Deliveries may come in any
    order: a late version splits the interval it falls into, so versions that
    repeat the one before them are kept too, for one that comes in between."""
    def merge(held, rows):
        new = rows.select(*keys, *payload, F.col(at).alias("valid_from"))
        both = new if held is None else held.select(*new.columns).unionByName(new)
        return _bucketed(flagged_versions(both, keys, "valid_from", payload), keys, buckets)

    return _bring_forward(spark, path, batch, keys, buckets, merge)


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """The intervals of a state kept by :func:`apply_versions`."""
    return read_state(spark, path).where("changed").drop("changed")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    restore_partitions(spark, path, BUCKET)
    return spark.read.parquet(path).drop(BUCKET)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same multiset of rows, by digest."""
    def digest(df):
        text = row_text(df.columns)
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(text).cast("decimal(20,0)")),
                      F.sum(F.xxhash64(F.lit(1), text).cast("decimal(20,0)"))).first()

    return set(a.columns) == set(b.columns) and digest(a) == digest(b)
