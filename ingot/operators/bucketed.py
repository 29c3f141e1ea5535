"""Bronze as a bucketed catalogue table.

A table is bucketed by its key, so an insert-only merge meets the target
bucket by bucket: the target's key column is scanned where it lies and never
shuffled, however many keys it has gathered. Only the batch's distinct keys
are (with a count each, combined before the shuffle, so a key that holds a
third of the batch is one row), and then the batch's rows.

Tables are external: a schema of the session's catalogue names them, the
files lie under ``path``. A catalogue that forgets (the in-memory one of a
plain session) gets the table back from the files by :func:`ensure`.
One writer per table at a time is assumed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.schemas import merge_schemas, same_type
from ingot.operators.merge import PARTITION_COLUMN, align_to_target, table_exists
from ingot.session import list_dir, metrics_of, new_workspace, path_exists, remove


@dataclass(frozen=True)
class BucketedTable:
    """``buckets`` is fixed when the table is created: about the table's
    size at its largest over the size of a file that one task should read."""

    schema: str
    table: str
    path: str
    key: str = "_source_id"
    buckets: int = 64
    partition: str = PARTITION_COLUMN

    @property
    def name(self) -> str:
        return f"`{self.schema}`.`{self.table}`"


def exists(spark: SparkSession, t: BucketedTable) -> bool:
    return spark.catalog.tableExists(t.name)


def buckets_of(spark: SparkSession, t: BucketedTable) -> int | None:
    """The number of buckets the table was made with: from the catalogue, or
    as noted beside the files for a catalogue that forgets."""
    if exists(spark, t):
        rows = spark.sql(f"DESCRIBE EXTENDED {t.name}").where("col_name = 'Num Buckets'").collect()
        return int(rows[0].data_type) if rows else None
    note = f"{t.path}/_buckets"
    return int(spark.read.text(note).first()[0]) if path_exists(spark, note) else None


def read(spark: SparkSession, t: BucketedTable) -> DataFrame:
    return spark.table(t.name)


def _create(spark: SparkSession, t: BucketedTable, schema: T.StructType) -> None:
    last = [f for f in schema.fields if f.name == t.partition]
    ddl = T.StructType([f for f in schema.fields if f.name != t.partition] + last).toDDL()
    spark.sql(f"CREATE TABLE {t.name} ({ddl}) USING parquet PARTITIONED BY (`{t.partition}`) "
              f"CLUSTERED BY (`{t.key}`) SORTED BY (`{t.key}`) INTO {t.buckets} BUCKETS LOCATION '{t.path}'")
    if path_exists(spark, t.path):
        spark.sql(f"ALTER TABLE {t.name} RECOVER PARTITIONS")


def ensure(spark: SparkSession, t: BucketedTable, schema: T.StructType | None = None) -> bool:
    """Makes the catalogue table fit ``schema`` (K5): created if absent,
    from its files if there are some; new columns and new fields at any depth
    are added to its schema, and older files read as NULL there. Nothing is
    rewritten. False when there is no table and no schema to make one of."""
    if not exists(spark, t):
        if table_exists(spark, t.path):
            schema = merge_schemas(spark.read.option("mergeSchema", "true").parquet(t.path).schema, schema)
        if schema is None:
            return False
        base = t.path.rstrip("/").rsplit("/", 1)[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{t.schema}` LOCATION '{base}/_catalogue'")
        _create(spark, t, schema)
        spark.createDataFrame([(str(t.buckets),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{t.path}/_buckets")
        return True
    now = read(spark, t).schema
    merged = merge_schemas(now, schema)
    if not same_type(now, merged):
        # an external table's files stay; a reader by name finds none in between
        spark.sql(f"DROP TABLE {t.name}")
        _create(spark, t, merged)
    return True


def batch_keys(batch: DataFrame, t: BucketedTable) -> DataFrame:
    """Distinct keys of the batch with their rows, dealt like the buckets."""
    return batch.where(F.col(t.key).isNotNull()).groupBy(t.key).agg(F.count(F.lit(1)).alias("__n")) \
        .repartition(t.buckets, t.key)


def new_keys(spark: SparkSession, keys: DataFrame, t: BucketedTable, key_range: tuple | None = None) -> DataFrame:
    """Those of :func:`batch_keys` that the table lacks. Both sides lie by
    bucket, so the join shuffles neither; the target gives its key column
    only, cut to the batch's key range where it is known."""
    there = read(spark, t).select(F.col(t.key).alias("__k")).where(F.col("__k").isNotNull())
    if key_range is not None and key_range[0] is not None:
        there = there.where(F.col("__k").between(F.lit(key_range[0]), F.lit(key_range[1])))
    return keys.join(there, keys[t.key] == there["__k"], "left_anti")


@dataclass(frozen=True)
class Merged:
    written: int
    duplicate_groups: int
    observed: dict


def insert_new(spark: SparkSession, batch: DataFrame, t: BucketedTable, key_range: tuple | None = None,
               null_keys: bool = True, observe: dict[str, Column] | None = None) -> Merged:
    """Insert-only merge (J1): rows whose key the table lacks are appended,
    all duplicates of a new key included; rows with a NULL key match nothing
    and are appended. ``batch`` is read twice (keys, rows), so hand in a
    written one. ``observe`` aggregates over the appended rows; counts come
    from result stages, so a task that runs again counts once."""
    ensure(spark, t, batch.schema)
    batch = align_to_target(batch, read(spark, t).schema)
    path = None
    if _empty(spark, t):
        dups = batch.where(F.col(t.key).isNotNull()).groupBy(t.key).agg(F.count(F.lit(1)).alias("n")) \
            .agg(F.count_if(F.col("n") > 1)).first()[0]
        rows = batch if null_keys else batch.where(F.col(t.key).isNotNull())
        null_keys = False
    else:
        seen, path = Observation(f"keys_{uuid.uuid4().hex[:8]}"), f"{new_workspace(spark, 'merge-keys')}/keys"
        keys = batch_keys(batch, t).observe(seen, F.count_if(F.col("__n") > 1).alias("dups"))
        new_keys(spark, keys, t, key_range).select(F.col(t.key).alias("__k")).write.parquet(path)
        dups = metrics_of(seen).get("dups")
        fresh = spark.read.parquet(path)
        rows = batch.join(fresh, batch[t.key] == fresh["__k"], "left_semi")
    if null_keys:
        rows = rows.unionByName(batch.where(F.col(t.key).isNull()))
    wrote = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    have = set(batch.columns)
    rows = rows.select(*[F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in read(spark, t).schema.fields])
    extra = [c.alias(n) for n, c in (observe or {}).items()]
    # splits a hot key's bucket among tasks, and puts small buckets together
    rows.hint("rebalance", t.buckets, t.key).observe(wrote, F.count(F.lit(1)).alias("rows"), *extra) \
        .write.insertInto(t.name)
    if path:
        remove(spark, path)
    got = metrics_of(wrote)
    return Merged(int(got.get("rows") or 0), int(dups or 0), {n: got.get(n) for n in (observe or {})})


def _empty(spark: SparkSession, t: BucketedTable) -> bool:
    return not any(d and "=" in n for n, _, d, _ in list_dir(spark, t.path))


def _overwrite_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the overwrite mode, so that writes of other
    threads keep theirs; catalogue and executors are shared."""
    own = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        if (v := spark.conf.get(k, None)) is not None:
            own.conf.set(k, v)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return own


def delete_keys(spark: SparkSession, t: BucketedTable, keys: DataFrame) -> int:
    """Deletes rows by key (K10): only partitions that hold one are
    rewritten, bucketed as before, and put in place by one commit. Returns
    the number of partitions touched."""
    path = f"{new_workspace(spark, 'delete-keys')}/keys"
    keys.select(F.col(t.key).alias("__k")).where("__k IS NOT NULL").distinct().write.parquet(path)
    own = _overwrite_session(spark)
    gone, target = own.read.parquet(path).repartition(t.buckets, "__k"), own.table(t.name)
    on = target[t.key] == gone["__k"]
    # one value for each partition (a day), not for each row
    parts = [r[0] for r in target.join(gone, on, "left_semi").select(t.partition).distinct().collect()]
    if not parts:
        return 0
    inside = F.col(t.partition).isin(parts)
    kept = target.where(inside).join(gone, on, "left_anti")
    left = {r[0] for r in kept.select(t.partition).distinct().collect()}
    kept.hint("rebalance", t.buckets, t.key).write.insertInto(t.name, overwrite=True)
    for p in parts:
        if p not in left:
            spark.sql(f"ALTER TABLE {t.name} DROP IF EXISTS PARTITION (`{t.partition}` = '{p}')")
            remove(spark, f"{t.path}/{t.partition}={p}")
    spark.catalog.refreshTable(t.name)
    return len(parts)


def rewrite(spark: SparkSession, t: BucketedTable, parts: list, change) -> None:
    """Puts ``change(rows)`` in the place of the rows of some partitions,
    bucketed as before, by one commit."""
    own = _overwrite_session(spark)
    columns = read(spark, t).columns
    change(own.table(t.name).where(F.col(t.partition).isin(parts))).select(*[F.col(f"`{c}`") for c in columns]) \
        .hint("rebalance", t.buckets, t.key).write.insertInto(t.name, overwrite=True)
    spark.catalog.refreshTable(t.name)


def compact(spark: SparkSession, t: BucketedTable, parts: list) -> int:
    """Rewrites partitions to one file a bucket (M7), rows unchanged; hot
    buckets keep as many as their size needs. Returns the files written."""
    rewrite(spark, t, parts, lambda rows: rows)
    return sum(1 for p in parts for n, _, d, _ in list_dir(spark, f"{t.path}/{t.partition}={p}")
               if not d and n.endswith(".parquet"))
