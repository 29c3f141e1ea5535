"""Repair loop (M8, P14): rescued values and quarantined rows read again under
a newer schema, applied once, and marked settled.

A value that did not fit its schema waits in ``_rescued_data`` by path, a row
without a key in the quarantine. When the schema has grown, :func:`repair`
takes the rescued top-level values that now have a column, or that their
column's type now holds, into the bronze rows and out of their rescue column,
which is the mark: a later repair finds nothing there. Rows of the quarantine
get the same and their key by an expression over the new columns; those that
have one are merged insert-only, and their content hashes are kept beside the
quarantine as settled.

Only partitions of bronze with something to repair are rewritten. A repair
that stops midway is repeated: bronze by partition, the merge by key, the
settled list last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.rescue import RESCUE_COLUMN
from ingot.operators import bucketed
from ingot.operators.bucketed import BucketedTable
from ingot.operators.merge import read_table, table_exists

CONTENT_HASH = "_content_hash"
_MAP = "map<string,string>"


@dataclass(frozen=True)
class Repaired:
    values: int          # bronze rows that got a rescued value
    rows: int            # quarantined rows that went to bronze
    left: int            # quarantined rows that still wait


def _read_again(raw: Column, dt: T.DataType) -> Column:
    """A rescued raw value as the type its column has now; a nested one only
    if that type holds all of it, as it would leave the rescue column whole."""
    if isinstance(dt, T.StringType):
        return raw
    if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
        value = F.from_json(raw, dt)
        whole = F.to_json(F.try_parse_json(raw)) == F.to_json(F.try_parse_json(F.to_json(value)))
        return F.when(whole, value)
    return raw.try_cast(dt)


def reparse(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with the fields of ``schema``, empty ones filled from the rescue
    column; values that were taken leave it. Adds ``__taken``: how many."""
    have = {f.name.lower(): f for f in rows.schema.fields}
    held = F.from_json(F.col(RESCUE_COLUMN), _MAP)
    out = rows.withColumn("__held", held)
    values, taken = {}, []
    for f in schema.fields:
        if f.name.startswith("_"):
            continue
        known = have.get(f.name.lower())
        now = F.col(f"`{known.name}`") if known else F.lit(None).cast(f.dataType)
        path = f.name.replace("\\", "\\\\").replace(".", "\\.")
        again = _read_again(F.try_element_at("__held", F.lit(path)), known.dataType if known else f.dataType)
        take = now.isNull() & again.isNotNull()
        values[known.name if known else f.name] = F.coalesce(now, again)
        taken.append(F.when(take, F.array(F.lit(path))).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("__paths", F.concat(*taken) if taken else F.array().cast("array<string>")).withColumns(values)
    rest = F.map_filter("__held", lambda k, _: ~F.array_contains("__paths", k))
    return out.withColumn(RESCUE_COLUMN, F.when(F.size("__held") > F.size("__paths"), F.to_json(rest))) \
        .withColumn("__taken", F.size("__paths")).drop("__held", "__paths")


def repair_bronze(spark: SparkSession, t: BucketedTable, schema: T.StructType) -> int:
    """Takes rescued values into the table's rows; returns the rows changed."""
    bucketed.ensure(spark, t, schema)
    waiting = reparse(bucketed.read(spark, t).where(F.col(RESCUE_COLUMN).isNotNull()), schema).where("__taken > 0")
    per_part = waiting.groupBy(t.partition).count().collect()      # one row for each partition (a day)
    if not per_part:
        return 0
    bucketed.rewrite(spark, t, [r[0] for r in per_part], lambda rows: reparse(rows, schema).drop("__taken"))
    return sum(r[1] for r in per_part)


def waiting_rows(spark: SparkSession, quarantine: str) -> DataFrame | None:
    """Quarantined rows that no repair has settled."""
    if not table_exists(spark, quarantine):
        return None
    rows = read_table(spark, quarantine)
    settled = f"{quarantine}_settled"
    return rows.join(spark.read.parquet(settled), CONTENT_HASH, "left_anti") if table_exists(spark, settled) else rows


def repair(spark: SparkSession, t: BucketedTable, quarantine: str, schema: T.StructType, key: Column) -> Repaired:
    """One turn of the loop. ``key`` gives a row's key from its columns under
    the newer schema; NULL leaves the row in quarantine."""
    values = repair_bronze(spark, t, schema)
    rows = waiting_rows(spark, quarantine)
    if rows is None:
        return Repaired(values, 0, 0)
    again = reparse(rows, schema).withColumn(t.key, key.cast("string"))
    ready = again.where(F.col(t.key).isNotNull())
    hashes = ready.select(CONTENT_HASH).distinct()
    merged = bucketed.insert_new(spark, ready.drop(CONTENT_HASH, "__taken"), t, null_keys=False)
    # settled only after bronze has them; a row whose key was there already is settled too
    hashes.write.mode("append").parquet(f"{quarantine}_settled")
    return Repaired(values, merged.written, waiting_rows(spark, quarantine).count())
