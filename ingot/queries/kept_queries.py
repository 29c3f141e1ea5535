"""Registered queries of kept state and repair (M2, W1, M8, P14). Whole
tables; state goes to fresh folders and is read back."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.scalars import iso_text
from ingot.operators import bucketed
from ingot.operators.bucketed import BucketedTable
from ingot.operators.repair import repair
from ingot.operators.state import apply_latest, apply_versions, read_intervals, read_state
from ingot.plans.bronze import landing_to_bronze
from ingot.queries.common import catalogue_schema, iso_sql, table
from ingot.session import new_workspace

# Three deliveries of the events table; the middle one comes last, and
# neighbours overlap.
CUTS = (("2024-01-01", "2024-01-12"), ("2024-01-18", "2024-12-31"), ("2024-01-10", "2024-01-20"))


def _deliveries(events: DataFrame):
    for lo, hi in CUTS:
        yield events.where((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))


def kept_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event of each user, kept over three deliveries."""
    events = table(spark, sf_dir, "events")
    path = f"{new_workspace(spark, 'kept-latest')}/state"
    for part in _deliveries(events):
        apply_latest(spark, path, part, ["user_id"], ["ts", "event_id"], buckets=16)
    return read_state(spark, path).select("user_id", "event_id", iso_text(F.col("ts")).alias("ts"), "event_type", "value", "props")


def kept_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From when to when a user's last event was of a type, kept over three
    deliveries of which the last is late."""
    events = table(spark, sf_dir, "events")
    path = f"{new_workspace(spark, 'kept-validity')}/state"
    for part in _deliveries(events):
        apply_versions(spark, path, part, ["user_id"], "ts", ["event_type"], buckets=16)
    return read_intervals(spark, path).select("user_id", "event_type", iso_text(F.col("valid_from")).alias("valid_from"),
                                          iso_text(F.col("valid_to")).alias("valid_to"))


_INSIDE = " OR ".join(f"(ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}')" for lo, hi in CUTS)


def rescue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land as JSON lines of which the first schema knows only the id
    and the type; errors have their id under another name and are
    quarantined. A repair under the full schema takes the rescued values into
    bronze and the quarantined rows after them; a second one finds nothing."""
    ws = new_workspace(spark, "repair")
    events = table(spark, sf_dir, "events")
    error = F.col("event_type") == "error"
    events.select(F.when(~error, F.col("event_id")).alias("event_id"), F.when(error, F.col("event_id")).alias("id"),
                  "event_type", "user_id", "value", F.struct("user_id").alias("origin")).write.json(f"{ws}/landing")
    first = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    t = BucketedTable(catalogue_schema(), "events", f"{ws}/bronze/events", buckets=8)
    quarantine = f"{ws}/quarantine"
    landing_to_bronze(spark, f"{ws}/landing", "events", "event_id", "run-1", "full", t.path, _dt.datetime(2024, 2, 1), first,
                      quarantine_path=quarantine, table=t)
    newer = T.StructType([*first.fields, T.StructField("id", T.LongType()), T.StructField("user_id", T.LongType()),
                          T.StructField("value", T.DoubleType()),
                          T.StructField("origin", T.StructType([T.StructField("user_id", T.LongType())]))])
    key = F.coalesce("event_id", "id")
    turns = [repair(spark, t, quarantine, newer, key) for _ in range(2)]
    return bucketed.read(spark, t).select(
        F.col("_source_id").cast("long").alias("key"), "event_type", "user_id", "value",
        F.col("origin.user_id").alias("origin_user"), F.col("_rescued_data").isNull().alias("settled"),
        F.lit(turns[0].values + turns[0].rows).cast("long").alias("first_turn"),
        F.lit(turns[1].values + turns[1].rows + turns[1].left).cast("long").alias("second_turn"))


QUERIES = {
    "kept_latest": kept_latest,
    "kept_validity": kept_validity,
    "rescue_repair": rescue_repair,
}

ORACLES = {
    "kept_latest": f"""
SELECT user_id, event_id, {iso_sql('ts')} AS ts, event_type, value, props FROM events
WHERE {_INSIDE} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "kept_validity": f"""
WITH v AS (SELECT user_id, ts, max(event_type) AS event_type FROM events WHERE {_INSIDE} GROUP BY user_id, ts),
c AS (SELECT * FROM v QUALIFY coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) <> event_type, true))
SELECT user_id, event_type, {iso_sql('ts')} AS valid_from,
       {iso_sql('lead(ts) OVER (PARTITION BY user_id ORDER BY ts)')} AS valid_to FROM c""",
    "rescue_repair": """
SELECT event_id AS key, event_type, user_id, value, user_id AS origin_user, true AS settled,
       (SELECT count(*) FROM events) AS first_turn, CAST(0 AS BIGINT) AS second_turn FROM events""",
}
