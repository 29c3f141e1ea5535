"""Registered queries of whole steps: bronze to silver, exploration with its
tags written and read back (M2, J2, C8, P5, P14). Whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.config import CollectionConfig
from ingot.operators import bucketed
from ingot.operators.control import ControlLog
from ingot.operators.quality import empty_or_null
from ingot.plans.bronze import bronze_table, process_collection
from ingot.plans.exploration import explore
from ingot.plans.silver import enrich, to_silver
from ingot.queries.bronze_queries import OVERLAP_END, OVERLAP_START
from ingot.queries.common import catalogue_schema, iso_sql, run_config, table, ticking_clock
from ingot.session import new_workspace


# ------------------------------------------------------------ M2, J2: silver
def silver_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a nested origin and an array of marks come to bronze in two
    overlapping deliveries; silver is the newest event of each user, flattened,
    one row per mark, with the segment of the customer of that number."""
    events = table(spark, sf_dir, "events")
    marks = F.when(F.col("event_type") == "error", F.lit(None).cast("array<string>")) \
        .when(F.col("event_type") == "view", F.array().cast("array<string>")) \
        .otherwise(F.array("event_type", F.col("event_id").cast("string")))
    docs = events.select("event_id", "ts", F.struct("user_id", F.struct("event_type").alias("kind")).alias("origin"),
                         marks.alias("marks"))
    coll = CollectionConfig("events", "full", id_field="event_id")
    cfg = run_config(spark, "silver", [coll], bronze_schema=catalogue_schema())
    control, clock = ControlLog(spark, cfg.control_path), ticking_clock()
    for part in (docs.where(F.col("ts") < F.lit(OVERLAP_END).cast("timestamp_ntz")),
                 docs.where(F.col("ts") >= F.lit(OVERLAP_START).cast("timestamp_ntz"))):
        process_collection(spark, cfg, coll, part, control, clock=clock)
    bronze = bucketed.read(spark, bronze_table(spark, cfg, "events", docs)) \
        .select("origin", "ts", "event_id", "marks", F.col("origin.user_id").alias("user"))
    silver = to_silver(bronze, "user", ["ts", "event_id"], explode=["marks"])
    joined = enrich(silver, table(spark, sf_dir, "customer"), "user", "c_custkey", ["c_mktsegment"])
    return joined.select(F.col("origin_user_id").alias("user_id"), F.col("origin_kind_event_type").alias("event_type"),
                         "ts", "event_id", F.col("marks").alias("mark"), F.col("c_mktsegment").alias("segment"))


SILVER_SQL = f"""
WITH n AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
m AS (SELECT user_id, event_type, ts, event_id, unnest([event_type, CAST(event_id AS VARCHAR)]) AS mark FROM n
      WHERE event_type NOT IN ('error', 'view')
      UNION ALL SELECT user_id, event_type, ts, event_id, NULL FROM n WHERE event_type IN ('error', 'view'))
SELECT m.user_id, event_type, {iso_sql('ts')} AS ts, event_id, mark, c_mktsegment AS segment
FROM m LEFT JOIN customer ON c_custkey = m.user_id
"""


# ------------------------------------------------------------ C8, P5, P14: exploration
EXPLORED_AT = "2024-02-01 00:00:00"


def exploration_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw part documents explored: the size of all, and the words that only
    large parts have, in a field that the first documents lack. The tagged
    documents overwrite a snapshot, twice, and are read back."""
    part = table(spark, sf_dir, "part")
    words = F.when(F.col("p_size") > 40, F.split("p_name", " ")).when(F.col("p_size") > 30, F.array().cast("array<string>"))
    body = F.to_json(F.struct("p_partkey", F.struct(F.col("p_size").cast("string").alias("size"), words.alias("words")).alias("about")))
    raw = part.select(F.col("p_partkey").cast("string").alias("_id"), body.alias("body")).orderBy("p_size")
    target = f"{new_workspace(spark, 'explored')}/part"
    for _ in range(2):
        explore(raw, {"_id": "_id", "size": "about.size", "words": "about.words"}, {"size": "int"}, empty_or_null("words"),
                "words not informed", "source://part", F.lit(EXPLORED_AT).cast("timestamp"), target=target)
    tagged = spark.read.parquet(target)
    return tagged.select("_id", "size", F.array_join("words", " ").alias("words"), "origem", "motivo",
                         F.date_format("quarentena_em", "yyyy-MM-dd HH:mm:ss").alias("quarentena_em"))


EXPLORATION_SQL = f"""
WITH t AS (SELECT *, p_size > 40 AS large FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS _id, CAST(p_size AS INTEGER) AS size,
       CASE WHEN large THEN p_name WHEN p_size > 30 THEN '' END AS words, 'source://part' AS origem,
       CASE WHEN NOT large THEN 'words not informed' END AS motivo, CASE WHEN NOT large THEN '{EXPLORED_AT}' END AS quarentena_em
FROM t
"""

QUERIES = {
    "silver_from_bronze": silver_from_bronze,
    "exploration_tags": exploration_tags,
}

ORACLES = {
    "silver_from_bronze": SILVER_SQL,
    "exploration_tags": EXPLORATION_SQL,
}
