"""Registered queries of the document path: landing, bronze merge,
watermarks, control log, replay (J1, C1, C3-C5, C9, P2, A4, T1, K1, S1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.config import CollectionConfig
from ingot.plans.bronze import process_collection, run_all
from ingot.operators.control import ControlLog
from ingot.queries.common import catalogue_schema, iso_sql, run_config, table, ticking_clock
from ingot.sources.tables import list_catalog_tables, read_catalog_table

# Two overlapping deliveries of the events collection: the first holds
# everything before OVERLAP_END, the second everything from OVERLAP_START
# on, re-sent with changed values. Together they cover the whole table.
OVERLAP_START = "2024-01-10 00:00:00"
OVERLAP_END = "2024-01-20 00:00:00"
VALUE_SHIFT = 1000.0

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def bronze_insert_only_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load, then a second delivery overlapping the first: only new
    keys are inserted and matched rows keep their first values. Bronze is a
    bucketed catalogue table, read by name."""
    events = table(spark, sf_dir, "events")
    coll = CollectionConfig("events", "full", id_field="event_id")
    cfg = run_config(spark, "bronze-events", [coll], bronze_schema=catalogue_schema())
    control = ControlLog(spark, cfg.control_path)
    clock = ticking_clock()
    first = events.where(F.col("ts") < F.lit(OVERLAP_END).cast("timestamp_ntz"))
    second = events.where(F.col("ts") >= F.lit(OVERLAP_START).cast("timestamp_ntz")) \
        .withColumn("value", F.col("value") + F.lit(VALUE_SHIFT))
    for src in (first, second):
        rec = process_collection(spark, cfg, coll, src, control, clock=clock)
        if rec["status"] == "FAILED":
            raise RuntimeError(rec["mensagem_erro"])
    bronze = spark.table(f"{cfg.bronze_schema}.events")
    return bronze.select(*EVENT_COLS, "_source_id", "_load_type", "_source_path",
                         F.col("_ingestion_date").cast("string").alias("_ingestion_date"))


def _bronze_events_sql() -> str:
    cols = f"event_id, {iso_sql('ts')} AS ts, user_id, event_type"
    tail = ("props, CAST(event_id AS VARCHAR) AS _source_id, 'full' AS _load_type, "
            "'document_source' AS _source_path, '2024-02-01' AS _ingestion_date")
    return f"""
SELECT {cols}, value, {tail} FROM events WHERE ts < TIMESTAMP '{OVERLAP_END}'
UNION ALL
SELECT {cols}, value + {VALUE_SHIFT} AS value, {tail} FROM events
WHERE ts >= TIMESTAMP '{OVERLAP_START}'
  AND event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '{OVERLAP_END}')
"""


# ------------------------------------------------------------ J1, K5: evolution inside structs and arrays
EVOLVED_FROM = "1998-01-01"


def nested_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents with their lines, in two deliveries. The second
    one's documents have a field more inside the customer struct and inside
    every element of the lines; bronze's schema grows there, and rows of the
    first delivery read as NULL."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    orders = table(spark, sf_dir, "orders")
    old = orders.where(F.col("o_orderdate") < F.lit(EVOLVED_FROM).cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit(EVOLVED_FROM).cast("timestamp_ntz"))
    number, quantity = F.col("l_linenumber").alias("number"), F.col("l_quantity").alias("quantity")
    customer = F.col("o_custkey").alias("id")
    deliveries = [
        old.join(lines.agg(F.collect_list(F.struct(number, quantity)).alias("lines")), old.o_orderkey == F.col("l_orderkey"), "left")
        .select("o_orderkey", F.struct(customer).alias("customer"), "lines"),
        new.join(lines.agg(F.collect_list(F.struct(number, quantity, F.col("l_extendedprice").alias("price"))).alias("lines")),
                 new.o_orderkey == F.col("l_orderkey"), "left")
        .select("o_orderkey", F.struct(customer, F.col("o_orderstatus").alias("status")).alias("customer"), "lines")]
    coll = CollectionConfig("orders", "full", id_field="o_orderkey")
    cfg = run_config(spark, "nested-evolution", [coll], bronze_schema=catalogue_schema())
    control, clock = ControlLog(spark, cfg.control_path), ticking_clock()
    for src in deliveries:
        rec = process_collection(spark, cfg, coll, src, control, clock=clock)
        if rec["status"] == "FAILED":
            raise RuntimeError(rec["mensagem_erro"])
    bronze = spark.table(f"{cfg.bronze_schema}.orders")
    priced = F.filter("lines", lambda x: x["price"].isNotNull())
    return bronze.select(
        "o_orderkey", F.col("customer.id").alias("customer_id"), F.col("customer.status").alias("customer_status"),
        F.size(F.coalesce("lines", F.array())).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("lines", F.lit(0.0), lambda a, x: a + x["quantity"]), F.lit(0.0)).alias("quantity"),
        F.size(F.coalesce(priced, F.array())).cast("long").alias("n_priced"),
        F.array_max(F.transform("lines", lambda x: x["price"])).alias("highest_price"),
        F.col("_rescued_data").isNull().alias("nothing_rescued"))


_NESTED_EVOLUTION_SQL = f"""
SELECT o_orderkey, o_custkey AS customer_id,
       CASE WHEN o_orderdate >= TIMESTAMP '{EVOLVED_FROM}' THEN o_orderstatus END AS customer_status,
       count(l_orderkey) AS n_lines, CAST(coalesce(sum(l_quantity), 0) AS DOUBLE) AS quantity,
       CASE WHEN o_orderdate >= TIMESTAMP '{EVOLVED_FROM}' THEN count(l_orderkey) ELSE 0 END AS n_priced,
       CASE WHEN o_orderdate >= TIMESTAMP '{EVOLVED_FROM}' THEN max(l_extendedprice) END AS highest_price,
       true AS nothing_rescued
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate
"""


# ------------------------------------------------------------ K5, S10, S14: the schema's tables
BRONZE_TYPES = ("click", "error", "purchase", "signup", "view")


def bronze_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type loaded as a collection of its own into the tables of
    one catalogue schema, delivered twice; the schema's tables are listed and
    read by name."""
    events = table(spark, sf_dir, "events")
    colls = [CollectionConfig(t, "full", id_field="event_id") for t in BRONZE_TYPES]
    cfg = run_config(spark, "bronze-catalogue", colls, bronze_schema=catalogue_schema())
    clock = ticking_clock()
    for _ in range(2):
        run_all(spark, cfg, {t: events.where(F.col("event_type") == t) for t in BRONZE_TYPES}, clock,
                parallelism=len(BRONZE_TYPES))
    out = None
    for r in list_catalog_tables(spark, cfg.bronze_schema).collect():
        one = read_catalog_table(spark, f"{cfg.bronze_schema}.{r.table_name}").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_source_id").alias("n_keys")) \
            .select(F.lit(r.table_name).alias("table_name"), F.lit(r.table_type).alias("table_type"), "n_rows", "n_keys")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "bronze_insert_only_events": bronze_insert_only_events,
    "nested_evolution": nested_evolution,
    "bronze_catalogue": bronze_catalogue,
}

ORACLES = {
    "bronze_insert_only_events": _bronze_events_sql(),
    "nested_evolution": _NESTED_EVOLUTION_SQL,
    "bronze_catalogue": """
SELECT event_type AS table_name, 'EXTERNAL' AS table_type, count(*) AS n_rows, count(DISTINCT event_id) AS n_keys
FROM events GROUP BY event_type""",
}
