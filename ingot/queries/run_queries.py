"""Registered queries about runs and what they left: statuses, content
reconciliation, overlap of runs, the replayed stream (C2, C3, M1, M3, M6,
X14, X15). Whole tables; state goes to fresh folders and is read back."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.config import ERROR_MESSAGE_LIMIT, CollectionConfig
from ingot.functions.scalars import elapsed_seconds, normalise_types, truncate
from ingot.operators import bucketed
from ingot.operators.content import content_diff
from ingot.operators.control import ControlLog, run_overlap
from ingot.operators.merge import read_table
from ingot.plans.bronze import bronze_table, process_collection, run_all
from ingot.queries.bronze_queries import EVENT_COLS, OVERLAP_END, OVERLAP_START, VALUE_SHIFT
from ingot.queries.common import catalogue_schema, run_config, table, ticking_clock
from ingot.queries.state_queries import _CONTROL_SQL, events_as_control
from ingot.session import list_dir, new_workspace, remove
from ingot.sources.landing import read_landing
from ingot.streaming.file_ingest import ingest_available


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ------------------------------------------------------------ M6, C2: content
GONE_TYPE, LOST_TYPE = "signup", "error"


def content_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping deliveries of events; the second has changed values
    and no more signups. Bronze keeps first values and then loses the errors.
    Landing and bronze are reconciled with the source as it is now, by
    content: every missing, extra and changed key is named."""
    events = table(spark, sf_dir, "events")
    shifted = events.withColumn("value", F.when(F.col("ts") >= _at(OVERLAP_START), F.col("value") + VALUE_SHIFT)
                                .otherwise(F.col("value")))
    source = shifted.where(F.col("event_type") != GONE_TYPE)
    coll = CollectionConfig("events", "full", id_field="event_id")
    cfg = run_config(spark, "content", [coll], bronze_schema=catalogue_schema())
    control, clock = ControlLog(spark, cfg.control_path), ticking_clock()
    for src in (events.where(F.col("ts") < _at(OVERLAP_END)), source.where(F.col("ts") >= _at(OVERLAP_START))):
        process_collection(spark, cfg, coll, src, control, clock=clock)
    bronze = bronze_table(spark, cfg, "events", events)
    lost = bucketed.read(spark, bronze).where(F.col("event_type") == LOST_TYPE).select("_source_id")
    bucketed.delete_keys(spark, bronze, lost)
    pages = [path for _, path, is_dir, _ in list_dir(spark, f"{cfg.landing_dir}/events") if is_dir]
    landed = read_landing(spark, pages, normalise_types(events).schema, rescue=False)
    return content_diff(source, {"landing": landed, "bronze": bucketed.read(spark, bronze)}, "event_id", EVENT_COLS)


CONTENT_SQL = f"""
WITH s AS (SELECT event_id, event_type, ts < TIMESTAMP '{OVERLAP_END}' AS first, ts >= TIMESTAMP '{OVERLAP_START}' AS second,
                  event_type <> '{GONE_TYPE}' AS there FROM events),
n AS (SELECT *, CASE WHEN there THEN 1 ELSE 0 END AS n_source,
             (CASE WHEN first THEN 1 ELSE 0 END) + (CASE WHEN second AND there THEN 1 ELSE 0 END) AS n_landed FROM s),
d AS (
  SELECT 'landing' AS side, event_id, n_source, n_landed AS n_copy, first AND second AS old FROM n
  UNION ALL
  SELECT 'bronze', event_id, n_source, CASE WHEN event_type = '{LOST_TYPE}' THEN 0 ELSE least(n_landed, 1) END, first AND second FROM n)
SELECT side, CAST(event_id AS VARCHAR) AS key,
       CASE WHEN n_copy = 0 THEN 'missing' WHEN n_source = 0 THEN 'extra' ELSE 'changed' END AS problem,
       CAST(n_source AS BIGINT) AS n_source, CAST(n_copy AS BIGINT) AS n_copy
FROM d WHERE n_source <> n_copy OR (old AND n_source > 0)
"""


# ------------------------------------------------------------ M3: overlap of runs
def run_overlap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs active at once and idle gaps of each collection (events as runs)."""
    return run_overlap(events_as_control(table(spark, sf_dir, "events")))


RUN_OVERLAP_SQL = f"""
WITH {_CONTROL_SQL},
m AS (SELECT collection, epoch_us(start_time) AS t, 1 AS d FROM control
      UNION ALL SELECT collection, epoch_us(end_time), -1 FROM control),
g AS (SELECT collection, t, sum(d) AS d FROM m GROUP BY collection, t),
r AS (SELECT collection, sum(d) OVER w AS active, lead(t) OVER w - t AS us FROM g
      WINDOW w AS (PARTITION BY collection ORDER BY t))
SELECT collection, CAST(max(active) AS BIGINT) AS most_active,
       CAST(coalesce(sum(us) FILTER (WHERE active >= 2), 0) AS BIGINT) AS overlap_us,
       CAST(coalesce(sum(us) FILTER (WHERE active = 0 AND us IS NOT NULL), 0) AS BIGINT) AS idle_us,
       count(*) FILTER (WHERE active = 0 AND us IS NOT NULL) AS gaps,
       CAST(coalesce(max(us) FILTER (WHERE active = 0), 0) AS BIGINT) AS longest_gap_us
FROM r GROUP BY collection
"""


# ------------------------------------------------------------ C2, C3, X14, X15: statuses
FAILURE = "source is not there: " + "no answer; " * 200


def control_status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as collections under the original rules: views lack keys
    (PARTIAL), clicks come twice (PARTIAL), errors have no source (FAILED, the
    message cut), the others are whole (SUCCESS). Statuses, counts, duration
    and message as the log keeps them."""
    events = table(spark, sf_dir, "events")
    of = {t: events.where(F.col("event_type") == t) for t in ("click", "purchase", "signup", "view")}

    def gone():
        raise RuntimeError(FAILURE)

    sources = of | {"click": of["click"].unionByName(of["click"]), "error": gone,
                    "view": of["view"].withColumn("event_id", F.when(F.col("user_id") % 2 == 0, F.col("event_id")))}
    colls = [CollectionConfig(t, "full", id_field="event_id") for t in sorted(sources)]
    cfg = run_config(spark, "statuses", colls, watermark_rule="reference")
    run_all(spark, cfg, sources, ticking_clock())
    log = ControlLog(spark, cfg.control_path).read()
    return log.select("collection", "status", "qtd_lida_origem", "qtd_gravada_destino", "duracao_seg",
                      (F.col("duracao_seg") == elapsed_seconds(F.col("start_time"), F.col("end_time"))).alias("duration_agrees"),
                      F.length("mensagem_erro").cast("long").alias("message_length"),
                      truncate(F.col("mensagem_erro"), 19).alias("message_start"))


CONTROL_STATUS_SQL = f"""
WITH c AS (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE user_id % 2 <> 0) AS odd FROM events GROUP BY event_type),
m AS (SELECT *, CASE event_type WHEN 'click' THEN 2 * n WHEN 'error' THEN 0 ELSE n END AS rows,
        CASE event_type
          WHEN 'click' THEN 'divergencia=0.00% (limiar=1.0%) nulos_id=0.0% duplicados_no_lote=' || n
          WHEN 'view' THEN 'divergencia=0.00% (limiar=1.0%) nulos_id=' || CAST(round(100.0 * odd / n, 4) AS VARCHAR)
                           || '% duplicados_no_lote=' || CASE WHEN odd > 1 THEN 1 ELSE 0 END
          WHEN 'error' THEN '{FAILURE[:ERROR_MESSAGE_LIMIT]}' END AS message FROM c)
SELECT event_type AS collection,
       CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'PARTIAL'
            WHEN 'view' THEN CASE WHEN odd > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END ELSE 'SUCCESS' END AS status,
       CAST(rows AS BIGINT) AS qtd_lida_origem, CAST(rows AS BIGINT) AS qtd_gravada_destino,
       CAST(CASE event_type WHEN 'error' THEN 0 ELSE 120 END AS DOUBLE) AS duracao_seg, true AS duration_agrees,
       length(message) AS message_length, substr(message, 1, 19) AS message_start
FROM m
"""


# ------------------------------------------------------------ M1: a micro-batch that comes again
STREAM_SPLIT = "2024-01-15 00:00:00"


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of event files picked up by a checkpointed stream; rows
    of errors have no key. The second micro-batch loses its commit and comes
    again. Bronze, quarantine and control rows as they stand then."""
    ws = new_workspace(spark, "stream-replay")
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"), F.col("event_id").alias("seq"), "event_type")
    parts = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "ts")
    events = events.join(parts, "seq")
    control = ControlLog(spark, f"{ws}/control")
    late = F.col("ts") >= _at(STREAM_SPLIT)
    args = (spark, f"{ws}/landing", None, f"{ws}/bronze", f"{ws}/checkpoint", "id", "stream", _dt.datetime(2024, 2, 1))
    for i, part in enumerate((events.where(~late), events.where(late))):
        part.drop("ts").write.option("ignoreNullFields", "false").json(f"{ws}/landing/delivery={i}")
        ingest_available(*args, collection="events", control=control)
    for name, path, _, _ in list_dir(spark, f"{ws}/checkpoint/commits"):
        if name.lstrip(".").split(".")[0] == "1":
            remove(spark, path)
    ingest_available(*args, collection="events", control=control)
    rows = [read_table(spark, f"{ws}/{folder}").select(F.lit(place).alias("place"), "seq", "event_type")
            for place, folder in (("bronze", "bronze"), ("quarantine", "bronze_quarantine"))]
    runs = control.read().select(F.lit("control").alias("place"), F.col("qtd_lida_origem").alias("seq"),
                                 F.col("status").alias("event_type"))
    return rows[0].unionByName(rows[1]).unionByName(runs)


STREAM_REPLAY_SQL = f"""
SELECT CASE WHEN event_type = 'error' THEN 'quarantine' ELSE 'bronze' END AS place, event_id AS seq, event_type FROM events
UNION ALL
SELECT 'control', count(*), 'SUCCESS' FROM events GROUP BY ts < TIMESTAMP '{STREAM_SPLIT}'
"""


QUERIES = {
    "content_reconcile": content_reconcile,
    "run_overlap": run_overlap_q,
    "control_status_rows": control_status_rows,
    "stream_replay": stream_replay,
}

ORACLES = {
    "content_reconcile": CONTENT_SQL,
    "run_overlap": RUN_OVERLAP_SQL,
    "control_status_rows": CONTROL_STATUS_SQL,
    "stream_replay": STREAM_REPLAY_SQL,
}
