"""Registered queries of the path catalogue and of kept profiles (A7, A9, M4,
X8). Whole tables; profiles go to a fresh folder and are read back."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.functions.scalars import normalise_types
from ingot.operators.paths import path_catalogue
from ingot.operators.profiles import (DISTINCT_ERROR, RANK_ERROR, drift, keep_profile, merge_profiles, n_distinct,
                                      quantile, read_profiles, top_values)
from ingot.queries.common import iso_sql, table
from ingot.session import new_workspace

# Documents around an event's props whose shape drifts, one kind of drift per
# remainder of event_id; these rules only shape test data.
_BODIES = (
    "props",
    "'{\"p\":' || props || ',\"k\":\"' || event_type || '\",\"tags\":[\"a\",{\"b\":' || id || ',\"c\":[]}]}'",
    "'{\"k\":null,\"odd.key\":' || id || '}'",
    "'{\"k\":' || id || '.5,\"p\":{\"k\":null,\"q\":[' || id || ',null,0.25,[true,[' || id || ']]]}}'",
    "'{broken ' || id",
    "'[' || id || ',' || props || ']'",
)
_CASES = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(_BODIES))
_BODY = f"CASE event_id % {len(_BODIES)} {_CASES} END"


def json_path_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every path of the drifting documents of all events: type, kinds, values,
    nulls, and objects without it."""
    events = table(spark, sf_dir, "events").withColumn("id", F.col("event_id").cast("string"))
    # two steps in the first pass: the documents are deeper, so it is made again
    return path_catalogue(events.select(F.expr(_BODY).alias("body")), "body", steps=2)


JSON_PATH_SQL = f"""
WITH e AS (SELECT *, CAST(event_id AS VARCHAR) AS id FROM events),
d AS (SELECT {_BODY} AS body FROM e WHERE {_BODY} IS NOT NULL),
good AS (SELECT CASE WHEN json_valid(body) THEN body ELSE 'null' END AS body FROM d WHERE json_valid(body)),
w AS (SELECT t.fullkey, t.path AS up, t.type FROM good, json_tree(good.body) AS t),
v AS (SELECT replace(regexp_replace(fullkey, '\\[[0-9]+\\]', '[*]', 'g'), '."odd.key"', '[''odd.key'']') AS path,
             CASE WHEN fullkey = '$' THEN NULL ELSE regexp_replace(up, '\\[[0-9]+\\]', '[*]', 'g') END AS parent,
             CASE type WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'decimal'
                       WHEN 'VARCHAR' THEN 'string' ELSE lower(type) END AS kind FROM w
      UNION ALL SELECT '$', NULL, 'malformed' FROM d WHERE NOT json_valid(body)),
p AS (SELECT path, parent, list_sort(list_distinct(list(kind))) AS kinds,
             list_sort(list_distinct(list(kind) FILTER (WHERE kind NOT IN ('null', 'malformed')))) AS told,
             count(*) FILTER (WHERE kind <> 'malformed') AS n_values, count(*) FILTER (WHERE kind = 'null') AS n_null
      FROM v GROUP BY path, parent),
o AS (SELECT path, count(*) AS n FROM v WHERE kind = 'object' GROUP BY path)
SELECT p.path, CASE WHEN coalesce(len(told), 0) = 0 THEN 'null' WHEN len(told) = 1 THEN told[1]
                    WHEN told = ['bigint', 'decimal'] THEN 'decimal' ELSE 'variant' END AS type,
       array_to_string(kinds, ',') AS kinds, n_values, n_null,
       CASE WHEN n_values = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * n_null / n_values, 4) END AS pct_null,
       CAST(CASE WHEN p.path LIKE '%[*]' OR o.n IS NULL THEN 0 ELSE o.n - n_values END AS BIGINT) AS n_missing
FROM p LEFT JOIN o ON o.path = p.parent
"""

# Runs by day ranges; the last one changes: values are larger by SHIFT and
# users are known for clicks only.
RUNS = (("run-1", "2024-01-01", "2024-01-08"), ("run-2", "2024-01-08", "2024-01-15"),
        ("run-3", "2024-01-15", "2024-01-22"), ("run-4", "2024-01-22", "2025-01-01"))
LAST_RUN, SHIFT = "run-4", 1000.0
PROFILED = ("event_id", "ts", "user_id", "event_type", "value")


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of four runs, each kept as it ran (the third twice), merged per
    column. Counts and ranges are exact; sketched figures are held against the
    rows within their stated bounds, and the last run's drift told."""
    events = normalise_types(table(spark, sf_dir, "events"))
    last = F.col("ts") >= RUNS[-1][1]
    rows = events.select("event_id", "ts", F.when(~last | (F.col("event_type") == "click"), F.col("user_id")).alias("user_id"),
                         "event_type", F.when(last, F.col("value") + SHIFT).otherwise(F.col("value")).alias("value"))
    path = f"{new_workspace(spark, 'profiles')}/events"
    for i, (run, lo, hi) in enumerate((*RUNS, RUNS[2])):
        part = rows.where((F.col("ts") >= lo) & (F.col("ts") < hi))
        keep_profile(part, path, run, _dt.datetime(2024, 2, 1 + min(i, 3)), list(PROFILED))
    profiles = read_profiles(spark, path)
    merged = merge_profiles(profiles).withColumn("median", quantile("rank_sketch", 0.5))
    middle = {r.column_name: r["median"] for r in merged.select("column_name", "median").collect()}     # one row per column
    truth = rows.agg(F.struct(*[F.count_distinct(c).alias(c) for c in PROFILED]).alias("n"),
                     F.struct(*[F.avg((F.col(c) <= middle[c]).cast("double")).alias(c) if middle[c] is not None
                                else F.lit(None).cast("double").alias(c) for c in PROFILED]).alias("rank"))
    truth = truth.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n.{c}").alias("n_true"),
                                                     F.col(f"rank.{c}").alias("true_rank")) for c in PROFILED])))
    shown = drift(profiles, LAST_RUN).select(
        "column_name", "null_change", (F.col("rank_shift") > 0.3).alias("values_moved"))
    top = F.get(top_values("top_sketch", 1), F.lit(0))
    return merged.join(truth, "column_name").join(shown, "column_name").select(
        "column_name", "n_runs", "n_rows", "n_nulls", "low", "high", "low_text", "high_text",
        (F.abs(n_distinct("distinct_sketch") - F.col("n_true")) <= F.ceil(DISTINCT_ERROR * F.col("n_true"))).alias("distinct_in_bound"),
        (F.abs(F.col("true_rank") - 0.5) <= RANK_ERROR).alias("median_in_bound"),
        F.when(F.col("column_name") == "event_type", top["item"]).alias("top_value"),
        F.when(F.col("column_name") == "event_type", top["count"]).alias("top_count"),
        F.round("null_change", 6).alias("null_change"), "values_moved")


def _profile_sql() -> str:
    spans = " ".join(f"WHEN ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}' THEN '{run}'" for run, lo, hi in RUNS)
    last = f"run = '{LAST_RUN}'"
    head = f"""WITH e AS (SELECT *, CASE {spans} END AS run FROM events),
r AS (SELECT run, event_id, ts, CASE WHEN {last} AND event_type <> 'click' THEN NULL ELSE user_id END AS user_id, event_type,
             CASE WHEN {last} THEN value + {SHIFT} ELSE value END AS value FROM e WHERE run IS NOT NULL)"""
    parts = []
    for c in PROFILED:
        number = c in ("event_id", "user_id", "value")
        text = iso_sql(c) if c == "ts" else c
        moved = {"event_id": "true", "value": "true", "user_id": "false"}.get(c, "CAST(NULL AS BOOLEAN)")
        top = "(SELECT {} FROM r GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)" if c == "event_type" else "NULL"
        parts.append(f"""
SELECT '{c}' AS column_name, count(DISTINCT run) AS n_runs, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
       {f'CAST(min({c}) AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS low,
       {f'CAST(max({c}) AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS high,
       {'CAST(NULL AS VARCHAR)' if number else f'min({text})'} AS low_text,
       {'CAST(NULL AS VARCHAR)' if number else f'max({text})'} AS high_text,
       true AS distinct_in_bound, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS median_in_bound,
       CAST({top.format('event_type')} AS VARCHAR) AS top_value, CAST({top.format('count(*)')} AS BIGINT) AS top_count,
       round(1.0::DOUBLE * (count(*) FILTER (WHERE {last} AND {c} IS NULL)) / (count(*) FILTER (WHERE {last}))
             - 1.0::DOUBLE * (count(*) FILTER (WHERE NOT {last} AND {c} IS NULL)) / (count(*) FILTER (WHERE NOT {last})), 6) AS null_change,
       {moved} AS values_moved FROM r""")
    return head + "\nUNION ALL".join(parts)


QUERIES = {
    "json_path_catalogue": json_path_catalogue,
    "profile_merged": profile_merged,
}

ORACLES = {
    "json_path_catalogue": JSON_PATH_SQL,
    "profile_merged": _profile_sql(),
}
