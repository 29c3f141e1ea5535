"""Registered queries of the stateless operators over the supplied tables
(P, A, W, T, U, X groups, M4, M5, J2, J3, M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.functions.json import expand_json, infer_json_schema, parse_variant, variant_field
from ingot.functions.rescue import parse_json_lines
from ingot.functions.names import sanitize_columns
from ingot.functions.scalars import iso_text, normalise_types, with_default
from ingot.operators.filters import (all_of, cast_columns, exclude_fields, incremental_filter,
                                     is_missing, key_after, select_nested, watermark_rank)
from ingot.operators.merge import dedup_by_hash, distinct_rows, latest_per_key, row_hash
from ingot.operators.ordering import key_pages
from ingot.operators.quality import (column_profile, contract_check, empty_or_null, key_metrics,
                                     reconcile, removed_by_dedup, source_profile, tag_quarantine)
from ingot.plans.silver import enrich, explode_array, flatten
from ingot.queries.common import iso_sql, table
from ingot.sources.documents import raw_documents, scan_collection

Q: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- P2, S1
BOUND = "2024-01-15T00:00:00"
TEXT_BOUND = "2024-01-15 12:00:00"


@register("incremental_bound_events", f"""
SELECT event_id, {iso_sql('ts')} AS ts, user_id, event_type, value FROM events
WHERE ts > TIMESTAMP '{BOUND.replace('T', ' ')}'""")
def incremental_bound_events(spark: SparkSession, sf: str) -> DataFrame:
    """Typed time column: strict bound pushed into the Parquet scan, the
    excluded field never read."""
    ev = table(spark, sf, "events")
    out = scan_collection(ev, incremental_filter(ev, "ts", BOUND, "date"), exclude=("props",))
    return out.withColumn("ts", iso_text(F.col("ts")))


@register("incremental_bound_text", f"""
SELECT event_id, {iso_sql('ts')} AS ts FROM events WHERE ts > TIMESTAMP '{TEXT_BOUND}'""")
def incremental_bound_text(spark: SparkSession, sf: str) -> DataFrame:
    """Landed text watermark (``T`` separator) against a space-separated
    bound of the same day: compared as instants, not as text."""
    ev = table(spark, sf, "events").select("event_id", iso_text(F.col("ts")).alias("ts"))
    return ev.where(incremental_filter(ev, "ts", TEXT_BOUND, "string"))


# ---------------------------------------------------------------- A4, T1
WM_BOUND = "2024-01-29T00:00:00"


@register("watermark_next", f"""
SELECT event_type, '{WM_BOUND}' AS watermark_inicial,
       count(*) FILTER (WHERE ts > TIMESTAMP '{WM_BOUND.replace('T', ' ')}') AS rows_read,
       coalesce(max({iso_sql('ts')}) FILTER (WHERE ts > TIMESTAMP '{WM_BOUND.replace('T', ' ')}'),
                '{WM_BOUND}') AS watermark_final
FROM events GROUP BY event_type""")
def watermark_next(spark: SparkSession, sf: str) -> DataFrame:
    """Per collection (event type): rows after the stored watermark and the
    next watermark = their max as text, else the old one (A4)."""
    ev = table(spark, sf, "events")
    after = incremental_filter(ev, "ts", WM_BOUND, "date")
    return ev.groupBy("event_type").agg(
        F.lit(WM_BOUND).alias("watermark_inicial"),
        F.count_if(after).cast("long").alias("rows_read"),
        F.max(F.when(after, F.col("ts"))).alias("__max_ts")) \
        .select("event_type", "watermark_inicial", "rows_read",
                F.coalesce(iso_text(F.col("__max_ts")), F.lit(WM_BOUND)).alias("watermark_final"))


# ---------------------------------------------------------------- A11, S5
@register("source_profile", f"""
SELECT o_orderstatus, count(*) AS n_docs, {iso_sql('min(o_orderdate)')} AS min_watermark,
       {iso_sql('max(o_orderdate)')} AS max_watermark,
       count(*) FILTER (WHERE o_orderdate IS NULL) AS n_missing_watermark
FROM orders GROUP BY o_orderstatus""")
def source_profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    p = source_profile(table(spark, sf, "orders"), "o_orderdate", by=["o_orderstatus"])
    return p.withColumns({"min_watermark": iso_text(F.col("min_watermark")),
                          "max_watermark": iso_text(F.col("max_watermark"))})


@register("source_count", """
SELECT count(*) AS n_all, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS n_open FROM orders""")
def source_count(spark: SparkSession, sf: str) -> DataFrame:
    """Source count with and without a filter (S5) as one row."""
    o = table(spark, sf, "orders")
    return o.agg(F.count(F.lit(1)).cast("long").alias("n_all"),
                 F.count_if(F.col("o_orderstatus") == "O").cast("long").alias("n_open"))


# ---------------------------------------------------------------- S1, T2
PAGE_SIZE = 2000


@register("landing_pages", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT CAST(floor((rn - 1) / {PAGE_SIZE}) + 1 AS BIGINT) AS page, count(*) AS n_docs,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM r GROUP BY 1""")
def landing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of key-ordered paging: number, size, first and last key."""
    return key_pages(table(spark, sf, "orders"), "o_orderkey", PAGE_SIZE)


# ---------------------------------------------------------------- P1, X6
@register("exclude_projection", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS embedding_len FROM embeddings""")
def exclude_projection(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return exclude_fields(e.withColumn("embedding_len", F.size("embedding")), ["embedding"])


# ---------------------------------------------------------------- A1-A3, X12
_LINE_KEY_SQL = ("CASE WHEN l_linenumber = 7 THEN NULL "
                 "ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END")


@register("key_quality", f"""
WITH k AS (SELECT l_returnflag, {_LINE_KEY_SQL} AS k FROM lineitem),
     g AS (SELECT l_returnflag, k, count(*) AS n FROM k GROUP BY ALL)
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS total_rows,
       CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       round(100.0 * coalesce(sum(n) FILTER (WHERE k IS NULL), 0) / sum(n), 4) AS pct_null_keys,
       count(*) FILTER (WHERE n > 1) AS duplicate_key_groups, count(k) AS distinct_keys
FROM g GROUP BY l_returnflag""")
def key_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Null and duplicate keys on the composite line key; line 7 is given
    a NULL key (derived, not filtered)."""
    li = table(spark, sf, "lineitem")
    key = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")))
    return key_metrics(li, key, by=["l_returnflag"])


# ---------------------------------------------------------------- C2
# Divergence thresholds per collection (priority), default 1.0.
THRESHOLDS = {"1-URGENT": 0.0, "2-HIGH": 0.5}
LANDED_MIN_PRICE = 2000.0
NULL_KEY_PRICE = 499000.0


@register("reconcile_status", f"""
WITH f AS (
  SELECT o_orderpriority, count(*) AS extracted,
         count(*) FILTER (WHERE o_totalprice >= {LANDED_MIN_PRICE}) AS landed,
         count(*) FILTER (WHERE o_totalprice > {NULL_KEY_PRICE}) AS null_keys,
         CAST(0 AS BIGINT) AS duplicate_key_groups,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 0.5 ELSE 1.0 END AS DOUBLE) AS threshold_pct
  FROM orders GROUP BY o_orderpriority),
d AS (SELECT *, round(100.0 * null_keys / extracted, 4) AS pct_null_keys,
             CASE WHEN extracted = 0 THEN 0.0 ELSE abs(extracted - landed) / extracted * 100.0 END AS div
      FROM f)
SELECT o_orderpriority, extracted, landed, null_keys, duplicate_key_groups, threshold_pct, pct_null_keys,
       round(div, 4) AS divergence_pct,
       CASE WHEN div > threshold_pct OR null_keys > 0 OR duplicate_key_groups > 0
            THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
FROM d""")
def reconcile_status_q(spark: SparkSession, sf: str) -> DataFrame:
    """Reconciliation per collection: extracted vs landed with a threshold
    per collection, null and duplicate keys (C2)."""
    o = table(spark, sf, "orders")
    thr = F.coalesce(*[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in THRESHOLDS.items()],
                     F.lit(1.0))
    figures = o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("extracted"),
        F.count_if(F.col("o_totalprice") >= LANDED_MIN_PRICE).alias("landed"),
        F.count_if(F.col("o_totalprice") > NULL_KEY_PRICE).alias("null_keys"),
        F.lit(0).cast("long").alias("duplicate_key_groups"))
    figures = figures.withColumns({
        "threshold_pct": thr,
        "pct_null_keys": F.round(F.lit(100.0) * F.col("null_keys") / F.col("extracted"), 4)})
    return reconcile(figures).drop("message")


# ---------------------------------------------------------------- W1
@register("latest_per_key", f"""
SELECT user_id, event_id, {iso_sql('ts')} AS ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_per_key_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_per_key(ev, ["user_id"], ["ts"]).withColumn("ts", iso_text(F.col("ts")))


@register("latest_per_key_lineitem", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, {iso_sql('l_shipdate')} AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                                        l_extendedprice DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def latest_per_key_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Composite key with real duplicates; order is total."""
    li = table(spark, sf, "lineitem")
    out = latest_per_key(li, ["l_orderkey", "l_linenumber"],
                         ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.withColumn("l_shipdate", iso_text(F.col("l_shipdate")))


# ---------------------------------------------------------------- U1, A8
@register("distinct_rows", "SELECT DISTINCT lang, text FROM documents")
def distinct_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_rows(table(spark, sf, "documents").select("lang", "text"))


@register("dedup_removed", """
WITH g AS (SELECT lang, text, count(*) AS n FROM documents GROUP BY ALL)
SELECT lang, CAST(sum(n) AS BIGINT) AS rows_read, count(*) AS rows_kept,
       CAST(sum(n) - count(*) AS BIGINT) AS rows_removed FROM g GROUP BY lang""")
def dedup_removed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows removed by the full-row dedup, per language, from one
    ``groupBy(lang, text)`` pass (A8)."""
    return removed_by_dedup(table(spark, sf, "documents"), ["lang", "text"], by=["lang"])


# ---------------------------------------------------------------- X7, P5, A9, X8
@register("json_expand", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Schema of the JSON body inferred over all rows, then the body
    expanded to typed columns."""
    ev = table(spark, sf, "events").select("event_id", "props")
    return expand_json(ev, "props", infer_json_schema(spark, ev, "props"), "event_id")


@register("json_late_key", """
SELECT event_id, user_id, CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN event_type END AS late
FROM events""")
def json_late_key(spark: SparkSession, sf: str) -> DataFrame:
    """A key that only the last document has is in the inferred schema."""
    ev = table(spark, sf, "events")
    newest = ev.agg(F.max("event_id")).first()[0]
    body = F.to_json(F.struct("user_id", F.when(F.col("event_id") == newest, F.col("event_type")).alias("late")))
    docs = ev.select("event_id", body.alias("body"))
    return expand_json(docs, "body", infer_json_schema(spark, docs, "body"), "event_id").select("event_id", "user_id", "late")


# Lines whose values drift from the schema, one kind of drift per remainder
# of event_id; these rules only shape test data.
DRIFT_SCHEMA = "id long, v struct<a:long>, l array<struct<x:long>>, m map<string,long>"
DRIFT_LINES = [
    """{"id":%d,"v":{"a":1},"l":[{"x":1}],"m":{"k":2}}""",
    """{"id":"no-%d","v":{"a":1},"l":[{"x":1}]}""",
    """{"id":1,"e.x":%d,"v":{"a":1}}""",
    """{"id":1,"v":{"a":1,"z":{"y":%d}},"l":null}""",
    """{"id":1,"l":[{"x":1},{"x":"bad","y":%d}]}""",
    """{"id":1,"z":1,"z":%d}""",
    """{"id":1,"m":{"k":2,"w":"x%d"}}""",
    """{broken %d""",
    """{"id":1,"id":%d}""",
]
DRIFT_SQL = r"""
WITH e AS (SELECT event_id, event_id % 9 AS kind, CAST(event_id AS VARCHAR) AS n FROM events)
SELECT event_id, CASE kind
  WHEN 1 THEN '{"id":"no-' || n || '"}'
  WHEN 2 THEN '{"e\\.x":"' || n || '"}'
  WHEN 3 THEN '{"v.z":"{\"y\":' || n || '}"}'
  WHEN 4 THEN '{"l[1].y":"' || n || '","l[1].x":"bad"}'
  WHEN 5 THEN '{"z":"[\"1\",\"' || n || '\"]"}'
  WHEN 6 THEN '{"m":"{\"k\":2,\"w\":\"x' || n || '\"}"}'
  WHEN 7 THEN '{"_corrupt_record":"{broken ' || n || '"}'
  WHEN 8 THEN '{"id":"[\"1\",\"' || n || '\"]"}'
  END AS rescued FROM e"""


@register("rescue_drift", DRIFT_SQL)
def rescue_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Rescued values of drifting, malformed and repeated-key lines."""
    ev = table(spark, sf, "events").select("event_id")
    line = F.element_at(F.array(*[F.lit(x) for x in DRIFT_LINES]), (F.col("event_id") % len(DRIFT_LINES) + 1).cast("int"))
    lines = ev.select("event_id", F.replace(line, F.lit("%d"), F.col("event_id").cast("string")).alias("value"))
    return parse_json_lines(lines, StructType.fromDDL(DRIFT_SCHEMA), keep=["event_id"]) \
        .select("event_id", F.col("_rescued_data").alias("rescued"))


# Texts of one instant in several spellings, and some that are no time.
@register("watermark_text_mixed", """
WITH t AS (SELECT event_type, event_id, ts, CASE event_id % 4
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' ELSE 'n/a ' || event_id END AS text FROM events)
SELECT event_type, arg_max(text, (ts, event_id)) FILTER (event_id % 4 <> 3) AS watermark,
       count(*) FILTER (event_id % 4 = 3) AS unreadable FROM t GROUP BY event_type""")
def watermark_text_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """The next bound over texts with mixed separators: the latest instant,
    never a value that is no time."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.col("event_id") % 4
    text = F.when(kind == 0, iso).when(kind == 1, F.replace(iso, F.lit("T"), F.lit(" "))) \
        .when(kind == 2, F.concat(iso, F.lit("Z"))).otherwise(F.concat(F.lit("n/a "), F.col("event_id")))
    rank = watermark_rank(F.col("text"), "date")
    return table(spark, sf, "events").withColumn("text", text).groupBy("event_type").agg(
        F.max(rank)["text"].alias("watermark"),
        F.count_if(rank.isNull()).alias("unreadable"))


@register("variant_read", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing FROM events""")
def variant_read(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    v = parse_variant(F.col("props"))
    return ev.select("event_id", variant_field(v, ["k"], "int").alias("k"),
                     variant_field(v, ["missing"], "string").alias("missing"))


# ---------------------------------------------------------------- P14, X5
QUARANTINE_AT = "2024-02-01T00:00:00.000000"


@register("quarantine_tag", f"""
WITH t AS (SELECT p_partkey, CASE WHEN p_size <= 5 THEN NULL
                                  WHEN p_size <= 10 THEN []::VARCHAR[]
                                  ELSE string_split(p_name, ' ') END AS tokens FROM part)
SELECT p_partkey, CAST(len(tokens) AS INTEGER) AS n_tokens, 'source://part' AS origem,
       CASE WHEN tokens IS NULL OR len(tokens) = 0 THEN '{QUARANTINE_AT}' END AS quarentena_em,
       CASE WHEN tokens IS NULL OR len(tokens) = 0 THEN 'tokens not informed' END AS motivo
FROM t""")
def quarantine_tag(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a NULL or empty array are tagged, none dropped."""
    p = table(spark, sf, "part")
    tokens = (F.when(F.col("p_size") <= 5, F.lit(None).cast("array<string>"))
              .when(F.col("p_size") <= 10, F.array().cast("array<string>"))
              .otherwise(F.split("p_name", " ")))
    t = p.select("p_partkey", tokens.alias("tokens"))
    at = F.lit(QUARANTINE_AT.replace("T", " ")).cast("timestamp")
    tagged = tag_quarantine(t, empty_or_null("tokens"), "tokens not informed", "source://part", at)
    return tagged.select("p_partkey", F.size("tokens").alias("n_tokens"), "origem",
                         iso_text(F.col("quarentena_em")).alias("quarentena_em"), "motivo")


# ---------------------------------------------------------------- P4
@register("nested_select", """
SELECT event_id, event_type AS kind, value AS metric_value, user_id AS metric_user FROM events""")
def nested_select(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select(
        "event_id", F.struct("event_type", F.struct("value", "user_id").alias("metrics")).alias("detail"))
    return select_nested(ev, {"event_id": "event_id", "kind": "detail.event_type",
                              "metric_value": "detail.metrics.value", "metric_user": "detail.metrics.user_id"})


# ---------------------------------------------------------------- A7
_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(cols: list[str], tbl: str) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, 'double' AS data_type, count({c}) AS count,
  round(100.0 * (count(*) - count({c})) / count(*), 4) AS pct_null, avg({c}) AS mean,
  stddev_samp({c}) AS stddev, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max
FROM {tbl}""")
    return "\nUNION ALL\n".join(parts)


@register("column_profile", _profile_sql(_PROFILE_COLS, "lineitem"))
def column_profile_q(spark: SparkSession, sf: str) -> DataFrame:
    return column_profile(table(spark, sf, "lineitem"), _PROFILE_COLS)


# ---------------------------------------------------------------- P10
# Awkward column names given to part's columns (name, source column).
AWKWARD = [("p partkey", "p_partkey"), ("p(name)", "p_name"), ("p_brand ", "p_brand"),
           ("P TYPE", "p_type"), ("p_type", "p_size"), ("=", "p_retailprice"), ("_run_id", "p_partkey")]


@register("sanitise_columns", """
SELECT p_partkey AS p_partkey, p_name AS p_name, p_brand AS p_brand, p_type AS "P_TYPE",
       p_size AS p_type_2, p_retailprice AS col, p_partkey AS _run_id FROM part""")
def sanitise_columns(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    awkward = p.select(*[F.col(src).alias(name) for name, src in AWKWARD])
    return sanitize_columns(awkward)


# ---------------------------------------------------------------- X9, X10
@register("normalise_types", f"""
SELECT o_orderkey, {iso_sql('o_orderdate')} AS o_orderdate, lower(hex(o_orderpriority)) AS priority_hex,
       o_orderstatus AS status_from_body, o_totalprice AS price_from_body FROM orders""")
def normalise_types_q(spark: SparkSession, sf: str) -> DataFrame:
    """Values normalised as landed (times ISO, bytes hex) and the document
    text read back (X9, X10)."""
    o = table(spark, sf, "orders").withColumn("prio_bytes", F.col("o_orderpriority").cast("binary"))
    n = normalise_types(o.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "prio_bytes"))
    body = F.to_json(F.struct(*[F.col(c) for c in n.columns]))
    return n.select("o_orderkey", "o_orderdate", F.col("prio_bytes").alias("priority_hex"),
                    F.get_json_object(body, "$.o_orderstatus").alias("status_from_body"),
                    F.get_json_object(body, "$.o_totalprice").cast("double").alias("price_from_body"))


# ---------------------------------------------------------------- J2, J3
@register("orders_customer_join", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def orders_customer_join(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return enrich(o, table(spark, sf, "customer"), "o_custkey", "c_custkey", ["c_custkey", "c_name", "c_mktsegment"])


@register("customer_nation_join", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def customer_nation_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return enrich(c, table(spark, sf, "nation"), "c_nationkey", "n_nationkey", ["n_nationkey", "n_name"]) \
        .drop("c_nationkey")


# ---------------------------------------------------------------- M2
@register("silver_explode", """
SELECT vec_id, label, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings""")
def silver_explode(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    out = explode_array(e, "embedding", position="pos", value="value")
    return out.withColumns({"pos": F.col("pos").cast("long"), "value": F.col("value").cast("double")})


@register("silver_flatten", f"""
SELECT user_id AS _source_id, event_type AS detail_kind, value AS detail_metrics_value,
       {iso_sql('ts')} AS detail_metrics_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def silver_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Latest record per key, then nested structs flattened to columns."""
    ev = table(spark, sf, "events")
    nested = ev.select(F.col("user_id").alias("_source_id"), F.col("ts").alias("_order"), F.col("event_id").alias("_tie"),
                       F.struct(F.col("event_type").alias("kind"),
                                F.struct("value", iso_text(F.col("ts")).alias("ts")).alias("metrics")).alias("detail"))
    latest = latest_per_key(nested, ["_source_id"], ["_order", "_tie"])
    return flatten(latest.drop("_order", "_tie"))


# ---------------------------------------------------------------- M5
@register("row_hash", """
SELECT doc_id, sha256(to_json({'lang': lang, 'source': source, 'text': text})) AS row_hash FROM documents""")
def row_hash_q(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", row_hash(["lang", "source", "text"]).alias("row_hash"))


@register("dedup_by_hash", """
WITH t AS (SELECT CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type || '#' || user_id % 7 END AS a,
                  CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id % 7 || '#' END AS b FROM events)
SELECT a, b FROM t GROUP BY a, b""")
def dedup_by_hash_q(spark: SparkSession, sf: str) -> DataFrame:
    """Rows told apart by their hash, with separators and NULLs inside."""
    ev = table(spark, sf, "events")
    a = F.when(F.col("event_id") % 5 != 0, F.concat("event_type", F.lit("#"), (F.col("user_id") % 7).cast("string")))
    b = F.when(F.col("event_id") % 3 != 0, F.concat((F.col("user_id") % 7).cast("string"), F.lit("#")))
    return dedup_by_hash(ev.select(a.alias("a"), b.alias("b")), ["a", "b"]).select("a", "b")


# ---------------------------------------------------------------- S2, X10
@register("raw_documents", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_custkey, o_orderpriority, 6 AS n_fields FROM orders""")
def raw_documents_q(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as ``(_id, body)``; fields read back from the body text."""
    raw = raw_documents(table(spark, sf, "orders"), "o_orderkey")
    return raw.select("_id", F.get_json_object("body", "$.o_custkey").cast("long").alias("o_custkey"),
                      F.get_json_object("body", "$.o_orderpriority").alias("o_orderpriority"),
                      F.size(F.json_object_keys("body")).alias("n_fields"))


# ---------------------------------------------------------------- P13, X1, X2, X13
@register("typed_cast", f"""
SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, coalesce(TRY_CAST(p_type AS INTEGER), -1) AS type_num,
       coalesce(TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER), -1) AS size_back
FROM part""")
def typed_cast(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    c = cast_columns(p.select("p_partkey", F.col("p_size").alias("size_text"), F.col("p_type").alias("type_num")),
                     {"size_text": "string", "type_num": "int"})
    return c.select("p_partkey", "size_text", with_default(F.col("type_num"), -1).alias("type_num"),
                    with_default(F.col("size_text").try_cast("int"), -1).alias("size_back"))


@register("event_dates", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events""")
def event_dates(spark: SparkSession, sf: str) -> DataFrame:
    """String → date (X2) on the landed ISO text."""
    ev = table(spark, sf, "events").select("event_id", iso_text(F.col("ts")).alias("ts"))
    return ev.select("event_id", F.to_date(F.col("ts")).cast("string").alias("event_date"))


# ---------------------------------------------------------------- P3, P8, P9
@register("filter_predicates", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_orderkey > 1000""")
def filter_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """Base conjunction plus the paging conjunct, all pushed to the scan."""
    o = table(spark, sf, "orders")
    cond = all_of(F.col("o_orderstatus") == "O", F.col("o_orderpriority") == "1-URGENT",
                  key_after("o_orderkey", 1000))
    return o.where(cond).select("o_orderkey", "o_custkey", "o_totalprice")


@register("null_filter", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE NULLIF(o_orderpriority, '5-LOW') IS NULL""")
def null_filter(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("prio", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return o.where(is_missing("prio")).select("o_orderkey", "o_orderstatus")


# ---------------------------------------------------------------- M4
@register("schema_contract", """
SELECT 'key_not_null' AS rule, count(*) FILTER (WHERE NOT coalesce(o_orderkey IS NOT NULL, false)) AS violations FROM orders
UNION ALL SELECT 'price_positive', count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) FROM orders
UNION ALL SELECT 'status_domain', count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) FROM orders
UNION ALL SELECT 'priority_format', count(*) FILTER (WHERE NOT coalesce(regexp_matches(o_orderpriority, '^[1-5]-'), false)) FROM orders
UNION ALL SELECT 'price_below_400k', count(*) FILTER (WHERE NOT coalesce(o_totalprice < 400000, false)) FROM orders
""")
def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    rules = {"key_not_null": F.col("o_orderkey").isNotNull(),
             "price_positive": F.col("o_totalprice") > 0,
             "status_domain": F.col("o_orderstatus").isin("F", "O", "P"),
             "priority_format": F.col("o_orderpriority").rlike("^[1-5]-"),
             "price_below_400k": F.col("o_totalprice") < 400000}
    return contract_check(o, rules).select("rule", "violations")


QUERIES = Q
ORACLES = SQL
