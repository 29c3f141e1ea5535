import datetime as dt

from pyspark.sql import functions as F

from ingot.functions.scalars import divergence_pct, elapsed_seconds, normalise_types, pct, truncate
from ingot.operators.quality import batch_metrics, reconcile_status
from ingot.sources.tables import count_frame, count_where


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 1, 500000), 200, 199, "abcdef")],
                               "s timestamp, e timestamp, a long, b long, t string")
    r = df.select(elapsed_seconds(F.col("s"), F.col("e")).alias("x"),
                  divergence_pct(F.col("a"), F.col("b")).alias("d"),
                  pct(F.col("b"), F.col("a"), 2).alias("p"), truncate(F.col("t"), 3).alias("c")).first()
    assert (r.x, r.d, r.p, r.c) == (1.5, 0.5, 99.5, "abc")


def test_normalise_types_for_landing(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2), bytearray(b"\x01\xab"))],
                               "ts timestamp_ntz, d date, b binary").withColumn("m", F.lit(1.5).cast("decimal(4,2)"))
    r = normalise_types(df).first()
    assert (r.ts, r.d, r.b, r.m) == ("2024-01-02T03:04:05.000000", "2024-01-02", "01ab", "1.50")


def test_batch_metrics_and_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    m = batch_metrics(df, "k")
    assert (m.total, m.null_keys, m.pct_null, m.duplicate_groups, m.min_key, m.max_key) == (4, 1, 25.0, 1, "a", "b")
    assert count_where(df) == 4 and count_where(df, F.col("k") == "a") == 2
    assert count_frame(df, F.col("k").isNull()).first()[0] == 1


def test_reconcile_status_scalar():
    assert reconcile_status(0, 0, 0.0, 0, 0.0, 0)[0] == "SUCCESS"
    assert reconcile_status(1000, 996, 0.5, 0, 0.0, 0)[0] == "SUCCESS"
    status, msg, div = reconcile_status(1000, 990, 0.5, 0, 0.0, 0)
    assert status == "PARTIAL" and div == 1.0 and "divergencia=1.00%" in msg
    assert reconcile_status(10, 10, 1.0, 1, 0.00001, 0)[0] == "PARTIAL"   # count, not the rounded share


def test_dedup_by_hash_keeps_one_row_per_version(spark):
    from ingot.operators.merge import dedup_by_hash
    df = spark.createDataFrame([("k", "a", 1), ("k", "a", 2), ("k", "b", 3), ("j", "a", 4)],
                               "key string, payload string, seq int")
    out = dedup_by_hash(df, ["payload"], key="key", order_by=["seq"])
    assert sorted((r.key, r.payload, r.seq) for r in out.collect()) == [("j", "a", 4), ("k", "a", 2), ("k", "b", 3)]


def test_source_profile_with_array_lengths(spark):
    from ingot.operators.quality import source_profile
    df = spark.createDataFrame([("x", "2024-01-02", [1.0, 2.0]), ("x", None, [1.0]), ("y", "2024-01-01", None)],
                               "c string, w string, emb array<double>")
    got = {r.c: r for r in source_profile(df, "w", by=["c"], array_field="emb").collect()}
    assert (got["x"].n_docs, got["x"].n_missing_watermark, got["x"].max_watermark) == (2, 1, "2024-01-02")
    assert (got["x"].min_array_len, got["x"].max_array_len) == (1, 2)


def test_accumulated_reconcile_ignores_failed_runs(spark):
    import datetime as dt
    from ingot.operators.control import CONTROL_SCHEMA, accumulated_reconcile
    t = dt.datetime(2024, 1, 1)
    rows = [("1", "c", "full", None, None, 10, 10, t, t, 0.0, "SUCCESS", None),
            ("2", "c", "incremental", None, None, 5, 4, t, t, 0.0, "PARTIAL", "x"),
            ("3", "c", "incremental", None, None, 7, 0, t, t, 0.0, "FAILED", "boom")]
    control = spark.createDataFrame(rows, CONTROL_SCHEMA)
    bronze = spark.createDataFrame([("c", 13)], "collection string, bronze_rows long")
    r = accumulated_reconcile(control, bronze).first()
    assert (r.runs, r.total_read, r.total_written, r.bronze_rows, r.difference) == (2, 15, 14, 13, 1)
