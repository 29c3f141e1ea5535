"""Kept state, content reconciliation, run overlap and the repair loop
against plain versions."""

import datetime as dt
import random
import uuid
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.operators import bucketed
from ingot.operators.bucketed import BucketedTable
from ingot.operators.content import content_diff, differing_buckets
from ingot.operators.control import run_overlap
from ingot.operators.repair import repair, reparse
from ingot.operators.state import apply_latest, apply_versions, intervals, read_intervals, read_state, same_rows
from ingot.plans.bronze import quarantine_rows

T0 = dt.datetime(2024, 1, 1)


def versions(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "a", "b", None]), T0 + dt.timedelta(hours=rng.randrange(300)), rng.choice(["x", "y", None]))
            for _ in range(n)]


def plain_intervals(rows):
    best = {}
    for k, t, v in rows:
        best[k, t] = max(best.get((k, t), (False, "")), (v is not None, v or ""))
    out = []
    for key in {k for k, _ in best}:
        kept = []
        for t in sorted(t for k, t in best if k == key):
            v = best[key, t][1] if best[key, t][0] else None
            if not kept or kept[-1][1] != v:
                kept.append((t, v))
        out += [(key, v, t, kept[i + 1][0] if i + 1 < len(kept) else None) for i, (t, v) in enumerate(kept)]
    return sorted(out, key=repr)


def test_intervals_and_late_deliveries(spark, ws):
    rows = versions(1)
    want = plain_intervals(rows)
    frame = lambda r: spark.createDataFrame(r, "k string, at timestamp_ntz, v string")      # noqa: E731
    got = lambda df: sorted(map(tuple, df.select("k", "v", "valid_from", "valid_to").collect()), key=repr)
    assert got(intervals(frame(rows), ["k"], "at", ["v"])) == want
    for part in (rows[:100], rows[200:], rows[90:210], rows[:5]):
        apply_versions(spark, f"{ws}/v", frame(part), ["k"], "at", ["v"], buckets=4)
    assert got(read_intervals(spark, f"{ws}/v")) == want


def test_kept_latest_touches_only_its_buckets(spark, ws):
    rows = [(f"k{i % 40}", i, f"v{i}") for i in range(400)]
    frame = lambda r: spark.createDataFrame(r, "k string, n int, v string")                 # noqa: E731
    for part in (rows[:150], rows[100:300], rows[250:]):
        apply_latest(spark, f"{ws}/s", frame(part), ["k"], ["n"], buckets=8)
    want = {f"k{i % 40}": (i, f"v{i}") for i in range(400)}
    assert {r.k: (r.n, r.v) for r in read_state(spark, f"{ws}/s").collect()} == want
    files = lambda: {r[0] for r in spark.read.parquet(f"{ws}/s").select(F.input_file_name()).collect()}
    before = files()
    assert apply_latest(spark, f"{ws}/s", frame([("k1", 9999, "new")]), ["k"], ["n"], buckets=8) == 1
    assert len(before - files()) == 1
    assert apply_latest(spark, f"{ws}/s", frame([]), ["k"], ["n"], buckets=8) == 0


def test_content_diff_names_the_keys(spark):
    src = [(i, "a") for i in range(50)] + [(7, "a"), (None, "n")]
    copy = [(i, "a") for i in range(3, 50)] + [(9, "b"), (60, "z"), (None, "n")]
    frame = lambda r: spark.createDataFrame(r, "id int, v string")                          # noqa: E731
    s, c = Counter(src), Counter(copy)
    want = set()
    for key in {k for k, _ in [*s, *c]}:
        a, b = ({x: n for x, n in m.items() if x[0] == key} for m in (s, c))
        if a != b:
            want.add(("copy", None if key is None else str(key), "missing" if not b else "extra" if not a else "changed",
                      sum(a.values()), sum(b.values())))
    got = content_diff(frame(src), {"copy": frame(copy), "same": frame(src[::-1])}, "id", ["id", "v"], buckets=16)
    assert {tuple(r) for r in got.collect()} == want
    assert differing_buckets(frame(src), {"same": frame(src[::-1])}, "id", ["id", "v"]) == []
    assert same_rows(frame(src), frame(src[::-1])) and not same_rows(frame(src), frame(copy))


def test_run_overlap_against_a_plain_sweep(spark):
    rng = random.Random(4)
    runs = [(rng.choice("ab"), T0 + dt.timedelta(seconds=s), T0 + dt.timedelta(seconds=s + rng.choice([0, 5, 400, 9000])))
            for s in (rng.randrange(90_000) for _ in range(120))]
    want = set()
    for c in "ab":
        own = [(s, e) for k, s, e in runs if k == c]
        marks = sorted({t for r in own for t in r})
        spans = [(sum(s <= a and e > a for s, e in own), int((b - a).total_seconds() * 10**6)) for a, b in zip(marks, marks[1:])]
        idle = [u for n, u in spans if n == 0]
        want.add((c, max(n for n, _ in spans), sum(u for n, u in spans if n >= 2), sum(idle), len(idle), max(idle, default=0)))
    df = spark.createDataFrame(runs, "collection string, start_time timestamp, end_time timestamp")
    assert {tuple(r) for r in run_overlap(df, 600).collect()} == want


def test_repair_settles_once(spark, ws):
    day = dt.date(2024, 2, 1)
    t = BucketedTable(f"t_{uuid.uuid4().hex[:8]}", "m", f"{ws}/bronze", buckets=2)
    schema = "_source_id string, a int, _rescued_data string, _ingestion_date date"
    rows = [("1", 1, '{"b":"5","o":"{\\"x\\":1}"}', day), ("2", None, '{"a":"oops","b":"no"}', day), ("3", 3, None, day),
            ("4", 4, '{"o":"{\\"x\\":1,\\"unknown\\":2}"}', day)]
    bucketed.insert_new(spark, spark.createDataFrame(rows, schema), t)
    waiting = [(None, 9, '{"id":"77","b":"6"}', day), (None, 8, None, day), (None, 7, '{"id":"1"}', day)]
    quarantine_rows(spark.createDataFrame(waiting, schema), f"{ws}/q")
    newer = T.StructType.fromDDL("a int, b int, id string, o struct<x:int>")
    first = repair(spark, t, f"{ws}/q", newer, F.col("id"))
    assert (first.values, first.rows, first.left) == (1, 1, 1)     # key 1 was there already
    got = {r._source_id: r for r in bucketed.read(spark, t).collect()}
    assert set(got) == {"1", "2", "3", "4", "77"}
    assert (got["1"].b, got["1"].o.x, got["1"]._rescued_data) == (5, 1, None)
    assert got["2"].b is None and got["2"]._rescued_data == '{"a":"oops","b":"no"}'
    assert got["4"].o is None and "unknown" in got["4"]._rescued_data
    assert (got["77"].a, got["77"].b) == (9, 6)
    again = repair(spark, t, f"{ws}/q", newer, F.col("id"))
    assert (again.values, again.rows, again.left) == (0, 0, 1)
    wider = T.StructType.fromDDL("b string")
    assert reparse(bucketed.read(spark, t), wider).where("__taken > 0").count() == 0
