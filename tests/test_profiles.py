"""Path catalogue and mergeable profiles against plain versions."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ingot.operators import paths, profiles

AT = dt.datetime(2024, 2, 1)


def _walk(v, path, parent, out):
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "bigint", float: "decimal"}.get(type(v), "null")
    out[path, parent, kind] += 1
    if kind == "object":
        for k, x in v.items():
            step = f".{k}" if k.isascii() and k.replace("_", "a").isalnum() else "['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']"
            _walk(x, path + step, path, out)
    for x in v if kind == "array" else ():
        _walk(x, path + "[*]", path, out)


def _random_value(rng, depth):
    pick = rng.random()
    if depth and pick < 0.3:
        return {rng.choice(["a", "b_1", "c d", "it's", "e.f", "", "é", "back\\slash"]): _random_value(rng, depth - 1)
                for _ in range(rng.randint(0, 4))}
    if depth and pick < 0.5:
        return [_random_value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, 7, -3, 0.25, "x", "", "null", "{}"])


@pytest.mark.parametrize("steps", [1, 6])
def test_paths_against_a_plain_walk(spark, steps):
    rng = random.Random(4)
    values = [_random_value(rng, 9) for _ in range(400)]
    df = spark.createDataFrame([(json.dumps(v),) for v in values] + [(None,), ("{broken",), ('{"a":1,"a":2}',)], "body string")
    want = Counter({("$", None, "malformed"): 2})
    for v in values:
        _walk(v, "$", None, want)
    got = {(r.path, r.parent, r.kind): r.n for r in paths.path_kinds(df, "body", steps).collect()}
    assert got == want and max(p.count("[") + p.count(".") for p, _, _ in want) > 6


def test_catalogue_types_nulls_and_missing(spark):
    rows = ['{"n":1,"o":{"x":null}}', '{"n":2.5}', '{"n":null,"o":{}}', '{"n":1e3,"v":"a"}', '{"v":[1]}', "nope", None]
    got = {r.path: tuple(r)[1:] for r in paths.path_catalogue(spark.createDataFrame([(r,) for r in rows], "b string"), "b").collect()}
    assert got == {
        "$": ("object", "malformed,object", 5, 0, 0.0, 0),
        "$.n": ("double", "bigint,decimal,double,null", 4, 1, 25.0, 1),
        "$.o": ("object", "object", 2, 0, 0.0, 3), "$.o.x": ("null", "null", 1, 1, 100.0, 1),
        "$.v": ("variant", "array,string", 2, 0, 0.0, 3), "$.v[*]": ("bigint", "bigint", 1, 0, 0.0, 0)}
    assert paths.path_catalogue(spark.createDataFrame([], "b string"), "b").count() == 0


def _rows(spark, seed, n, shift=0.0):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(i, rng.gauss(shift, 1.0), f"w{min(300, int(rng.paretovariate(1.1)))}", None if rng.random() < 0.1 else rng.randint(0, 50))
         for i in range(n)], "id long, x double, word string, part int")


def test_merged_sketches_keep_their_bounds(spark, ws):
    runs = [_rows(spark, seed, n, seed * 0.3).withColumn("id", F.col("id") + 2000 * seed)
            for seed, n in enumerate((5000, 300, 9000, 0))]
    for i, df in enumerate((*runs, runs[2])):       # the third run comes twice
        profiles.keep_profile(df, ws + "/p", f"r{min(i, 3) if i < 4 else 2}", AT + dt.timedelta(hours=i))
    whole = runs[0].union(runs[1]).union(runs[2])
    n = whole.count()
    got = {r.column_name: r for r in profiles.merge_profiles(profiles.read_profiles(spark, ws + "/p"))
           .withColumns({"n_distinct": profiles.n_distinct("distinct_sketch"), "top": profiles.top_values("top_sketch", 5),
                         **{f"q{k}": profiles.quantile("rank_sketch", k / 10) for k in range(1, 10)}}).collect()}
    for c in whole.columns:
        exact = [r[0] for r in whole.select(c).collect()]
        told = [x for x in exact if x is not None]
        assert (got[c].n_runs, got[c].n_rows, got[c].n_nulls) == (4, n, n - len(told))
        assert abs(got[c].n_distinct - len(set(told))) <= 1 + profiles.DISTINCT_ERROR * len(set(told))
        if c == "word":
            assert (got[c].low_text, got[c].high_text, got[c].q5) == (min(told), max(told), None)
            counts = Counter(told)
            assert [(t["item"], t["count"]) for t in got[c].top][:3] == counts.most_common(3)
            continue
        assert (got[c].low, got[c].high) == (min(told), max(told))
        for k in range(1, 10):
            v = got[c][f"q{k}"]
            below, upto = sum(x < v for x in told) / len(told), sum(x <= v for x in told) / len(told)
            assert below - profiles.RANK_ERROR <= k / 10 <= upto + profiles.RANK_ERROR


def test_drift_against_the_runs_before(spark, ws):
    for i, df in enumerate((_rows(spark, 1, 3000), _rows(spark, 2, 3000), _rows(spark, 3, 3000))):
        profiles.keep_profile(df.withColumn("gone", F.lit(1)), ws + "/p", f"r{i}", AT + dt.timedelta(days=i))
    moved = _rows(spark, 4, 3000, 2.0).withColumns({"part": F.lit(None).cast("int"), "fresh": F.lit("f")})
    profiles.keep_profile(moved, ws + "/p", "r9", AT + dt.timedelta(days=9))
    kept = profiles.read_profiles(spark, ws + "/p")
    got = {r.column_name: r for r in profiles.drift(kept, "r9", last=2).collect()}
    assert {c: r.column_state for c, r in got.items() if r.column_state != "kept"} == {"gone": "gone", "fresh": "new"}
    assert abs(got["x"].rank_shift - 0.683) < 0.08          # of two normal distributions two deviations apart
    assert got["id"].rank_shift < 0.06 and got["id"].new_values < 0.1
    assert abs(got["part"].null_change - 0.9) < 0.02 and got["part"].rank_shift is None
    assert got["fresh"].null_change is None and got["x"].new_values > 0.9


def test_profile_of_nothing_and_of_odd_values(spark, ws):
    df = spark.createDataFrame([(float("nan"), [1], None), (2.0, None, None), (float("-inf"), [1], None)],
                               "x double, l array<int>, v string")
    profiles.keep_profile(df, ws + "/p", "a", AT)
    profiles.keep_profile(df.limit(0), ws + "/p", "b", AT)
    got = {r.column_name: r for r in profiles.merge_profiles(profiles.read_profiles(spark, ws + "/p")).collect()}
    assert (got["x"].low, got["x"].n_rows, got["l"].n_nulls, got["v"].n_nulls) == (float("-inf"), 3, 1, 3)
    assert got["x"].high != got["x"].high and got["v"].high_text is None       # NaN is above all
