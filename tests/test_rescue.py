import json

from pyspark.sql.types import StructType

from pyspark.sql import functions as F

from ingot.sources.landing import read_landing
from conftest import write_lines

SCHEMA = "_id string, year int, imdb struct<rating:double>"


def _load(spark, ws, lines):
    from pyspark.sql.types import StructType
    write_lines(ws, lines)
    schema = StructType.fromDDL(SCHEMA)
    return {r["_id"] or r["_rescued_data"]: r for r in read_landing(spark, ws, schema).collect()}


def test_type_drift_rescued_top_level_and_nested(spark, ws):
    rows = _load(spark, ws, ['{"_id":"1","year":1903,"imdb":{"rating":7.4}}',
                             '{"_id":"2","year":"2010e","imdb":{"rating":"n/a"}}'])
    assert rows["1"]["_rescued_data"] is None
    assert rows["1"]["imdb"]["rating"] == 7.4
    r2 = rows["2"]
    assert r2["year"] is None and r2["imdb"]["rating"] is None
    assert json.loads(r2["_rescued_data"]) == {"year": "2010e", "imdb.rating": "n/a"}


def test_new_field_kept_and_explicit_null_not_rescued(spark, ws):
    rows = _load(spark, ws, ['{"_id":"3","year":null,"new":[1,2],"imdb":{"rating":1.5,"x":{"a":1}}}'])
    r = rows["3"]
    assert json.loads(r["_rescued_data"]) == {"new": "[1,2]", "imdb.x": '{"a":1}'}


def test_malformed_line_kept_whole(spark, ws):
    rows = _load(spark, ws, ['{"_id":"1","year":1}', "{bad json"])
    bad = [r for k, r in rows.items() if r["_id"] is None][0]
    assert json.loads(bad["_rescued_data"]) == {"_corrupt_record": "{bad json"}
    assert rows["1"]["_rescued_data"] is None


def test_empty_landing_gives_no_rows(spark, ws):
    from pyspark.sql.types import StructType
    write_lines(ws, [""], name="empty.jsonl")
    assert read_landing(spark, ws, StructType.fromDDL(SCHEMA)).count() == 0


def test_inferred_schema_when_none_given(spark, ws):
    write_lines(ws, ['{"_id":"1","n":1}', '{"_id":"2","n":"x"}'])
    df = read_landing(spark, ws)
    assert dict(df.dtypes)["n"] == "string"
    assert df.where(F.col("_rescued_data").isNotNull()).count() == 0


from hypothesis import given, settings, strategies as st  # noqa: E402

_scalars = st.one_of(st.none(), st.integers(-2 ** 40, 2 ** 40), st.floats(allow_nan=False, allow_infinity=False,
                                                                           width=32),
                     st.text(alphabet="abc12é", max_size=4), st.booleans())
_values = st.recursive(_scalars, lambda inner: st.one_of(st.lists(inner, max_size=3),
                                                         st.dictionaries(st.sampled_from("xyz"), inner, max_size=3)),
                       max_leaves=6)
_docs = st.dictionaries(st.sampled_from(["a", "b", "c", "d", "extra"]), _values, max_size=5)


@settings(max_examples=8, deadline=None)
@given(st.lists(_docs, min_size=1, max_size=6))
def test_no_value_is_lost(spark, docs):
    """Every non-null top-level value lands in its typed column or in the
    rescue column (by its own name or a dotted sub-path)."""
    schema = StructType.fromDDL("a int, b string, c struct<x:double>, d array<int>")
    from ingot.functions.rescue import parse_json_lines
    text = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    rows = parse_json_lines(text, schema).collect()
    assert len(rows) == len(docs)
    for doc, row in zip(docs, rows):
        rescued = json.loads(row["_rescued_data"]) if row["_rescued_data"] else {}
        for k, v in doc.items():
            if v is None:
                continue
            typed = row[k] if k in schema.fieldNames() else None
            in_rescue = any(r == k or r.startswith(k + ".") for r in rescued)
            assert typed is not None or in_rescue, (k, v, row)


def test_values_inside_arrays_maps_and_repeated_keys(spark):
    from ingot.functions.rescue import parse_json_lines
    schema = StructType.fromDDL("cast array<struct<name:string,year:int>>, m map<string,struct<a:int>>, n array<array<int>>")
    lines = {
        '{"cast":[{"name":"a","year":"bad","extra":9},{"name":"b","year":2}]}':
            {"cast[0].extra": "9", "cast[0].year": "bad"},
        '{"z":1,"z":2,"a.b":{"c":3}}': {"z": '["1","2"]', "a\\.b": '{"c":3}'},
        '{"m":{"k.1":{"a":1,"b":2}}}': {"m.k\\.1.b": "2"},
        '{"cast":[{"name":"a","name":"b"}]}': {"cast[0].name": '["a","b"]'},
        '{"cast":[],"m":{},"n":[[1],[2,3]]}': None,
        '{"cast":null,"m":null}': None,
    }
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r["_rescued_data"] for r in parse_json_lines(df, schema, keep=["value"]).collect()]
    want = list(lines.values())
    assert [json.loads(x) if x else None for x in got] == want


def _typed_values(typed, doc, path=""):
    """(path, raw value) pairs of a document that its typed form does not hold."""
    if isinstance(doc, dict):
        if not isinstance(typed, dict):
            return [(path, doc)]
        return [x for k, v in doc.items() if v is not None
                for x in _typed_values(typed.get(k), v, f"{path}.{k}" if path else k)]
    if isinstance(doc, list):
        if not isinstance(typed, list):
            return [(path, doc)]
        return [x for i, v in enumerate(doc) if v is not None
                for x in _typed_values(typed[i] if i < len(typed) else None, v, f"{path}[{i}]")]
    return [] if typed is not None else [(path, doc)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.fixed_dictionaries({}, optional={
    "a": _scalars, "s": st.dictionaries(st.sampled_from(["x", "y"]), _scalars, max_size=2),
    "l": st.lists(st.dictionaries(st.sampled_from(["x", "q"]), _scalars, max_size=2), max_size=3)}), min_size=1, max_size=6))
def test_lost_values_are_rescued_as_they_were(spark, docs):
    from ingot.functions.rescue import parse_json_lines
    schema = StructType.fromDDL("a int, s struct<x:int>, l array<struct<x:int>>")
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, value string")
    for r in parse_json_lines(df, schema, keep=["i"]).collect():
        rescued = json.loads(r["_rescued_data"]) if r["_rescued_data"] else {}
        for path, value in _typed_values(r.asDict(recursive=True), docs[r["i"]]):
            holder = max((p for p in rescued if path == p or path.startswith((p + ".", p + "["))), key=len)
            if holder == path and not isinstance(value, (dict, list)):
                raw = rescued[path]
                assert raw == value if isinstance(value, str) else json.loads(raw) == value


def test_lines_that_are_read_whole_are_not_parsed_for_the_rescue(spark, monkeypatch):
    """A line that its typed form writes again as it was has nothing to rescue;
    the raw values of any other line are looked into."""
    from ingot.functions import rescue
    schema = StructType.fromDDL("a int, s struct<x:double>, l array<struct<x:int,t:string>>")
    lines = {'{"a":1,"s":{"x":0.5},"l":[{"x":1,"t":"\u00e9"},null]}': None,
             '{"a":null,"s":null,"l":[]}': None,
             '{"s":{"x":0.5},"a":1}': None,
             '{"a":1,"a":1,"s":null,"l":null}': {"a": '["1","1"]'},
             '{"a":"1x","s":null,"l":null}': {"a": "1x"},
             '{"a":1,"s":{"x":0.5,"y":2},"l":null}': {"s.y": "2"},
             '{"a":1,"s":null,"l":[{"x":1,"t":null,"u":3}]}': {"l[0].u": "3"}}
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r["_rescued_data"] for r in rescue.parse_json_lines(df, schema).collect()]
    assert [json.loads(x) if x else None for x in got] == list(lines.values())
    # the nested values' look-up fails on purpose: only lines that need it come there
    monkeypatch.setattr(rescue, "_line_entries", lambda schema: f"CAST(raise_error('looked into') AS {rescue.ENTRIES})")
    whole = df.where("value like '%\u00e9%' or value like '%[]%'")
    assert [r["_rescued_data"] for r in rescue.parse_json_lines(whole, schema).collect()] == [None, None]
