"""Rescue column (M8): keep every value that does not fit the pinned schema.

For each JSON line the rescue column is a JSON object from paths to raw
values. It holds
  * keys that the schema does not know, at any depth: in structs, in
    elements of arrays and in values of maps;
  * values whose typed form came out NULL although the raw value was not
    JSON null (type mismatch);
  * all values of a key that occurs more than once in one object.
A path joins keys by dots and shows array positions as ``[i]``; a dot or
backslash inside a key is escaped by a backslash. Several raw values under
one path become a JSON array of them. A line that is not a JSON object at
all is kept whole under ``_corrupt_record``. A line that parses fully gets
NULL.

Each line is parsed once to the typed struct. Where that struct, written as
JSON again, is the line itself, all of it was read and nothing is rescued; a
landing's own lines are such. Any other line is parsed once more, to a
``map<string,string>`` of raw values; nested values re-parse only their own
text. The typed parse sits behind a generator (``inline``) so the optimizer
cannot split it into one pruned parse per column, which would parse every
line once per field.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

RESCUE_COLUMN = "_rescued_data"
CORRUPT_KEY = "_corrupt_record"
_MAP = "map<string,string>"
ENTRIES = "array<struct<path:string,value:string>>"


def no_entries() -> Column:
    return F.array().cast(ENTRIES)


def entry(path: Column, value: Column) -> Column:
    """One (path, raw value) entry as an array."""
    return F.array(F.struct(path.cast("string").alias("path"), value.cast("string").alias("value"))).cast(ENTRIES)


def escaped(key: Column) -> Column:
    return F.regexp_replace(key, r"([\\.])", r"\\$1")


def entries_to_json(entries: Column) -> Column:
    """JSON object of the entries; NULL without any."""
    paths = F.array_distinct(F.transform(entries, lambda e: e["path"]))

    def value_of(path: Column) -> Column:
        values = F.transform(F.filter(entries, lambda e: e["path"] == path), lambda e: e["value"])
        return F.when(F.size(values) == 1, values[0]).otherwise(F.to_json(values))

    return F.when(F.size(entries) > 0, F.to_json(F.map_from_arrays(paths, F.transform(paths, value_of))))


def json_to_entries(rescued: Column) -> Column:
    """The entries of an existing rescue value."""
    pairs = F.transform(F.map_entries(F.from_json(rescued, _MAP)),
                        lambda e: F.struct(e["key"].alias("path"), e["value"].alias("value")))
    return F.coalesce(pairs.cast(ENTRIES), no_entries())


# The expressions below are built as SQL text and parsed once: for a wide
# schema that takes the driver a tenth of the time of single column calls.
_NONE = f"CAST(array() AS {ENTRIES})"


def _text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _field(of: str, name: str) -> str:
    return f"{of}.`{name.replace('`', '``')}`"


def _escaped_sql(key: str) -> str:
    return f"regexp_replace({key}, {_text(r'([\\.])')}, {_text(r'\\$1')})"


def _entry_sql(path: str, value: str) -> str:
    return f"array(named_struct('path', {path}, 'value', CAST({value} AS STRING)))"


def _nested(dt: DataType) -> bool:
    """Types inside which a value can be lost while the outer one stays."""
    return isinstance(dt, (StructType, ArrayType, MapType))


def _value_entries(dt: DataType, typed: str, raw: str, path: str, depth: int) -> str:
    """Entries of one value, given its typed form and its raw text. ``depth``
    tells the variables of nested lambdas apart."""
    lost = f"{typed} IS NULL AND {raw} IS NOT NULL"
    if not _nested(dt):
        return f"CASE WHEN {lost} THEN {_entry_sql(path, raw)} ELSE {_NONE} END"
    e, x, i = f"e{depth}", f"x{depth}", f"i{depth}"
    if isinstance(dt, StructType):
        inner = _object_entries(dt, typed, f"map_entries(from_json({raw}, '{_MAP}'))", path, depth + 1)
    elif isinstance(dt, ArrayType):
        at = f"concat({path}, '[', CAST({i} AS STRING), ']')"
        inner = (f"flatten(transform(from_json({raw}, 'array<string>'), ({x}, {i}) -> "
                 f"{_value_entries(dt.elementType, f'get({typed}, {i})', x, at, depth + 1)}))")
    else:
        at = f"concat({path}, '.', {_escaped_sql(f'{e}.key')})"
        value = _value_entries(dt.valueType, f"try_element_at({typed}, {e}.key)", f"{e}.value", at, depth + 1)
        inner = f"flatten(transform(map_entries(from_json({raw}, '{_MAP}')), {e} -> {value}))"
    return (f"CASE WHEN {lost} THEN {_entry_sql(path, raw)} WHEN {raw} IS NULL THEN {_NONE} "
            f"ELSE coalesce({inner}, {_entry_sql(path, raw)}) END")


def _holds_map(dt: DataType) -> bool:
    """Whether a map occurs at any depth: its keys may repeat in a line that is
    written again as it was."""
    if isinstance(dt, StructType):
        return any(_holds_map(f.dataType) for f in dt.fields)
    return isinstance(dt, MapType) or isinstance(dt, ArrayType) and _holds_map(dt.elementType)


def _values_of(pairs: str, key: str) -> str:
    """Raw values of a key, as often as it occurs."""
    return f"transform(filter({pairs}, p -> p.key = {_text(key)}), p -> p.value)"


def _object_entries(schema: StructType, typed: str, pairs: str, path: str | None, depth: int = 0) -> str:
    """Entries of an object, given its raw (key, value) pairs in which a key
    may be repeated."""
    known = f"CAST(array({', '.join(_text(f.name) for f in schema.fields)}) AS array<string>)"

    def at(key: str) -> str:
        return key if path is None else f"concat({path}, '.', {key})"

    parts = [f"transform(filter({pairs}, p -> NOT array_contains({known}, p.key) AND p.value IS NOT NULL), "
             f"p -> named_struct('path', {at(_escaped_sql('p.key'))}, 'value', p.value))"]
    for f in schema.fields:
        own, here = _values_of(pairs, f.name), at(_text(re.sub(r"([\\.])", r"\\\1", f.name)))
        value = _value_entries(f.dataType, _field(typed, f.name), f"get({own}, 0)", here, depth + 1)
        parts.append(f"CASE WHEN size({own}) > 1 THEN transform(filter({own}, v -> v IS NOT NULL), "
                     f"v -> named_struct('path', {here}, 'value', v)) ELSE {value} END")
    return f"concat({', '.join(f'coalesce(CAST({p} AS {ENTRIES}), {_NONE})' for p in parts)})"


def _line_entries(schema: StructType) -> str:
    """Entries of a line. One pair for each field that was read, none else
    with a value and no key twice: then nothing is missing at the top, and
    only nested values are looked into."""
    pairs = "map_entries(__m)"
    read = " + ".join(["0", *(f"int({_field('__t', f.name)} IS NOT NULL)" for f in schema.fields)])
    plain = (f"size(filter({pairs}, p -> p.value IS NOT NULL)) = {read} "
             f"AND size(array_distinct(map_keys(__m))) = size({pairs})")
    inner = [_value_entries(f.dataType, _field("__t", f.name), f"get({_values_of(pairs, f.name)}, 0)",
                            _text(re.sub(r"([\\.])", r"\\\1", f.name)), 0) for f in schema.fields if _nested(f.dataType)]
    inner = f"concat({', '.join(f'CAST({p} AS {ENTRIES})' for p in inner)})" if inner else _NONE
    return f"CASE WHEN {plain} THEN {inner} ELSE {_object_entries(schema, '__t', pairs, None)} END"


_RESCUED = f"""
CASE WHEN __same OR __v IS NULL THEN CAST(NULL AS STRING)
     WHEN __m IS NULL THEN to_json(map('{CORRUPT_KEY}', __v))
     WHEN size(__e) > 0 THEN to_json(map_from_arrays(
       array_distinct(transform(__e, e -> e.path)),
       transform(array_distinct(transform(__e, e -> e.path)), p ->
         CASE WHEN size(filter(__e, e -> e.path = p)) = 1 THEN filter(__e, e -> e.path = p)[0].value
              ELSE to_json(transform(filter(__e, e -> e.path = p), e -> e.value)) END)))
END"""


def parse_json_lines(text: DataFrame, schema: StructType, column: str = "value", rescue: bool = True,
                     keep: list[str] | None = None) -> DataFrame:
    """Typed columns of a JSON-text column (plus ``_rescued_data``), each
    line parsed once per parse kind. ``keep`` carries other columns of
    ``text`` through."""
    keep = keep or []
    items = [F.from_json(F.col(column), schema).alias("__t")]
    if rescue:
        items.append(F.col(column).alias("__v"))
    items += [F.col(f"`{c}`").alias(c) for c in keep]
    parsed = text.select(F.inline(F.array(F.struct(*items))))
    cols = [F.col(f"`{c}`") for c in keep] + [F.col("__t").getField(f.name).alias(f.name) for f in schema.fields]
    if not rescue:
        return parsed.select(*cols)
    same = "false" if _holds_map(schema) else "to_json(__t, map('ignoreNullFields', 'false')) <=> __v"
    # these are columns of their own: they are used several times
    return parsed.withColumn("__same", F.expr(same)) \
        .withColumn("__m", F.expr(f"CASE WHEN NOT __same THEN from_json(__v, '{_MAP}') END")) \
        .withColumn("__e", F.expr(f"CASE WHEN NOT __same THEN {_line_entries(schema)} END")) \
        .select(*cols, F.expr(_RESCUED).alias(RESCUE_COLUMN))
