"""Path catalogue of JSON documents (A9, X8): which paths occur, with which
types, how often and how often as null.

The documents are walked as VARIANT values, all on the JVM. One step turns an
object or array into itself and its members, so a chain of steps reads as many
levels in one pass over the texts; the rows are counted by path and kind before
the shuffle. Where values nested deeper than the chain are left, the pass is
made again with twice the steps: any depth is walked to its end, in a
logarithmic number of passes, and nothing is kept between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingot.functions.json import parse_variant
from ingot.functions.scalars import pct

ROOT = "$"
ELEMENT = "[*]"
#: Kind of a text that is no JSON document; its path is the root.
MALFORMED = "malformed"
#: From the narrowest to the widest: a type takes in those before it in its line.
WIDENING = ("bigint", "decimal", "double")
FIRST_STEPS = 6

_MEMBERS = "array<struct<path string, parent string, v variant, open boolean>>"


def path_step(key: Column) -> Column:
    """A member's part of a path; names other than plain words in brackets."""
    quoted = F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.when(key.rlike("^[A-Za-z0-9_]+$"), F.concat(F.lit("."), key)) \
        .otherwise(F.concat(F.lit("['"), quoted, F.lit("']")))


def _as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def value_kind(v: Column) -> Column:
    """``object``, ``array``, ``null`` or the scalar type of a VARIANT, without
    precision; ``malformed`` where there is none."""
    name = F.lower(F.regexp_extract(F.schema_of_variant(v), "^[A-Za-z_]+", 0))
    return F.when(v.isNull(), MALFORMED).when(F.is_variant_null(v), "null") \
        .when(_as_object(v).isNotNull(), "object").when(_as_array(v).isNotNull(), "array").otherwise(name)


def _step(rows: DataFrame) -> DataFrame:
    """Open objects and arrays become themselves, done, and their members, open."""
    path, v = F.col("path"), F.col("v")

    def member(step: Column, value: Column) -> Column:
        return F.struct(F.concat(path, step).alias("path"), path.alias("parent"), value.alias("v"), F.lit(True).alias("open"))

    none = F.array().cast(_MEMBERS)
    own = F.array(F.struct(path.alias("path"), F.col("parent").alias("parent"), v.alias("v"), F.lit(False).alias("open")))
    fields = F.transform(F.map_entries(_as_object(v)), lambda e: member(path_step(e["key"]), e["value"]))
    elements = F.transform(_as_array(v), lambda e: member(F.lit(ELEMENT), e))
    members = F.when(F.col("open"), F.coalesce(fields, elements, none)).otherwise(none)
    return rows.select(F.inline(F.concat(own.cast(_MEMBERS), members.cast(_MEMBERS))))


def _counts(texts: DataFrame, column: str, steps: int) -> DataFrame:
    rows = texts.where(F.col(column).isNotNull()) \
        .select(F.lit(ROOT).alias("path"), F.lit(None).cast("string").alias("parent"),
                parse_variant(column).alias("v"), F.lit(True).alias("open"))
    for _ in range(steps):
        rows = _step(rows)
    return rows.select("path", "parent", value_kind(F.col("v")).alias("kind"), "open") \
        .groupBy("path", "parent", "kind") \
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("open") & F.col("kind").isin("object", "array")).alias("deeper"))


def path_kinds(texts: DataFrame, column: str, steps: int = FIRST_STEPS) -> DataFrame:
    """``(path, parent, kind, n)``: values by path and kind over all texts, NULL
    texts left out. ``steps`` levels are read in the first pass."""
    while True:
        counts = _counts(texts, column, steps).checkpoint()
        if counts.where("deeper").isEmpty():
            return counts.drop("deeper")
        steps *= 2


def common_type(kinds: Column) -> Column:
    """The narrowest type that takes in all kinds of an array of them: ``null``
    goes into any, numbers widen, all else that differs is ``variant``. Objects
    and arrays have their members' types at the members' paths."""
    some = F.array_except(kinds, F.array(F.lit("null"), F.lit(MALFORMED)))
    number = F.size(F.array_except(some, F.array(*map(F.lit, WIDENING)))) == 0
    widest = F.lit(WIDENING[0])
    for wider in WIDENING[1:]:
        widest = F.when(F.array_contains(some, wider), wider).otherwise(widest)
    return F.when(F.size(some) == 0, "null").when(F.size(some) == 1, F.element_at(some, 1)) \
        .when(number, widest).otherwise("variant")


def path_catalogue(texts: DataFrame, column: str, steps: int = FIRST_STEPS) -> DataFrame:
    """One row per path: its type, its kinds in order, how many values it has,
    how many are null and their share, and in how many objects that could hold
    it it is missing (0 for the root and for array elements). Malformed texts
    are counted as nothing but a kind of the root."""
    kinds = path_kinds(texts, column, steps)
    real = F.when(F.col("kind") != MALFORMED, F.col("n"))
    by_path = kinds.groupBy("path", "parent").agg(
        F.array_sort(F.collect_set("kind")).alias("kinds"),       # at most one entry per type
        F.coalesce(F.sum(real), F.lit(0)).alias("n_values"),
        F.coalesce(F.sum(F.when(F.col("kind") == "null", F.col("n"))), F.lit(0)).alias("n_null"))
    objects = kinds.where(F.col("kind") == "object").select(F.col("path").alias("parent"), F.col("n").alias("n_objects"))
    missing = F.when(F.col("path").endswith(ELEMENT) | F.col("n_objects").isNull(), F.lit(0)) \
        .otherwise(F.col("n_objects") - F.col("n_values"))
    return by_path.join(objects, "parent", "left").select(
        "path", common_type(F.col("kinds")).alias("type"), F.array_join("kinds", ",").alias("kinds"),
        "n_values", "n_null", pct(F.col("n_null"), F.col("n_values")).alias("pct_null"), missing.cast("long").alias("n_missing"))
