"""Projection and predicate operators.

Every predicate is a plain Column so Catalyst can push it into the scan
(Parquet ``PushedFilters``) and prune columns.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.config import DEFAULT_WATERMARK_START


def exclude_fields(df: DataFrame, fields: list[str] | tuple[str, ...]) -> DataFrame:
    """Exclusion projection ``{"field": 0}``: top-level names are dropped,
    dotted names drop a nested struct field. Fields not present are
    ignored, like a document store ignores absent keys."""
    out = df
    top = [f for f in fields if "." not in f and f in df.columns]
    if top:
        out = out.drop(*top)
    for f in fields:
        if "." in f:
            head, rest = f.split(".", 1)
            if head in out.columns and isinstance(out.schema[head].dataType, T.StructType):
                out = out.withColumn(head, F.col(f"`{head}`").dropFields(rest))
    return out


def _fraction9(c: Column) -> Column:
    return F.rpad(F.coalesce(F.regexp_extract(c, r"\.(\d+)", 1), F.lit("")), 9, "0")


def incremental_filter(df: DataFrame, field: str, start: str | None,
                       watermark_type: str | None) -> Column:
    """Strict ``field > start``.

    * typed time column: the bound is cast to the column type, so the
      comparison reaches the Parquet scan as a pushed filter;
    * text column with ``watermark_type == "date"`` or text that looks like
      a time: both sides are read as timestamps (``T`` and space
      separators alike) and equal instants are ordered by their
      sub-microsecond digits;
    * otherwise plain string order.
    Rows without the field never satisfy the bound (SQL NULL semantics)."""
    start = start or DEFAULT_WATERMARK_START
    c = F.col(f"`{field}`")
    dt = df.schema[field].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c > F.lit(start.replace("T", " ")).cast(dt)
    if isinstance(dt, T.NumericType):
        if start == DEFAULT_WATERMARK_START:
            return c.isNotNull()  # no stored watermark yet: every row that has the field
        return c > F.lit(start).cast(dt)
    if watermark_type == "date" or _looks_like_time(start):
        tv, tb = F.try_to_timestamp(c), F.try_to_timestamp(F.lit(start))
        as_time = (tv > tb) | ((tv == tb) & (_fraction9(c) > _fraction9(F.lit(start))))
        newer = F.when(tv.isNotNull() & tb.isNotNull(), as_time).otherwise(c > F.lit(start))
        if watermark_type == "date" and _looks_like_time(start):
            # a plain comparison that the scan can use: no text of an earlier
            # day passes, whatever its zone; text that begins below the digits
            # (white space, signs) is left to the exact test
            day = (_dt.date.fromisoformat(start[:10]) - _dt.timedelta(days=2)).isoformat()
            return ((c >= F.lit(day)) | (c < F.lit("0"))) & newer
        return newer
    return c > F.lit(start)


def watermark_rank(c: Column, watermark_type: str | None) -> Column:
    """What the greatest watermark is the maximum of: a struct whose last
    field ``text`` is the value as stored. A declared date compares by
    instant, then by its sub-microsecond digits; a value that is no time has
    no rank and can never become a bound."""
    text = c.cast("string")
    if watermark_type != "date":
        return F.when(c.isNotNull(), F.struct(c.alias("value"), text.alias("text")))
    instant = F.try_to_timestamp(text)
    return F.when(instant.isNotNull(), F.struct(instant.alias("value"), _fraction9(text).alias("fraction"),
                                                text.alias("text")))


def _looks_like_time(s: str) -> bool:
    return len(s) >= 10 and s[4] == "-" and s[7] == "-"


def key_after(key: str, last) -> Column:
    """Paging conjunct ``key > last`` (P3); combined with the base filter,
    never replacing it."""
    return F.col(f"`{key}`") > F.lit(last)


def all_of(*conds: Column) -> Column:
    """Conjunction of predicates (P8); empty → TRUE."""
    conds = [c for c in conds if c is not None]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def is_missing(col: str) -> Column:
    """Null predicate."""
    return F.col(f"`{col}`").isNull()


def select_nested(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Nested-field select with aliases (P4): ``{"imdb_rating": "imdb.rating"}``.
    Only the referenced leaves are read (nested schema pruning)."""
    return df.select(*[F.col(src).alias(alias) for alias, src in mapping.items()])


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast columns to declared types (P13). Non-strict uses ``try_cast``:
    values that do not convert become NULL instead of failing the job."""
    return df.withColumns({
        name: (F.col(f"`{name}`").cast(t) if strict else F.col(f"`{name}`").try_cast(t))
        for name, t in types.items()})
