"""Schema evolution at any depth: the merged type of two deliveries, and
values brought to it.

Fields that only one side has are added, in structs, in elements of arrays
and in values of maps. A field both sides have keeps the older type; values
that do not convert are found by :func:`loses`. Names compare without case,
as Spark's own do, and keep their first spelling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal up to nullability."""
    return a.simpleString() == b.simpleString()


def merge_types(old: T.DataType, new: T.DataType) -> T.DataType:
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schemas(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merge_types(old.elementType, new.elementType), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, merge_types(old.valueType, new.valueType), True)
    return old


def merge_schemas(old: T.StructType | None, new: T.StructType | None) -> T.StructType | None:
    """Fields of ``old`` in their places, each merged with its namesake,
    then the fields only ``new`` has; added fields can be NULL."""
    if old is None or new is None:
        return new if old is None else old
    by_name = {f.name.lower(): f for f in new.fields}
    fields = [T.StructField(f.name, merge_types(f.dataType, by_name[f.name.lower()].dataType), True, f.metadata)
              if f.name.lower() in by_name else f for f in old.fields]
    known = {f.name.lower() for f in old.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata)
                                  for f in new.fields if f.name.lower() not in known])


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type ``have`` as ``want``: missing fields are NULL, fields
    unknown to ``want`` go, other values are cast or NULL."""
    if same_type(have, want):
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        by_name = {f.name.lower(): f for f in have.fields}
        fields = []
        for w in want.fields:
            h = by_name.get(w.name.lower())
            fields.append((conform(value.getField(h.name), h.dataType, w.dataType) if h
                           else F.lit(None).cast(w.dataType)).alias(w.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and same_type(have.keyType, want.keyType):
        return F.transform_values(value, lambda _, x: conform(x, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in (have, want)):
        return F.lit(None).cast(want)
    return value.try_cast(want)


def loses(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """TRUE where :func:`conform` turns something into NULL or drops it."""
    if same_type(have, want):
        return F.lit(False)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        by_name = {f.name.lower(): f for f in want.fields}
        out = F.lit(False)
        for h in have.fields:
            w, inner = by_name.get(h.name.lower()), value.getField(h.name)
            out = out | (loses(inner, h.dataType, w.dataType) if w else inner.isNotNull())
        return F.coalesce(out, F.lit(False))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.coalesce(F.exists(value, lambda x: loses(x, have.elementType, want.elementType)), F.lit(False))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and same_type(have.keyType, want.keyType):
        return F.coalesce(F.exists(F.map_values(value), lambda x: loses(x, have.valueType, want.valueType)), F.lit(False))
    return value.isNotNull() & conform(value, have, want).isNull()
