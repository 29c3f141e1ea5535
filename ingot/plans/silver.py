"""Silver step: latest record per key, nested structs flattened, arrays
exploded, related collections joined (M2, J2, J3).

Joins are written as plain equi-joins: AQE turns a shuffle join into a
broadcast at runtime only when the measured side is below the broadcast
threshold, so no side is broadcast on an unchecked guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.operators.merge import latest_per_key


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every nested struct field becomes a top-level column named by its
    path (``imdb.rating`` → ``imdb_rating``); arrays are left as they are."""
    cols = []

    def walk(dt: T.StructType, path: list[str]):
        for f in dt.fields:
            p = path + [f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p)
            else:
                ref = ".".join(f"`{x}`" for x in p)
                cols.append(F.col(ref).alias(sep.join(p)))

    walk(df.schema, [])
    return df.select(*cols)


def explode_array(df: DataFrame, column: str, position: str | None = None, value: str | None = None) -> DataFrame:
    """One row per element; rows with a NULL or empty array are kept with
    NULL element (outer explode). ``position`` adds the 0-based index."""
    value = value or column
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    if position:
        return df.select(*others, F.posexplode_outer(F.col(f"`{column}`")).alias(position, value))
    return df.select(*others, F.explode_outer(F.col(f"`{column}`")).alias(value))


def to_silver(bronze: DataFrame, key: str = "_source_id", order_by: list[str] | None = None,
              explode: list[str] | None = None) -> DataFrame:
    """Latest bronze row per key, flattened, with the given arrays exploded
    one after the other."""
    order_by = order_by or ["_ingestion_timestamp"]
    latest = latest_per_key(bronze, [key], order_by)
    out = flatten(latest)
    for c in explode or []:
        out = explode_array(out, c)
    return out


def enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
           right_cols: list[str] | None = None, how: str = "left") -> DataFrame:
    """N:1 lookup join (J2, J3): only the key and the wanted columns of the
    right side are read."""
    keep = [c for c in (right_cols or right.columns) if c != right_key]
    r = right.select(F.col(right_key).alias("__rk"), *[F.col(c) for c in keep])
    return left.join(r, left[left_key] == r["__rk"], how).drop("__rk")
