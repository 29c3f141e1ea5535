"""Document-collection reads.

A collection is any DataFrame with an id field. The filtered, projected
scan is lazy; paging is a property of how it is landed (see
``operators.landing``), not a driver loop over pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ingot.functions.json import expand_json, infer_json_schema, read_variant, to_json_text
from ingot.operators.filters import exclude_fields

# Raw document table layout.
RAW_SCHEMA = StructType([StructField("_id", StringType(), True), StructField("body", StringType(), True)])


def scan_collection(df: DataFrame, condition: Column | None = None,
                    exclude: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Filtered and projected collection scan (S1, P1): the predicate and
    the pruned column list both reach the source scan."""
    out = df.where(condition) if condition is not None else df
    return exclude_fields(out, list(exclude))


def raw_documents(df: DataFrame, id_field: str, condition: Column | None = None,
                  exclude: tuple[str, ...] = (), limit: int | None = None) -> DataFrame:
    """``(_id string, body string)`` rows (S2): the id as text ("" when
    missing) and the whole document as JSON text with nulls kept. A
    truthy ``limit`` caps the read (S3)."""
    src = scan_collection(df, condition, exclude)
    if limit:
        src = src.limit(limit)
    id_col = F.col(f"`{id_field}`").cast("string") if id_field in src.columns else F.lit(None)
    return src.select(F.coalesce(id_col, F.lit("")).alias("_id"), to_json_text(src).alias("body"))


def expand_documents(raw: DataFrame, sample_size: int | None = None, schema=None) -> DataFrame:
    """Raw documents expanded to typed columns using a schema inferred from
    all bodies (A9 + P5), so a field that only late ones have is kept, or from
    ``sample_size`` of them; the body's own ``_id`` is dropped."""
    spark = raw.sparkSession
    schema = schema or infer_json_schema(spark, raw, "body", sample_size)
    return expand_json(raw, "body", schema, id_col="_id")


def variant_documents(raw: DataFrame) -> DataFrame:
    """``(_id, doc VARIANT)``."""
    return read_variant(raw, "body", "_id")
