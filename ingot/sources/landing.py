"""JSON-lines landing scan with a pinned schema and a rescue column.

The landing folder is read as text (one document per line), parsed
against a pinned schema, and every value that does not fit is kept in
``_rescued_data``. The schema is the target table's when it exists,
else inferred once over all lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingot.functions.json import infer_json_schema
from ingot.functions.rescue import RESCUE_COLUMN, parse_json_lines


def read_landing_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("pathGlobFilter", "*.json*").text(paths) \
        .where(F.length(F.trim("value")) > 0)


def read_landing(spark: SparkSession, paths: str | list[str], schema: StructType | None = None,
                 rescue: bool = True, sample_size: int | None = None) -> DataFrame:
    """Typed landing rows plus ``_rescued_data``. Blank lines are skipped;
    an empty landing gives an empty frame with the pinned schema."""
    text = read_landing_text(spark, paths)
    if schema is None:
        schema = infer_json_schema(spark, text, "value", sample_size)
    if not schema.fields:
        return text.select(F.col("value").alias(RESCUE_COLUMN))
    return parse_json_lines(text, schema, "value", rescue)


def read_landing_fields(spark: SparkSession, paths: str | list[str], schema: StructType,
                        fields: list[str]) -> DataFrame:
    """Only some typed fields of the landing (for metrics passes): one parse
    per line with a schema holding just those fields."""
    sub = StructType([schema[f] for f in fields if f in schema.fieldNames()])
    if not sub.fields:
        return read_landing_text(spark, paths).select()
    return parse_json_lines(read_landing_text(spark, paths), sub, "value", rescue=False)
