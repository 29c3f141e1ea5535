"""JSON / variant functions: document text, typed expansion, variant reads
and schema inference (X7, X8, X10, P5, A9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def to_json_text(df: DataFrame, cols: list[str] | None = None, keep_nulls: bool = True) -> Column:
    """Whole row (or chosen columns) as one JSON object text; nulls kept as
    JSON null like the source encoder does."""
    cols = cols or df.columns
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]),
                     {"ignoreNullFields": "false" if keep_nulls else "true"})


def json_path(path: list[str]) -> str:
    """Variant/JSON path for a list of field names; bracket form keeps
    names with dots or spaces intact."""
    parts = []
    for p in path:
        if p.replace("_", "a").isalnum():
            parts.append(f".{p}")
        else:
            parts.append("['" + p.replace("'", "\\'") + "']")
    return "$" + "".join(parts)


def parse_variant(col: Column | str) -> Column:
    """Text → VARIANT; a malformed value gives NULL instead of failing the
    whole job (strict ``parse_json`` aborts on one bad row)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c)


def variant_field(v: Column, path: list[str] | str, type_: str = "string") -> Column:
    p = path if isinstance(path, str) else json_path(path)
    return F.try_variant_get(v, p, type_)


def infer_json_schema(spark: SparkSession, text_df: DataFrame, column: str = "value",
                      sample_size: int | None = None) -> StructType:
    """Schema of all JSON texts (A9), inferred by Spark's own JSON reader
    over the column, so a key that only late rows have is not missed.
    ``sample_size`` bounds the rows looked at, for exploration."""
    texts = text_df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull())
    if sample_size is not None:
        texts = texts.limit(sample_size)
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    inferred = DataFrame(spark._jsparkSession.read().json(strings), spark).schema
    return StructType([f for f in inferred.fields if f.name != "_corrupt_record"])


def expand_json(df: DataFrame, column: str, schema: StructType | str, id_col: str | None = None,
                drop_duplicate_id: bool = True) -> DataFrame:
    """Typed struct from a JSON text column, then its fields as columns
    (P5). The document's own id field is dropped when it repeats the
    outer id column, so the result has one id column."""
    keep = [c for c in df.columns if c != column]
    # parsed once per row behind a generator: selecting doc fields straight
    # off from_json would be rewritten into one pruned parse per field
    parsed = df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in keep],
                                                 F.from_json(F.col(column), schema).alias("__doc")))))
    st = parsed.schema["__doc"].dataType
    inner = []
    for f in st.fields:
        if drop_duplicate_id and id_col and f.name == id_col and id_col in keep:
            continue
        if f.name in keep:
            inner.append(F.col(f"__doc.`{f.name}`").alias(f"doc_{f.name}"))
        else:
            inner.append(F.col(f"__doc.`{f.name}`").alias(f.name))
    return parsed.select(*[F.col(f"`{c}`") for c in keep], *inner)


def read_variant(df: DataFrame, column: str, id_col: str | None = None) -> DataFrame:
    """(id, doc VARIANT) view of a JSON text column."""
    cols = [F.col(id_col)] if id_col else []
    return df.select(*cols, parse_variant(column).alias("doc"))
