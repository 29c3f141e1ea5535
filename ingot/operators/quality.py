"""Quality operators: key metrics, reconciliation status, profiles,
quarantine tags and data contracts (A1-A3, A7, A8, A11, C2, P14, M4, M6).

Metrics are computed in one pass: a ``groupBy(key)`` count (partial
aggregation on the map side, so a hot key costs one row per map task)
followed by one global aggregate. Only the final scalars reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.config import PARTIAL, SUCCESS
from ingot.functions.scalars import divergence_pct, pct


def key_metrics(df: DataFrame, key: str | Column, by: list[str] | None = None,
                with_range: bool = False) -> DataFrame:
    """Per group (or overall): total rows, null-key rows and their share
    (4 places), keys occurring more than once (all nulls are one group) and
    distinct non-null keys; ``with_range`` adds the key range. Both levels
    are hash aggregates on numbers; only the optional text min/max needs
    a sort-based aggregate."""
    by = by or []
    k = F.col(key) if isinstance(key, str) else key
    per_key = df.groupBy(*by, k.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    total = F.sum("__n")
    nulls = F.coalesce(F.sum(F.when(F.col("__k").isNull(), F.col("__n"))), F.lit(0))
    aggs = [total.cast("long").alias("total_rows"),
            nulls.cast("long").alias("null_keys"),
            pct(nulls, total).alias("pct_null_keys"),
            F.count_if(F.col("__n") > 1).cast("long").alias("duplicate_key_groups"),
            F.count("__k").cast("long").alias("distinct_keys")]
    if with_range:
        aggs += [F.min("__k").alias("min_key"), F.max("__k").alias("max_key")]
    return per_key.groupBy(*by).agg(*aggs)


@dataclass(frozen=True)
class BatchMetrics:
    total: int
    null_keys: int
    pct_null: float
    duplicate_groups: int
    min_key: object
    max_key: object


def batch_metrics(df: DataFrame, key: str) -> BatchMetrics:
    """Driver-side scalars of :func:`key_metrics` for one batch."""
    r = key_metrics(df, key, with_range=True).first()
    if r is None:
        return BatchMetrics(0, 0, 0.0, 0, None, None)
    return BatchMetrics(r.total_rows or 0, r.null_keys or 0, float(r.pct_null_keys or 0.0),
                        r.duplicate_key_groups or 0, r.min_key, r.max_key)


def removed_by_dedup(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows read, rows kept after dedup on ``keys`` and rows removed (A8),
    overall or per ``by`` group. Counted from one ``groupBy(by + keys)``;
    null keys form one group, as in the dedup itself (``count(distinct)``
    would skip them)."""
    by = by or []
    g = df.groupBy(*by, *[k for k in keys if k not in by]).agg(F.count(F.lit(1)).alias("__n"))
    return g.groupBy(*by).agg(F.sum("__n").cast("long").alias("rows_read"),
                              F.count(F.lit(1)).cast("long").alias("rows_kept")) \
        .withColumn("rows_removed", F.col("rows_read") - F.col("rows_kept"))


# The control-log message of a PARTIAL run (three figures),
# as a Python format and as a Spark format_string pattern.
PARTIAL_MESSAGE = "divergencia={div:.2f}% (limiar={threshold}%) nulos_id={pct_null}% duplicados_no_lote={dups}"
PARTIAL_MESSAGE_SQL = "divergencia=%.2f%% (limiar=%s%%) nulos_id=%s%% duplicados_no_lote=%s"

# Quarantine tag columns.
QUARANTINE_ORIGIN, QUARANTINE_AT, QUARANTINE_REASON = "origem", "quarentena_em", "motivo"


def status_column(divergence: Column, threshold: Column, null_keys: Column, duplicate_groups: Column) -> Column:
    """PARTIAL when divergence exceeds the threshold, or any null key, or any
    duplicate key group; else SUCCESS (C2). Null keys are tested by count,
    not by the rounded share, so a tiny share cannot vanish."""
    bad = (divergence > threshold) | (null_keys > 0) | (duplicate_groups > 0)
    return F.when(bad, F.lit(PARTIAL)).otherwise(F.lit(SUCCESS))


def reconcile(df: DataFrame, extracted: str = "extracted", landed: str = "landed",
              threshold: str = "threshold_pct", null_keys: str = "null_keys",
              null_pct: str = "pct_null_keys", duplicate_groups: str = "duplicate_key_groups") -> DataFrame:
    """Add divergence % and status to rows of per-run (or per-collection)
    figures. Works on any number of rows — one per collection and run."""
    div = divergence_pct(F.col(extracted).cast("double"), F.col(landed).cast("double"))
    out = df.withColumn("divergence_pct", F.round(div, 4))
    out = out.withColumn("status", status_column(div, F.col(threshold), F.col(null_keys), F.col(duplicate_groups)))
    msg = F.format_string(PARTIAL_MESSAGE_SQL, div, F.col(threshold).cast("string"),
                          F.col(null_pct).cast("string"), F.col(duplicate_groups).cast("string"))
    return out.withColumn("message", F.when(F.col("status") == PARTIAL, msg))


def reconcile_status(extracted: int, landed: int, threshold: float, null_keys: int,
                     pct_null: float, duplicate_groups: int) -> tuple[str, str | None, float]:
    """Scalar form used by the run driver for one collection."""
    div = abs(extracted - landed) / extracted * 100 if extracted else 0.0
    if div > threshold or null_keys > 0 or duplicate_groups > 0:
        msg = PARTIAL_MESSAGE.format(div=div, threshold=threshold, pct_null=pct_null, dups=duplicate_groups)
        return PARTIAL, msg, div
    return SUCCESS, None, div


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def column_profile(df: DataFrame, cols: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """Describe-style profile in long form, one row per column (A7): type,
    count of non-null values, null share, mean, sample stddev, min, max.
    One aggregate pass over the data; the per-column rows are produced
    from the single result row by ``inline``."""
    cols = cols or df.columns
    aggs, rows = [], []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        cc = F.col(f"`{c}`")
        num = isinstance(dt, _NUMERIC)
        aggs += [F.count(cc).alias(f"c{i}"), F.count(F.lit(1)).alias(f"n{i}"),
                 (F.avg(cc) if num else F.lit(None).cast("double")).alias(f"a{i}"),
                 (F.stddev_samp(cc) if num else F.lit(None).cast("double")).alias(f"s{i}"),
                 F.min(cc).cast("string").alias(f"lo{i}"), F.max(cc).cast("string").alias(f"hi{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(dt.simpleString()).alias("data_type"),
            F.col(f"c{i}").cast("long").alias("count"),
            pct(F.col(f"n{i}") - F.col(f"c{i}"), F.col(f"n{i}")).alias("pct_null"),
            (F.round(F.col(f"a{i}"), digits) if digits is not None else F.col(f"a{i}")).alias("mean"),
            (F.round(F.col(f"s{i}"), digits) if digits is not None else F.col(f"s{i}")).alias("stddev"),
            F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def source_profile(df: DataFrame, watermark_field: str, by: list[str] | None = None,
                   array_field: str | None = None) -> DataFrame:
    """Validation figures of a collection (A11, S5): documents, min/max of
    the watermark field where present, documents lacking it, and the
    array length range of an optional array field."""
    by = by or []
    w = F.col(f"`{watermark_field}`")
    aggs = [F.count(F.lit(1)).cast("long").alias("n_docs"),
            F.min(w).alias("min_watermark"), F.max(w).alias("max_watermark"),
            F.count_if(w.isNull()).cast("long").alias("n_missing_watermark")]
    if array_field:
        s = F.size(F.col(array_field))
        aggs += [F.min(s).alias("min_array_len"), F.max(s).alias("max_array_len")]
    return df.groupBy(*by).agg(*aggs)


def tag_quarantine(df: DataFrame, condition: Column, reason: str, origin: str, at: Column) -> DataFrame:
    """Keep every row; rows meeting ``condition`` get a quarantine time and
    reason, all rows the origin label (P14). Null columns are typed."""
    return df.withColumns({
        QUARANTINE_ORIGIN: F.lit(origin),
        QUARANTINE_AT: F.when(condition, at).otherwise(F.lit(None).cast("timestamp")),
        QUARANTINE_REASON: F.when(condition, F.lit(reason)).otherwise(F.lit(None).cast("string")),
    })


def empty_or_null(col: str) -> Column:
    c = F.col(f"`{col}`")
    return c.isNull() | (F.coalesce(F.size(c), F.lit(0)) == 0)


def split_quarantine(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) by one condition; NULL counts as bad."""
    bad = F.coalesce(condition, F.lit(True))
    return df.where(~bad), df.where(bad)


def contract_check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Data contract (M4): one row per rule with its violation count, all in
    one pass. A rule holds for a row when its condition is TRUE; NULL is a
    violation."""
    names = list(rules)
    aggs = [F.count_if(~F.coalesce(rules[n], F.lit(False))).cast("long").alias(f"v{i}")
            for i, n in enumerate(names)]
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations"),
                     (F.col(f"v{i}") == 0).alias("passed")) for i, n in enumerate(names)]
    return df.agg(F.count(F.lit(1)).cast("long").alias("__rows"), *aggs) \
        .select(F.inline(F.array(*rows)))


def schema_diff(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, problem, expected type, actual type) for missing columns,
    type changes and unexpected columns; empty when they agree."""
    out = []
    a = {f.name: f for f in actual.fields}
    e = {f.name: f for f in expected.fields}
    for n, f in e.items():
        if n not in a:
            out.append((n, "missing", f.dataType.simpleString(), None))
        elif a[n].dataType != f.dataType:
            out.append((n, "type", f.dataType.simpleString(), a[n].dataType.simpleString()))
        elif not f.nullable and a[n].nullable:
            out.append((n, "nullability", "not null", "nullable"))
    for n, f in a.items():
        if n not in e:
            out.append((n, "unexpected", None, f.dataType.simpleString()))
    return out
