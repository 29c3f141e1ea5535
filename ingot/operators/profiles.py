"""Mergeable column profiles (A7, M4): kept per run, merged over runs, and
compared with the last runs.

A run's profile is one aggregate pass over its rows and one small row per
column: exact counts and range, and sketches of its different values (HLL), its
distribution (KLL, numbers only) and its most frequent values. Sketches merge
as counts do, so what a collection looks like over any runs is read from their
profiles, never from the rows again. All sketches are Spark's own aggregates.

Bounds: different values within ``DISTINCT_ERROR`` of the true number (three
standard errors), ranks within ``RANK_ERROR`` of the rows, counts of frequent
values within ``n_rows / (0.75 * TRACKED)``, exact while no more than that many
values are told apart.

Cases: an empty run gives zero counts and NULL ranges; a column that a run
lacks has no row for it and is merged from the others; a column whose type
changes between numbers and text keeps both ranges; NaN counts as a value, has
no rank, and is above all others in the range.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_LG_K, KLL_K, TRACKED = 12, 200, 1000
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03
GRID = 100        # the quantiles at which two distributions are compared

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def profile_run(df: DataFrame, run_id: str, at: _dt.datetime, cols: list[str] | None = None) -> DataFrame:
    """One row per column of a run's rows. Nested columns count by their JSON text."""
    aggs, rows = [], []
    for i, name in enumerate(cols or df.columns):
        dt = df.schema[name].dataType
        c = F.col(f"`{name}`")
        text = F.to_json(F.struct(c)) if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
        number = c.cast("double") if isinstance(dt, _NUMERIC) else F.lit(None).cast("double")
        ranked = F.when(~F.isnan(number), number)
        aggs += [F.count(F.lit(1)).alias(f"n{i}"), F.count_if(c.isNull()).alias(f"u{i}"),
                 F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"),
                 F.min(text).alias(f"lo{i}"), F.max(text).alias(f"hi{i}"),
                 F.hll_sketch_agg(text, HLL_LG_K).alias(f"d{i}"),
                 F.kll_sketch_agg_double(ranked, KLL_K).alias(f"q{i}"),
                 F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"t{i}")]
        is_number = F.lit(isinstance(dt, _NUMERIC))
        rows.append(F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("n_rows"), F.col(f"u{i}").alias("n_nulls"),
                             F.col(f"a{i}").alias("low"), F.col(f"b{i}").alias("high"),
                             F.when(~is_number, F.col(f"lo{i}")).alias("low_text"),
                             F.when(~is_number, F.col(f"hi{i}")).alias("high_text"),
                             F.col(f"d{i}").alias("distinct_sketch"),
                             F.when(is_number, F.col(f"q{i}")).alias("rank_sketch"),
                             F.col(f"t{i}").alias("top_sketch")))
    return df.agg(*aggs).select(F.lit(run_id).alias("run_id"), F.lit(at).cast("timestamp_ntz").alias("profiled_at"),
                                F.inline(F.array(*rows)))


def keep_profile(df: DataFrame, path: str, run_id: str, at: _dt.datetime, cols: list[str] | None = None) -> None:
    """Profile a run and keep it under ``path``. A run profiled again replaces
    its profile, so a repeated run is not counted twice."""
    profile_run(df, run_id, at, cols).drop("run_id").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).option("mergeSchema", "false").parquet(path) \
        .withColumn("run_id", F.col("run_id").cast("string"))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of any runs as one per column, of the same columns but
    ``n_runs`` for the run's own."""
    return profiles.groupBy("column_name").agg(
        F.count_distinct("run_id").alias("n_runs"), F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("rank_sketch", KLL_K).alias("rank_sketch"),
        F.call_function("approx_top_k_combine", F.col("top_sketch"), F.lit(TRACKED)).alias("top_sketch"))


def n_distinct(sketch: Column | str) -> Column:
    return F.hll_sketch_estimate(sketch)


def _ranked(sketch: Column) -> Column:
    """The sketch where it holds anything: an empty one has no quantiles."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, sketch)


def quantile(sketch: Column | str, rank: float) -> Column:
    s = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.kll_sketch_get_quantile_double(_ranked(s), F.lit(rank))


def top_values(sketch: Column | str, k: int) -> Column:
    """The k most frequent values as text with their counts, NULL among them."""
    s = F.col(sketch) if isinstance(sketch, str) else sketch
    return F.call_function("approx_top_k_estimate", s, F.lit(k))


def drift(profiles: DataFrame, run_id: str, last: int = 10) -> DataFrame:
    """A run against the ``last`` runs before it, per column: the change of the
    null share, how far apart the ranks of a value lie at most (0 to 1, to one
    part in ``GRID``), the share of its different values that are new, and whether the column is
    new or gone. Columns without a counterpart have NULL figures."""
    when = F.col("profiled_at")
    at = profiles.where(F.col("run_id") == run_id).agg(F.max(when)).first()[0]
    before = profiles.where((F.col("run_id") != run_id) & (when <= F.lit(at).cast("timestamp_ntz"))) \
        .select("run_id", "profiled_at").distinct().orderBy(when.desc(), F.col("run_id").desc()).limit(last)
    own = merge_profiles(profiles.where(F.col("run_id") == run_id))
    old = merge_profiles(profiles.join(before.select("run_id"), "run_id", "left_semi"))

    def share(side: str) -> Column:
        return F.col(f"{side}.n_nulls") / F.when(F.col(f"{side}.n_rows") > 0, F.col(f"{side}.n_rows"))

    # both distributions as quantiles; a value's rank is the share of them up to it
    ranks = F.array(*[F.lit(i / GRID) for i in range(1, GRID)])
    own_grid, old_grid = (F.kll_sketch_get_quantile_double(_ranked(F.col(f"{side}.rank_sketch")), ranks) for side in "no")

    def shift(value: Column) -> Column:
        return F.abs(F.size(F.filter(own_grid, lambda x: x <= value)) - F.size(F.filter(old_grid, lambda x: x <= value)))

    apart = F.array_max(F.transform(F.array_union(own_grid, old_grid), shift)) / GRID
    both = F.hll_sketch_estimate(F.hll_union("n.distinct_sketch", "o.distinct_sketch"))
    seen, here = n_distinct("o.distinct_sketch"), n_distinct("n.distinct_sketch")
    return own.alias("n").join(old.alias("o"), "column_name", "full").select(
        "column_name",
        F.when(F.col("o.n_runs").isNull(), "new").when(F.col("n.n_runs").isNull(), "gone").otherwise("kept").alias("column_state"),
        (share("n") - share("o")).alias("null_change"),
        F.when(own_grid.isNotNull() & old_grid.isNotNull(), apart).alias("rank_shift"),
        F.when(here > 0, F.least(F.lit(1.0), F.greatest(both - seen, F.lit(0)) / here)).alias("new_values"))
