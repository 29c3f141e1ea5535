"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised in double precision; equal vectors form one class and
only the smallest vec_id of a class goes on. On the unit sphere a cosine of
0.95 or more is a Euclidean distance of at most 0.316. Each of ``TABLES``
tables hashes a vector to the floors of ``PROJECTIONS`` shifted Gaussian
projections divided by ``WIDTH``; a pair at exactly 0.95 meets in one of the
tables with probability 0.999 (closer pairs more surely), an unrelated pair
with 6e-4. Vectors of one bucket are compared exactly in double precision.

A bucket of more than ``BLOCK`` vectors is cut into blocks, and each pair of
blocks is a unit of work of its own, so no task gathers a large bucket and no
pair is left out.

Cases: null, zero or empty vectors and vectors with null or non-finite
components are linked with nothing and are components of their own; vectors of
different lengths are never linked; a null vec_id is linked with nothing;
rows repeated under one vec_id count as rows; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import components, written

TABLES, PROJECTIONS, WIDTH = 56, 14, 1.8
BLOCK = 512
SEED = 11


@lru_cache(maxsize=8)
def _projections(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return (rng.standard_normal((dim, TABLES * PROJECTIONS)), rng.uniform(0, WIDTH, TABLES * PROJECTIONS),
            rng.integers(1, 1 << 63, TABLES * PROJECTIONS, np.uint64) | np.uint64(1))


def unit(vector) -> np.ndarray | None:
    """The vector scaled to length 1 in double precision, or None."""
    if vector is None or len(vector) == 0:
        return None
    try:
        x = np.asarray(vector, dtype=np.float64)
    except TypeError:        # a null component among objects
        return None
    if not np.isfinite(x).all():
        return None
    peak = np.abs(x).max()
    if peak == 0:
        return None
    x = x / peak             # keeps the squares of very small and very large components finite
    return x / np.sqrt(x @ x) + 0.0   # adding 0 makes a negative zero an ordinary one


def bucket_keys(x: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per table for each row of unit vectors."""
    a, shift, mul = _projections(x.shape[1])
    cell = np.floor((x @ a + shift) / WIDTH).astype(np.int64).view(np.uint64)
    cell = ((cell ^ (cell >> np.uint64(31))) + np.uint64(0x9E3779B97F4A7C15)) * mul
    cell ^= cell >> np.uint64(29)
    key = cell.reshape(len(x), TABLES, PROJECTIONS).sum(axis=2, dtype=np.uint64)
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.arange(TABLES, dtype=np.uint64)
    return key.view(np.int64)


def _keyed(vectors: DataFrame) -> DataFrame:
    def run(batches):
        for pdf in batches:
            units = [unit(v) for v in pdf["embedding"]]
            out = pd.DataFrame({
                "vec_id": pdf["vec_id"].astype("Int64"),
                "vec": [None if u is None else u.tobytes() for u in units],
                "same": [None if u is None else hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in units],
                "keys": [None] * len(units)}, dtype=object)
            by_dim: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                if u is not None:
                    by_dim.setdefault(len(u), []).append(i)
            keys = [None] * len(units)
            for rows in by_dim.values():
                for i, k in zip(rows, bucket_keys(np.stack([units[i] for i in rows])), strict=True):
                    keys[i] = k
            out["keys"] = keys
            yield out

    return vectors.select(F.col("vec_id").cast("long"), "embedding") \
        .mapInPandas(run, "vec_id long, vec binary, same binary, keys array<long>")


def _compare(batches, least: float):
    """Rows (unit, lo, vec_id, vec) with the rows of a unit of work together:
    pairs of ids with a cosine of ``least`` or more. ``lo`` says which of the
    unit's two blocks a row is of; both are the same for a unit within a block."""
    def finish(part: pd.DataFrame):
        out_a, out_b = [], []
        ids = part["vec_id"].to_numpy(np.int64)
        unit_no = part["unit"].to_numpy()
        left = part["lo"].to_numpy(bool)
        within = part["inner"].to_numpy(bool)
        vecs = part["vec"].tolist()
        cuts = np.flatnonzero(np.concatenate(([True], unit_no[1:] != unit_no[:-1], [True])))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if e - s < 2:
                continue
            by_dim: dict[int, list[int]] = {}
            for i in range(s, e):
                by_dim.setdefault(len(vecs[i]), []).append(i)
            for rows in by_dim.values():
                x = np.frombuffer(b"".join(vecs[i] for i in rows)).reshape(len(rows), -1)
                rows = np.array(rows)
                if within[s]:
                    i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
                else:
                    l, r = np.flatnonzero(left[rows]), np.flatnonzero(~left[rows])
                    i, j = np.nonzero(x[l] @ x[r].T >= least)
                    i, j = l[i], r[j]
                out_a.append(ids[rows[i]])
                out_b.append(ids[rows[j]])
        a = np.concatenate(out_a) if out_a else np.empty(0, np.int64)
        b = np.concatenate(out_b) if out_b else np.empty(0, np.int64)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        u = pdf["unit"].to_numpy()
        last = int(np.searchsorted(u, u[-1])) if len(u) else 0    # the last unit may go on
        if last:
            yield finish(pdf.iloc[:last])
        held = pdf.iloc[last:]
    if held is not None and len(held):
        yield finish(held)


def links(keyed: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)``, a < b, between class representatives."""
    rows = keyed.select("vec_id", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    member = written(rows.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
                     .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
                     .select("key", "vec_id", "blocks", "block"), "bucket-members")
    pairs = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("vec_id", (F.col("block") <= F.col("other")).alias("lo"), (F.col("block") == F.col("other")).alias("inner"),
                F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit"))
    # a block within itself and beside another block are units of their own
    work = pairs.join(keyed.select("vec_id", "vec"), "vec_id") \
        .repartition("unit").sortWithinPartitions("unit")
    return work.select("unit", "lo", "inner", "vec_id", "vec") \
        .mapInPandas(lambda b: _compare(b, least), "a long, b long").distinct()


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """Per row ``(vec_id, n_links, component_id, kept)``."""
    keyed = written(_keyed(vectors), "keyed-vectors")
    classes = written(keyed.filter("vec is not null and vec_id is not null").groupBy("same")
                      .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    reps = keyed.join(classes.select(F.col("rep").alias("vec_id"), F.col("same").alias("_s")), "vec_id") \
        .filter(F.col("same") == F.col("_s")).dropDuplicates(["vec_id"]).select("vec_id", "vec", "keys")
    reps = written(reps, "class-vectors")
    found = written(links(reps, least), "links")
    size = classes.select(F.col("rep").alias("b"), "copies")
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(size, "b").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("linked"))
    comp = components(found).select(F.col("node").alias("rep"), "component")
    per_class = classes.join(others, "rep", "left").join(comp, "rep", "left") \
        .select("same", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n"),
                F.coalesce("component", "rep").alias("c"))
    usable = F.col("vec_id").isNotNull() & F.col("n").isNotNull()
    return keyed.select("vec_id", "same").join(per_class, "same", "left") \
        .select("vec_id", F.when(usable, F.col("n")).otherwise(0).cast("long").alias("n_links"),
                F.when(usable, F.col("c")).otherwise(F.col("vec_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
