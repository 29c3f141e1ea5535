"""Table write operators: insert-only merge, snapshot overwrite, delete by
key, latest record per key, full-row distinct and row hash (J1, K5, K6,
K10, W1, U1, M5).

Without a transactional table format the insert-only merge is an anti
join against the target's key column followed by a partitioned append.
Single writer per table is assumed (documented limit).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.rescue import RESCUE_COLUMN, entries_to_json, entry, escaped, json_to_entries, no_entries
from ingot.functions.schemas import conform, loses, merge_schemas, merge_types, same_type
from ingot.session import list_dir, metrics_of, path_exists

PARTITION_COLUMN = "_ingestion_date"


SCHEMA_FILE = "_schema.json"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table schema kept beside the data (``_schema.json``), if any."""
    p, fs = _fs_path(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = "".join(iter(reader.readLine, None))
    finally:
        stream.close()
    if not text.strip():
        return None  # cut off while it was written: footers tell the schema
    return T.StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Write the table schema beside the data. Written before the data it
    describes, so it is always a superset of the columns on disk; the
    leading underscore keeps it out of Spark's file listing."""
    p, fs = _fs_path(spark, f"{path}/{SCHEMA_FILE}")
    fresh, _ = _fs_path(spark, f"{path}/_schema_{uuid.uuid4().hex[:12]}.json")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(schema.json().encode("utf-8")))
    finally:
        out.close()
    # a reader between the two steps finds no sidecar and merges footers instead
    if fs.exists(p):
        fs.delete(p, False)
    _move(fs, fresh, p)


def read_table(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """A path table. With a stored schema no footer is read to plan the
    scan; otherwise schema evolution across appends is resolved by
    Parquet schema merging (one job over all footers)."""
    schema = stored_schema(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    if not path_exists(spark, path):
        return False
    # partition folders (``_ingestion_date=...``) count; temp/marker names do not
    return any("=" in n or n == "_SUCCESS" or not n.startswith(("_", "."))
               for n, _, _, _ in list_dir(spark, path))


def ensure_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                 partition_by: tuple[str, ...] = (PARTITION_COLUMN,), fmt: str = "parquet") -> bool:
    """Bootstrap an empty catalogue table over ``path`` with the batch's
    schema, partitioned, only if absent (K5); partitions appended to the
    path later are picked up by :func:`refresh_table`. Returns True when
    created."""
    if spark.catalog.tableExists(name):
        return False
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{part} LOCATION '{path}'")
    return True


def refresh_table(spark: SparkSession, name: str) -> None:
    """Register partition folders written through the path and drop cached
    file listings, so the catalogue table sees every append."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def align_to_target(batch: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Bring batch columns to the target's types, so appends stay readable:
    fields that only one side has are kept at any depth (the target's schema
    gets them), other values are cast (``try_cast``). A column in which a value
    does not convert is written to ``_rescued_data`` under its name, whole."""
    tgt = {f.name.lower(): f.dataType for f in target_schema.fields}
    casts, lost = {}, []
    for f in batch.schema.fields:
        want = merge_types(tgt.get(f.name.lower(), f.dataType), f.dataType)
        if not same_type(f.dataType, want) and not f.name.startswith("_"):
            src = F.col(f"`{f.name}`")
            casts[f.name] = conform(src, f.dataType, want)
            text = (F.to_json(src) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
                    else src.cast("string"))
            lost.append(F.when(loses(src, f.dataType, want), entry(escaped(F.lit(f.name)), text))
                        .otherwise(no_entries()))
    if not casts:
        return batch
    if RESCUE_COLUMN in batch.columns:
        lost.insert(0, json_to_entries(F.col(RESCUE_COLUMN)))
    # the entries are a column of their own: they are used several times
    out = batch.withColumn("__lost", F.concat(*lost))
    return out.withColumn(RESCUE_COLUMN, entries_to_json(F.col("__lost"))).withColumns(casts).drop("__lost")


def insert_only_rows(batch: DataFrame, target: DataFrame | None, key: str = "_source_id",
                     key_range: tuple | None = None) -> DataFrame:
    """The rows an insert-only merge would append (the plan, no write):
    batch rows whose key the target lacks. A NULL key equals nothing, so the
    anti join keeps it; should many rows have one, AQE splits that partition.
    The batch is read once, and of the target only the key column, cut to the
    batch's key range where it is known."""
    if target is None:
        return batch
    batch = align_to_target(batch, target.schema)
    existing = target.select(F.col(f"`{key}`").alias("__k")).where(F.col("__k").isNotNull())
    if key_range is not None and key_range[0] is not None:
        existing = existing.where(F.col("__k").between(F.lit(key_range[0]), F.lit(key_range[1])))
    return batch.join(existing, batch[key] == existing["__k"], "left_anti")


def insert_only_merge(spark: SparkSession, batch: DataFrame, target_path: str, key: str = "_source_id",
                      partition_by: tuple[str, ...] = (PARTITION_COLUMN,),
                      key_range: tuple | None = None, sort_within: bool = True,
                      target: DataFrame | None = None,
                      observe: dict[str, Column] | None = None, observed: dict | None = None) -> int:
    """Insert batch rows whose key is absent from the target; matched rows
    stay untouched (J1). Equality is not null-safe: a NULL key never
    matches and is inserted on every run; duplicates inside the batch are
    all inserted when their key is new. Returns the rows written, counted
    by an observation on the write itself (no second scan).

    Only the target's key column is read. When the batch key range is
    known it is pushed into the target scan as a range predicate, so
    Parquet min/max statistics skip files of older key ranges (the target
    is written sorted by key within each file). ``target`` may pass an
    already resolved read of the table (saves a schema-merge pass).

    ``observe`` adds aggregate expressions over the rows actually written;
    their values land in ``observed``. All observations sit in the write
    stage itself, so a re-run map stage (lost executor) cannot count a row
    twice."""
    obs = Observation(f"written_{uuid.uuid4().hex[:8]}")
    if target is None and table_exists(spark, target_path):
        target = read_table(spark, target_path)
    new_rows = insert_only_rows(batch, target, key, key_range)
    if sort_within:
        new_rows = new_rows.sortWithinPartitions(*partition_by, key)
    data_cols = [f for f in new_rows.schema.fields if f.name not in partition_by]
    part_cols = [new_rows.schema[c] for c in partition_by]
    store_schema(spark, target_path, merge_schemas(target.schema if target is not None else None,
                                                   T.StructType(data_cols + part_cols)))
    extra = [c.alias(n) for n, c in (observe or {}).items()]
    new_rows = new_rows.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)
    (new_rows.write.mode("append").option("mergeSchema", "true")
     .partitionBy(*partition_by).parquet(target_path))
    got = metrics_of(obs)
    if observed is not None:
        observed.update({n: got.get(n) for n in (observe or {})})
    return int(got.get("rows", 0) or 0)


def _move(fs, src, dst) -> None:
    """Rename, raising where Hadoop only returns false."""
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {src.toString()} to {dst.toString()}")


def swap_in(spark: SparkSession, src: str, dst: str, aside: str) -> None:
    """Put folder ``src`` in the place of ``dst``. The old folder is moved to
    ``aside`` (whose own name readers skip) and is deleted last; if ``src``
    cannot be moved in, the old one is moved back. A crash in between leaves
    the old folder whole under ``aside``: :func:`restore_aside` puts it back."""
    new, fs = _fs_path(spark, src)
    old, _ = _fs_path(spark, dst)
    if not fs.exists(old):
        fs.mkdirs(old.getParent())
        _move(fs, new, old)
        return
    backup, _ = _fs_path(spark, aside)
    fs.mkdirs(backup.getParent())
    _move(fs, old, backup)
    try:
        _move(fs, new, old)
    except Exception:
        _move(fs, backup, old)
        raise
    fs.delete(backup, True)
    if not fs.listStatus(backup.getParent()):
        fs.delete(backup.getParent(), False)


def restore_aside(spark: SparkSession, aside: str, dst: str) -> bool:
    """After a crash inside :func:`swap_in`: if ``dst`` is missing, move the
    folder kept under ``aside`` back. True when it did."""
    old, fs = _fs_path(spark, dst)
    backup, _ = _fs_path(spark, aside)
    if fs.exists(old) or not fs.exists(backup):
        return False
    _move(fs, backup, old)
    return True


def overwrite_snapshot(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table with a new snapshot, schema included (K6). The new
    snapshot is written completely to a sibling staging folder first and
    then swapped in. Readers never see a half-written table, and ``df`` may
    read ``path`` itself (a table rebuilt from its own rows)."""
    spark = df.sparkSession
    base = path.rstrip("/")
    staging = f"{base}__staging_{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staging)
    parent, name = base.rsplit("/", 1)
    aside = f"{parent}/_replaced_{name}/old"
    restore_aside(spark, aside, base)
    swap_in(spark, staging, base, aside)


def _replace_partitions(spark: SparkSession, table_path: str, partition_col: str, parts: list,
                        new_rows: DataFrame, max_records: int | None = None) -> None:
    """Rewrite the given partitions of a path table with ``new_rows``
    (rows of those partitions only). The new files go to a staging folder
    first; each old partition folder is then swapped for the new one. Old
    folders wait under ``_replaced/``, which readers skip."""
    staging = f"{table_path}/_staging_{uuid.uuid4().hex[:12]}"
    w = new_rows.write.mode("overwrite").partitionBy(partition_col)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(staging)
    for p in parts:
        name = f"{partition_col}={p}"
        src, fs = _fs_path(spark, f"{staging}/{name}")
        if fs.exists(src):
            swap_in(spark, f"{staging}/{name}", f"{table_path}/{name}", f"{table_path}/_replaced/{p}")
        else:
            gone, _ = _fs_path(spark, f"{table_path}/{name}")
            fs.delete(gone, True)
    rest, fs = _fs_path(spark, staging)
    fs.delete(rest, True)


def restore_partitions(spark: SparkSession, table_path: str, partition_col: str = PARTITION_COLUMN) -> int:
    """Finish a partition rewrite that a crash cut short: partitions whose
    old folder still waits aside and whose place is empty come back."""
    return sum(restore_aside(spark, full, f"{table_path}/{partition_col}={name}")
               for name, full, d, _ in list_dir(spark, f"{table_path}/_replaced") if d)


def delete_keys(spark: SparkSession, table_path: str, keys: DataFrame, key: str = "_source_id",
                partition_col: str = PARTITION_COLUMN) -> int:
    """Delete rows whose key is in ``keys`` (K10) by rewriting only the
    partitions that hold them. Returns the number of partitions rewritten."""
    target = read_table(spark, table_path)
    k = keys.select(F.col(key).alias("__k")).distinct()
    hit = target.join(k, target[key] == k["__k"], "left_semi")
    # bounded: one value per table partition (a day), not per row
    parts = [r[0] for r in hit.select(partition_col).distinct().collect()]
    if not parts:
        return 0
    kept = target.where(F.col(partition_col).isin(parts)).join(k, target[key] == k["__k"], "left_anti")
    _replace_partitions(spark, table_path, partition_col, parts, kept)
    return len(parts)


def compact_partitions(spark: SparkSession, table_path: str, parts: list, partition_col: str = PARTITION_COLUMN,
                       key: str = "_source_id", target_file_bytes: int = 256 << 20) -> int:
    """Small-file control for a bronze table (M7): rewrite the given
    partitions into files of about ``target_file_bytes``, sorted by key
    (which keeps the key-range pruning of the merge effective). Rows are
    unchanged. Returns the number of files written."""
    target = read_table(spark, table_path)
    rows = target.where(F.col(partition_col).isin(parts))
    size = sum(n for p in parts for _, _, d, n in list_dir(spark, f"{table_path}/{partition_col}={p}") if not d)
    n = max(1, -(-size // target_file_bytes))
    out = rows.repartitionByRange(n, F.col(partition_col), F.col(f"`{key}`")) \
        .sortWithinPartitions(partition_col, key)
    _replace_partitions(spark, table_path, partition_col, parts, out)
    return sum(1 for p in parts for name, _, d, _ in list_dir(spark, f"{table_path}/{partition_col}={p}")
               if not d and name.endswith(".parquet"))


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def _json_packable(dt: T.DataType) -> bool:
    """Types that survive a ``to_json`` → ``from_json``/``parse_json``
    round trip exactly (maps need string keys)."""
    if isinstance(dt, T.MapType):
        return isinstance(dt.keyType, T.StringType) and _json_packable(dt.valueType)
    if isinstance(dt, T.StructType):
        return all(_json_packable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _json_packable(dt.elementType)
    return not isinstance(dt, (T.BinaryType, T.CalendarIntervalType))


def _pack(c: Column, dt: T.DataType) -> Column:
    return F.to_json(c) if not _orderable(dt) else c


def _unpack(c: Column, dt: T.DataType) -> Column:
    if _orderable(dt):
        return c
    if isinstance(dt, T.VariantType):
        return F.parse_json(c)
    return F.from_json(c, dt)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str], method: str = "auto",
                   group_rows: str | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` values (all
    descending), remaining columns breaking ties, so the survivor is
    deterministic (W1). NULL keys form one group.

    Default plan is a ``groupBy(keys).agg(max(struct(order..., rest...)))``:
    the aggregate is partial on the map side, so a key holding a third of
    all rows is reduced per map task before the shuffle (a window would
    sort that whole key in one task). Types that cannot be ordered fall
    back to ``row_number`` over a window. Payload columns that cannot be
    ordered (maps, variants) travel through the aggregate as JSON text and
    are restored after it, so they keep the skew-safe plan too; only maps
    with non-string keys need the window. ``group_rows`` names an extra
    output column holding how many input rows each key had."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    aggregatable = (all(_orderable(df.schema[c].dataType) for c in order_by)
                    and all(_orderable(df.schema[c].dataType) or _json_packable(df.schema[c].dataType)
                            for c in rest))
    if method == "window" or (method == "auto" and not aggregatable):
        src = df
        if group_rows:
            from pyspark.sql.window import Window
            src = df.withColumn(group_rows, F.count(F.lit(1)).over(
                Window.partitionBy(*[F.col(f"`{k}`") for k in keys])))
        return latest_per_key_window(src, keys, order_by)
    packed = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_by)],
                      *[_pack(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"r{i}") for i, c in enumerate(rest)])
    aggs = [F.max(packed).alias("__best")] + ([F.count(F.lit(1)).alias(group_rows)] if group_rows else [])
    agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs)
    sel = {c: F.col(f"__best.o{i}") for i, c in enumerate(order_by)}
    sel.update({c: _unpack(F.col(f"__best.r{i}"), df.schema[c].dataType) for i, c in enumerate(rest)})
    out_cols = [F.col(f"`{c}`") if c in keys else sel[c].alias(c) for c in df.columns]
    return agg.select(*out_cols, *([F.col(group_rows)] if group_rows else []))


def latest_per_key_window(df: DataFrame, keys: list[str], order_by: list[str],
                          tie_break: list[str] | None = None) -> DataFrame:
    """``row_number() = 1`` form of W1 (used for non-orderable payloads)."""
    from pyspark.sql.window import Window
    tie = tie_break if tie_break is not None else [c for c in df.columns
                                                    if c not in keys and c not in order_by
                                                    and _orderable(df.schema[c].dataType)]
    order = [F.col(f"`{c}`").desc() for c in order_by + tie] or [F.lit(1)]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Full-row (or column-subset) distinct."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def row_hash(cols: list[str]) -> Column:
    """SHA-256 of the columns as one JSON object (M5). JSON quotes its
    strings and writes NULL as such, so no two different rows share a text."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def dedup_by_hash(df: DataFrame, cols: list[str], key: str | None = None,
                  order_by: list[str] | None = None) -> DataFrame:
    """Append-and-dedup form of change detection: one row per (key, hash),
    the latest by ``order_by`` when given."""
    h = df.withColumn("_row_hash", row_hash(cols))
    keys = ([key] if key else []) + ["_row_hash"]
    if order_by:
        return latest_per_key(h, keys, order_by)
    return h.dropDuplicates(keys)
