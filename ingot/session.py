"""Spark session and shared work-folder helpers.

All written state (landing pages, bronze tables, control log, manifests)
lives under the shared folder the cluster names in ``spark.checkpoint.dir``.
The setting is read from the session; without it a cluster session is
an error and a local one gets a scratch folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Observation, SparkSession

# Settings every job of the library relies on. AQE re-plans joins and
# partition counts at runtime from real shuffle sizes; UTC keeps ISO
# strings and dates stable across machines.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "ingot",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster the launcher's
    settings win and only the defaults above are layered on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables, as the
    session names it in ``spark.checkpoint.dir``. Executors write there, so
    on a cluster no local folder can stand in for it; a local master, whose
    executors are this process, gets a scratch folder where none is named."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            # getCheckpointDir returns <dir>/<app uuid>; keep the app folder
            d = d.rsplit("/", 1)[0]
    if not d and re.match(r"local(\[|$)", spark.sparkContext.master):
        d = tempfile.mkdtemp(prefix="ingot-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not d:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder (never reused, never cleared) under the shared dir."""
    path = f"{shared_dir(spark)}/ingot/{label}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def metrics_of(observation: Observation) -> dict:
    """An observation's values; none where Spark found the plan empty and
    left its metrics out."""
    try:
        return observation.get
    except Py4JJavaError as e:
        if "AssertionError" not in e.java_exception.toString():
            raise
        return {}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the library wrote for itself."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Filesystem-agnostic existence check through the Hadoop FS API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, str, bool, int]]:
    """(name, full path, is_dir, length) of the entries of one directory.
    Used for directory-level metadata only (bounded by directory size)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        out.append((st.getPath().getName(), st.getPath().toString(), st.isDirectory(), st.getLen()))
    return sorted(out)


BYTES_PER_PARTITION = 128 << 20


def estimated_bytes(df) -> int:
    """Bytes of the files a DataFrame is read from (no job); 0 without files."""
    spark = df.sparkSession
    try:
        files = [unquote(f) for f in df.inputFiles()]
    except AnalysisException:
        return 0
    folders = {f.rsplit("/", 1)[0] for f in files}
    size = {f"{d}/{name}": n for d in folders for name, _, is_dir, n in list_dir(spark, d) if not is_dir}
    return sum(size.get(f, 0) for f in files)


def partitions_for(df, bytes_per_partition: int = BYTES_PER_PARTITION) -> int:
    """Partition count for an explicit (range) repartition that grows with
    the input: about ``bytes_per_partition`` of input per task, never fewer
    than the session's shuffle partitions. AQE does not resize an explicit
    range partitioning, so the count has to be right up front."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    est = estimated_bytes(df)
    return max(base, -(-est // bytes_per_partition))
