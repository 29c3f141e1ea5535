"""State beside a stream's checkpoint: which micro-batches were applied, and
the versions of its schema.

Spark runs a micro-batch again when a query stopped between its work and the
checkpoint's commit. The ledger makes that harmless: an epoch is *begun*
before its rows are touched and *done* after its last effect, under the
query's own id, so a checkpoint that starts anew is a new query. An epoch that
is done is skipped; one that was only begun is applied again with the same run
id, and what its first attempt left is found by that id.

Both logs are small JSON files written whole under their final name, never
changed. Only the newest epoch can come again, so older ones are pruned.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ingot.functions.schemas import merge_schemas, same_type
from ingot.session import list_dir, path_exists, remove

KEEP_EPOCHS = 100


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with this content; False if there is one already.
    Written under another name and renamed, so no reader sees half of it."""
    jvm = spark.sparkContext._jvm
    p, tmp = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        return False
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, p):
        fs.delete(tmp, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


class EpochLedger:
    """``{root}/{query}/{epoch}.begun`` and ``.done``."""

    def __init__(self, spark: SparkSession, root: str, query: str):
        self.spark, self.folder = spark, f"{root}/epochs/{query}"

    def _path(self, epoch: int, state: str) -> str:
        return f"{self.folder}/{epoch:012d}.{state}"

    def is_done(self, epoch: int) -> bool:
        return path_exists(self.spark, self._path(epoch, "done"))

    def begin(self, epoch: int, entry: dict) -> tuple[dict, bool]:
        """What the epoch was begun with, and whether it was begun before."""
        fresh = write_text(self.spark, self._path(epoch, "begun"), json.dumps(entry))
        return (entry if fresh else json.loads(read_text(self.spark, self._path(epoch, "begun")))), not fresh

    def finish(self, epoch: int, result: dict) -> None:
        write_text(self.spark, self._path(epoch, "done"), json.dumps(result))
        for name, full, is_dir, _ in list_dir(self.spark, self.folder):
            number = name.split(".")[0]
            if not is_dir and number.isdigit() and int(number) < epoch - KEEP_EPOCHS:
                remove(self.spark, full)

    def result(self, epoch: int) -> dict | None:
        text = read_text(self.spark, self._path(epoch, "done"))
        return json.loads(text) if text else None


class SchemaLog:
    """``{root}/schemas/v{n}.json``: the stream's schema, a file a version.
    Fields are only ever added, so rows written under an older version read
    under every later one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/schemas"

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n, _, _, _ in list_dir(self.spark, self.folder)
                      if n.startswith("v") and n.endswith(".json"))

    def read(self, version: int) -> StructType:
        return StructType.fromJson(json.loads(read_text(self.spark, f"{self.folder}/v{version:06d}.json")))

    def current(self) -> tuple[int, StructType] | None:
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else None

    def evolve(self, incoming: StructType | None) -> tuple[int, StructType]:
        """The current version with what ``incoming`` adds, written as the
        next one if that is anything."""
        now = self.current()
        merged = merge_schemas(now[1] if now else None, incoming)
        if merged is None:
            raise ValueError("a stream needs a schema to begin with")
        if now and same_type(now[1], merged):
            return now
        version = now[0] + 1 if now else 1
        if not write_text(self.spark, f"{self.folder}/v{version:06d}.json", merged.json()):
            return self.evolve(incoming)        # another run wrote this version first
        return version, merged
