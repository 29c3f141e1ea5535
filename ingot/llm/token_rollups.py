"""Token totals kept up to date by signed deltas.

A batch of changes (insert, delete, revised count) is turned into signed
contributions, summed by source, language and tokenizer version, and
committed as one folder ``batch=<id>`` of a Parquet table. Totals are the sum
over the committed batches, so maintaining them costs as much as the batch,
not the corpus.

A commit is idempotent: a batch id that is already committed is not applied
again, and a writer that dies leaves an uncommitted staging folder that no
reader sees. ``compact`` folds committed batches into one and remembers their
ids.

Cases: null source or lang are groups of their own; a null count adds 0
tokens; a null text counts 0; an empty batch commits nothing but its id;
columns beyond those named are not read.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.llm.tokens import worker_encoder

KEYS = ["source", "lang", "tokenizer"]
INSERT, DELETE, REVISE = "insert", "delete", "revise"
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def word_count(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def byte_quads(text) -> F.Column:
    """UTF-8 bytes divided by four, rounded up: the usual budget estimate."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / F.lit(4)).cast("long")


def token_counts(docs: DataFrame, tokenizers: dict[str, tuple[str, str]]) -> DataFrame:
    """``source``, ``lang`` and, per version, the number of tokens of a text:
    ``tokenizers`` maps a version to the path and kind of its file."""

    def count(batches):
        encoders = {v: worker_encoder(*x) for v, x in tokenizers.items()}
        for pdf in batches:
            yield pd.DataFrame({"source": pdf["source"], "lang": pdf["lang"]} | {
                v: [len(ids) // 4 for ids in enc.encode_batch(pdf["text"])] for v, enc in encoders.items()})

    schema = "source string, lang string, " + ", ".join(f"`{v}` long" for v in tokenizers)
    return docs.select("source", "lang", "text").mapInPandas(count, schema)


def signed(changes: DataFrame) -> DataFrame:
    """``changes(op, source, lang, tokenizer, n_tokens, old_tokens)`` to signed
    contributions; a revision keeps the document and adds the difference."""
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    return changes.select(
        *KEYS,
        F.when(F.col("op") == INSERT, 1).when(F.col("op") == DELETE, -1).otherwise(0).cast("long").alias("n_docs"),
        F.when(F.col("op") == INSERT, new).when(F.col("op") == DELETE, -old)
        .otherwise(new - old).cast("long").alias("n_tokens"))


#: a fold of earlier batches, and the file in it that names them
FOLD, REPLACES = "batch=fold-", "_replaces"


class Rollup:
    """A rollup table at ``path`` (shared folder, any Hadoop store)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, p: str) -> bool:
        return self._fs.exists(self._path(p))

    def _replaced(self, fold: str) -> list[str]:
        """Names of the folders a fold stands for, those of earlier folds
        included."""
        stream = self._fs.open(self._path(f"{self.path}/{fold}/{REPLACES}"))
        try:
            jvm = self.spark.sparkContext._jvm
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return list(iter(reader.readLine, None))
        finally:
            stream.close()

    def _folders(self) -> tuple[list[str], set[str]]:
        """Batch folders that are there, and the names that folds replace."""
        if not self._exists(self.path):
            return [], set()
        names = sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(self.path)))
                       if n.startswith("batch="))
        gone: set[str] = set()
        for n in names:
            if n.startswith(FOLD):
                gone.update(self._replaced(n))
        return names, gone

    def committed(self) -> list[str]:
        """Folders whose sum is the table: batches, and the fold that replaced
        earlier ones. A replaced folder counts no more, whether it is deleted
        yet or not."""
        names, gone = self._folders()
        return [n for n in names if n not in gone]

    def has(self, batch_id: str) -> bool:
        names, gone = self._folders()
        return f"batch={batch_id}" in names or f"batch={batch_id}" in gone

    def _publish(self, staging: str, name: str) -> bool:
        """One rename; on stores where that moves a folder into one of the same
        name, the later of two writers finds itself inside and withdraws."""
        target = f"{self.path}/{name}"
        if self._exists(target) or not self._fs.rename(self._path(staging), self._path(target)):
            return False
        inside = f"{target}/{staging.rsplit('/', 1)[1]}"
        if self._exists(inside):
            self._fs.delete(self._path(inside), True)
            return False
        return True

    def commit(self, batch_id: str, contributions: DataFrame) -> bool:
        """Apply a batch once; False if it was applied before. The rename of
        the staging folder is the commit; of two racing writers one wins."""
        if self.has(batch_id):
            return False
        staging = f"{self.path}/_staging/{batch_id}-{uuid.uuid4().hex[:8]}"
        (contributions.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .filter("n_docs <> 0 or n_tokens <> 0").write.parquet(staging))
        return self._publish(staging, f"batch={batch_id}")

    def totals(self) -> DataFrame:
        """Totals by source, language and tokenizer; empty groups vanish."""
        parts = self.committed()
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        df = self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{p}" for p in parts])
        return df.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")) \
            .filter("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Fold the committed folders into one. The fold is written whole,
        with the names of all it replaces, and one rename makes it count and
        them not; only then are they deleted. A crash before that rename
        changes nothing, one after it leaves folders that nobody counts and
        the next call deletes."""
        parts = self.committed()
        if len(parts) > 1:
            name = f"{FOLD}{uuid.uuid4().hex[:8]}"
            staging = f"{self.path}/_staging/{name}"
            self.totals().coalesce(1).write.parquet(staging)
            _, gone = self._folders()
            out = self._fs.create(self._path(f"{staging}/{REPLACES}"), True)
            try:
                out.write(bytearray("".join(f"{p}\n" for p in sorted(gone | set(parts))).encode()))
            finally:
                out.close()
            if not self._publish(staging, name):
                raise OSError(f"cannot move {staging}")
        names, gone = self._folders()
        for n in names:
            if n in gone:
                self._fs.delete(self._path(f"{self.path}/{n}"), True)


def count_changes(docs: DataFrame, op: str, counters: dict, old: dict | None = None) -> DataFrame:
    """Changes of a document batch, one row per tokenizer version. ``counters``
    and ``old`` map a version to the expression of its new and earlier count."""
    none = F.lit(None).cast("long")
    rows = F.array(*[F.struct(F.lit(v).alias("tokenizer"),
                              (counters[v] if op != DELETE else none).alias("n_tokens"),
                              ((old or counters)[v] if op != INSERT else none).alias("old_tokens"))
                     for v in counters])
    return docs.select(F.lit(op).alias("op"), "source", "lang", F.inline(rows))
