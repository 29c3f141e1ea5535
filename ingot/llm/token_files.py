"""Token-ID shard files: patched frame-of-reference blocks.

Texts are range-partitioned by doc_id, encoded, and each partition becomes one
shard file. A shard cuts its id stream into blocks of ``BLOCK`` ids. A block
stores its minimum, the ids minus that minimum packed at a width chosen as a
percentile of their bit lengths, and an exception list (position, high part)
for the few that are wider. The footer holds the byte offset of every block
and, per document, its doc_id and first id, so one document is read by
decoding only its own blocks.

Shard layout (little-endian):
  blocks   each: base u32, width u8, pad u8, n_exceptions u16,
           16 * width packed u64, exceptions' positions u16, high parts u32
  index    block offsets u64[n_blocks], doc ids i64[n_docs] (nulls as the
           smallest i64), doc starts u64[n_docs]
  trailer  n_ids u64, n_blocks u64, n_docs u64, magic b"PFORIDS1"

Files carry a fresh name per task attempt; the manifest, a written table,
names those of the attempts that Spark accepted. A lost executor or a
repeated task leaves at most a file that no manifest names.

Cases: null or empty text gives only the end id; a null doc_id sorts first;
repeated rows are kept, equal doc_ids in text order; an empty table gives an
empty manifest; other columns of the input are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ingot.llm.common import written
from ingot.llm.tokens import worker_encoder
from ingot.session import new_workspace, partitions_for

BLOCK = 1024
MAGIC = b"PFORIDS1"
NULL_ID = -(1 << 63)
WIDTH_PERCENTILE = 0.99
TEXT_BYTES_PER_SHARD = 32 << 20


# ---- block codec ---------------------------------------------------------

def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """(n, BLOCK) values below 2**w as (n, 16 * w) u64 words."""
    n = len(v)
    lanes = np.ascontiguousarray(v.reshape(n * BLOCK // 64, 64).T.astype(np.uint64))
    out = np.zeros((w, lanes.shape[1]), np.uint64)
    for i in range(64):
        k, s = divmod(i * w, 64)
        out[k] |= lanes[i] << np.uint64(s)
        if s + w > 64:
            out[k + 1] |= lanes[i] >> np.uint64(64 - s)
    return np.ascontiguousarray(out.T).reshape(n, -1)


def _unpack(words: np.ndarray, w: int) -> np.ndarray:
    n = len(words)
    lanes = np.ascontiguousarray(words.reshape(-1, w).T)
    out = np.empty((64, lanes.shape[1]), np.uint64)
    mask = np.uint64((1 << w) - 1)
    for i in range(64):
        k, s = divmod(i * w, 64)
        x = lanes[k] >> np.uint64(s)
        if s + w > 64:
            x = x | (lanes[k + 1] << np.uint64(64 - s))
        out[i] = x & mask
    return np.ascontiguousarray(out.T).reshape(n, BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = WIDTH_PERCENTILE) -> list[bytes]:
    """Blocks of an id array; the last one is padded with its own last id."""
    if not len(ids):
        return []
    pad = -len(ids) % BLOCK
    v = np.concatenate([ids, np.full(pad, ids[-1], ids.dtype)]).reshape(-1, BLOCK).astype(np.uint32)
    base = v.min(axis=1)
    d = v - base[:, None]
    bits = np.frexp(d.astype(np.float64))[1].astype(np.uint8)
    at = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.maximum(1, np.partition(bits, at, axis=1)[:, at])
    out: list[bytes] = [b""] * len(v)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        x = d[rows]
        words = _pack(x & np.uint32((1 << w) - 1), w)
        over = bits[rows] > w
        for j, r in enumerate(rows.tolist()):
            pos = np.flatnonzero(over[j])
            out[r] = b"".join((struct.pack("<IBBH", int(base[r]), w, 0, len(pos)), words[j].tobytes(),
                               pos.astype("<u2").tobytes(), (x[j, pos] >> np.uint32(w)).astype("<u4").tobytes()))
    return out


def decode_blocks(raw: bytes, offsets: np.ndarray) -> np.ndarray:
    """The ids of the blocks at ``offsets`` of ``raw``, BLOCK ids each."""
    out = np.empty((len(offsets), BLOCK), np.uint32)
    heads = [struct.unpack_from("<IBBH", raw, o) for o in offsets.tolist()]
    width = np.array([h[1] for h in heads], np.uint8)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        words = np.stack([np.frombuffer(raw, "<u8", 16 * w, int(offsets[r]) + 8) for r in rows])
        out[rows] = _unpack(words, w)
        for r in rows.tolist():
            n = heads[r][3]
            if n:
                o = int(offsets[r]) + 8 + 128 * w
                pos = np.frombuffer(raw, "<u2", n, o)
                out[r, pos] |= np.frombuffer(raw, "<u4", n, o + 2 * n) << np.uint32(w)
    out += np.array([h[0] for h in heads], np.uint32)[:, None]
    return out.reshape(-1)


# ---- shard files ---------------------------------------------------------

class ShardWriter:
    """Appends documents; ids leave memory block by block."""

    def __init__(self, out, percentile: float):
        self.out, self.percentile = out, percentile
        self.pending: list[bytes] = []
        self.pending_ids = self.n_ids = self.at = 0
        self.offsets: list[int] = []
        self.docs: list[int] = []
        self.starts: list[int] = []

    def add(self, doc_id, ids: bytes) -> None:
        self.docs.append(NULL_ID if doc_id is None else int(doc_id))
        self.starts.append(self.n_ids)
        self.pending.append(ids)
        self.n_ids += len(ids) // 4
        self.pending_ids += len(ids) // 4
        if self.pending_ids >= 512 * BLOCK:
            self._flush(whole=False)

    def _flush(self, whole: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        n = len(ids) if whole else len(ids) // BLOCK * BLOCK
        for b in encode_blocks(ids[:n], self.percentile):
            self.offsets.append(self.at)
            self.at += len(b)
            self.out.write(b)
        self.pending, self.pending_ids = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> int:
        self._flush(whole=True)
        tail = (np.array(self.offsets, "<u8").tobytes() + np.array(self.docs, "<i8").tobytes()
                + np.array(self.starts, "<u8").tobytes()
                + struct.pack("<QQQ", self.n_ids, len(self.offsets), len(self.docs)) + MAGIC)
        self.out.write(tail)
        return self.at + len(tail)


class Shard:
    """Random access to one shard's bytes."""

    def __init__(self, raw: bytes):
        if raw[-8:] != MAGIC:
            raise ValueError("not a token shard")
        self.raw = raw
        self.n_ids, nb, nd = struct.unpack_from("<QQQ", raw, len(raw) - 32)
        at = len(raw) - 32 - 8 * nb - 16 * nd
        self.offsets = np.frombuffer(raw, "<u8", nb, at)
        self.docs = np.frombuffer(raw, "<i8", nd, at + 8 * nb)
        self.starts = np.frombuffer(raw, "<u8", nd, at + 8 * nb + 8 * nd)

    def ids(self, first: int, last: int | None = None) -> list[np.ndarray]:
        """Ids of the documents ``first`` to before ``last`` (default: the one),
        decoding only the blocks they touch."""
        last = first + 1 if last is None else min(last, len(self.docs))
        ends = np.append(self.starts[first:last], self.starts[last] if last < len(self.docs) else self.n_ids)
        b0, b1 = int(ends[0]) // BLOCK, -(-int(ends[-1]) // BLOCK)
        if b1 <= b0:
            return [np.empty(0, np.uint32)] * (last - first)
        flat = decode_blocks(self.raw, self.offsets[b0:b1])
        cut = (ends - np.uint64(b0 * BLOCK)).astype(np.int64)
        return [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


# ---- Spark jobs ------------------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer: str, kind: str, out_dir: str, end_id: int | None = 0,
                      percentile: float = WIDTH_PERCENTILE) -> DataFrame:
    """Encode ``docs(doc_id, text)`` to shard files under ``out_dir`` (a URI
    that executors can write); returns the manifest ``(shard, path, first_doc,
    n_docs, n_ids, n_bytes)``, shards in ascending doc_id order."""
    end = b"" if end_id is None else struct.pack("<I", end_id)
    fs, base = pafs.FileSystem.from_uri(out_dir)
    fs.create_dir(base, recursive=True)

    def encode(batches):
        enc, writer, path = worker_encoder(tokenizer, kind), None, f"{out_dir}/{uuid.uuid4().hex}.ids"
        sink = None
        for pdf in batches:
            if writer is None and len(pdf):
                store, name = pafs.FileSystem.from_uri(path)
                sink = store.open_output_stream(name)
                writer = ShardWriter(sink, percentile)
                first = pdf["part"].iloc[0]
            for d, ids in zip(pdf["doc_id"], enc.encode_batch(pdf["text"]), strict=True):
                writer.add(None if pd.isna(d) else d, ids + end)
        if writer is not None:
            n_bytes = writer.close()
            sink.close()
            yield pd.DataFrame({"part": [int(first)], "path": [path], "n_docs": [len(writer.docs)],
                                "n_ids": [writer.n_ids], "n_bytes": [n_bytes]})

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    n = partitions_for(rows, TEXT_BYTES_PER_SHARD)
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text") \
        .withColumn("part", F.spark_partition_id())
    return written(rows.mapInPandas(encode, "part int, path string, n_docs long, n_ids long, n_bytes long"),
                   "token-manifest")


def read_token_digests(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    # one row per shard: the running total is over the manifest only
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def digests(batches):
        for pdf in batches:
            for path, base in zip(pdf["path"], pdf["base"], strict=True):
                store, name = pafs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    sh = Shard(f.read())
                for lo in range(0, len(sh.docs), 256):
                    ids = sh.ids(lo, lo + 256)
                    doc = sh.docs[lo:lo + 256]
                    yield pd.DataFrame({
                        "doc_id": pd.arrays.IntegerArray(doc.astype(np.int64), doc == NULL_ID),
                        "start": sh.starts[lo:lo + 256].astype(np.int64) + int(base),
                        "n_tokens": [len(x) for x in ids],
                        "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]})

    n = max(1, manifest.count())
    return shards.select("path", "base").repartition(n, "path") \
        .mapInPandas(digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, kind: str, end_id: int | None = 0) -> DataFrame:
    """Write, then read back from the files alone."""
    out = new_workspace(spark, "token-files")
    return read_token_digests(write_token_files(docs, tokenizer, kind, out, end_id))
