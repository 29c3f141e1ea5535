"""Harmonic packing of documents into fixed-length sequences.

Class k holds the pieces longer than ``capacity / (k + 1)`` and not longer than
``capacity / k``; k of them fill a sequence of their class. A worker has one
open sequence for each class and closes it at its k-th piece, so workers need
nothing of each other: one pass over the documents, no shuffle, and each task
holds at most one open sequence for each class.

Documents may be cut, so pieces are cut where their class wastes nothing: a
document gives whole sequences, then powers of two down to ``tail``, and one
piece shorter than ``tail``. A class of short pieces holds one length x only and
loses ``capacity mod x`` to its sequence. What a worker has open at its end is
cut into powers of two and put together to sequences whose totals are powers of
two, which take no padding.

Sequence numbers are unique, not dense: the partition's number and a count.
A partition that runs again gives the same rows if it reads the same rows in
the same order, as file scans do.

Cases: a null or empty text is one piece with only the end id; equal and
repeated rows are packed each for itself; an empty table gives an empty result;
other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.tokens import worker_encoder

CAPACITY = 2048
TAIL = 32                    # shorter remainders are not cut unless their sequence stays open
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)
NUMBERS = 1 << 40            # sequences of one partition


def cut_lengths(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """Lengths of a document's pieces, in its order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest >= max(tail, 1):
        out.append(1 << (rest.bit_length() - 1))
        rest -= out[-1]
    return out + [rest] * (rest > 0)


class Packer:
    """The open sequences of one worker. A piece is ``(document, start, ids,
    document's tokens)`` with the ids as bytes; rows come out as their
    sequence closes."""

    def __init__(self, first: int, capacity: int = CAPACITY, tail: int = TAIL):
        self.next, self.capacity, self.tail = first, capacity, tail
        self.open: dict[int, list[tuple]] = {}

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, at
            at += len(ids) // 4
        self.next += 1

    def _add(self, piece: tuple) -> Iterator[tuple]:
        k = self.capacity // (len(piece[2]) // 4)
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            del self.open[k]
            yield from self._close(held)

    def document(self, doc, ids: bytes) -> Iterator[tuple]:
        at, total = 0, len(ids) // 4
        for n in cut_lengths(total, self.capacity, self.tail):
            yield from self._add((doc, at, ids[4 * at:4 * (at + n)], total))
            at += n

    def finish(self) -> Iterator[tuple]:
        """Sequences of powers of two from all that is still open."""
        pool: dict[int, list[tuple]] = {}
        for doc, start, ids, total in (p for held in self.open.values() for p in held):
            at = 0
            for n in cut_lengths(len(ids) // 4, self.capacity, 1):
                pool.setdefault(n, []).append((doc, start + at, ids[4 * at:4 * (at + n)], total))
                at += n
        self.open = {}
        for n, pieces in sorted(pool.items(), reverse=True):
            while pieces:
                some = 1 << (min(len(pieces), self.capacity // n).bit_length() - 1)
                yield from self._close(pieces[:some])
                pieces = pieces[some:]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COLUMNS))], COLUMNS)


def pack(docs: DataFrame, tokenizer: str, kind: str, end_id: int = 1,
         capacity: int = CAPACITY, tail: int = TAIL) -> DataFrame:
    """One row per piece: its place in its document, the crc of its ids, and
    its place in a sequence (``COLUMNS``)."""
    end = struct.pack("<I", end_id)

    def run(batches):
        enc = worker_encoder(tokenizer, kind)
        packer = Packer(TaskContext.get().partitionId() * NUMBERS, capacity, tail)

        for batch in batches:
            rows = []
            ids_of = enc.encode_batch(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                rows.extend(packer.document(doc, ids + end))
            yield _batch(rows)
        yield _batch(list(packer.finish()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, SCHEMA)
