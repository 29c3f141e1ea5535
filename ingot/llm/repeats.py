"""Repeated byte strings across a whole collection, by column-wise
construction of Burrows-Wheeler transforms.

A byte is repeated if a ``length``-byte string covering it also starts
earlier: in a document of smaller doc_id, or earlier in its own. Strings are
judged on the input and never cross documents.

Distribution. Every window of ``length`` bytes is owned by one anchor, its
leftmost smallest-hash ``ANCHOR``-gram. Equal windows have equal anchors at
equal offsets, so all occurrences of a window meet under its anchor's hash.
The windows that an anchor owns are contiguous; the bytes they cover are the
anchor's fragment, at most ``2 * length - ANCHOR`` bytes. Anchors whose hash
occurs once are done. Equal fragments of one hash collapse to the first one
(partially aggregated), all others are repeated throughout. A hash left with
one distinct fragment is done as well. The distinct fragments of the others
are collections of short strings; they are grouped by hash and go through
the column-wise construction (``repeated_windows``). Aligned at their anchors,
the strings are taken column by column from the right: each round inserts one
symbol per string, the stable order by symbol is the new suffix order, and the
common prefixes follow from range minima over the earlier ones. Since equal
windows start in equal columns, the transform is kept per column (a positional
transform), and a round costs as much as there are strings, not suffixes.
Order, common prefixes and transform live in files that a round reads and
writes from start to end. Neighbours that share ``length`` bytes are equal
windows; all but the first occurrence are repeated.

A hash with more than ``LARGEST_GROUP`` distinct fragments (a passage whose
surroundings all differ) would be one task's work. Its windows are instead
spread and compared one by one under a 128-bit hash, again partially
aggregated: an exact way whose cost is linear in them.

Cases: a null or empty text has no bytes; a document with a null doc_id
neither loses bytes nor takes them from others; equal rows under one doc_id
are one document (equal starts are not earlier), judged once and returned as
often as they come; different texts under one doc_id are documents of their
own, in order of a hash of the text; other columns of the input are not read,
whatever their names; an empty table gives an empty result. Texts may be of any length.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import discard, written
from ingot.session import partitions_for

LENGTH = 100
ANCHOR = 40
LARGEST_GROUP = 1000
BATCH = 20_000               # strings per collection; a group is never split
_GRAM = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64)


# ---- anchors ---------------------------------------------------------------

def _gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    h, n = _GRAM[b], 1
    while n < k:
        s = min(n, k - n)
        h = h[:-s] * np.uint64(0x9E3779B97F4A7C15) + h[s:]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        n += s
    return h


def _slide(x: np.ndarray, width: int, fold) -> np.ndarray:
    n = 1
    while n < width:
        s = min(n, width - n)
        x = fold(x[:-s], x[s:])
        n += s
    return x


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchors of a text, the first window each owns, how many
    it owns, and the anchor's place after that first start. Every window
    belongs to exactly one anchor."""
    k = min(ANCHOR, length)
    width = length - k + 1
    b = np.frombuffer(text, np.uint8)
    n = len(b) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3
    h = _gram_hashes(b, k)
    low = _slide(h, width, np.minimum)                      # smallest hash of each window
    pad = np.zeros(width - 1, np.uint64)
    # a position is an anchor if its hash is the smallest of some window over it
    at = np.flatnonzero(_slide(np.concatenate((pad, low, pad)), width, np.maximum) == h)
    values, rank = np.unique(h[at], return_inverse=True)
    span = len(h) + 1
    keys = rank.astype(np.int64) * span + at
    by_key = np.argsort(keys)
    keys, places = keys[by_key], at[by_key]
    # owners change only where the smallest hash changes or just behind an anchor
    starts = np.unique(np.concatenate(
        ([0], np.flatnonzero(low[1:] != low[:-1]) + 1, at[at + 1 < n] + 1)))
    owner = places[np.searchsorted(keys, np.searchsorted(values, low[starts]) * span + starts)]
    first = np.concatenate(([True], owner[1:] != owner[:-1]))
    lo = starts[first]
    return h[owner[first]], lo, np.diff(np.append(lo, n)), owner[first] - lo


# ---- column-wise construction ----------------------------------------------

class _Columns:
    """The sorted order and the common prefixes of the current column, kept in
    files that a round reads and rewrites from start to end. The symbols that
    the rounds insert are appended to ``transform``, one column after another."""

    def __init__(self, folder: str):
        self.files = [open(os.path.join(folder, x), "w+b", buffering=0) for x in ("order", "common")]
        self.transform = open(os.path.join(folder, "transform"), "wb")
        self.rows = 0

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for f, kind in zip(self.files, (np.int32, np.uint16), strict=True):
            f.seek(0)
            out.append(np.frombuffer(f.read(self.rows * np.dtype(kind).itemsize), kind))
        return out[0], out[1]

    def write(self, order: np.ndarray, common: np.ndarray, symbols: np.ndarray) -> None:
        for f, x in zip(self.files, (order.astype(np.int32), common.astype(np.uint16)), strict=True):
            f.seek(0)
            f.write(x.data)
        self.rows = len(order)
        self.transform.write(symbols.data)

    def close(self) -> None:
        for f in (*self.files, self.transform):
            f.close()


def repeated_windows(strings: list[bytes], groups: np.ndarray, pivot: np.ndarray, rank: np.ndarray,
                     length: int, folder: str) -> np.ndarray:
    """For strings in ascending groups, each with the place of its anchor:
    a matrix telling for every start whether the window there is equal to one
    of lower ``rank`` in the group (equal windows have equal offsets from the
    anchor).

    The strings are aligned at their anchors and taken column by column from
    the right. A round inserts one symbol per string: the order of the
    suffixes that start in this column is the stable order by symbol of those
    that start in the next, and the common prefix of two neighbours is one
    longer than the smallest between their tails. Strings begin and end in
    different columns; an empty suffix sorts first. Suffixes of other columns
    cannot be equal windows and are not kept."""
    m = len(strings)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    size = np.fromiter(map(len, strings), np.int64, m)
    begin = np.cumsum(size) - size
    left, right = -pivot, size - pivot - 1           # first and last column of each string
    again = np.zeros((m, max(1, int(size.max(initial=0)) - length + 1)), bool)
    by_right = np.argsort(-right, kind="stable")
    entering = 0
    columns = _Columns(folder)
    for x in range(int(right.max(initial=-1)), int(left.min(initial=0)) - 1, -1):
        order, common = columns.read()
        # strings that ended to the right of this column leave; prefixes shorten to the minimum over them
        stay = np.flatnonzero(left[order] <= x)
        if len(stay) < len(order):
            begins = np.concatenate(([0], stay[:-1] + 1)) if len(stay) else stay
            common = np.minimum.reduceat(common[:stay[-1] + 1], begins) if len(stay) else common[:0]
            order = order[stay]
        upto = entering
        while upto < m and right[by_right[upto]] == x:
            upto += 1
        order = np.concatenate((by_right[entering:upto], order))
        common = np.concatenate((np.zeros(upto - entering, np.uint16), common))
        entering = upto
        if not len(order):
            columns.write(order, common, flat[:0])
            continue
        symbol = flat[begin[order] + x + pivot[order]]
        to = np.argsort(groups[order] * 256 + symbol, kind="stable")
        new = order[to]
        key = groups[new] * 256 + symbol[to]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        grown = np.zeros(len(new), np.uint16)
        if len(same):
            pairs = np.empty(2 * len(same), np.int64)
            pairs[::2], pairs[1::2] = to[same - 1] + 1, to[same] + 1
            grown[same] = np.minimum.reduceat(np.append(common, np.uint16(0)), pairs)[::2] + 1
        columns.write(new, grown, symbol[to])
        if grown.max(initial=0) >= length:
            heads = np.flatnonzero(grown < length)
            lowest = np.repeat(np.minimum.reduceat(rank[new], heads), np.diff(np.append(heads, len(new))))
            late = np.flatnonzero(rank[new] > lowest)
            again[new[late], x + pivot[new[late]]] = True
    columns.close()
    return again


def merge_spans(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pd.DataFrame:
    """Touching or overlapping spans of one document as one."""
    o = np.lexsort((lo, doc))
    doc, lo, hi = doc[o], lo[o], hi[o]
    if not len(doc):
        return pd.DataFrame({"doc_id": doc, "lo": lo, "hi": hi})
    head = np.concatenate(([True], doc[1:] != doc[:-1]))
    block = np.cumsum(head) - 1
    step = int(hi.max()) + 1
    far = np.maximum.accumulate(hi + block * step) - block * step
    cut = head.copy()
    cut[1:] |= lo[1:] > far[:-1]
    first = np.flatnonzero(cut)
    return pd.DataFrame({"doc_id": doc[first], "lo": lo[first],
                         "hi": np.maximum.reduceat(hi, first)})


SPANS = "doc_id long, lo long, hi long"


def _first_occurrences(batches, length: int):
    """Fragments (v, doc_id, lo, at, frag), all of one v together, to the
    repeated spans among them."""
    def finish(part: pd.DataFrame) -> pd.DataFrame:
        doc, lo = part["doc_id"].to_numpy(np.int64), part["lo"].to_numpy(np.int64)
        pivot, v = part["at"].to_numpy(np.int64), part["v"].to_numpy()
        place = np.lexsort((lo + pivot, doc))
        d, p = doc[place], (lo + pivot)[place]
        rank = np.empty(len(part), np.int64)
        # an equal (doc, place) is the same occurrence, not an earlier one
        rank[place] = np.cumsum(np.concatenate(([0], (d[1:] != d[:-1]) | (p[1:] != p[:-1]))))
        groups = np.cumsum(np.concatenate(([0], v[1:] != v[:-1])))
        with tempfile.TemporaryDirectory() as folder:
            who, start = np.nonzero(repeated_windows(part["frag"].tolist(), groups, pivot, rank, length, folder))
        return merge_spans(doc[who], lo[who] + start, lo[who] + start + length)

    held: list[pd.DataFrame] = []
    rows = 0
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows < BATCH:
            continue
        pdf = pd.concat(held, ignore_index=True)
        v = pdf["v"].to_numpy()
        ends = np.append(np.flatnonzero(v[1:] != v[:-1]) + 1, len(v))   # group ends; the last may go on
        at = 0
        while (k := int(np.searchsorted(ends[:-1], at + BATCH))) < len(ends) - 1:
            yield finish(pdf.iloc[at:ends[k]])
            at = int(ends[k])
        held, rows = [pdf.iloc[at:]], len(pdf) - at
    if rows:
        yield finish(pd.concat(held, ignore_index=True))


# ---- Spark jobs ------------------------------------------------------------

def _cut(texts: DataFrame, wanted: DataFrame, emit, schema: str) -> DataFrame:
    """``emit(doc_id, text bytes, v, lo, n, at)`` over the documents of
    ``wanted(doc_id, v, lo, n, at)``; a document's arrays are bounded by its text."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("v", "lo", "n", "at")).alias("o")) \
        .select("doc_id", *[F.col(f"o.{c}").alias(c) for c in ("v", "lo", "n", "at")])

    def run(batches):
        for pdf in batches:
            out = [emit(int(d), (t or "").encode("utf-8", "surrogatepass"), *x)
                   for d, t, *x in zip(pdf["doc_id"], pdf["text"], pdf["v"], pdf["lo"], pdf["n"], pdf["at"], strict=True)]
            if out:
                yield pd.concat(out, ignore_index=True)

    return texts.join(lists, "doc_id").select("doc_id", "text", "v", "lo", "n", "at").mapInPandas(run, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans ``(doc_id, lo, hi)`` of repeated bytes; they may overlap. A doc_id
    names one row."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")

    def find(batches):
        for pdf in batches:
            ids, v, lo, n, at = [], [], [], [], []
            for d, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                x = anchors((t or "").encode("utf-8", "surrogatepass"), length)
                ids.append(np.full(len(x[0]), d))
                v.append(x[0].view(np.int64))
                lo.append(x[1])
                n.append(x[2])
                at.append(x[3])
            if ids:
                yield pd.DataFrame({"v": np.concatenate(v), "doc_id": np.concatenate(ids),
                                    "lo": np.concatenate(lo).astype(np.int32),
                                    "n": np.concatenate(n).astype(np.int32),
                                    "at": np.concatenate(at).astype(np.int32)})

    found = written(texts.mapInPandas(find, "v long, doc_id long, lo int, n int, at int"), "anchors")
    often = found.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1").select("v")
    twice = written(found.join(often, "v"), "repeated-anchors")
    discard(found)
    involved = written(texts.join(twice.select("doc_id").distinct(), "doc_id", "left_semi"), "involved-texts")

    def cuts(t, lo, n):
        return [t[a:b] for a, b in zip(lo.tolist(), (lo + n + (length - 1)).tolist(), strict=True)]

    def hashed(d, t, v, lo, n, at):
        f = np.fromiter(map(xxhash.xxh3_64_intdigest, cuts(t, lo, n)), np.uint64, len(v)).view(np.int64)
        return pd.DataFrame({"v": v, "f": f, "doc_id": d, "lo": lo, "n": n, "at": at})

    frags = written(_cut(involved, twice, hashed, "v long, f long, doc_id long, lo int, n int, at int"), "fragments")
    discard(twice)
    firsts = written(frags.groupBy("v", "f").agg(F.min(F.struct("doc_id", "lo")).alias("o"), F.max("n").alias("n"), F.max("at").alias("at"))
                     .select("v", "f", F.col("o.doc_id").alias("doc_id"), F.col("o.lo").alias("lo"), "n", "at"), "first-fragments")
    whole = frags.join(firsts.select("v", "f", F.col("doc_id").alias("d0"), F.col("lo").alias("l0")), ["v", "f"]) \
        .filter("doc_id <> d0 or lo <> l0") \
        .select("doc_id", F.col("lo").cast("long"), (F.col("lo") + F.col("n") - 1 + length).cast("long").alias("hi"))
    whole = written(whole, "spans")

    several = firsts.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1")
    several = written(firsts.join(several, "v").select("v", "doc_id", "lo", "n", "at", "c"), "distinct-fragments")
    discard(frags)

    def bytes_of(d, t, v, lo, n, at):
        return pd.DataFrame({"v": v, "doc_id": d, "lo": lo, "at": at, "frag": cuts(t, lo, n)})

    groups = _cut(involved, several.filter(F.col("c") <= LARGEST_GROUP), bytes_of,
                  "v long, doc_id long, lo int, at int, frag binary") \
        .repartition("v").sortWithinPartitions("v")
    built = written(groups.mapInPandas(lambda b: _first_occurrences(b, length), SPANS), "spans")

    def windows_of(d, t, v, lo, n, at):
        starts = np.concatenate([np.arange(a, a + k) for a, k in zip(lo, n, strict=True)])
        return pd.DataFrame({"w": [xxhash.xxh3_128_digest(t[a:a + length]) for a in starts.tolist()], "doc_id": d, "at": starts})

    single = written(_cut(involved, several.filter(F.col("c") > LARGEST_GROUP), windows_of,
                          "w binary, doc_id long, at long"), "windows")
    first = single.groupBy("w").agg(F.min(F.struct("doc_id", "at")).alias("o"), F.count("*").alias("c")).filter("c > 1")
    spread = single.join(first, "w").filter("doc_id <> o.doc_id or at <> o.at") \
        .select("doc_id", F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))
    spread = written(spread, "spans")
    discard(single)
    discard(involved)
    return whole.union(built).union(spread)


def _with_spans(docs: DataFrame, length: int, name: str) -> DataFrame:
    """Documents with their spans as a column ``name``: a list per document,
    bounded by the text. Where a doc_id is repeated, its different texts are
    numbered in order of doc_id and a hash of the text, written down, and
    judged by their numbers."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")
    single = texts.groupBy("doc_id").count().filter("count > 1").isEmpty()
    if not single:
        by = ["doc_id", F.xxhash64("text")]
        named = written(texts.dropDuplicates().repartitionByRange(partitions_for(docs), *by).sortWithinPartitions(*by)
                        .withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
        texts = named.select(F.col("row").alias("doc_id"), "text")
    lists = repeated_spans(texts, length).distinct().groupBy("doc_id") \
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias(name))
    if single:
        return docs.join(lists, "doc_id", "left")
    found = named.join(lists.withColumnRenamed("doc_id", "row"), "row").select("doc_id", "text", name)
    return docs.alias("d").join(found.alias("f"), (F.col("d.doc_id").cast("long") == F.col("f.doc_id"))
                                & F.col("d.text").eqNullSafe(F.col("f.text")), "left") \
        .select("d.*", F.col(f"f.{name}").alias(name))


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in spans if spans is not None else ():
        if out and s["lo"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["hi"])
        else:
            out.append([s["lo"], s["hi"]])
    return [(a, b) for a, b in out]


def _outside(t: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, keep = 0, []
    for a, b in spans:
        keep.append(t[at:a])
        at = b
    keep.append(t[at:])
    return b"".join(keep)


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256."""
    def digest(batches):
        for pdf in batches:
            rows = []
            for d, t, s in zip(pdf["doc_id"], pdf["text"], pdf["_spans"], strict=True):
                t = (t or "").encode("utf-8", "surrogatepass")
                cut = _merged(s)
                rows.append((d, len(t), sum(b - a for a, b in cut), len(cut),
                             hashlib.sha256(_outside(t, cut)).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) \
                .astype({"doc_id": "Int64"})

    return _with_spans(docs.select(F.col("doc_id").cast("long"), "text"), length, "_spans") \
        .select("doc_id", "text", "_spans") \
        .mapInPandas(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(t: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for a, b in spans:
        while a < b and t[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(t) and t[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents, all columns, with the repeated characters cut from
    ``text``; ``n_chars``, if there, follows."""
    spans = f"spans_{uuid.uuid4().hex}"

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(text, spans, strict=True):
            if t is not None and s is not None and len(s):
                b = t.encode("utf-8", "surrogatepass")
                t = _outside(b, whole_characters(b, _merged(s))).decode("utf-8", "surrogatepass")
            out.append(t)
        return pd.Series(out, dtype=object)

    out = _with_spans(docs, length, spans).withColumn("text", cut("text", spans))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
