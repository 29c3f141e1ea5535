"""Near-duplicate documents by b-bit MinHash.

Per document: the set of k-word shingles (64-bit hashes), ``BANDS * ROWS``
minima, one key per band of ``ROWS`` full minima, and a packed signature of
the low ``BITS`` bits of every minimum. Documents with equal sets form one
class; only its smallest doc_id goes on.

Candidates share a band key. Their similarity is estimated on the packed
signatures: the share of equal b-bit values, corrected for the 2**-b of values
that are equal by chance. Candidates whose estimate is far below the threshold
(``ESTIMATE_SLACK`` standard errors or more) are left out, the others are
confirmed on their full sets. With 40 bands of 5 rows a pair of similarity 0.8
is missed with probability 1.3e-7.

A band's bucket may hold a great many near copies, so its members are first
compared with the bucket's smallest document only (each document with its most
similar such partner, then with the others that are still in another
component). Members that are then still in different components of the
bucket are compared pairwise, so no link between components is lost: first
each with the few most similar ones of other components, then all that are
still apart. A task compares up to ``BLOCK`` members with as many others. Of
larger buckets only the members outside the bucket's largest component are cut
into blocks that meet each other; those of the largest, which need no comparison
among themselves, meet these blocks only. Which links join two documents of one component does not matter to
the result. Pairs of this step must also pass the parity of their sets' hashes in
``ODD_BITS`` cells: cells that differ are never more than the sets' elements that
do, so no pair is lost by it, and few go on that are not links.

Cases: a null text, or one without words, has the empty set: no links, a
component of its own; fewer than k words make one shingle of the whole
sequence; a null doc_id is not linked; rows repeated under one doc_id count
once for the links and are returned as often as they come; other columns of
the input are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import components, written

BANDS, ROWS, BITS = 40, 5, 4
PERMS = BANDS * ROWS
ESTIMATE_SLACK = 5.0
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 20      # pairs that a task gathers before it hands them on
BEST = 4                     # partners of a document in other components tried before all others
ODD_BITS = 4096
_rng = np.random.default_rng(20240229)
_MUL = (_rng.integers(0, 1 << 32, PERMS, np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, PERMS, np.uint64).astype(np.uint32)
_BAND_SALT = _rng.integers(0, 1 << 63, BANDS, np.uint64)
SIG_WORDS = -(-PERMS * BITS // 64)

SIGNATURES = "doc_id long, n_shingles long, set_key binary, bands array<long>, sig array<long>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text; A-Z are
    lower-cased, words are runs without ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return np.unique(acc)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The PERMS minima of a non-empty set."""
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMS, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(h), 2048):
        x = h[None, lo:lo + 2048] * _MUL[:, None]
        x += _ADD[:, None]
        np.minimum(out, x.min(axis=1), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    key = _BAND_SALT.copy()
    for col in m.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + col)
    return key.view(np.int64)


def pack_low_bits(m: np.ndarray) -> np.ndarray:
    per = 64 // BITS
    low = np.zeros(SIG_WORDS * per, np.uint64)
    low[:PERMS] = m & np.uint32((1 << BITS) - 1)
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(SIG_WORDS, per) << shifts, axis=1).view(np.int64)


def odd_cells(hashes: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes in each of ODD_BITS cells."""
    odd = np.bincount((hashes & np.uint64(ODD_BITS - 1)).astype(np.int64), minlength=ODD_BITS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    def sign(batches):
        for pdf in batches:
            rows = []
            for d, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                s = shingle_set(t, k)
                if len(s):
                    m = minima(s)
                    rows.append((d, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                 band_keys(m), pack_low_bits(m)))
                else:
                    rows.append((d, 0, None, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_key", "bands", "sig"]) \
                .astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(sign, SIGNATURES)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    def sets(batches):
        for pdf in batches:
            hashes = [shingle_set(t, k) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["doc_id"], "hashes": [x.view(np.int64) for x in hashes],
                                "odd": [odd_cells(x) for x in hashes]})

    return docs.mapInPandas(sets, "id long, hashes array<long>, odd array<long>")


def estimate(a: F.Column, b: F.Column) -> F.Column:
    """Collision-corrected similarity from two packed signatures."""
    step = int("1" * (64 // BITS), 2) if BITS == 1 else sum(1 << (i * BITS) for i in range(64 // BITS))
    step = step - (1 << 64) if step >= 1 << 63 else step

    def differing(x):
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        return F.bit_count(folded.bitwiseAND(F.lit(step)))

    unequal = F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))),
                          F.lit(0), lambda acc, x: acc + x.cast("int"))
    chance = 2.0 ** -BITS
    return ((F.lit(1.0) - unequal / F.lit(float(PERMS))) - chance) / (1 - chance)


def lowest_estimate(threshold: float) -> float:
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * threshold
    return threshold - ESTIMATE_SLACK * (p * (1 - p) / PERMS) ** 0.5 / (1 - chance)


def _plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` that the sizes and the packed signatures allow, with
    the estimate."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("sig").alias(f"s{x}"),
                                 F.col("n_shingles").alias(f"n{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) \
        .select("a", "b", estimate(F.col("sa"), F.col("sb")).alias("est")) \
        .filter(F.col("est") >= lowest_estimate(percent / 100))


def _compare(batches, percent: int, best: int | None = None):
    """Rows (unit, left, inner, id, c, n_shingles, sig, odd) with the rows of a
    unit of work together: pairs ``(a, b)`` of different components that the
    sizes, the packed signatures and the odd cells allow, or those among the
    ``best`` most similar ones of one of the two. ``left`` says which of the unit's two blocks a row is
    of; ``inner`` marks a block against itself."""
    chance, least = 2.0 ** -BITS, lowest_estimate(percent / 100)
    step = np.uint64(sum(1 << (i * BITS) for i in range(64 // BITS)))

    def most_similar(i, j, differ):
        if best is None:
            return i, j, differ
        end, pair = np.concatenate((i, j)), np.tile(np.arange(len(i)), 2)
        o = np.lexsort((np.tile(differ, 2), end))
        head = np.concatenate(([True], end[o][1:] != end[o][:-1]))[:len(o)]
        nth = np.arange(len(o)) - np.maximum.accumulate(np.where(head, np.arange(len(o)), 0))
        chosen = np.unique(pair[o][nth < best])
        return i[chosen], j[chosen], differ[chosen]

    def pairs_of(part: pd.DataFrame):
        ids, comp, size = (part[x].to_numpy(np.int64) for x in ("id", "c", "n_shingles"))
        sig, odd = (np.stack(part[x].to_numpy()).astype(np.int64).view(np.uint64) for x in ("sig", "odd"))
        left, inner = part["left"].to_numpy(bool), part["inner"].to_numpy(bool)

        def frame(pairs):
            i, j, _ = np.concatenate(pairs, axis=1)
            return pd.DataFrame({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])}).drop_duplicates()

        out, ready = [], 0
        unit_no = part["unit"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], unit_no[1:] != unit_no[:-1], [True])))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            rows = np.arange(s, e)
            found, gathered = [], 0
            for i in rows if inner[s] else rows[left[s:e]]:
                other = rows[i - s + 1:] if inner[s] else rows[~left[s:e]]
                other = other[(comp[other] != comp[i])
                              & (np.minimum(size[other], size[i]) * 100 >= np.maximum(size[other], size[i]) * percent)]
                if len(other):
                    x = sig[other] ^ sig[i]
                    folded = x.copy()
                    for k in range(1, BITS):
                        folded |= x >> np.uint64(k)
                    unequal = np.bitwise_count(folded & step).sum(axis=1).astype(np.int64)
                    est = ((1 - unequal / PERMS) - chance) / (1 - chance)
                    other = other[est >= least]
                    both = size[other] + size[i]
                    differ = np.bitwise_count(odd[other] ^ odd[i]).sum(axis=1).astype(np.int64)
                    # 100 * intersection >= percent * union, by the elements that differ
                    near = differ * (100 + percent) <= both * (100 - percent)
                    if near.any():
                        found.append(np.stack((np.full(near.sum(), i), other[near], differ[near] * 1_000_000 // both[near])))
                        gathered += found[-1].shape[1]
                if gathered >= PAIRS_AT_ONCE:
                    found = [np.stack(most_similar(*np.concatenate(found, axis=1)))]
                    if best is None:
                        yield frame(found)
                        found = []
                    # what stays is at most ``best`` times the unit's rows
                    gathered = 0
            if found:
                out.append(np.stack(most_similar(*np.concatenate(found, axis=1))))
                ready += out[-1].shape[1]
            if ready >= PAIRS_AT_ONCE:
                yield frame(out)
                out, ready = [], 0
        if out:
            yield frame(out)

    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        u = pdf["unit"].to_numpy()
        last = int(np.searchsorted(u, u[-1])) if len(u) else 0     # the last unit may go on
        if last:
            yield from pairs_of(pdf.iloc[:last])
        held = pdf.iloc[last:]
    if held is not None and len(held):
        yield from pairs_of(held)


def _split_buckets(placed: DataFrame) -> DataFrame:
    """``(key, main, most, rest)`` of the buckets of ``placed(key, id, c)`` that
    hold members of several components: the largest of these, its members in
    the bucket, and the other members."""
    by_component = placed.groupBy("key", "c").agg(F.count("*").alias("n"))
    return by_component.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "c")).alias("m")) \
        .select("key", F.col("m.c").alias("main"), F.col("m.n").alias("most"), (F.col("n") - F.col("m.n")).alias("rest")) \
        .filter("rest > 0")


def _units(placed: DataFrame) -> DataFrame:
    """Rows ``(id, c, left, inner, unit)`` that bring the members of different
    components of a bucket of ``placed(key, id, c, main, most, rest)`` together.
    A bucket of up to ``BLOCK`` documents is one unit of work. Of a larger one
    the documents outside of its component ``main`` are cut into blocks, each
    pair of which is a unit, and each with each block of ``main``."""
    whole = F.col("most") + F.col("rest") <= BLOCK
    main = ~whole & (F.col("c") == F.col("main"))
    cut = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    return placed.withColumn("is_main", main) \
        .withColumn("blocks", F.when(whole, 1).otherwise(cut("rest"))) \
        .withColumn("others", F.when(whole | F.col("is_main"), F.col("blocks")).otherwise(F.col("blocks") + cut("most"))) \
        .withColumn("block", F.when(F.col("is_main"), F.col("blocks") + F.pmod(F.xxhash64("id"), cut("most")))
                    .otherwise(F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))) \
        .select("id", "c", (F.col("block") <= F.col("other")).alias("left"),
                (F.col("block") == F.col("other")).alias("inner"),
                F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit"))


def _apart(placed: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Plausible pairs ``(a, b)`` of different components within the buckets of
    ``placed``; only pairs that the signatures allow leave a task."""
    described = reps.select("id", "n_shingles", "sig").join(sets.select("id", "odd"), "id")
    work = _units(placed).join(described, "id").repartition("unit").sortWithinPartitions("unit", "id")
    return work.select("unit", "left", "inner", "id", "c", "n_shingles", "sig", "odd") \
        .mapInPandas(lambda b: _compare(b, percent, best), "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    one = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    two = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    return pairs.select("a", "b").join(two, "b").join(one, "a") \
        .filter(shared * 100 >= (F.size("ha") + F.size("hb") - shared) * percent).select("a", "b")


def _across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    for x in "ab":
        pairs = pairs.join(comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")), x, "left") \
            .withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    return pairs.filter("ca <> cb").drop("ca", "cb")


def _sets_of(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Full sets of the documents ``ids(doc_id)``, a list that grows with the
    corpus and is therefore never broadcast."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(ids.hint("merge"), "doc_id", "left_semi") \
        .dropDuplicates(["doc_id"])
    return written(shingle_sets(texts, k), "shingle-sets")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per document ``(doc_id, n_shingles, component_id, kept)``; documents
    are linked when 100 * intersection >= percent * union of their sets."""
    signed = written(signatures(docs, k), "signatures")
    classes = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key") \
        .agg(F.min("doc_id").alias("rep"))
    reps = written(signed.join(classes.select(F.col("rep").alias("doc_id"), F.col("set_key").alias("_k")),
                               "doc_id").filter(F.col("set_key") == F.col("_k"))
                   .dropDuplicates(["doc_id"])
                   .select(F.col("doc_id").alias("id"), "n_shingles", "bands", "sig"), "class-signatures")

    member = reps.select("id", F.explode("bands").alias("key"))
    shared = written(member.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n"))
                     .filter("n > 1").select("key", "hub"), "bands")
    member = written(member.join(shared, "key"), "band-members")

    # members of a bucket against its smallest document
    star = member.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    star = written(_plausible(star, reps, percent), "candidates")
    sets = _sets_of(docs, member.select(F.col("id").alias("doc_id")).distinct(), k)
    best = star.groupBy("b").agg(F.max(F.struct("est", (-F.col("a")).alias("na"))).alias("m")) \
        .select((-F.col("m.na")).alias("a"), "b")
    links = written(_confirmed(best, sets, percent), "links")
    comp = components(links)
    rest = _across(star.select("a", "b").join(best, ["a", "b"], "left_anti"), comp)
    links = links.union(written(_confirmed(rest, sets, percent), "links"))
    comp = components(links)

    # members of one bucket that are still apart, against each other: the most
    # similar ones of each first, then all that are left
    tried = star.select("a", "b")
    for best in (BEST, None):
        placed = member.select("key", "id").join(comp.select(F.col("node").alias("id"), "component"), "id", "left") \
            .select("key", "id", F.coalesce("component", "id").alias("c"))
        placed = written(placed.join(_split_buckets(placed), "key"), "split-buckets")
        apart = _apart(placed, reps, sets, percent, best)
        apart = written(apart.join(tried, ["a", "b"], "left_anti"), "candidates")
        links = links.union(written(_confirmed(apart, sets, percent), "links"))
        tried = tried.union(apart)
        comp = components(links)

    found = classes.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .select("set_key", F.coalesce("component", "rep").alias("component_id"))
    return signed.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left") \
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))) \
        .select("doc_id", "n_shingles", "component_id",
                F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
