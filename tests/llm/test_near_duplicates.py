"""MinHash and embedding near-duplicates against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ingot.llm import common, embeddings, minhash


def _components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] \
        + [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)] + [(5, 5)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = _components({x for e in edges for x in e if e[0] != e[1]}, edges)
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _texts(k):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "one two"), (6, "ÀB x y z"), (7, "àB x y z")]
    at = 10
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([8, 30, 120, 400]))]
        for _ in range(rng.randint(1, 8)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 12))):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((at, rng.choice([" ", "\n", "\t "]).join(t)))
            at += 1
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_minhash_against_all_pairs(spark, k):
    rows = _texts(k)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, set_key string, n_shingles int")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, k, 80).collect()}

    def shingles(t):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    sets = {d: shingles(t) for d, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = _components(sets, links)
    assert got == {d: (len(sets[d]), comp[d], comp[d] == d) for d in sets}
    assert len(links) > 30


def test_minhash_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "a b c d e f"),
                                (None, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False),
                          (None, 0, None, True)], key=repr)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_bucket_members_that_miss_the_smallest_document_still_meet(spark, monkeypatch):
    """With one band for all, everything shares a bucket: links must not
    depend on the bucket's smallest document."""
    rows = [(i, t) for i, t in enumerate(t for _, t in _texts(2)[8:60])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {d: set(minhash.shingle_set(t, 2).tolist()) for d, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    # the workers import the package anew, so keys come from the driver's patched function
    monkeypatch.setattr(minhash, "BLOCK", 3)
    signed = [(d, len(sets[d]), hashlib.blake2b(str(sorted(sets[d])).encode(), digest_size=16).digest(), [0], minhash.pack_low_bits(
        minhash.minima(minhash.shingle_set(t, 2))).tolist()) for d, t in rows]
    monkeypatch.setattr(minhash, "signatures", lambda docs, k: spark.createDataFrame(signed, minhash.SIGNATURES))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 2, 80).collect()}
    assert got == _components(sets, links)


def test_members_of_a_buckets_largest_component_are_not_copied_to_each_other(spark):
    """600 members of one component and 30 others: before, each was copied to
    every block of the bucket."""
    rows = [(7, i, 0 if i < 600 else i, 0, 600, 30) for i in range(630)]
    for block, most in ((630, 630), (100, 630 + 30 * 6)):
        kept, minhash.BLOCK = minhash.BLOCK, block
        try:
            units = minhash._units(spark.createDataFrame(rows, "key long, id long, c long, main long, most long, rest long")).collect()
        finally:
            minhash.BLOCK = kept
        assert len(units) <= most
        met = set()
        for _, of in itertools.groupby(sorted(units, key=lambda r: r.unit), key=lambda r: r.unit):
            of = list(of)
            left = [r for r in of if r.left]
            for x in left:
                met |= {frozenset((x.id, y.id)) for y in (of if x.inner else (r for r in of if not r.left)) if x.c != y.c}
        assert met == {frozenset(p) for p in itertools.combinations(range(630), 2) if max(p) >= 600}


def test_split_buckets_name_the_largest_component(spark):
    rows = [(1, 1, 5), (1, 2, 5), (1, 3, 6), (2, 1, 5), (2, 2, 5), (3, 4, 8), (3, 5, 9)]
    got = sorted(tuple(r) for r in minhash._split_buckets(spark.createDataFrame(rows, "key long, id long, c long")).collect())
    assert got == [(1, 5, 2, 1), (3, 9, 1, 1)]


def test_pairs_handed_on_in_parts_are_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 200, np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(200) > .05], rng.integers(0, 1 << 63, 6, np.uint64)))) for _ in range(60)]
    part = pd.DataFrame({"unit": 1, "left": True, "inner": True, "id": range(60), "c": range(60), "n_shingles": [len(s) for s in sets],
                         "sig": [minhash.pack_low_bits(minhash.minima(s)) for s in sets], "odd": [minhash.odd_cells(s) for s in sets]})
    for best in (None, 2):
        pairs = []
        for at_once in (1 << 20, 10):
            monkeypatch.setattr(minhash, "PAIRS_AT_ONCE", at_once)
            pairs.append({tuple(p) for pdf in minhash._compare([part], 80, best) for p in pdf.to_numpy().tolist()})
        assert pairs[0] == pairs[1] and len(pairs[0]) > 60


def test_estimate_corrects_for_chance(spark):
    rng = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.8, 1.0):
        n = 4000
        common_part = rng.integers(0, 1 << 63, int(n * share), np.uint64)
        own = lambda: rng.integers(0, 1 << 63, (n - len(common_part)) // 2, np.uint64)
        sigs = [minhash.pack_low_bits(minhash.minima(np.concatenate((common_part, own())))).tolist() for _ in range(2)]
        row = spark.createDataFrame([sigs], "a array<long>, b array<long>").select(
            minhash.estimate(F.col("a"), F.col("b"))).collect()[0][0]
        assert abs(row - share) < 0.15
    assert 0.5 < minhash.lowest_estimate(0.8) < 0.7


def _vectors():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        base = rng.standard_normal(24)
        rows.append(base)
        for _ in range(i % 4):
            rows.append(base + rng.standard_normal(24) * rng.choice([0.05, 0.2, 0.3, 0.4]))
    rows += [rows[0], rows[0], rows[0] * 2, rows[1] * 1e-30]
    return [x.astype(np.float32).tolist() for x in rows]


@pytest.mark.parametrize("block", [512, 2])
def test_embeddings_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    vecs = _vectors()
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, vecs[0][:12]]
    rows = [(i, v, i % 3, b"x") for i, v in enumerate(vecs + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, same binary")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    x = np.array(vecs, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    links = [(a, b) for a, b in itertools.combinations(range(len(vecs)), 2) if close[a, b]]
    comp = _components(range(len(rows)), links)
    n = {i: 0 for i in range(len(rows))}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in range(len(rows))}
    assert len(links) > 30


def test_embeddings_odd_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (4, [1.0, -0.0])],
                               "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in embeddings.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (4, 2, 1, False)], key=repr)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_table_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.standard_normal((3000, 64))
    g -= (g * x).sum(1, keepdims=True) * x
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * g
    assert (embeddings.bucket_keys(x) == embeddings.bucket_keys(y)).any(axis=1).mean() > 0.995


def test_near_copies_below_the_threshold_are_no_candidates():
    """A unit of near copies: every link is a candidate, pairs well below the
    threshold are not, and with ``best`` the count grows with the documents."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 400, np.uint64)
    sets = []
    for i in range(90):
        s = base.copy()
        change = 30 if i < 60 else 15            # similarity to each other about 0.75, and 0.86
        s[rng.choice(len(s), change, replace=False)] = rng.integers(0, 1 << 63, change, np.uint64)
        sets.append(np.unique(s))
    rows = []
    for i, s in enumerate(sets):
        m = minhash.minima(s)
        rows.append((7, True, True, i, i, len(s), minhash.pack_low_bits(m), minhash.odd_cells(s)))
    unit = pd.DataFrame(rows, columns=["unit", "left", "inner", "id", "c", "n_shingles", "sig", "odd"])
    similar = {(a, b): len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
               for a in range(90) for b in range(a + 1, 90)}
    links = {p for p, x in similar.items() if x >= 0.8}
    pairs = lambda best: {(r.a, r.b) for pdf in minhash._compare([unit], 80, best) for r in pdf.itertuples()}
    got = pairs(None)
    assert len(links) > 400 and links <= got
    assert all(similar[p] > 0.77 for p in got)
    few = pairs(minhash.BEST)
    assert few < got and len(few) <= minhash.BEST * len(sets)
    assert all(any(x in p for p in few) for x in {y for p in got for y in p})
