"""Repeated byte strings against brute force."""

import hashlib
import random
import time

import numpy as np
import pandas as pd
import pytest

from ingot.llm import repeats


def _spans(rows, length):
    """Removed byte positions by document, from all windows in order."""
    first, out = {}, {d: set() for d, _ in rows}
    for d, t in sorted((d, (t or "").encode()) for d, t in rows):
        for i in range(len(t) - length + 1):
            if first.setdefault(t[i:i + length], (d, i)) != (d, i):
                out[d].update(range(i, i + length))
    return out


def _digest(t, gone):
    t = (t or "").encode()
    keep = bytes(b for i, b in enumerate(t) if i not in gone)
    runs = sum(1 for i in gone if i - 1 not in gone)
    return len(t), len(gone), runs, hashlib.sha256(keep).hexdigest()


def _texts(seed=1, n=60):
    rng = random.Random(seed)
    words = [rng.choice("abcdéfgß") * rng.randint(1, 4) + str(rng.randint(0, 99)) for _ in range(300)]
    shared = [" ".join(rng.choices(words, k=k)) for k in (12, 25, 40)]
    rows = [(0, None), (1, ""), (2, "short"), (3, "z" * 700), (4, "zy" * 300 + "z" * 500)]
    for i in range(10, n):
        parts = [" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(3)]
        if rng.random() < 0.7:
            parts.insert(rng.randint(0, 3), rng.choice(shared))
        if rng.random() < 0.3:
            t = list(rng.choice(rows)[1] or "x")
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = "Q"
            parts.append("".join(t))
        rows.append((i, " ".join(parts)))
    rows.append((500, rows[12][1]))
    return rows


@pytest.mark.parametrize("length,largest", [(100, 1000), (40, 1000), (100, 1)])
def test_digests(spark, monkeypatch, length, largest):
    monkeypatch.setattr(repeats, "LARGEST_GROUP", largest)
    rows = _texts()
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, v int, _spans string")
    got = {r[0]: tuple(r)[1:] for r in repeats.repeat_digests(df, length).collect()}
    gone = _spans(rows, length)
    assert got == {d: _digest(t, gone[d]) for d, t in rows}
    assert sum(len(g) > 0 for g in gone.values()) > 20


def test_odd_rows(spark):
    t = "the same text " * 20
    df = spark.createDataFrame([(None, t), (None, t), (7, t), (7, t), (9, t)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in repeats.repeat_digests(df).collect())
    inner = got[2][1]           # the text repeats itself within
    assert got[:2] == [(0, 0), (0, 0)] and got[3][1] == inner and got[4] == (9, len(t)) and 0 < inner < len(t)
    assert repeats.repeat_digests(df.limit(0)).count() == 0
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_rows_of_one_id_are_judged_once(spark):
    rng = random.Random(5)
    text = " ".join(str(rng.randint(0, 10 ** 6)) for _ in range(4000))
    took = {}
    for copies in (80, 320):
        df = spark.createDataFrame([(1, text)] * copies + [(2, text)], "doc_id long, text string").repartition(4)
        start = time.monotonic()
        got = repeats.repeat_digests(df).collect()
        took[copies] = time.monotonic() - start
        assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0)] * copies + [(2, len(text))]
    assert took[320] < 2.5 * took[80] + 5


def test_different_texts_of_one_id(spark):
    rng = random.Random(6)
    a, b, shared = (" ".join(str(rng.randint(0, 10 ** 6)) for _ in range(60)) for _ in range(3))
    rows = [(1, a), (1, a), (1, b + shared), (2, shared), (3, a), (1, None)]
    df = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows],
                               "doc_id long, text string, row long, lo int, _spans string")
    got = sorted(((r.doc_id, r.text) for r in repeats.remove_repeats(df).collect()), key=str)
    assert got == sorted([(1, a), (1, a), (1, b + shared), (2, ""), (3, ""), (1, None)], key=str)


def test_clashing_names(spark):
    t = " ".join(str(i * i) for i in range(60))
    df = spark.createDataFrame([(1, t, "s", 1, 2, 3), (2, t, "s", 1, 2, 3)],
                               "doc_id long, text string, _spans string, v long, lo int, row long")
    got = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    assert got[2].text == "" and got[2]._spans == "s" and got[2].row == 3 and got[1].text == t


def test_removal_keeps_whole_characters(spark):
    a = "é" * 80 + "abc"
    df = spark.createDataFrame([(1, a, 9, 5), (2, "è" + a, 9, 5), (3, None, 9, 5)], "doc_id long, text string, n_chars long, lo int")
    got = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    assert got[1].n_chars == len(got[1].text) and got[3].text is None and got[2].lo == 5
    assert got[2].text.startswith("è") and len(got[2].text) <= 2
    assert repeats.whole_characters("aéb".encode(), [(2, 4)]) == [(3, 4)]


def test_anchors_own_each_window_once():
    rng = random.Random(3)
    for text in (bytes(rng.choices(b"ab", k=900)), b"z" * 500, bytes(rng.choices(range(256), k=1500)), b"q" * 99, b"q" * 100):
        v, lo, n, at = repeats.anchors(text)
        windows = [(a + i, int(x), int(a + p)) for x, a, k, p in zip(v, lo, n, at, strict=True) for i in range(k)]
        assert [w for w, _, _ in windows] == list(range(max(0, len(text) - 99)))
        owner = {}
        for w, x, p in windows:
            assert w <= p <= w + 100 - repeats.ANCHOR
            assert owner.setdefault(text[w:w + 100], (x, p - w)) == (x, p - w)      # equal windows, equal anchors


@pytest.mark.parametrize("batch", [10, 100_000])
def test_columns_against_all_windows(monkeypatch, batch):
    monkeypatch.setattr(repeats, "BATCH", batch)
    texts = [(d, (t or "").encode()) for d, t in _texts(4, 120)]
    frags = {}
    for d, t in texts:
        for v, lo, n, at in zip(*(x.tolist() for x in repeats.anchors(t)), strict=True):
            frags.setdefault((v, t[lo:lo + n + 99]), (d, lo, at))
    df = pd.DataFrame([(np.int64(np.uint64(v).view(np.int64)), *x, f) for (v, f), x in frags.items()],
                      columns=["v", "doc_id", "lo", "at", "frag"]).sort_values("v", kind="stable")
    got = set()
    for out in repeats._first_occurrences([df[i:i + 7] for i in range(0, len(df), 7)], 100):
        got |= {(r.doc_id, k) for r in out.itertuples() for k in range(r.lo, r.hi)}
    places = {}
    for r in df.itertuples():
        for j in range(len(r.frag) - 99):
            places.setdefault(r.frag[j:j + 100], []).append((r.doc_id, r.lo + j))
    want = {(d, s + k) for o in places.values() for d, s in o if (d, s) > min(o) for k in range(100)}
    assert got == want
