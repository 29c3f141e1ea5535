"""Multi-query lexical search against a plain version, and its sharing plan."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from ingot.llm import shared_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    terms = [TERM.findall((t or "").translate(UPPER)) for _, t in docs]
    n_docs, n_terms = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(x for t in terms for x in set(t))
    out = []
    for item_id, text in items:
        query = set(TERM.findall((text or "").translate(UPPER)))
        scored = []
        for (doc_id, _), t in zip(docs, terms, strict=True):
            m = 10 + (90 * len(t) * n_docs) // n_terms if n_terms else 0
            held = Counter(t)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1)))
                    * ((10**9 * held[q]) // (1000 * held[q] + 8 * m)) for q in query if held[q])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        for rank, (s, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item_id, rank, doc_id, -s))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


DOCS = [(1, "Alpha beta GAMMA delta"), (2, "alpha beta"), (3, None), (4, ""), (5, "  .,;- "), (6, "Élan éLAN alpha"),
        (7, "beta " * 3000 + "alpha"), (7, "beta " * 3000 + "alpha"), (None, "alpha beta"), (8, "alpha-beta_gamma9 日本 x"),
        (2**62 + 3, "gamma"), (-4, "gamma"), (9, "alpha beta")]
ITEMS = [(1, "alpha beta"), (2, "ALPHA, beta! gamma alpha"), (2, "alpha beta gamma"), (3, None), (4, ""), (None, "élan 日本"),
         (5, "nowhere"), (6, "alpha beta gamma delta")]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in DOCS], "doc_id long, text string, score int, terms int")
    items = spark.createDataFrame([(i, t, 3) for i, t in ITEMS], "item_id long, text string, rank int")
    for k in (1, 3, 10):
        assert got(shared_search.search(docs.repartition(3), items, k)) == plain(DOCS, ITEMS, k)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("text is null"), items)):
        out = shared_search.search(d, i)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_whole_tables_in_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    want = plain([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert got(shared_search.search(docs, items)) == want
    monkeypatch.setattr(shared_search, "BLOCK_TERMS", 100)
    monkeypatch.setattr(shared_search, "BATCH_CELLS", 3000)
    assert got(shared_search.search(docs, items)) == want


@pytest.mark.parametrize("seed", range(6))
def test_plan_adds_up_and_saves_work(seed):
    rng = random.Random(seed)
    common = [rng.sample(range(60), rng.randint(2, 12)) for _ in range(4)]
    items = [list({*rng.choice(common), *rng.choice(common), *rng.sample(range(60, 200), rng.randint(0, 9))})
             for _ in range(40)]
    plan = shared_search.sharing_plan(items, 200)
    rows = [np.array(rng.sample(range(200), 30)) for _ in range(7)]
    leaves, docs = np.concatenate(rows), np.repeat(np.arange(7), 30)
    values = np.array([rng.randint(1, 10**12) for _ in leaves])
    dense = np.zeros((200, 7), np.int64)
    dense[leaves, docs] = values
    want = np.array([dense[x].sum(axis=0) for x in items])
    assert (shared_search.accumulate(plan, leaves, docs, values, 7) == want).all()
    assert plan.additions < sum(len(x) - 1 for x in items)
    # every inner node serves what two or more items hold
    assert len(plan.left) == plan.levels[-1] - 200


def test_equal_items_are_one_node():
    plan = shared_search.sharing_plan([[1, 2, 3, 4, 5]] * 9, 6)
    assert plan.additions == 4 and len(plan.nodes) == 9
