"""Ranked lexical search of many items at once with common subexpressions.

Items share terms. :func:`sharing_plan` mines sets of terms that several items
have in common and makes each a node of a DAG: terms are its leaves, an inner
node is the sum of two nodes, an item the sum of a few nodes. A document's
accumulators, one for each node, are materialised once in order of the DAG;
every item that shares a node reuses them.

The texts are read once for a block of items: a task finds the items' terms in
whole documents and writes down, for each document, its length and the items'
terms it holds with their occurrences. From that table come the statistics over
all documents and then the scores, so no text is shuffled. A task keeps the best
``k`` documents of each item, and the few rows of all tasks are ranked in two
rounds, so no task gathers an item's rows of the whole table.

A block of items holds at most ``BLOCK_TERMS`` pairs of item and term (or one
item that has more); further items take further blocks with a scan each, so what
goes to the driver and to the tasks does not grow with the items.

Terms are the maximal runs of letters and digits of ASCII and of all characters
beyond it, with only A-Z lower-cased. All arithmetic on scores is in 64-bit
integers; term weights are floors of doubles.

Cases: null or empty texts have no term, and an item without a term gets no row;
documents repeated under one id are documents each, and rank by equal score and
id in any order; a null doc_id comes after all others; items repeated under one
id are ranked each for itself; empty tables give an empty result; other columns
of the inputs are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingot.llm.common import discard, written

BLOCK_TERMS = 200_000        # pairs of item and term that one scan of the documents serves
BATCH_CELLS = 1 << 21        # accumulators held at a time: nodes x documents
SALTS = 64                   # groups of tasks whose best rows are ranked first
_TABLE = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
_NULL_LAST = np.iinfo(np.int64).max


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms of a UTF-8 text, with repeats."""
    return [] if text is None else text.translate(_TABLE).split()


@dataclass
class Plan:
    """Leaves are 0 .. n_leaves - 1, the inner nodes follow level by level:
    ``left`` and ``right`` are their summands, ``levels`` the cuts between
    levels. Item i sums ``nodes[starts[i]:starts[i + 1]]``."""

    n_leaves: int
    left: np.ndarray
    right: np.ndarray
    levels: list[int]
    nodes: np.ndarray
    starts: np.ndarray

    @property
    def additions(self) -> int:
        return len(self.left) + len(self.nodes) - (len(self.starts) - 1)


def sharing_plan(items: list[list[int]], n_leaves: int) -> Plan:
    """Mines pairs of nodes that several items have, level by level.

    Each round orders the nodes by the number of items that use them, and nodes
    of the same items beside each other; so items with a set of terms in common
    list it in one order. Neighbours that occur in two or more items become a
    node there. A round is linear in the items' lengths, and lists get shorter
    with each, so large sets are found after a few."""
    lists = [sorted(set(x)) for x in items]
    left: list[int] = []
    right: list[int] = []
    levels = [n_leaves]
    while True:
        users: dict[int, list[int]] = {}
        for i, nodes in enumerate(lists):
            for x in nodes:
                users.setdefault(x, []).append(i)
        order = {x: at for at, x in enumerate(sorted(users, key=lambda x: (-len(users[x]), users[x], x)))}
        lists = [sorted(nodes, key=order.__getitem__) for nodes in lists]
        pairs = Counter(p for nodes in lists for p in zip(nodes, nodes[1:]))
        made: dict[tuple[int, int], int] = {}
        shorter = []
        for nodes in lists:
            out, j = [], 0
            while j < len(nodes):
                pair = tuple(nodes[j:j + 2])
                if pairs.get(pair, 0) > 1:
                    if pair not in made:
                        made[pair] = levels[-1] + len(made)
                        left.append(pair[0])
                        right.append(pair[1])
                    out.append(made[pair])
                    j += 2
                else:
                    out.append(nodes[j])
                    j += 1
            shorter.append(out)
        if not made:
            break
        lists = shorter
        levels.append(levels[-1] + len(made))
    return Plan(n_leaves, np.array(left, np.int64), np.array(right, np.int64), levels,
                np.array([x for nodes in lists for x in nodes], np.int64),
                np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64))


def accumulate(plan: Plan, leaves: np.ndarray, docs: np.ndarray, values: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores, items x documents: ``values`` of (leaf, document) cells summed
    along the plan, each node once."""
    acc = np.zeros((plan.levels[-1], n_docs), np.int64)
    acc[leaves, docs] = values
    for lo, hi in zip(plan.levels, plan.levels[1:]):
        a, b = lo - plan.n_leaves, hi - plan.n_leaves
        np.add(acc[plan.left[a:b]], acc[plan.right[a:b]], out=acc[lo:hi])
    return np.add.reduceat(acc[plan.nodes], plan.starts[:-1], axis=0)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The best k documents of each item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.score = np.zeros((n_items, k), np.int64)        # 0: no document
        self.doc = np.full((n_items, k), _NULL_LAST, np.int64)
        self.known = np.zeros((n_items, k), bool)
        self.k = k

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        # an equal score still counts: its document may have the smaller id
        item, at = np.nonzero((scores >= self.score[:, -1:]) & (scores > 0))
        if not len(item):
            return
        every = np.arange(len(self.score))
        i = np.concatenate((np.repeat(every, self.k), item))
        s = np.concatenate((self.score.ravel(), scores[item, at]))
        d = np.concatenate((self.doc.ravel(), ids[at]))
        n = np.concatenate((self.known.ravel(), known[at]))
        order = np.lexsort((d, ~n, -s, i))
        first = np.searchsorted(i[order], every)
        keep = order[first[:, None] + np.arange(self.k)]
        self.score, self.doc, self.known = s[keep], d[keep], n[keep]

    def rows(self, salt: int) -> pa.RecordBatch:
        item, at = np.nonzero(self.score > 0)
        known = self.known[item, at]
        return pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(np.full(len(item), salt, np.int32)),
             pa.array(self.doc[item, at], mask=~known), pa.array(self.score[item, at])],
            ["item", "salt", "doc_id", "score"])


def document_terms(docs: DataFrame, known: Broadcast[dict[bytes, int]]) -> DataFrame:
    """Per document ``(doc_id, n, terms, counts)``: the terms of its whole text
    with repeats, and the vocabulary's numbers in it with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]):
        number = known.value
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = terms_of(text)
                n.append(len(found))
                held = Counter(map(number.get, found))
                held.pop(None, None)
                terms.append(list(held.keys()))
                counts.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")) \
        .mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def _best_rows(found: DataFrame, given: Broadcast[tuple[Plan, np.ndarray]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's best documents of each item: ``(item, salt, doc_id, score)``."""
    plan = given.value[0]
    width = max(1, BATCH_CELLS // (plan.levels[-1] + len(plan.nodes)))

    def run(batches: Iterator[pa.RecordBatch]):
        plan, weights = given.value
        best = _Best(len(plan.starts) - 1, k)
        for whole in batches:
            for at in range(0, whole.num_rows, width):
                batch = whole.slice(at, width)
                ids = batch.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(_NULL_LAST).to_numpy(zero_copy_only=False)
                terms, counts = batch.column("terms"), batch.column("counts").flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy(zero_copy_only=False))
                terms = terms.flatten().to_numpy(zero_copy_only=False)
                m = 10 + (90 * batch.column("n").to_numpy(zero_copy_only=False) * n_docs) // n_terms
                values = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[doc]))
                best.add(accumulate(plan, terms, doc, values, batch.num_rows), ids, known)
        yield best.rows(TaskContext.get().partitionId() % SALTS)

    return found.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item int, salt int, doc_id long, score long")


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of ``(item_id, distinct terms)``, made as the rows arrive."""
    block, size = [], 0
    for item_id, text in items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).toLocalIterator():
        terms = set(terms_of(None if text is None else bytes(text)))
        if not terms:
            continue
        if block and size + len(terms) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((item_id, terms))
        size += len(terms)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: ``(item_id, rank, doc_id,
    score)``, rank from 1, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    out = None
    for number, block in enumerate(item_blocks(items)):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in block))))}
        known = spark.sparkContext.broadcast(vocabulary)
        found = written(document_terms(docs, known), "document-terms")
        known.destroy()
        n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            discard(found)
            break
        df = np.zeros(len(vocabulary), np.int64)      # one count for each term of the block
        for term, n in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = n
        weights = np.array([weight(n_docs, n) for n in df.tolist()], np.int64)
        plan = sharing_plan([[vocabulary[t] for t in terms] for _, terms in block], len(vocabulary))
        given = spark.sparkContext.broadcast((plan, weights))
        rows = _best_rows(found, given, n_docs, n_terms, k)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for by in (["item", "salt"], ["item"]):
            rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))) \
                .filter(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id long")
        rows = written(rows.join(ids, "item").select("item_id", "rank", "doc_id", "score"), f"ranked-{number}")
        given.destroy()
        discard(found)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
