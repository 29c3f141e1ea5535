"""Severity of toxic text by cumulative-link ordinal regression.

Grades 0 < 1 < ... < K-1 share one weight vector over sparse binary text
features (words and word beginnings); they differ in ordered thresholds only:
P(grade >= k) = logistic(w x - threshold_k). The expected severity of a text
is the sum of these probabilities.

The model is fitted on a bounded sample, at most about ``TRAIN_PER_GRADE``
rows of each grade chosen by a hash of doc_id and weighted back to the counts
over all labelled rows. Features are those whose presence tells the grades
apart in the sample, at most ``MAX_FEATURES``. Every text is scored whole.

Cases: null or empty texts have no features and get the score of a text
without any (near 0 where most rows are of grade 0); rows with a null label,
or whose document is missing, are not learned from; with fewer than two grades
among the labels every severity is that of the one grade there is (0 for
none); repeated rows are scored each for itself; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PER_GRADE = 2500
MAX_FEATURES = 6000
MIN_DOCS = 5
PREFIXES = (4, 5, 6)
STEPS, RATE, L2 = 300, 0.15, 2e-4
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_WORKER: dict = {}


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights by feature and ascending thresholds."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, thresholds: np.ndarray):
        self.features, self.weights, self.thresholds = features, weights, thresholds

    def columns(self, word: str) -> list[int]:
        return [self.features[f] for f in features_of(word) if f in self.features]

    def at_least(self, linear: np.ndarray) -> np.ndarray:
        """P(grade >= k), k = 1 .. K-1, for linear scores."""
        return _logistic(linear[:, None] - self.thresholds[None, :])


def _select(docs: list[set[str]], grades: np.ndarray, weight: np.ndarray) -> dict[str, int]:
    """The features that separate the texts above grade 0 best, by the
    weighted log-odds of their presence scaled by its standard error."""
    above = grades > 0
    raw_in, raw_out = Counter(), Counter()
    for d, a in zip(docs, above.tolist(), strict=True):
        (raw_in if a else raw_out).update({f for w in d for f in features_of(w)})
    n_in, n_out = max(1, int(above.sum())), max(1, int((~above).sum()))
    scored = []
    for f in raw_in.keys() | raw_out.keys():
        a, b = raw_in[f], raw_out[f]
        if a + b < MIN_DOCS:
            continue
        odds = np.log((a + 0.5) / (n_in - a + 0.5)) - np.log((b + 0.5) / (n_out - b + 0.5))
        error = np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        scored.append((-abs(odds) / error, f))
    return {f: k for k, (_, f) in enumerate(sorted(scored)[:MAX_FEATURES])}


def fit(texts: list[str | None], grades: list[int], weights: list[float] | None = None) -> Model | None:
    """Weighted maximum likelihood by Adam; None without two grades."""
    y = np.array(grades, np.int64)
    levels = np.unique(y)
    if len(levels) < 2:
        return None
    top = int(y.max())
    g = np.ones(len(y)) if weights is None else np.array(weights, float)
    g = g / g.mean()
    docs = [words_of(t) for t in texts]
    features = _select(docs, y, g)
    model = Model(features, np.zeros(len(features)), np.zeros(top))
    cols = [sorted({c for w in d for c in model.columns(w)}) for d in docs]
    row = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    col = np.array([c for x in cols for c in x], np.int64)
    # start where the model without features is: the share of each grade and above
    share = np.array([np.clip((g * (y >= k)).sum() / g.sum(), 1e-4, 1 - 1e-4) for k in range(1, top + 1)])
    first = -np.log(share[0] / (1 - share[0]))
    gaps = np.log(np.maximum(np.diff(-np.log(share / (1 - share))), 0.05))   # thresholds ascend: gaps are exponentials
    w = np.zeros(len(features))
    params = [w, np.array([first]), gaps]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n = len(y)
    for step in range(1, STEPS + 1):
        thresholds = np.concatenate((params[1], params[1] + np.cumsum(np.exp(params[2]))))
        linear = np.bincount(row, params[0][col], n) if len(col) else np.zeros(n)
        # P(y) = upper - lower with upper = P(>= y), lower = P(>= y + 1)
        p = np.concatenate((np.ones((n, 1)), _logistic(linear[:, None] - thresholds), np.zeros((n, 1))), axis=1)
        up, low = p[np.arange(n), y], p[np.arange(n), y + 1]
        prob = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / prob, low * (1 - low) / prob
        d_linear = g * (d_up - d_low) / n
        d_thr = np.zeros(top + 2)
        np.add.at(d_thr, y, -g * d_up / n)
        np.add.at(d_thr, y + 1, g * d_low / n)
        d_thr = d_thr[1:-1]
        grads = [np.bincount(col, d_linear[row], len(features)) - L2 * params[0] if len(features) else params[0],
                 np.array([d_thr.sum()]),
                 np.array([d_thr[k:].sum() for k in range(1, top)]) * np.exp(params[2])]
        for value, (m1, m2), grad in zip(params, moments, grads, strict=True):
            m1 += 0.1 * (grad - m1)
            m2 += 0.01 * (grad ** 2 - m2)
            value += RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    thresholds = np.concatenate((params[1], params[1] + np.cumsum(np.exp(params[2]))))
    return Model(features, params[0], thresholds)


def score_texts(model: Model, texts, key="one") -> np.ndarray:
    """P(grade >= k) of each text."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = (set(), {})
    plain, marked = _WORKER[key]        # words without and with features
    linear = np.zeros(len(texts))
    for i, t in enumerate(texts):
        cols: set[int] = set()
        for w in words_of(t) - plain:
            c = marked.get(w)
            if c is None:
                c = model.columns(w)
                if c:
                    marked[w] = c
                else:
                    plain.add(w)
            cols.update(c)
        linear[i] = model.weights[list(cols)].sum() if cols else 0.0
        if len(plain) + len(marked) > CACHE_WORDS:
            plain.clear()
            marked.clear()
    return model.at_least(linear)


def severity(docs: DataFrame, model: Model | None, only: float = 0.0) -> DataFrame:
    """The documents with ``expected_severity``, ``p_toxic`` (P(grade >= 1)),
    ``grade`` (the most probable) and ``toxic`` (p_toxic >= 0.5) added.
    Without a model all are of severity ``only``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # bounded by MAX_FEATURES
    key = uuid.uuid4().hex

    @F.pandas_udf("expected_severity double, p_toxic double, grade int")
    def run(text: pd.Series) -> pd.DataFrame:
        if shared.value is None:
            return pd.DataFrame({"expected_severity": [only] * len(text), "p_toxic": [float(only > 0)] * len(text),
                                 "grade": [int(only)] * len(text)})
        p = score_texts(shared.value, text.tolist(), key)
        edges = np.hstack((np.ones((len(p), 1)), p, np.zeros((len(p), 1))))
        return pd.DataFrame({"expected_severity": p.sum(axis=1), "p_toxic": p[:, 0] if len(p) else [],
                             "grade": (edges[:, :-1] - edges[:, 1:]).argmax(axis=1).astype(np.int32)})

    out = docs.withColumn("_s", run("text"))
    return out.select(*docs.columns, "_s.*").withColumn("toxic", F.col("p_toxic") >= 0.5)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_grade: int = TRAIN_PER_GRADE) -> list[tuple]:
    """``(text, grade, weight)`` of about ``per_grade`` labelled documents per
    value of ``labels.grade``; the weight restores the counts of all rows."""
    usable = labels.select("doc_id", F.col("grade").cast("int")).filter("doc_id is not null and grade is not null")
    counts = {r[0]: r[1] for r in usable.groupBy("grade").count().collect()}    # one row per grade
    if not counts:
        return []
    share = {k: min(1.0, per_grade / n) for k, n in counts.items()}
    kept = F.create_map(*[F.lit(x) for k, s in share.items() for x in (k, s)])[F.col("grade")]
    some = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < kept * (1 << 30))
    # the sample is bounded by per_grade x grades rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "grade").collect()
    return [(r[0], r[1], 1.0 / share[r[1]]) for r in rows]


def grade_by_marks(sample: list[tuple]) -> list[tuple]:
    """Turns a sample with a yes-or-no label into three grades: rows labelled
    1 are mild (1) or severe (2) as their share of marked words lies below or
    above the median. Marked words are those far likelier in labelled rows."""
    docs = [_WORD.findall((t or "").lower()) for t, _, _ in sample]
    yes, no = Counter(), Counter()
    for d, (_, label, _) in zip(docs, sample, strict=True):
        (yes if label else no).update({f for w in set(d) for f in features_of(w)})
    n_yes, n_no = sum(bool(s[1]) for s in sample) + 1, sum(not s[1] for s in sample) + 1
    marks = {f for f, a in yes.items() if a >= MIN_DOCS and (a + 0.5) / n_yes > 10 * (no[f] + 0.5) / n_no}
    rate = [sum(any(f in marks for f in features_of(w)) for w in d) / max(1, len(d)) for d in docs]
    middle = np.median([r for r, s in zip(rate, sample, strict=True) if s[1]] or [0.0])
    return [(t, (1 + (r > middle)) if label else 0, g) for (t, label, g), r in zip(sample, rate, strict=True)]
