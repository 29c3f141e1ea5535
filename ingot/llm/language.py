"""Language of words and documents by a linear-chain conditional random field.

A text's words (runs of letters, lower-cased) are a chain; the label of a word
is its language. Emission weights belong to hashed features of the word: its
affixes, its character n-grams and the word itself (the lexicon). Transition
weights between neighbouring words are learned with them, by gradient ascent
on the conditional log-likelihood; the gradient needs the marginals of the
forward-backward recursion. Training chains are code-switched: stretches of
texts of different languages put one after another, so that the transitions
learn how long a language lasts.

Prediction runs forward-backward over the whole text, whatever its length,
for many texts side by side. A document's score for a language is the mean
marginal of its words; the predicted language has the highest.

The model is fitted on at most about ``TRAIN_PER_LANG`` labelled texts per
language, chosen by a hash of the text; everything else reads every row.

Cases: a text that is null or has no letter is ``und`` with score 0; rows
without a language are not learned from; without any labelled text every
document is ``und`` with score 0; ties go to the first language in
alphabetical order; repeated rows are predicted each for itself; other columns
are passed through or not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm import tokens

UNKNOWN = "und"
TRAIN_PER_LANG = 400         # labelled texts per language, in expectation
FEATURES = 1 << 17
CHAIN = 40                   # words of a training chain
CHAINS_PER_STEP = 96
STEPS = 220
RATE, L2 = 0.25, 1e-6
SEED = 5
WORDS_AT_ONCE = 200_000    # words of the texts that are labelled side by side
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")
_WORKER_CACHE: dict = {}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@lru_cache(maxsize=50_000)
def _hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


def features_of(word: str) -> list[int]:
    """Hashed features of a word: lexicon entry, affixes, n-grams."""
    b = f"<{word}>"
    out = [zlib.crc32(word.encode("utf-8", "surrogatepass")) % FEATURES,
           _hashed("p" + word[:2]), _hashed("p" + word[:4]), _hashed("s" + word[-2:]), _hashed("s" + word[-4:])]
    out += [_hashed(b[i:i + 3]) for i in range(len(b) - 2)]
    return out


class Model:
    """Learned weights; ``emit(words)`` gives the words' scores per language."""

    def __init__(self, langs: list[str], emission: np.ndarray, transition: np.ndarray, start: np.ndarray):
        self.langs, self.emission = langs, emission.astype(np.float32)
        self.transition, self.start = transition, start

    def emit(self, words: list[str]) -> np.ndarray:
        feats = [features_of(w) for w in words]
        ends = np.cumsum([len(f) for f in feats])
        return np.add.reduceat(self.emission[list(chain.from_iterable(feats))], np.concatenate(([0], ends[:-1])), axis=0)


def _marginals(e: np.ndarray, transition: np.ndarray, start: np.ndarray):
    """Forward-backward over chains of one length, e of shape (chains, words,
    languages): marginals of words, summed marginals of neighbours."""
    n, t, c = e.shape
    m = np.exp(transition)
    p = np.exp(e - e.max(axis=2, keepdims=True))
    alpha, beta = np.empty_like(p), np.ones_like(p)
    a = p[:, 0] * np.exp(start)
    alpha[:, 0] = a / a.sum(1, keepdims=True)
    for k in range(1, t):
        a = (alpha[:, k - 1] @ m) * p[:, k]
        alpha[:, k] = a / a.sum(1, keepdims=True)
    pairs = np.zeros((c, c))
    for k in range(t - 2, -1, -1):
        nxt = p[:, k + 1] * beta[:, k + 1]
        b = nxt @ m.T
        joint = alpha[:, k][:, :, None] * m * nxt[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        beta[:, k] = b / b.sum(1, keepdims=True)
    post = alpha * beta
    return post / post.sum(2, keepdims=True), pairs


def fit(samples: list[tuple[str, str]]) -> Model | None:
    """Train on ``(text, language)`` samples; None without any words."""
    texts = [(words_of(t), lang) for t, lang in samples]
    texts = sorted((w, lang) for w, lang in texts if w)
    langs = sorted({lang for _, lang in texts})
    if not langs:
        return None
    by_lang = [[w for w, lang in texts if lang == x] for x in langs]
    rng, c = np.random.default_rng(SEED), len(langs)
    vocabulary: dict[str, int] = {}
    feats: list[list[int]] = []

    def number(word: str) -> int:
        if word not in vocabulary:
            vocabulary[word] = len(feats)
            feats.append(features_of(word))
        return vocabulary[word]

    def drawn_chain() -> tuple[list[int], list[int]]:
        ids, labels, y = [], [], int(rng.integers(c))
        while len(ids) < CHAIN:
            doc = by_lang[y][rng.integers(len(by_lang[y]))]
            at = int(rng.integers(len(doc)))
            part = doc[at:at + int(rng.integers(4, 25))]
            ids += [number(w) for w in part]
            labels += [y] * len(part)
            y = (y + int(rng.integers(1, c))) % c if c > 1 else y
        return ids[:CHAIN], labels[:CHAIN]

    w = np.zeros((FEATURES, c))
    trans, start = np.zeros((c, c)), np.zeros(c)
    gw, gt, gs = np.full((FEATURES, c), 1e-2), np.full((c, c), 1e-2), np.full(c, 1e-2)
    for _ in range(STEPS):
        drawn = [drawn_chain() for _ in range(CHAINS_PER_STEP)]
        ids = np.array([x for x, _ in drawn])
        y = np.array([x for _, x in drawn])
        uniq, inv = np.unique(ids, return_inverse=True)
        sizes = np.array([len(feats[u]) for u in uniq])
        flat = np.concatenate([feats[u] for u in uniq])
        word_scores = np.add.reduceat(w[flat], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
        post, pairs = _marginals(word_scores[inv].reshape(*ids.shape, c), trans, start)
        truth = np.eye(c)[y]
        diff = (truth - post).reshape(-1, c) / CHAINS_PER_STEP
        per_word = np.zeros((len(uniq), c))
        np.add.at(per_word, inv.ravel(), diff)
        used, back = np.unique(flat, return_inverse=True)
        grad = np.zeros((len(used), c))
        np.add.at(grad, back, np.repeat(per_word, sizes, axis=0))
        grad -= L2 * w[used]
        gw[used] += grad ** 2
        w[used] += RATE * grad / np.sqrt(gw[used])
        seen = np.zeros((c, c))
        np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        for value, acc, g in ((trans, gt, (seen - pairs) / CHAINS_PER_STEP),
                              (start, gs, (truth[:, 0] - post[:, 0]).mean(0))):
            acc += g ** 2
            value += RATE * g / np.sqrt(acc)
    return Model(langs, w, trans, start)


def label_words(model: Model, emissions: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Marginals of every word of many chains. ``emissions`` has the words of
    the chains one after another; ``sizes`` (all above 0) their lengths.

    The chains are laid out by word position, longest chain first, so that one
    step of the recursion serves all chains that still have a word there."""
    n = len(sizes)
    by_size = np.argsort(-sizes, kind="stable")
    begin = np.cumsum(sizes) - sizes
    live = n - np.searchsorted(np.sort(sizes), np.arange(int(sizes.max())), "right")   # chains with a k-th word
    first = np.concatenate(([0], np.cumsum(live)))
    rank = np.empty(n, np.int64)
    rank[by_size] = np.arange(n)
    k = np.arange(len(emissions)) - np.repeat(begin, sizes)
    to = first[k] + np.repeat(rank, sizes)
    p = np.empty_like(emissions)
    p[to] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    m = np.exp(model.transition).astype(p.dtype)
    alpha = np.empty_like(p)
    a = p[:live[0]] * np.exp(model.start).astype(p.dtype)
    alpha[:live[0]] = a / a.sum(1, keepdims=True)
    for t in range(1, len(live)):
        a = (alpha[first[t - 1]:first[t - 1] + live[t]] @ m) * p[first[t]:first[t + 1]]
        alpha[first[t]:first[t + 1]] = a / a.sum(1, keepdims=True)
    beta = np.ones((live[-1], p.shape[1]), p.dtype)
    for t in range(len(live) - 1, -1, -1):
        here = slice(first[t], first[t + 1])
        if t + 1 < len(live):
            b = (p[first[t + 1]:first[t + 2]] * beta) @ m.T
            beta = np.ones((live[t], p.shape[1]), p.dtype)
            beta[:live[t + 1]] = b / b.sum(1, keepdims=True)
        alpha[here] *= beta
    alpha /= alpha.sum(1, keepdims=True)
    return alpha[to]


def _word_scores(model: Model, key, words: list[str]) -> np.ndarray:
    """Emissions of words; a worker scores each distinct word once. The table
    starts anew when it is full."""
    if key not in _WORKER_CACHE:
        _WORKER_CACHE.clear()
        tokens.forget()
        _WORKER_CACHE[key] = ({}, np.empty((CACHE_WORDS, len(model.langs)), np.float32))
    known, table = _WORKER_CACHE[key]
    ids = list(map(known.get, words))
    if None in ids:
        missing = list({w for w, i in zip(words, ids, strict=True) if i is None})
        if len(known) + len(missing) > len(table):
            known.clear()
            missing = list(set(words))
        if len(missing) > len(table):
            return model.emit(words)
        for lo in range(0, len(missing), 10_000):
            part = missing[lo:lo + 10_000]
            table[len(known):len(known) + len(part)] = model.emit(part)
            known.update(zip(part, range(len(known), len(known) + len(part)), strict=True))
        ids = list(map(known.__getitem__, words))
    return table[ids]


def predict_batch(model: Model | None, texts, key="one") -> tuple[list[str], list[float]]:
    langs, scores = [], []
    held: list[list[str]] = []
    count = 0

    def flush():
        full = [i for i, w in enumerate(held) if w]
        out = [(UNKNOWN, 0.0)] * len(held)
        if full:
            sizes = np.array([len(held[i]) for i in full])
            flat = [w for i in full for w in held[i]]
            post = label_words(model, _word_scores(model, key, flat), sizes)
            mean = np.add.reduceat(post.astype(np.float64), np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            top = mean.argmax(axis=1)
            for i, k, s in zip(full, top.tolist(), mean.max(axis=1).tolist(), strict=True):
                out[i] = (model.langs[k], min(1.0, s))
        langs.extend(x for x, _ in out)
        scores.extend(x for _, x in out)
        held.clear()

    for t in texts:
        held.append(words_of(t) if model is not None else [])
        count += len(held[-1])
        if count >= WORDS_AT_ONCE:
            flush()
            count = 0
    flush()
    return langs, scores


def training_sample(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> list[tuple[str, str]]:
    """About ``per_lang`` labelled texts of each language, chosen by a hash of
    id and language, so that the choice does not depend on partitions. Rows
    that share an id fall in or out together: in all no more than twice
    ``per_lang`` for each language are taken, the lowest hashes first."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}   # one row per language
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_lang / n))])
    place = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30))
    chosen = labelled.filter(place < share[F.col("lang")] * (1 << 30)) \
        .orderBy(place, F.xxhash64("text")).limit(2 * per_lang * len(counts))
    return [(r[0], r[1]) for r in chosen.select("text", "lang").collect()]


def train(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> Model | None:
    return fit(training_sample(docs, per_lang))


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The documents with the predicted language and its score added as
    ``names``; input columns of these names are replaced. The function is
    declared non-deterministic, as a filter on its result would else run it a
    second time."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # bounded: FEATURES x languages
    key = uuid.uuid4().hex

    @F.pandas_udf("lang string, score double")
    def run(text: pd.Series) -> pd.DataFrame:
        langs, scores = predict_batch(shared.value, text, key)
        return pd.DataFrame({"lang": langs, "score": scores})

    both = f"_p_{key}"
    return docs.withColumn(both, run.asNondeterministic()("text")) \
        .withColumns({names[0]: F.col(f"{both}.lang"), names[1]: F.col(f"{both}.score")}).drop(both)


def held_out() -> F.Column:
    """Documents whose crc32 of doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
