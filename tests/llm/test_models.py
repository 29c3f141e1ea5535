"""Language, toxicity and decontamination."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ingot.llm import decontaminate, language, toxicity
from ingot.llm.common import corpus_table, ship_package
from ingot.llm.queries import op1_ordinal_toxicity, op8_crf_language, op10_lsa_decontamination

SF = "/root/testdata/sf0.01"


# ---- language -----------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in corpus_table(spark, SF, "documents").collect()}
    rows = op8_crf_language(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.97


def _brute_marginals(e, trans, start):
    t, c = e.shape
    p = np.zeros((t, c))
    for path in itertools.product(range(c), repeat=t):
        s = start[path[0]] + sum(e[i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in itertools.pairwise(path))
        for i, y in enumerate(path):
            p[i, y] += np.exp(s)
    return p / p.sum(1, keepdims=True)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    model = language.Model(["a", "b", "c"], np.zeros((4, 3)), rng.standard_normal((3, 3)), rng.standard_normal(3))
    sizes = np.array([3, 1, 6, 2, 6])
    e = rng.standard_normal((sizes.sum(), 3)) * 2
    got = language.label_words(model, e, sizes)
    want = np.vstack([_brute_marginals(x, model.transition, model.start) for x in np.split(e, np.cumsum(sizes)[:-1])])
    assert np.allclose(got, want)
    post, _ = language._marginals(e[4:10][None], model.transition, model.start)
    assert np.allclose(post[0], _brute_marginals(e[4:10], model.transition, model.start))


def test_code_switched_words():
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF}/documents.parquet", columns=["text", "lang"]).to_pylist()
    by = {x: [r["text"] for r in t if r["lang"] == x] for x in ("en", "de")}
    model = language.fit([(x, "en") for x in by["en"][:60]] + [(x, "de") for x in by["de"][:60]])
    a, b = language.words_of(by["en"][70])[:40], language.words_of(by["de"][70])[:40]
    post = language.label_words(model, model.emit(a + b), np.array([len(a + b)]))
    said = [model.langs[k] for k in post.argmax(1)]
    assert said[:40].count("en") > 33 and said[-40:].count("de") > 33


def test_language_odd_rows(spark):
    schema = "doc_id long, text string, lang string, lang_pred2 int"
    rows = [(i, "the and of it was", "en", 1) for i in range(20)] + [(i, "der die und das nicht", "de", 1) for i in range(20, 40)]
    rows += [(50, None, "en", 1), (51, "", "de", 1), (52, "123 !?", None, 1), (53, "the " * 30_000, None, 1), (None, "und das", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df, language.train(df)).collect()}
    assert got[50] == got[51] == got[52] == ("und", 0.0)
    assert got[53][0] == "en" and got[None][0] == "de" and got[1][0] == "en"
    assert language.train(df.filter("lang is null")) is None
    assert {r.lang_pred for r in language.predict(df, None).collect()} == {"und"}
    assert language.predict(df.limit(0), None).count() == 0
    assert language.predict(df, language.fit([("just one", "xx")])).filter("doc_id = 1").collect()[0].lang_pred == "xx"


def test_word_table_starts_anew(monkeypatch):
    monkeypatch.setattr(language, "CACHE_WORDS", 6)
    model = language.fit([("the and of", "en"), ("der die das", "de")])
    texts = ["the and of der", "alpha beta gamma delta epsilon zeta eta theta", "die das der the", ""]
    once = [language.predict_batch(model, [t], f"k{i}")[0][0] for i, t in enumerate(texts)]
    assert language.predict_batch(model, texts, "all")[0] == once


# ---- toxicity ------------------------------------------------------------------

def test_toxicity_of_labelled_documents(spark):
    labels = {r.doc_id: r.toxic for r in corpus_table(spark, SF, "labels").collect()}
    rows = op1_ordinal_toxicity(spark, SF).collect()
    assert len(rows) == corpus_table(spark, SF, "documents").count()
    said = [(r.toxic, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    clean = [t for t, y in said if y == 0]
    bad = [t for t, y in said if y == 1]
    assert sum(clean) / len(clean) < 0.03 and sum(bad) / len(bad) > 0.75
    assert all(0 <= r.expected_severity <= 2 and (r.grade > 0) <= (r.expected_severity > 0.3) for r in rows)


def test_toxicity_held_out_and_ordered():
    rng = random.Random(6)
    plain = [f"word{i}" for i in range(200)]

    def doc(grade):
        w = rng.choices(plain, k=40)
        for _ in range(2 * grade):
            w[rng.randrange(40)] = rng.choice(["nasty", "vile"] if grade < 3 else ["vile", "hateful"])
        return " ".join(w)

    grades = [rng.choice([0, 0, 1, 2, 3]) for _ in range(1200)]
    model = toxicity.fit([doc(g) for g in grades[:800]], grades[:800])
    assert (np.diff(model.thresholds) > 0).all()
    p = toxicity.score_texts(model, [doc(g) for g in grades[800:]], "held")
    assert (np.diff(p, axis=1) <= 0).all()
    severity = p.sum(axis=1)
    means = [severity[np.array(grades[800:]) == g].mean() for g in range(4)]
    assert means[0] < 0.3 and means[0] < means[1] <= means[3] and means[2] < means[3] + 0.3


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "vile nasty", 3), (4, "nasty " * 40_000, 3), (4, "fine", 3)],
                                 "doc_id long, text string, col int")
    texts = ["nasty vile thing"] * 20 + ["a fine day"] * 20
    model = toxicity.fit(texts, [1] * 20 + [0] * 20)
    got = {(r.doc_id, (r.text or "")[:5]): r for r in toxicity.severity(docs, model).collect()}
    assert got[4, "nasty"].toxic and got[None, "vile "].toxic and not got[4, "fine"].toxic
    assert got[1, ""].p_toxic == got[2, ""].p_toxic and got[1, ""].col == 3
    assert toxicity.fit(["a"], [0]) is None and toxicity.fit([], []) is None
    assert {r.expected_severity for r in toxicity.severity(docs, None).collect()} == {0.0}
    assert toxicity.severity(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(4, 1), (None, 1), (2, None), (77, 0), (1, 0)], "doc_id long, grade int")
    sample = toxicity.labelled_sample(docs, labels)
    assert sorted((g, w) for _, g, w in sample) == [(0, 1.0), (1, 1.0), (1, 1.0)]
    assert toxicity.labelled_sample(docs, labels.limit(0)) == []


# ---- decontamination -----------------------------------------------------------

def _lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_common_subsequence():
    rng = random.Random(7)
    for _ in range(200):
        a, b = (rng.choices(range(5), k=rng.randint(1, 30)) for _ in "ab")
        assert decontaminate.common_subsequence(a, b) == _lcs(a, b)


def test_planted_items_are_found_and_clean_documents_left(spark):
    docs = corpus_table(spark, SF, "documents")
    bench = corpus_table(spark, SF, "benchmark")
    grams = {}
    for r in bench.collect():
        w = decontaminate.words_of(r.text)
        for k in range(len(w) - 7):
            grams.setdefault(tuple(w[k:k + 8]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = decontaminate.words_of(r.text)
        want |= {(r.doc_id, i) for k in range(len(w) - 7) for i in grams.get(tuple(w[k:k + 8]), ())}
    rows = op10_lsa_decontamination(spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(want) > 10


def _paraphrase(words, rng, share, vocabulary):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(rng.choice(vocabulary) if x < 2 * share / 3 else w)
        if 2 * share / 3 <= x < share:
            out.append(rng.choice(vocabulary))
    return out


@pytest.mark.parametrize("share,least", [(0.0, 1.0), (0.15, 1.0), (0.3, 0.9)])
def test_paraphrases(spark, share, least):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(3000)]
    common_words = [f"c{i}" for i in range(20)]
    prose = lambda n: [rng.choice(common_words if rng.random() < 0.4 else vocabulary) for _ in range(n)]
    items = [prose(rng.choice([14, 30, 55, 150])) for _ in range(30)]
    docs = [(i, " ".join(prose(rng.randint(5, 400)))) for i in range(100, 300)]
    for i, item in enumerate(items):
        docs.append((i, " ".join(prose(rng.randint(0, 150)) + _paraphrase(item, rng, share, vocabulary) + prose(rng.randint(0, 150)))))
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, cosine double")
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(items)], "item_id long, text string, text2 string")
    rows = decontaminate.find_leaks(df, bench).collect()
    assert all(r.doc_id == r.item_id for r in rows)
    assert len({r.doc_id for r in rows}) >= least * len(items)
    left = {r.doc_id for r in decontaminate.remove_leaks(df, bench).collect()}
    assert left == {d for d, _ in docs} - {r.doc_id for r in rows}


def test_decontamination_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 1)      # several blocks of items
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x " + item), (4, item + " y"), (4, item), (5, "one two"),
                                  (6, "pad " * 30_000 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (None, item), (5, item + " thirteen")],
                                  "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()), key=repr)
    assert got == sorted([(d, i) for d in (None, 4, 4, 6) for i in (1, 5)], key=repr)
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.remove_leaks(docs, bench.limit(0)).count() == 7


def test_short_items_and_scripts_without_spaces(spark):
    assert decontaminate.words_of("Hello wörld_x 你好 abc日本 12a") == ["hello", "wörld", "x", "你", "好", "abc", "日", "本", "12a"]
    assert decontaminate.words_of("no_sign Éa") == ["no", "sign", "éa"]
    short, chinese = "blue cats seldom read quietly", "为什么天空在晴朗的日子里看起来是蓝色的"
    pad = " ".join(f"w{i % 37}" for i in range(150))
    docs = [(1, f"{pad} Blue cats, seldom read -- quietly {pad}"), (2, f"{pad} blue cats seldom quietly read {pad}"),
            (3, "Blue cats seldom read quietly"), (4, f"{pad} 他问{chinese}吗 {pad}"), (5, "今天天气很好我们去公园散步吧"),
            (6, " ".join(["w1"] * 62 + short.split() + ["w2"] * 40)), (7, "cats read")]
    bench = spark.createDataFrame([(1, short), (2, chinese), (3, "cats read")], "item_id long, text string")
    rows = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 1), (3, 1), (4, 2), (6, 1)]
    assert {(r.first_word, r.last_word) for r in rows if r.item_id == 1} == {(150, 154), (0, 4), (62, 66)}


def test_all_that_confirms_is_found_in_a_large_benchmark(spark, monkeypatch):
    """3000 items of 8 to 10 words out of prose, by far more than directions;
    documents with one each, verbatim or with words before the answer replaced."""
    monkeypatch.setattr(decontaminate, "PASSAGES_AT_ONCE", 7)
    rng = random.Random(3)
    table = corpus_table(spark, "/root/testdata/sf0.1", "documents").orderBy("doc_id").limit(1500)
    prose = [w for w in (decontaminate.words_of(r.text) for r in table.collect()) if len(w) > 150]
    items = []
    for _ in range(3000):
        words, n = rng.choice(prose), rng.randint(8, 10)
        at = rng.randrange(len(words) - n)
        items.append(words[at:at + n])
    docs = []
    for i, item in enumerate(items[:100]):
        words, at = prose[i * 7 % len(prose)], rng.randint(10, 100)
        if i % 2:
            item = [rng.choice(words) if k < len(item) // 2 and rng.random() < 0.35 else w for k, w in enumerate(item)]
        docs.append(words[:at] + item + words[at:140])
    rows = list(enumerate(" ".join(w) for w in docs + [x[:300] for x in prose[-700:]]))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    leaks = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    got = {(r.doc_id, r.item_id): r.overlap for r in leaks.filter(f"doc_id < {len(docs)}").collect()}
    want = {}
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            extra = len(item) // 2
            found = [decontaminate.confirm(item, words, max(0, a - extra), min(len(words), a + decontaminate.WINDOW + extra))
                     for a, _ in decontaminate._windows(len(words))]
            if any(found):
                want[d, i] = max(f[0] for f in found if f)
    assert got == want
    assert all((d, d) in want for d in range(0, len(docs), 2))


def test_the_latent_space_is_fitted_on_every_passage(spark):
    """Terms, document frequencies and the space equal those of all documents
    counted one by one; more documents than any sample held."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(60)]
    texts = [[rng.choice(words[:8 + 4 * (i % 14)]) for _ in range(rng.choice([0, 3, 32, 33, 64, 65, 100]))] for i in range(2600)]
    texts += [["late"] * 5 + rng.choices(words, k=40) for _ in range(12)] + [["later"]] * 14
    docs = spark.createDataFrame([(i, " ".join(t) if t else None) for i, t in enumerate(texts)], "doc_id long, text string") \
        .repartition(5)
    items = [(1, rng.choices(words, k=30) + ["asked"]), (2, rng.choices(words, k=150))]
    index = decontaminate.build_index(docs, items, decontaminate._word_documents(docs))
    df = Counter(w for t in texts for w in set(t))
    least = math.ceil(len(texts) * 5 / 1000)
    assert least == 14 and "later" in index.vocabulary
    assert set(index.vocabulary) == {w for w, n in df.items() if n >= least} | {w for _, x in items for w in x}
    idf = {w: math.log((len(texts) + 1) / (df[w] + 1)) + 1e-3 for w in index.vocabulary}
    gram = np.zeros((len(index.vocabulary),) * 2)
    passages = [(1.0, t[a:b]) for t in texts for a, b in decontaminate._windows(len(t))]
    passages += [(decontaminate.ITEM_WEIGHT ** 2 * len(texts) / 1000, x[a:b]) for _, t in items for c, d in decontaminate._item_passages(len(t))
                 for x in [t[c:d]] for a, b in decontaminate._windows(len(x))]
    for weight, p in passages:
        v = np.zeros(len(gram))
        for w, n in Counter(p).items():
            if w in index.vocabulary:
                v[index.vocabulary[w]] = n * idf[w]
        if v.any():
            gram += weight * np.outer(v, v) / (v @ v)
    basis = index.term_vectors[:-1] / np.array([idf[w] for w in sorted(index.vocabulary)])[:, None]
    # no more terms than directions: the space is the whole one, in order of the eigenvalues
    assert np.allclose(basis.T @ basis, np.eye(len(gram)), atol=1e-3)
    assert np.allclose(basis @ np.diag(np.linalg.eigvalsh(gram)[::-1]) @ basis.T, gram, rtol=1e-3, atol=1e-3 * gram.max())


def test_smallest_tables(spark):
    for q in (op1_ordinal_toxicity, op8_crf_language, op10_lsa_decontamination):
        q(spark, SF_SMALL).collect()


def test_words_are_cut_once_and_counted_like_texts(spark, monkeypatch):
    """Cut texts give back every document's words; the likely terms hold all
    that enough documents do, though the rows counted together are few."""
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 500)
    monkeypatch.setattr(decontaminate, "WORDS_COUNTED", 40)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(90)] + ["ä", "日"]
    texts = [None, "", "--"] + [" ".join(rng.choices(words[:4 + i % 88], k=rng.choice([1, 30, 200]))) for i in range(1200)] + ["rare"] * 5
    docs = spark.createDataFrame([(None if i == 7 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    chunks = decontaminate._word_chunks(docs)
    vocabulary = {w: k for k, w in enumerate([*words, "rare"])}
    got = []
    for batch in chunks.toArrow().to_batches():
        for ids, flat, sizes in decontaminate._texts_of([batch], vocabulary, 300):
            got += zip(ids, map(tuple, np.split(flat, np.cumsum(sizes)[:-1])), strict=True)
    assert sorted(got, key=repr) == sorted(((None if i == 7 else i, tuple(vocabulary[w] for w in decontaminate.words_of(t)))
                                            for i, t in enumerate(texts)), key=repr)
    held = Counter(w for t in texts for w in set(decontaminate.words_of(t)))
    assert {r.word: r.n for r in decontaminate._words_held(chunks).collect()} == held
    assert {r.word: r.n for r in decontaminate._words_held(chunks, {"w3", "rare"}).collect()} == {w: held[w] for w in ("w3", "rare")}
    likely = decontaminate._likely_terms(chunks, len(texts))
    assert {w for w, n in held.items() if n >= decontaminate._least_documents(len(texts))} <= likely <= set(held)
    assert "rare" not in likely


def test_words_are_numbered_like_they_are_cut():
    """Texts of several scripts, without words and with signs between them."""
    texts = [None, "", "--", "One one, two\u00a0Écu écu\x85three", "你好 one x", "  two  ", "Œuvre one écu", "a_b"] * 2
    for part in (texts, [t for t in texts if t and t.isascii()], texts[:3], texts[4:5]):
        words, n, ids, sizes = decontaminate._numbered([decontaminate._spaced(t) for t in part])
        names = words.split()
        assert len(names) == n == len(set(names))
        got = [[names[k] for k in x] for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [decontaminate.words_of(t) for t in part]


def test_search_and_last_pass_are_one(spark, monkeypatch):
    """One pass less over all words, and the cosines are those of the index
    that is built without a search."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(6)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 20, 150]))) for _ in range(60)]
    texts += [f"{texts[3 + i]} {t} {texts[30 + i]}" for i, t in items]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(docs, [(i, decontaminate.words_of(t)) for i, t in items], decontaminate._word_documents(docs))

    def no_pass_of_its_own(*_):
        raise AssertionError("the index is built before the search")

    monkeypatch.setattr(decontaminate, "build_index", no_pass_of_its_own)
    leaks = decontaminate.find_leaks(docs, bench).collect()
    assert {(60 + i, i) for i in range(6)} <= {(r.doc_id, r.item_id) for r in leaks}
    for r in leaks:
        text = [index.vocabulary.get(w, len(index.vocabulary)) for w in decontaminate.words_of(texts[r.doc_id])]
        passages = np.stack([index.term_vectors[text[a:b]].sum(axis=0) for a, b in decontaminate._windows(len(text))])
        passages /= np.linalg.norm(passages, axis=1, keepdims=True)
        assert np.abs(passages @ index.vectors[r.item_id] - r.cosine).min() < 1e-5


def test_a_stretch_of_enough_words_is_always_held():
    """No passage that would be confirmed fails the condition on its words;
    words that come again and again count once."""
    rng = random.Random(8)
    terms = 120
    draw = lambda n: [min(int(rng.expovariate(0.05)), terms) for _ in range(n)]
    items = [[min(w, terms - 1) for w in draw(rng.choice([4, 7, 8, 20, 45, 64]))] for _ in range(25)]
    index = decontaminate.Index({}, np.zeros((terms + 1, 2), np.float32), list(enumerate(items)), np.zeros((len(items), 2), np.float32),
                                np.arange(terms)[::-1])
    texts = [draw(n) for n in (0, 3, 32, 33, 64, 65, 300, 500)] + [draw(40) + x + draw(70) for x in items] + [[0] * 200]
    ids, sizes = np.array([w for t in texts for w in t]), np.array([len(t) for t in texts])
    padded, owner, nth, lead, _ = decontaminate._blocks(ids, sizes, terms)
    got = {(p, q) for p, q, _ in decontaminate._candidates(index, padded, owner, lead, np.zeros((len(lead), 2), np.float32))}
    want = set()
    for p, b in enumerate(lead.tolist()):
        text, at = texts[owner[b]], int(nth[b]) * decontaminate.STRIDE
        for q, item in enumerate(items):
            extra = len(item) // 2
            if decontaminate.confirm(item, text, max(0, at - extra), min(len(text), at + decontaminate.WINDOW + extra)):
                want.add((p, q))
    assert want <= got and len(want) > 25
    assert not any(owner[lead[p]] == len(texts) - 1 for p, _ in got)


def test_passages_near_an_item_are_candidates(monkeypatch):
    """Every passage is compared with every item's passage in the latent space;
    those near it are confirmed though the condition on words let none pass."""
    monkeypatch.setattr(decontaminate, "PASSAGES_AT_ONCE", 7)
    rng = np.random.default_rng(6)
    terms, rank = 400, 12
    items = [rng.choice(terms, n, replace=False).tolist() for n in (8, 20, 40, 64) for _ in range(5)]
    term_vectors = np.vstack([rng.standard_normal((terms, rank)), np.zeros((1, rank))]).astype(np.float32)
    vectors = np.stack([term_vectors[x].sum(axis=0) for x in items])
    index = decontaminate.Index({}, term_vectors, list(enumerate(items)), vectors / np.linalg.norm(vectors, axis=1, keepdims=True),
                                np.arange(terms))
    index.least[:] = 10_000
    texts = [rng.integers(0, terms + 1, n).tolist() for n in (0, 5, 33, 200, 500)] + [items[7], items[13] + items[13][:5]]
    flat, sizes = np.array([w for t in texts for w in t]), np.array([len(t) for t in texts])
    padded, owner, nth, lead, _ = decontaminate._blocks(flat, sizes, terms)
    places = np.stack([term_vectors[t[a:b]].sum(axis=0) for t in texts for a, b in decontaminate._windows(len(t))])
    places /= np.linalg.norm(places, axis=1, keepdims=True)
    cosine = places @ index.vectors.T
    want = {(p, q): cosine[p, q] for p, q in zip(*np.nonzero(cosine >= decontaminate.MIN_COSINE))}
    got = {(p, q): c for p, q, c in decontaminate._candidates(index, padded, owner, lead, places)}
    assert set(got) == set(want) and len(want) > 20
    assert all(abs(got[x] - c) < 1e-5 for x, c in want.items())
    found = decontaminate.search_texts(index, flat, sizes)
    assert [[x[0] for x in f] for f in found] == [[]] * 5 + [[7], [13]]
    assert all(abs(f[0][1] - cosine[-len(found) + k, f[0][0]]) < 1e-5 for k, f in enumerate(found) if f)


def test_texts_reach_python_in_batches_of_few_bytes(spark):
    """Long texts come a few at a time, whatever their rows."""
    ship_package(spark)
    docs = spark.range(0, 48, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 100_000).alias("text"))

    def bytes_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    sizes = [r.n for r in docs.mapInArrow(bytes_of, "n long").collect()]
    assert sum(sizes) > 24_000_000 and max(sizes) < 6_000_000
