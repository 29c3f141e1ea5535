"""The pipeline against a plain version of every stage."""

import itertools
import zlib
from array import array

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from ingot.llm import decontaminate, language, minhash, repeats
from ingot.llm.common import corpus_table


def _plain(spark, sf_dir):
    docs = corpus_table(spark, sf_dir, "documents")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    model = language.train(docs)
    ids = sorted(rows)
    langs, scores = language.predict_batch(model, [rows[i] for i in ids])
    rows = {i: rows[i] for i, lang, s in zip(ids, langs, scores, strict=True)
            if lang != "und" and s >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    sets = {i: set(minhash.shingle_set(t, 5).tolist()) for i, t in rows.items()}
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(rows), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    rows = {i: t for i, t in rows.items() if find(i) == i}
    first, cut = {}, {}
    for i in sorted(rows):
        t = rows[i].encode()
        gone = set()
        for k in range(len(t) - 99):
            if first.setdefault(t[k:k + 100], (i, k)) != (i, k):
                gone.update(range(k, k + 100))
        spans = [(k, k + 1) for k in sorted(gone)]
        cut[i] = repeats._outside(t, repeats.whole_characters(t, repeats._merged(
            [{"lo": a, "hi": b} for a, b in spans]))).decode()
    number: dict[str, int] = {}
    word_ids = lambda t: [number.setdefault(w, len(number)) for w in decontaminate.words_of(t)]
    items = [word_ids(r.text)[a:b] for r in corpus_table(spark, sf_dir, "benchmark").collect()
             for a, b in decontaminate._item_passages(len(decontaminate.words_of(r.text)))]
    clean = {}
    for i, t in cut.items():
        w = word_ids(t)
        if not any(decontaminate.confirm(x, w, 0, len(w)) for x in items):
            clean[i] = t
    tok = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.WORD_BPE))
    out = set()
    for i, t in clean.items():
        x = tok.encode(t, add_special_tokens=False).ids + [1]
        out |= {(i, k, a, len(x[a:a + 4096]), zlib.crc32(array("I", x[a:a + 4096]).tobytes()))
                for k, a in enumerate(range(0, len(x), 4096))}
    return out


def test_pipeline_against_plain_stages(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {tuple(r)[:5] for r in rows} == _plain(spark, SF_SMALL)
    assert len(rows) == len({(r.doc_id, r.piece) for r in rows})
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 4096


def test_stages_keep_the_columns(spark):
    docs = corpus_table(spark, SF_SMALL, "documents").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns


def test_empty_and_odd_documents(spark):
    schema = corpus_table(spark, SF_SMALL, "documents").schema
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the and of", "en", "s", 10),
                                  (3, "the and of", "en", "s", 10), (None, "the and of it", "en", None, 13)], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
    kept = corpus_pipeline.identify_language(spark, docs, SF_SMALL)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3]
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL).collect()) == [0, 1, 2, 3]


def test_different_texts_under_one_id_stay(spark):
    schema = corpus_table(spark, SF_SMALL, "documents").schema
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue white black brown"]
    docs = spark.createDataFrame([(7, t, "en", "s", 1) for t in texts] + [(7, texts[0], "en", "s", 1), (3, texts[1], "en", "s", 1),
                                  (9, texts[2] + "!", "en", "s", 1), (9, "quite another text about nothing at all", "en", "s", 1)], schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), SF_SMALL).collect()
    # of equal texts the smallest doc_id's row stays; nothing else goes
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(
        [(7, texts[0]), (3, texts[1]), (7, texts[2]), (9, texts[2] + "!"), (9, "quite another text about nothing at all")])


def test_columns_of_the_operators_own_names(spark):
    names = ["_p", "_given", "_spans", "score", "lang_pred", "_salt"]
    docs = corpus_table(spark, SF_SMALL, "documents").limit(40).selectExpr("*", *[f"'{n}' AS {n}" for n in names])
    for name, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        assert {tuple(r) for r in out.select(*names).collect()} == {tuple(names)}, name
