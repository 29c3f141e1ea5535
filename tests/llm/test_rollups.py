"""Signed deltas, idempotent commits, compaction."""

from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from ingot.llm import token_rollups as R
from ingot.llm.queries import TOKENIZERS, op7_tokenizer_rollups
from ingot.session import new_workspace


def _rows(df):
    return {tuple(r) for r in df.select("source", "lang", "tokenizer", "n_docs", "n_tokens").collect()}


def _batch(spark, rows):
    return R.signed(spark.createDataFrame(
        rows, "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long, n_docs string"))


def test_totals_follow_the_batches(spark):
    t = R.Rollup(spark, new_workspace(spark, "test") + "/t")
    assert t.totals().count() == 0
    first = _batch(spark, [(R.INSERT, "a", "en", "v1", 10, None, "x"), (R.INSERT, "a", "en", "v1", 5, None, "x"),
                           (R.INSERT, None, None, "v1", None, None, None)])
    assert t.commit("1", first)
    assert _rows(t.totals()) == {("a", "en", "v1", 2, 15), (None, None, "v1", 1, 0)}
    assert not t.commit("1", first)
    assert t.commit("2", _batch(spark, [(R.REVISE, "a", "en", "v1", 7, 10, "x"), (R.DELETE, None, None, "v1", None, None, "x")]))
    assert _rows(t.totals()) == {("a", "en", "v1", 2, 12)}
    assert t.commit("3", first.limit(0))
    t.compact()
    assert len(t.committed()) == 1
    assert not t.commit("2", first) and not t.commit("3", first)
    assert t.commit("4", _batch(spark, [(R.DELETE, "a", "en", "v1", None, 12, "x"), (R.DELETE, "a", "en", "v1", None, 0, "x")]))
    t.compact()
    assert _rows(t.totals()) == set()


class _Stop(Exception):
    pass


class _Failing:
    """A file system that stops the process at its n-th change."""

    def __init__(self, fs, steps):
        self.fs, self.steps = fs, steps

    def __getattr__(self, name):
        real = getattr(self.fs, name)
        if name not in ("rename", "delete", "create", "mkdirs"):
            return real

        def step(*args):
            if self.steps == 0:
                raise _Stop(name)
            self.steps -= 1
            return real(*args)
        return step


def test_a_crash_between_any_two_steps_of_compaction_loses_nothing(spark):
    want = {("a", "en", "v1", 3, 30)}
    for steps in range(12):
        path = new_workspace(spark, "test") + "/t"
        t = R.Rollup(spark, path)
        for i in range(3):
            t.commit(str(i), _batch(spark, [(R.INSERT, "a", "en", "v1", 10, None, "x")]))
        if steps % 2:                 # a fold of a fold
            t.compact()
            t.commit("3", _batch(spark, [(R.REVISE, "a", "en", "v1", 10, 10, "x")]))
        t._fs = _Failing(t._fs, steps // 2)
        try:
            t.compact()
            done = True
        except _Stop:
            done = False
        fresh = R.Rollup(spark, path)
        assert _rows(fresh.totals()) == want, steps
        assert not any(fresh.commit(str(i), _batch(spark, [(R.INSERT, "a", "en", "v1", 10, None, "x")])) for i in range(3))
        fresh.compact()
        assert _rows(fresh.totals()) == want and len(fresh.committed()) == 1
        if done and steps > 9:
            break


def test_of_two_writers_of_a_batch_one_wins(spark):
    t = R.Rollup(spark, new_workspace(spark, "test") + "/t")
    b = _batch(spark, [(R.INSERT, "a", "en", "v1", 10, None, "x")])
    late = R.Rollup(spark, t.path)
    assert t.commit("1", b)
    late.has = lambda _: False        # it had looked before the other's rename
    assert not late.commit("1", b)
    assert _rows(t.totals()) == {("a", "en", "v1", 1, 10)}


def test_unfinished_batches_are_not_seen(spark):
    path = new_workspace(spark, "test") + "/t"
    t = R.Rollup(spark, path)
    b = _batch(spark, [(R.INSERT, "a", "en", "v1", 1, None, "x")])
    b.write.parquet(f"{path}/_staging/1-dead")
    assert t.totals().count() == 0
    assert t.commit("1", b) and t.totals().count() == 1


def test_counters(spark):
    df = spark.createDataFrame([("a b\tc\n\x0bd\x85e",), ("",), (None,), ("é" * 5,)], "text string")
    got = [tuple(r) for r in df.select(R.word_count(F.col("text")), R.byte_quads(F.col("text"))).collect()]
    assert got == [(4, 3), (0, 0), (0, 0), (1, 3)]


def test_tokenizer_totals_against_direct_encoding(spark):
    want = Counter()
    toks = {v: Tokenizer.from_file(public_tokenizers.path(name)) for v, (name, _) in TOKENIZERS.items()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        n = {v: len(t.encode(r.text or "", add_special_tokens=False).ids) for v, t in toks.items()}
        for v in n if n["word_bpe_49k"] else ():
            want[r.source, r.lang, v, "docs"] += 1
            want[r.source, r.lang, v, "tokens"] += n[v]
    got = Counter()
    for source, lang, v, docs, tokens in _rows(op7_tokenizer_rollups(spark, SF_SMALL)):
        got[source, lang, v, "docs"], got[source, lang, v, "tokens"] = docs, tokens
    assert got == want and want


def test_token_counts_of_odd_rows(spark):
    df = spark.createDataFrame([("s", None, None), (None, "en", ""), ("s", "en", "a b")], "source string, lang string, text string")
    files = {v: (public_tokenizers.path(name), kind) for v, (name, kind) in TOKENIZERS.items()}
    got = {tuple(r) for r in R.token_counts(df, files).collect()}
    assert got == {("s", None, 0, 0), (None, "en", 0, 0), ("s", "en", 2, 2)}
    assert R.token_counts(df.limit(0), files).count() == 0
