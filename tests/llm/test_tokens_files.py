"""Whole-text encoding, block files and packing."""

import itertools
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from ingot.llm import packing, token_files
from ingot.llm.queries import BYTE_BPE, WORD_BPE, op3_best_fit_packing, op6_token_files
from ingot.llm.tokens import BYTE_LEVEL, WORD_LEVEL, PieceEncoder, worker_encoder
from ingot.session import new_workspace

ODD = ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "x\t\ty", "don't 's we'll", "É́ é x", "a<|endoftext|>b c",
       "1234 5²,b ,c\t d\x1ce", "naïve Straße ½ §5", "日本語 テキスト です", "ﬁne x​y᠎z", "a\r\nb  \n c", "İI ıi", "\x00 a\x85b"]


@pytest.mark.parametrize("name,kind", [(BYTE_BPE, BYTE_LEVEL), (WORD_BPE, WORD_LEVEL)])
def test_pieces_equal_the_whole(name, kind):
    path = public_tokenizers.path(name)
    tok, enc = Tokenizer.from_file(path), PieceEncoder(path, kind)
    rng = random.Random(4)
    parts = [*ODD, "the", "The", "of.", "%%%", "word,word", " ", "\n", "it's", "ÀÉ", "x2y"]
    texts = ODD + ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(12)) for _ in range(600)]
    for t, got in zip(texts, enc.encode_batch(texts), strict=True):
        assert got == array("I", tok.encode(t, add_special_tokens=False).ids).tobytes(), repr(t)


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("ingot.llm.tokens.CACHE_PIECES", 5)
    enc = PieceEncoder(public_tokenizers.path(BYTE_BPE), BYTE_LEVEL)
    texts = [f"word{i} and thing{i % 3}" for i in range(50)]
    tok = enc.tok
    assert list(enc.encode_batch(texts)) == [array("I", tok.encode(t).ids).tobytes() for t in texts]


@pytest.mark.parametrize("ids", [
    [], [0], [7] * 3000, list(range(2500)), [1] * 1023 + [2**32 - 1], [2**32 - 1, 0] * 700,
    np.random.default_rng(1).integers(0, 50257, 5000).tolist(),
    (np.random.default_rng(2).pareto(1.0, 5000) * 10).astype(int).clip(0, 60000).tolist()])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    for percentile in (0.5, 0.99, 1.0):
        blocks = token_files.encode_blocks(ids, percentile)
        at = np.cumsum([0, *map(len, blocks)])[:-1]
        if not len(ids):
            assert blocks == []
            continue
        assert (token_files.decode_blocks(b"".join(blocks), at)[:len(ids)] == ids).all()


def test_outliers_become_exceptions():
    ids = np.full(1024, 5, np.uint32)
    ids[17] = 1 << 20
    assert len(token_files.encode_blocks(ids)[0]) < 8 + 16 * 8 + 6 + 1      # one bit each and one exception


def test_shard_gives_any_document(tmp_path):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50000, n).astype("<u4") for n in (0, 1, 1023, 1024, 5000, 0, 700_000, 2)]
    with open(tmp_path / "s", "wb") as f:
        w = token_files.ShardWriter(f, 0.99)
        for k, d in enumerate(docs):
            w.add(None if k == 0 else k, d.tobytes())
        size = w.close()
    raw = (tmp_path / "s").read_bytes()
    assert len(raw) == size
    shard = token_files.Shard(raw)
    for k in (7, 3, 0, 6, 4):
        assert (shard.ids(k)[0] == docs[k]).all()
    assert all((a == b).all() for a, b in zip(shard.ids(0, 99), docs, strict=True))
    with pytest.raises(ValueError):
        token_files.Shard(raw[:-1])


def _expected(rows, end):
    tok, at, out = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE)), 0, []
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((d, at, len(ids), zlib.crc32(array("I", ids).tobytes())))
        at += len(ids)
    return out


def test_token_files_against_direct_encoding(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = [tuple(r) for r in op6_token_files(spark, SF_SMALL).orderBy("doc_id").collect()]
    assert got == _expected(rows, 0)


def test_token_files_odd_rows(spark):
    rows = [(3, "long " * 50_000, 1), (1, None, 2), (2, "", None), (2, "", 4), (None, "x", 5), (9, "a b", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    path = public_tokenizers.path(BYTE_BPE)
    got = {tuple(r) for r in token_files.token_files(spark, df, path, BYTE_LEVEL).collect()}
    order = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == set(_expected(order, 0))
    out = new_workspace(spark, "test")
    manifest = token_files.write_token_files(df.limit(0), path, BYTE_LEVEL, out)
    assert manifest.count() == 0
    assert token_files.read_token_digests(manifest).count() == 0


def _fewest(lengths, capacity):
    """Bins of an optimal packing, by trying all assignments."""
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best


def test_plan_is_close_to_the_optimum():
    rng = random.Random(8)
    extra = 0
    for _ in range(60):
        lengths = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        hist = {x: lengths.count(x) for x in lengths}
        plan = packing.plan_sequences(hist, 20)
        used = [x for filling, times in plan for _ in range(times) for x in filling]
        assert sorted(used) == sorted(lengths)
        assert all(sum(f) <= 20 for f, _ in plan)
        extra += sum(t for _, t in plan) - _fewest(lengths, 20)
    assert extra <= 2


def _best_fit(hist, capacity):
    rooms = []
    for x in sorted(hist, reverse=True):
        for _ in range(hist[x]):
            room = min((r for r in rooms if r >= x), default=None)
            if room is None:
                rooms.append(capacity - x)
            else:
                rooms[rooms.index(room)] -= x
    return len(rooms)


def test_plan_is_never_above_best_fit():
    rng = random.Random(5)
    hists = [{480: 24, 642: 26, 1427: 60}, {307: 93, 381: 94, 1433: 73, 1478: 65, 2530: 27}]
    hists += [{rng.randint(200, 3000): rng.randint(1, 80) for _ in range(rng.randint(3, 6))} for _ in range(15)]
    for hist in hists:
        plan = packing.plan_sequences(hist)
        used = Counter()
        for filling, times in plan:
            assert sum(filling) <= packing.CAPACITY and times > 0
            for x in filling:
                used[x] += times
        assert used == hist
        size, best_fit = sum(t for _, t in plan), _best_fit(hist, packing.CAPACITY)
        assert sum(t for _, t in packing.best_fit_decreasing(hist, packing.CAPACITY)) == best_fit
        lengths = np.array(sorted(hist))
        assert packing.fewest_sequences(lengths, np.array([hist[x] for x in sorted(hist)]), packing.CAPACITY) <= size <= best_fit


def test_best_filling_is_exact_on_small_tables():
    rng = random.Random(2)
    for _ in range(200):
        have = [rng.randint(1, 15) for _ in range(6)]
        lengths, counts = np.unique(have, return_counts=True)
        room = rng.randint(0, 30)
        want = max(sum(c) for n in range(7) for c in itertools.combinations(have, n) if sum(c) <= room)
        assert sum(packing.best_filling(lengths, counts, room)) == want


def test_many_tiny_pieces_need_no_deep_search():
    assert packing.plan_sequences({1: 10_000}, 4096) == [([1] * 4096, 2), ([1] * (10_000 - 8192), 1)]


def _check_packing(rows):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= packing.CAPACITY
    return len(by_seq)


def test_packing_query(spark):
    rows = op3_best_fit_packing(spark, SF_SMALL).collect()
    n = _check_packing(rows)
    assert n <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1
    tok = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    want = set()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        want |= {(r.doc_id, k, a, len(ids[a:a + 4096]), zlib.crc32(array("I", ids[a:a + 4096]).tobytes()))
                 for k, a in enumerate(range(0, len(ids), 4096))}
    assert {tuple(r)[:5] for r in rows} == want


def test_packing_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (2, "", 1), (None, "a b", 2), (5, "word " * 20_000, 3)] + [(9, "same", 4)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, `offset` int")
    path = public_tokenizers.path(WORD_BPE)
    got = packing.pack(packing.token_pieces(df, path, WORD_LEVEL)).collect()
    assert len(got) == 4 + 5 + 30
    _check_packing(got)
    assert packing.pack(packing.token_pieces(df.limit(0), path, WORD_LEVEL)).count() == 0
    assert worker_encoder(path, WORD_LEVEL) is worker_encoder(path, WORD_LEVEL)
