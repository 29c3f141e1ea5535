"""Harmonic packing against direct encoding, and the rules of its sequences."""

import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from ingot.llm import harmonic
from ingot.llm.queries import QUERIES
from ingot.llm.tokens import BYTE_LEVEL

PATH = public_tokenizers.path("byte_bpe_50k.json")


def direct(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, capacity=harmonic.CAPACITY):
    """Every id in one piece, no gap in a sequence; the sequences' lengths."""
    tok = Tokenizer.from_file(PATH)
    want = {}
    for d, t in docs:
        want.setdefault(d, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        if len(want[d]) > 1:        # repeated rows: together they have each id as often
            assert sum(p["length"] for p in pieces) == sum(map(len, want[d]))
            continue
        ids, at = want[d][0], 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            part = ids[at:at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += p["length"]
        assert at == len(ids)
    totals = []
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        totals.append(at)
    return totals


def padding(totals, capacity=harmonic.CAPACITY):
    return sum(0 if t & (t - 1) == 0 else capacity - t for t in totals)


def test_whole_table(spark):
    rows = [r.asDict() for r in QUERIES["op11_harmonic_packing"](spark, SF_SMALL).collect()]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    totals = check(rows, docs)
    assert padding(totals) <= 0.002 * sum(totals)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a"), (4, "word " * 9000), (5, "ab cd"), (5, "ab cd"), (None, "xy z"),
            (2**62 + 1, "日本語のテキスト 👍 " * 50), (-7, " \n\t ")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, length int, sequence_id int")
    rows = [r.asDict() for r in harmonic.pack(df.repartition(3), PATH, BYTE_LEVEL).collect()]
    assert padding(check(rows, docs)) == 0
    assert harmonic.pack(df.limit(0), PATH, BYTE_LEVEL).count() == 0


@pytest.mark.parametrize("capacity,tail", [(2048, 32), (2048, 1), (3000, 16), (7, 4), (1, 1)])
def test_classes_are_filled_by_count(capacity, tail):
    packer, rows = harmonic.Packer(5, capacity, tail), []
    lengths = [*range(1, 400), *[37] * 500, 9000, 2047, 2048, 2049]
    for d, n in enumerate(lengths):
        rows += packer.document(d, struct.pack(f"<{n}I", *range(n)))
    # all sequences closed so far are full by their class: k pieces of at most capacity / k
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r[5], []).append(r[2])
    for held in by_seq.values():
        assert {capacity // n for n in held} == {len(held)}
    closed = len(by_seq)
    rest = list(packer.finish())
    for r in rest:
        by_seq.setdefault(r[5], []).append(r[2])
    assert len(by_seq) == len({r[5] for r in rest}) + closed
    for held in list(by_seq.values())[closed:]:
        assert sum(held) & (sum(held) - 1) == 0 or sum(held) == capacity
    assert sum(map(sum, by_seq.values())) == sum(lengths)
    assert all(sum(held) <= capacity for held in by_seq.values())
