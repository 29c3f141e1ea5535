"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages of ``WINDOW`` words. Their
TF-IDF vectors are projected to a latent space found by a randomised singular
value decomposition, computed by Spark over passages: each pass multiplies the
passages' sparse rows with a thin matrix and sums the products by term. The
space (the index) is fitted on every passage of all documents and on all items,
which weigh ``ITEM_WEIGHT`` against each ``PER_DOCS`` documents so that their
directions stay however large the corpus. Its terms are the items' words and
those that ``MIN_TERM_DOCS`` of ``PER_DOCS`` documents hold, counted over all
documents: at most ``PER_DOCS / MIN_TERM_DOCS`` times the different words of a
document on the average, however many documents there are. Every passage of
every document is searched. Documents count as often as they come.

Every passage is compared with every item's passage in the latent space, and
is a candidate where their cosine reaches ``MIN_COSINE``. ``RANK`` directions
carry about as many items; where a block holds more, or an item is short, the
cosine of a true leak may stay below. So a passage is also a candidate for each
item of which a stretch in it holds enough words: a confirmation needs
``LIKELY`` of them. Words are looked up in an inverted index, by units of
``UNIT`` words; the ``COMMON`` commonest terms are kept as bits of a unit. No
passage that would be confirmed is left out, whatever the number of items.

Texts are cut into words once and written as word numbers (``CHUNKS``), which
the counts, the passes of the decomposition and the search read.

A candidate is confirmed on the words: the longest common subsequence must
hold ``SURE`` of the item's words, or ``LIKELY`` of them together with
``ANSWER`` of its last words (where an item has its answer). Paraphrases that
drop, add or replace words keep most of the subsequence. An item of fewer than
``SHORTEST_ITEM`` words is confirmed only where its whole sequence stands.

Words are runs of letters and digits; in scripts written without spaces
(Chinese, Japanese, Thai, Lao, Khmer, Burmese) every character is a word.

Items are searched ``ITEMS_AT_ONCE`` at a time, so what is sent to the workers
has a bound whatever the benchmark's size.

Cases: null or empty texts have no passages; items of fewer than
``SHORTEST_SEQUENCE`` words cannot be told from ordinary prose, not even
verbatim, and are not searched; a null doc_id is searched like any other; repeated rows give
repeated results; an empty table on either side gives an empty result; other
columns of the documents are kept by ``remove_leaks`` and not read otherwise.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingot.llm.common import written

WINDOW, STRIDE = 64, 32
SHORTEST_ITEM, SHORTEST_SEQUENCE = 8, 4
RANK, OVERSAMPLE = 192, 16
ITEM_WEIGHT = 6.0
MIN_COSINE = 0.35
MIN_TERM_DOCS, PER_DOCS = 5, 1000
SURE, LIKELY, ANSWER = 0.75, 0.5, 0.7
ANSWER_WORDS = 8
ITEMS_AT_ONCE = 5000
WORDS_AT_ONCE = 40_000
WORDS_SUMMED = 160_000       # the same where rows are summed by term
CHUNK_WORDS = 300_000        # words of a row of cut texts, with the signs between them
UNIT = 16                    # words that the inverted index takes together
COMMON = 64                  # terms counted in a matrix instead of looked up one by one
ROWS_AT_ONCE = 1000          # rows of a matrix handed on together
WORDS_COUNTED = 200_000       # different words that a task counts before it hands them on
PASSAGES_AT_ONCE = 512       # rows of the matrices of passages by items
SEED = 17
_WORD = re.compile(r"[^\W_]+")
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED_ANY = re.compile(f"[{_UNSPACED}]")
_WORD_OR_SIGN = re.compile(rf"(?!_)\w(?:(?<=[{_UNSPACED}])|[^\W_{_UNSPACED}]*)")

LEAKS = ("doc_id long, item_id long, cosine double, overlap double, answer_overlap double, "
         "first_word int, last_word int")
_LEAKS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("overlap", pa.float64()),
                    ("answer_overlap", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())])


#: Latin-1 with a space for all that is no letter or digit.
_LATIN_WORDS = bytes(c if chr(c).isalnum() else 32 for c in range(256))


def _spaced(text: str | None) -> bytes | list[str]:
    """The words of a text: in Latin-1 with spaces between them, if they can be
    written so, or else one by one."""
    text = (text or "").lower()
    try:
        return text.encode("latin-1").translate(_LATIN_WORDS)
    except UnicodeEncodeError:
        return (_WORD_OR_SIGN if _UNSPACED_ANY.search(text) else _WORD).findall(text)


def words_of(text: str | None) -> list[str]:
    found = _spaced(text)
    return found.decode("latin-1").split() if isinstance(found, bytes) else found


def _numbered(texts: list[bytes | list[str]]) -> tuple[str, int, np.ndarray, np.ndarray]:
    """``(words, n, ids, sizes)`` of texts as ``_spaced`` gives them: the ``n``
    different words with spaces between them, each word's number among them,
    one text after the other, and the words of each text."""
    latin = [t for t in texts if isinstance(t, bytes)]
    letters = np.frombuffer(b" ".join([b"", *latin, b""]), np.uint8)
    inside = letters != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    inside[end + 1] = True                                       # each word with the space behind it
    places = np.concatenate(([0], np.cumsum(end - begin + 1)))
    encoded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(places), pa.py_buffer(letters[inside])]) \
        .dictionary_encode()
    ids, n = encoded.indices.to_numpy(), len(encoded.dictionary)
    words = encoded.dictionary.buffers()[2].to_pybytes().decode("latin-1").rstrip(" ") if n else ""
    ends = np.cumsum([len(t) + 1 for t in latin])                # where the space behind each text is
    sizes = np.diff(np.searchsorted(begin, ends), prepend=0).astype(np.int32)
    if len(latin) == len(texts):
        return words, n, ids, sizes
    number = defaultdict(count(n).__next__, zip(words.split(), range(n), strict=True))
    own = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(latin) else ())
    parts = [next(own) if isinstance(t, bytes) else np.fromiter(map(number.__getitem__, t), np.int32, len(t)) for t in texts]
    return " ".join(number), len(number), np.concatenate(parts), np.array([len(x) for x in parts], np.int32)


def _windows(n: int) -> list[tuple[int, int]]:
    """Word ranges of the passages of a text of n words."""
    return [(a, min(a + WINDOW, n)) for a in range(0, max(1, n - STRIDE), STRIDE)] if n else []


# ---- corpus statistics and the latent space ------------------------------------

CHUNKS = "n long, doc_ids array<long>, sizes binary, words string, ids binary, held binary"


def _word_chunks(docs: DataFrame) -> DataFrame:
    """The words of ``docs(doc_id, text)``, cut once for all that reads them:
    ``CHUNKS``, one row per about ``CHUNK_WORDS`` words of a task. ``words``
    are the row's different words, ``ids`` each word's number among them,
    ``sizes`` the words of each of the ``n`` documents, ``held`` how many of
    them hold each different word."""
    def chunk(doc_ids, texts):
        words, n, ids, sizes = _numbered(texts)
        seen = np.repeat(np.arange(len(sizes)), sizes) * max(1, n) + ids
        seen.sort()
        once = seen[np.flatnonzero(np.diff(seen, prepend=-1))] % max(1, n)
        held = np.bincount(once, minlength=n).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array([len(sizes)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([sizes.tobytes()], pa.binary()),
            pa.array([words], pa.string()), pa.array([ids.astype(_id_type(n)).tobytes()], pa.binary()),
            pa.array([held.tobytes()], pa.binary())], ["n", "doc_ids", "sizes", "words", "ids", "held"])

    def cut(batches):
        doc_ids, texts, words = [], [], 0
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _spaced(t)
                doc_ids.append(d)
                texts.append(found)
                words += found.count(b" ") + 1 if isinstance(found, bytes) else len(found)
                if words >= CHUNK_WORDS or len(texts) >= CHUNK_WORDS:
                    yield chunk(doc_ids, texts)
                    doc_ids, texts, words = [], [], 0
        if texts:
            yield chunk(doc_ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, CHUNKS)


def _id_type(words: int) -> type:
    return np.uint16 if words <= 1 << 16 else np.int32


def _words_in(words: pa.Array) -> pa.Array:
    """The words of a ``CHUNKS`` row, given as an array of its one text."""
    return pc.split_pattern(words.cast(pa.string()), " ").values


def _places_in(vocabulary: pa.Array, words: pa.Array) -> np.ndarray:
    """The place in the vocabulary of each word of such a row; of other words
    the vocabulary's length."""
    at = pc.index_in(_words_in(words), value_set=vocabulary)
    return at.fill_null(len(vocabulary)).to_numpy(zero_copy_only=False)


def _texts_of(batches, vocabulary: dict[str, int], at_once: int):
    """``(doc_ids, ids, sizes)`` of the documents of ``CHUNKS`` rows, about
    ``at_once`` words at a time: their words' ids in the vocabulary, those
    outside of it its length, one text after the other."""
    names = pa.array(sorted(vocabulary, key=vocabulary.__getitem__), pa.string())
    for batch in batches:
        for k in range(batch.num_rows):
            ids, sizes = (batch.column(x)[k].as_py() for x in ("ids", "sizes"))
            sizes = np.frombuffer(sizes, np.int32).astype(np.int64)
            known = _places_in(names, batch.column("words").slice(k, 1))
            ids = np.frombuffer(ids, _id_type(len(known)))
            doc_ids = batch.column("doc_ids")[k].as_py()
            ends = np.concatenate(([0], np.cumsum(sizes)))
            d = 0
            while d < len(sizes):
                to = max(d + 1, int(np.searchsorted(ends, ends[d] + at_once)))
                yield doc_ids[d:to], known[ids[ends[d]:ends[min(to, len(sizes))]]], sizes[d:to]
                d = to


def _word_documents(docs: DataFrame) -> DataFrame:
    """``(word, n)``: how many of all documents hold each word."""
    return _words_held(_word_chunks(docs))


def _counted(batches):
    """``(words, counts, documents)`` of ``CHUNKS`` rows together, until they
    have ``WORDS_COUNTED`` different words."""
    def merged(parts):
        words, counts = (pa.chunked_array(x) for x in zip(*parts, strict=True))
        out = pa.table({"word": words, "n": counts}).group_by("word", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        return out["word"].chunk(0), out["n_sum"].chunk(0)

    parts, pending, docs = [], 0, 0
    for batch in batches:
        for k, (n, held) in enumerate(zip(batch.column("n").to_pylist(), batch.column("held").to_pylist(), strict=True)):
            docs += n
            if held:
                parts.append((_words_in(batch.column("words").slice(k, 1)), pa.array(np.frombuffer(held, np.int32), pa.int64())))
                pending += len(parts[-1][0])
            if pending >= WORDS_COUNTED:
                parts, pending = [merged(parts)], 0
                if len(parts[0][0]) >= WORDS_COUNTED:
                    yield parts[0][0], parts[0][1].to_numpy(), docs
                    parts, docs = [], 0
    if parts:
        words, counts = merged(parts)
        yield words, counts.to_numpy(), docs


def _words_held(chunks: DataFrame, only: set[str] | None = None) -> DataFrame:
    """The same from ``CHUNKS`` rows; of the words ``only``, if they are given."""
    def rows(words, counts):
        return pa.RecordBatch.from_arrays([words, pa.array(counts, pa.int64())], ["word", "n"])

    def all_held(batches):
        for words, counts, _ in _counted(batches):
            yield rows(words, counts)

    def some_held(batches):
        names = shared.value
        number, counts = pa.array(names, pa.string()), np.zeros(len(names) + 1, np.int64)
        for batch in batches:
            for k, held in enumerate(batch.column(2).to_pylist()):
                at = _places_in(number, batch.column(1).slice(k, 1))
                if held:
                    counts[at] += np.frombuffer(held, np.int32)  # a row's words are different
        at = np.flatnonzero(counts[:-1])
        yield rows(number.take(pa.array(at)), counts[at])

    if only is not None:
        shared = chunks.sparkSession.sparkContext.broadcast(sorted(only))
    return chunks.select("n", "words", "held").mapInArrow(all_held if only is None else some_held, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def _least_documents(n: int) -> int:
    """Documents of ``n`` that a term which no item holds must be in."""
    return max(MIN_TERM_DOCS, -(-n * MIN_TERM_DOCS // PER_DOCS))


def _likely_terms(chunks: DataFrame, n: int) -> set[str]:
    """All words that ``_least_documents`` of the ``n`` documents hold, and few
    others. Only words that at least half that share of some documents counted
    together hold are handed on; elsewhere a word is taken to be in half that
    share, so what is collected are words of half of it at least."""
    def frequent(batches):
        for words, counts, docs in _counted(batches):
            at = np.flatnonzero(2 * PER_DOCS * counts >= MIN_TERM_DOCS * docs)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(at)),
                                              pa.array(2 * PER_DOCS * counts[at] - MIN_TERM_DOCS * docs, pa.int64())], ["word", "more"])

    words = chunks.select("n", "words", "held").mapInArrow(frequent, "word string, more long") \
        .groupBy("word").agg(F.sum("more").alias("more")) \
        .filter(F.col("more") + MIN_TERM_DOCS * n >= 2 * PER_DOCS * _least_documents(n))
    return {r[0] for r in words.select("word").collect()}


def _blocks(ids: np.ndarray, sizes: np.ndarray, none: int):
    """Texts of ``sizes`` words, their ids joined, cut into blocks of ``STRIDE``
    words: ``(padded, owner, nth, lead, alone)``. One row of ids per block,
    filled up with ``none``; the text a block is of and its number there; the
    blocks that begin a passage, and whether a passage is that block alone or
    the one behind it too."""
    full = np.flatnonzero(sizes)
    blocks = -(-sizes[full] // STRIDE)
    owner = np.repeat(full, blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    padded = np.full(len(owner) * STRIDE, none, ids.dtype)
    begin = (np.cumsum(blocks) - blocks) * STRIDE
    padded[np.repeat(begin - (np.cumsum(sizes[full]) - sizes[full]), sizes[full]) + np.arange(sizes.sum())] = ids
    # a passage is a block and the one behind it; a text of one block is one passage
    lead = np.flatnonzero((nth == 0) | (nth < np.repeat(blocks, blocks) - 1))
    return padded.reshape(-1, STRIDE), owner, nth, lead, np.repeat(blocks, blocks)[lead] == 1


class _Words:
    """The words of blocks for sums over them: how often each of the
    ``common`` terms stands in each block, as a matrix, and the other terms of
    a block before its places without one."""

    def __init__(self, padded: np.ndarray, common: np.ndarray, none: int):
        place = np.full(none + 1, -1, np.int32)
        place[common] = np.arange(len(common))
        at = place[padded]
        row, col = np.nonzero(at >= 0)
        self.common, self.none = common, none
        self.counts = np.bincount(row * len(common) + at[row, col], minlength=len(padded) * len(common)) \
            .astype(np.float32).reshape(len(padded), -1)
        self.rest = np.where(at >= 0, np.array(none, padded.dtype), padded)
        self.rest.sort(axis=1)              # ``none`` is the last id
        self.width = (self.rest != none).sum(axis=1)

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Per block the sum of its words' ``rows``."""
        out = self.counts @ rows[self.common]
        order = np.argsort(self.width, kind="stable")
        for k in range(0, len(order), 64):
            x = order[k:k + 64]
            if w := self.width[x[-1]]:
                out[x] += rows.take(self.rest[x, :w], axis=0, mode="clip").sum(axis=1)
        return out

    def add_by_term(self, out: np.ndarray, block_rows: np.ndarray) -> None:
        """Adds to each term's row of ``out`` the rows of the blocks it stands
        in, as often as it does; terms of one count together."""
        out[self.common] += self.counts.T @ block_rows
        block = np.repeat(np.arange(len(self.rest)), self.width)
        ids = self.rest[self.rest != self.none].astype(_id_type(self.none))
        order = np.argsort(ids, kind="stable")
        ids, block = ids[order], block[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))[:len(ids)]
        count = np.diff(first, append=len(ids))
        for n in np.unique(count).tolist():
            of = first[count == n]
            step = max(1, 2048 // n)
            for k in range(0, len(of), step):
                x = of[k:k + step]
                out[ids[x]] += block_rows.take(block[x[:, None] + np.arange(n)], axis=0, mode="clip").sum(axis=1)


def _common_terms(df: np.ndarray) -> np.ndarray:
    """The terms that most documents hold, at most ``COMMON``."""
    return np.sort(np.argsort(-df, kind="stable")[:COMMON])


def _passage_norms(padded: np.ndarray, lead: np.ndarray, alone: np.ndarray, idf: np.ndarray, none: int) -> np.ndarray:
    """Squared length of each passage's TF-IDF vector."""
    behind = padded[np.minimum(lead + 1, len(padded) - 1)]
    words = np.concatenate((padded[lead], np.where(alone[:, None], none, behind)), axis=1)
    words.sort(axis=1)
    new = np.ones(words.shape, bool)
    new[:, 1:] = words[:, 1:] != words[:, :-1]
    at = np.flatnonzero(new)
    tf = np.diff(at, append=words.size)
    return np.bincount(at // words.shape[1], (tf * idf[words.ravel()[at]]) ** 2, len(lead))


def _passages(ids: np.ndarray, sizes: np.ndarray, weighted: np.ndarray, idf: np.ndarray, common: np.ndarray,
              weight: float):
    """The passages of texts given as term ids, as unit TF-IDF vectors times a
    matrix of which ``weighted`` is ``idf`` times the rows: ``(blocks, words,
    rows, scale)``, the blocks as ``_blocks`` gives them; ``rows`` are not
    scaled yet, ``scale`` is ``weight`` over the squared lengths. The last rows
    of ``weighted`` and ``idf`` are for words outside the vocabulary, and zero."""
    none = len(idf) - 1
    blocks = padded, _, _, lead, alone = _blocks(ids, sizes, none)
    norm = _passage_norms(padded, lead, alone, idf, none)
    words = _Words(padded, common, none)
    sums = words.sums(weighted)
    rows = sums[lead]
    rows[~alone] += sums[lead[~alone] + 1]
    return blocks, words, rows, np.divide(weight, norm, out=np.zeros_like(norm), where=norm > 0)[:, None].astype(rows.dtype)


def _times_gram(out: np.ndarray, ids: np.ndarray, sizes: np.ndarray, weighted: np.ndarray, idf: np.ndarray,
                common: np.ndarray, weight: float = 1.0) -> None:
    """Adds to ``out``, which is to be multiplied by ``idf`` at the end, the sum
    over the passages a of ``weight`` a a^T basis."""
    if not sizes.sum():
        return
    (_, _, _, lead, alone), words, rows, scale = _passages(ids, sizes, weighted, idf, common, weight)
    rows *= scale
    # a block is in the passage it begins and in the one that the block before it begins
    by_block = np.zeros((len(words.rest), rows.shape[1]), rows.dtype)
    by_block[lead] = rows
    by_block[lead[~alone] + 1] += rows[~alone]
    words.add_by_term(out, by_block)


def _gram_within(out: np.ndarray, ids: np.ndarray, sizes: np.ndarray, weighted: np.ndarray, idf: np.ndarray,
                 common: np.ndarray, weight: float = 1.0) -> None:
    """Adds to ``out`` the sum over the passages a of ``weight`` (a^T basis)^T (a^T basis)."""
    if sizes.sum():
        _, _, rows, scale = _passages(ids, sizes, weighted, idf, common, weight)
        rows *= np.sqrt(scale)
        out += rows.T @ rows                # one matrix with itself: half the work


def _row_batches(acc: np.ndarray):
    """The rows of a task's sum that are not zero, with their numbers."""
    at = np.flatnonzero(acc.any(axis=1))
    for k in range(0, len(at), ROWS_AT_ONCE):
        yield pa.RecordBatch.from_arrays([pa.array(at[k:k + ROWS_AT_ONCE], pa.int64()), pa.array(
            [x.tobytes() for x in acc[at[k:k + ROWS_AT_ONCE]]], pa.binary())], ["term", "row"])


def _add_rows(out: np.ndarray, parts: DataFrame, dtype: type) -> np.ndarray:
    """Adds to ``out`` the tasks' rows ``(term, row)``, summed by Spark."""
    def total(batches):
        acc: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(row, dtype)
                if term in acc:
                    acc[term] += x
                else:
                    acc[term] = x.astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(list(acc), pa.int64()),
                                          pa.array([x.tobytes() for x in acc.values()], pa.binary())], ["term", "row"])

    for term, row in parts.repartition("term").mapInArrow(total, "term long, row binary").collect():
        out[term] += np.frombuffer(row)     # as many rows as ``out``, whatever the corpus
    return out


def _weighted(basis: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Terms' vectors for sums over words, with a row for words outside the vocabulary."""
    return np.vstack([basis * idf[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)


def _directions(chunks: DataFrame, items: list[list[int]], vocabulary: dict[str, int],
                idf: np.ndarray, common: np.ndarray, item_weight: float) -> np.ndarray:
    """Orthonormal terms x (RANK + OVERSAMPLE) directions of the passages of all
    documents and the items': the first pass of the decomposition."""
    sc = chunks.sparkSession.sparkContext
    weights, width = np.append(idf, 0.0), min(RANK + OVERSAMPLE, len(idf))
    rng = np.random.default_rng(SEED)
    weighted = _weighted(np.linalg.qr(rng.standard_normal((len(idf), width)))[0], idf)
    shared = sc.broadcast((vocabulary, weighted, weights, common))

    def partial(batches):
        v, basis, w, c = shared.value
        acc = np.zeros((len(w), width), np.float32)
        for _, ids, sizes in _texts_of(batches, v, WORDS_SUMMED):
            _times_gram(acc, ids, sizes, basis, w, c)
        yield from _row_batches(acc)

    out = np.zeros((len(weights), width))
    _times_gram(out, *_joined(items), weighted, weights, common, item_weight)
    _add_rows(out, chunks.select("doc_ids", "sizes", "words", "ids").mapInArrow(partial, "term long, row binary"), np.float32)
    shared.destroy()
    return np.linalg.qr(out[:-1] * idf[:, None])[0]


def _joined(items: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([w for x in items for w in x], np.int32), np.array([len(x) for x in items])


def _leading(index: Index, parts: DataFrame) -> np.ndarray:
    """(RANK + OVERSAMPLE) x RANK: the leading right singular vectors among the
    directions, from the tasks' rows of the passages' products with them."""
    width = index.term_vectors.shape[1]
    gram = np.zeros((width, width))
    _gram_within(gram, *_joined([x for _, x in index.items]), index.term_vectors, index.weights, index.common, index.item_weight)
    gram = _add_rows(gram, parts, np.float64)             # (A directions)^T (A directions)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return vectors[:, np.argsort(-values)[:RANK]]


class Index:
    """What the workers need to search: vocabulary, latent term vectors and
    the items' passages."""

    def __init__(self, vocabulary, term_vectors, items, vectors, df, idf=(), item_weight=1.0):
        self.vocabulary, self.term_vectors = vocabulary, term_vectors
        self.items, self.vectors = items, vectors     # [(item_id, word ids)], unit rows
        self.weights, self.item_weight = np.append(idf, 0.0), item_weight
        self.common = _common_terms(df)
        self.first, self.held_by, self.places, self.often, self.least = _item_words([x for _, x in items], self.common, len(df))
        self.bit = np.zeros(len(df) + 1, np.uint64)          # a common word's bit
        self.bit[self.common] = np.uint64(1) << np.arange(len(self.common), dtype=np.uint64)
        self.common_bits = np.bitwise_or.reduce(np.where(self.often > 0, self.bit[self.common], np.uint64(0)), axis=1)
        self.repeated = (self.often - (self.often > 0)).sum(axis=1, dtype=np.int16)
        self.kinds = [frozenset(x) for _, x in items]
        self.kind, self.kind_bits = _kind_bits(self.kinds, len(df))
        self.kinds_needed = np.array([len(k) - (1 - LIKELY) * len(x) for k, (_, x) in zip(self.kinds, items, strict=True)])
        self.masks = [(_masks(x), _masks(_tail(x))) for _, x in items]
        # units that a stretch of words to be confirmed can touch
        self.units = np.array([-(-(_stretch(len(x)) - 1) // UNIT) + 1 for _, x in items])


def _item_words(items: list[list[int]], common: np.ndarray, terms: int):
    """Inverted index of the items' words that are not ``common``: where a
    word's entries begin, the items they name, how many places of the item the
    word takes. Items x common words: the places these take. Per item the
    places that a leak must hold: a confirmed stretch lacks at most ``m -
    ceil(LIKELY * m)`` of an item's m places, none of a short item's."""
    rows, often, least = [], np.zeros((len(items), len(common)), np.int16), []
    at = {w: k for k, w in enumerate(common.tolist())}
    for q, item in enumerate(items):
        least.append(math.ceil(LIKELY * len(item)) if len(item) >= SHORTEST_ITEM else len(item))
        for w, n in Counter(item).items():
            if w in at:
                often[q, at[w]] = n
            else:
                rows.append((w, q, n))
    rows = np.array(sorted(rows), np.int64).reshape(-1, 3)
    # one more word, outside the vocabulary, that no item holds
    first = np.searchsorted(rows[:, 0], np.arange(terms + 2))
    return first, rows[:, 1], rows[:, 2].astype(np.float32), often, np.array(least, np.int16)


def _kind_bits(kinds: list[frozenset], terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Each term's number among the items' different words, one number for all
    others, and the items' words as bits."""
    words = sorted(frozenset().union(*kinds))
    kind = np.full(terms + 1, len(words), np.int32)
    kind[words] = np.arange(len(words))
    bits = np.zeros((len(kinds), (len(words) // 64 + 1) * 64), bool)
    for row, x in zip(bits, kinds, strict=True):
        row[kind[list(x)]] = True
    return kind, np.packbits(bits, axis=1).view(np.uint64)


def _first_index(docs: DataFrame, items: list[tuple[int, list[str]]], counts: DataFrame, chunks: DataFrame) -> tuple[Index, np.ndarray]:
    """The index whose vectors are places among the directions, and these."""
    passages = [(i, w[a:b]) for i, w in items for a, b in _item_passages(len(w))]
    own = {w for _, p in passages for w in p}
    n = docs.count()
    least = _least_documents(n)
    asked = docs.sparkSession.createDataFrame([(w,) for w in sorted(own)], "word string").withColumn("own", F.lit(True))
    held = dict(counts.join(F.broadcast(asked), "word", "left").filter((F.col("n") >= least) | F.col("own"))
                .select("word", "n").collect())       # bounded by the items' words and PER_DOCS / MIN_TERM_DOCS
    names = sorted(own | held.keys())
    vocabulary = {w: k for k, w in enumerate(names)}
    df = np.array([held.get(w, 0) for w in names], np.int64)
    idf = np.log((n + 1.0) / (df + 1.0)) + 1e-3
    ids = [[vocabulary[w] for w in p] for _, p in passages]
    item_weight = ITEM_WEIGHT ** 2 * max(1.0, n / PER_DOCS)
    directions = _directions(chunks, ids, vocabulary, idf, _common_terms(df), item_weight)
    return Index(vocabulary, _weighted(directions, idf), [(i, x) for (i, _), x in zip(passages, ids, strict=True)],
                 None, df, idf, item_weight), directions


def _turned(index: Index, directions: np.ndarray, leading: np.ndarray) -> None:
    """The index whose vectors are places in the latent space."""
    basis = (directions @ leading).astype(np.float32)
    index.term_vectors = _weighted(basis, index.weights[:-1].astype(np.float32))
    vectors = np.stack([index.term_vectors[x].sum(axis=0) for _, x in index.items])
    index.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _last_pass(index: Index, directions: np.ndarray, chunks: DataFrame) -> None:
    """Completes the decomposition of the ``_first_index``."""
    shared = chunks.sparkSession.sparkContext.broadcast(index)

    def partial(batches):
        ix = shared.value
        gram = np.zeros((ix.term_vectors.shape[1],) * 2)
        for _, ids, sizes in _texts_of(batches, ix.vocabulary, WORDS_SUMMED):
            _gram_within(gram, ids, sizes, ix.term_vectors, ix.weights, ix.common)
        yield from _row_batches(gram)

    parts = chunks.select("doc_ids", "sizes", "words", "ids").mapInArrow(partial, "term long, row binary")
    _turned(index, directions, _leading(index, parts))
    shared.destroy()


def build_index(docs: DataFrame, items: list[tuple[int, list[str]]], counts: DataFrame,
                chunks: DataFrame | None = None) -> Index:
    """The index, without a search. ``counts``: ``_word_documents`` of the
    documents, at least for the items' words and ``_likely_terms``; ``chunks``:
    their ``_word_chunks``, if they are written already."""
    chunks = written(_word_chunks(docs), "word-chunks") if chunks is None else chunks
    index, directions = _first_index(docs, items, counts, chunks)
    _last_pass(index, directions, chunks)
    return index


def _item_passages(n: int) -> list[tuple[int, int]]:
    """An item longer than a passage is searched passage by passage."""
    if n < SHORTEST_SEQUENCE:
        return []
    if n <= WINDOW:
        return [(0, n)]
    return [(a, a + WINDOW) for a in [*range(0, n - WINDOW, STRIDE), n - WINDOW]]


# ---- confirmation -----------------------------------------------------------

def _masks(item: list[int]) -> dict[int, int]:
    """For each word of an item, the bits of its places."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def _subsequence(masks: dict[int, int], size: int, words) -> int:
    full = (1 << size) - 1
    s = full
    for m in filter(None, map(masks.get, words)):
        u = s & m
        s = ((s + u) | (s - u)) & full
    return size - s.bit_count()


def common_subsequence(item: list[int], words) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    return _subsequence(_masks(item), len(item), words)


def _stretch(m: int) -> int:
    """Words of the stretches compared with an item of ``m`` words."""
    return m + max(4, m // 4) if m >= SHORTEST_ITEM else m


def _tail(item: list[int]) -> list[int]:
    """The last words of an item, where it has its answer."""
    return item[-min(ANSWER_WORDS, max(1, len(item) // 2)):]


def confirm(item: list[int], words: list[int], first: int, last: int,
            kinds: frozenset | None = None, masks: tuple[dict, dict] | None = None) -> tuple[float, float, int, int] | None:
    """The best stretch of ``words[first:last]`` against an item: overlap,
    answer overlap and its place; None if it is no leak. ``kinds`` may give
    the item's different words, ``masks`` the masks of it and of its tail."""
    m = len(item)
    if m < SHORTEST_ITEM:
        return next(((1.0, 1.0, a, a + m - 1) for a in range(first, last - m + 1)
                     if words[a] == item[0] and words[a:a + m] == item), None)
    kinds = frozenset(item) if kinds is None else kinds
    # a stretch cannot share more of the item than the whole range does
    there = kinds.intersection(words[first:last])
    if len(kinds) - len(there) > (1 - LIKELY) * m:
        return None
    masks, tail_masks = masks or (_masks(item), _masks(_tail(item)))
    if _subsequence(masks, m, words[first:last]) < LIKELY * m:
        return None
    span, tail = _stretch(m), min(ANSWER_WORDS, max(1, m // 2))
    best = None
    step = max(1, span // 4)
    for a in range(first, max(first + 1, last - span + step), step):
        part = words[a:min(a + span, last)]
        overlap = _subsequence(masks, m, part) / m
        if overlap < LIKELY or (best and overlap <= best[0]):
            continue
        answer = _subsequence(tail_masks, tail, part) / tail
        if overlap >= SURE or answer >= ANSWER:
            best = (overlap, answer, a, a + len(part) - 1)
    return best


def _places_held(index: Index, units: np.ndarray) -> np.ndarray:
    """Units x items: how many places of each item the different words of the
    units take that a stretch beginning in the unit can touch, without the
    common words."""
    words = np.sort(units, axis=1)
    new = np.ones(words.shape, bool)
    new[:, 1:] = words[:, 1:] != words[:, :-1]
    row, col = np.nonzero(np.where(new, (index.first[1:] - index.first[:-1])[words], 0))
    word = words[row, col]
    order = np.argsort(word, kind="stable")
    row, word = row[order], word[order]
    # a word counts where the unit before that has it lies outside
    after = np.zeros(len(row), np.int64)
    after[1:] = np.where(word[1:] == word[:-1], row[:-1] + 1, 0)
    n, begin = (index.first[1:] - index.first[:-1])[word], index.first[word]
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    item, row = index.held_by[at], np.repeat(row, n)
    first = np.maximum(np.repeat(after, n), row - index.units[item] + 1)
    size = (len(units) + 1) * len(index.items)
    places = index.places[at]
    change = np.bincount(np.concatenate((first, row + 1)) * len(index.items) + np.concatenate((item, item)),
                         np.concatenate((places, -places)), size)
    return np.cumsum(change.astype(np.int16).reshape(len(units) + 1, -1), axis=0, dtype=np.int16)


def _holding(index: Index, padded: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``(block, item)`` of the blocks ``low`` to ``high`` and the items of whose
    places a stretch that begins in the block can hold enough. Words of the next
    document behind the block's count too, so none is missed."""
    per = STRIDE // UNIT
    longest = int(index.units.max())
    units = padded[low:high + -(-longest // per)].reshape(-1, UNIT)
    begins = (high - low) * per
    places = _places_held(index, units)[:begins]
    there = np.zeros(begins + longest, np.uint64)            # the common words of each unit
    there[:len(units)] = np.bitwise_or.reduce(index.bit[units], axis=1)[:len(there)]
    most = index.least - index.often.sum(axis=1, dtype=np.int16)
    out = [np.empty(0, np.int64)]
    seen = np.empty((longest, begins), np.uint64)            # and of the units from each one on
    for n in range(longest):
        np.bitwise_or(seen[n - 1] if n else 0, there[n:n + begins], out=seen[n])
    # with the common words that are there, each once
    row, col = np.divmod(np.flatnonzero(places >= most), len(index.items))
    for k in range(0, len(row), 1 << 16):
        r, c = row[k:k + (1 << 16)], col[k:k + (1 << 16)]
        own, bits = places[r, c], seen[index.units[c] - 1, r]
        some = np.flatnonzero(own + np.bitwise_count(bits & index.common_bits[c]) >= index.least[c] - index.repeated[c])
        r, c, own = r[some], c[some], own[some]
        bits = np.unpackbits(bits[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :index.often.shape[1]]
        good = own + np.einsum("ij,ij->i", bits, index.often[c]) >= index.least[c]
        out.append((low + r[good] // per) * len(index.items) + c[good])
    return np.divmod(np.unique(np.concatenate(out)), len(index.items))


def _near_or_holding(index: Index, padded: np.ndarray, owner: np.ndarray, lead: np.ndarray, vectors: np.ndarray):
    """``(first passage, passages, items' passages, cosines)`` of the candidates
    among ``PASSAGES_AT_ONCE`` passages, which are near the item in the latent
    space or hold enough of its words for a confirmation. ``vectors`` are the
    passages' places there, of length 1."""
    begins = np.full(len(owner), -1)                             # the passage that a block begins
    begins[lead] = np.arange(len(lead))
    for a in range(0, len(lead), PASSAGES_AT_ONCE):
        at = lead[a:a + PASSAGES_AT_ONCE]
        cosine = vectors[a:a + PASSAGES_AT_ONCE] @ index.vectors.T
        # confirm looks at a passage, two blocks, and up to one block on either side
        block, item = _holding(index, padded, max(0, int(at[0]) - 1), min(len(owner), int(at[-1]) + 3))
        pairs = [a * len(index.items) + np.flatnonzero(cosine >= MIN_COSINE)]
        for step in (-1, 0, 1, 2):
            inside = (block >= step) & (block - step < len(owner))
            first, q = block[inside] - step, item[inside]
            p = begins[first]
            good = (p >= a) & (p < a + len(at)) & (owner[first] == owner[block[inside]])
            pairs.append(p[good] * len(index.items) + q[good])
        p, q = np.divmod(np.unique(np.concatenate(pairs)), len(index.items))
        yield a, p, q, cosine[p - a, q]


def _candidates(index: Index, padded: np.ndarray, owner: np.ndarray, lead: np.ndarray, vectors: np.ndarray):
    """``(passage, item's passage, cosine)`` of the candidates."""
    for _, p, q, cosine in _near_or_holding(index, padded, owner, lead, vectors):
        yield from zip(p.tolist(), q.tolist(), cosine.tolist(), strict=True)


def _enough_kinds(index: Index, padded: np.ndarray, owner: np.ndarray, lead: np.ndarray, a: int,
                  p: np.ndarray, q: np.ndarray, cosine: np.ndarray) -> list[np.ndarray]:
    """The candidates that pass the first test of ``confirm``, on no fewer words
    than it looks at: a passage's two blocks and one on either side."""
    at = lead[a:a + PASSAGES_AT_ONCE]
    low, high = max(0, int(at[0]) - 1), min(len(owner), int(at[-1]) + 3)
    there = np.zeros((high - low, index.kind_bits.shape[1] * 64), bool)
    there[np.arange(high - low)[:, None], index.kind[padded[low:high]]] = True
    there = np.packbits(there, axis=1).view(np.uint64)
    around = there[at - low]
    for step in (-1, 1, 2):
        k = np.flatnonzero((at + step >= low) & (at + step < high))
        k = k[owner[at[k] + step] == owner[at[k]]]
        around[k] |= there[at[k] + step - low]
    good = [np.empty(0, np.int64)]
    for k in range(0, len(p), 1 << 14):
        x, y = p[k:k + (1 << 14)] - a, q[k:k + (1 << 14)]
        held = np.bitwise_count(around[x] & index.kind_bits[y]).sum(axis=1, dtype=np.int64)
        good.append(k + np.flatnonzero(index.kinds_needed[y] <= held))
    good = np.concatenate(good)
    return [p[good], q[good], cosine[good]]


def search_texts(index: Index, flat: np.ndarray, sizes: np.ndarray) -> list[list[tuple]]:
    """Leaks of each of the texts of ``sizes`` words, their words' ids joined:
    ``(item_id, cosine, overlap, answer overlap, first word, last word)``, the
    best per item."""
    none = len(index.term_vectors) - 1
    out: list[list[tuple]] = [[] for _ in sizes]
    if not sizes.sum():
        return out
    padded, owner, nth, lead, alone = _blocks(flat, sizes, none)
    sums = _Words(padded, index.common, none).sums(index.term_vectors)
    vectors = sums[lead]
    vectors[~alone] += sums[lead[~alone] + 1]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    begin = np.cumsum(sizes) - sizes
    hits: dict[tuple[int, int], tuple] = {}
    ids: dict[int, list[int]] = {}
    place = None
    for a, *pairs in _near_or_holding(index, padded, owner, lead, vectors):
        for p, q, cosine in zip(*(x.tolist() for x in _enough_kinds(index, padded, owner, lead, a, *pairs)), strict=True):
            if p != place:                                       # they come passage by passage
                place, d, at = p, int(owner[lead[p]]), int(nth[lead[p]]) * STRIDE
                if d not in ids:
                    ids[d] = flat[begin[d]:begin[d] + sizes[d]].tolist()
            item, words = index.items[q]
            extra = len(words) // 2
            found = confirm(words, ids[d], max(0, at - extra), min(len(ids[d]), at + WINDOW + extra), index.kinds[q], index.masks[q])
            if found and found[0] > hits.get((d, item), (0.0, -1.0))[1]:
                hits[d, item] = (cosine, *found)
    for (d, item), found in sorted(hits.items()):
        out[d].append((item, *found))
    return out


# ---- Spark jobs ------------------------------------------------------------

def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it (``LEAKS``)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    out = spark.createDataFrame([], LEAKS)
    # the query set, in blocks of ITEMS_AT_ONCE
    bench = benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null")
    blocks = max(1, -(-bench.count() // ITEMS_AT_ONCE))
    chunks = likely = None
    for b in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        items = [(r[0], words_of(r[1])) for r in rows]
        if not any(_item_passages(len(w)) for _, w in items):
            continue
        if chunks is None:
            chunks = written(_word_chunks(texts), "word-chunks")
            likely = _likely_terms(chunks, texts.count())
        counts = _words_held(chunks, likely | {w for _, x in items for w in x})
        index, directions = _first_index(texts, items, counts, chunks)     # bounded by ITEMS_AT_ONCE and the terms
        _last_pass(index, directions, chunks)
        shared = spark.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            ix = shared.value
            for doc_ids, ids, sizes in _texts_of(batches, ix.vocabulary, WORDS_AT_ONCE):
                rows = [(d, *x) for d, f in zip(doc_ids, search_texts(ix, ids, sizes), strict=True) for x in f]
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(_LEAKS.names, r, strict=True)) for r in rows], _LEAKS)

        out = out.unionByName(written(chunks.select("doc_ids", "sizes", "words", "ids").mapInArrow(search, LEAKS), "found-leaks"))
        shared.destroy()
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found."""
    leaked = written(find_leaks(docs, benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)
