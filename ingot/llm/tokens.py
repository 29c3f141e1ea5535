"""Whole-text encoding with a public tokenizer file.

A text is cut at places where the tokenizer's own pre-tokenizer always cuts and
the pieces' ids are joined: by whole stretches for a byte-level vocabulary, each
distinct word once per Python worker for a word-level one. The result equals
encoding the whole text (tests/llm/test_tokens_files.py). A text in
which a safe cut cannot be told is encoded whole."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import groupby

CACHE_PIECES = 400_000       # pieces remembered by a worker before it starts anew
BYTE_LEVEL, WORD_LEVEL = "byte", "word"
# a white-space run longer than one character beside a space: the run's cut depends on what follows
_UNSAFE = re.compile("[ ]\\s|\\s[ ]|\u180e|<\\|")
# Python splits at these, the tokenizers do not
_NOT_SPACE = re.compile("[\x1c-\x1f\u180e]|<\\|")
# A piece of these characters alone is cut here as the tokenizer files' own
# patterns cut it (their letters and digits are Unicode's; these are the ones
# below U+0100), and the library's model gets the words. All else takes the
# library's whole way.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", " \n\t\r"
_PLAIN = re.compile(f"[{_S}!-~\xa1-\xac\xae-\xff]*")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORDS = re.compile(f"{_CONTRACTIONS}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
# fixed value: the pattern that cuts a text into words before the byte-level merges
_BYTE_PATTERN = rf"{_CONTRACTIONS}| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+"
# byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _SHOWN} | \
    {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}
_PER_WORKER: dict = {}


def _ranked(vocabulary: dict[str, int]):
    """A byte-level vocabulary as an encoder by ranks: its ids are in merge
    order, so they are the ranks. Four times as fast on plain words, with
    equal ids (tests/llm/test_tokens_files.py)."""
    from tiktoken import Encoding
    byte_of = {c: b for b, c in _BYTE_CHARS.items()}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocabulary.items() if all(c in byte_of for c in t)}
    return Encoding("byte-level", pat_str=_BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


class PieceEncoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit bytes.

    kind ``byte``: byte-level BPE; a cut before a single space between two
    other characters is safe. Plain texts, and the stretches of plain pieces of
    others, are encoded at once; nothing is remembered. kind ``word``: white
    space is dropped, so every white-space run is a safe cut, and a piece is
    encoded once."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.kind = kind
        self.cache: dict[str, bytes] = {}
        if kind == BYTE_LEVEL:
            self.ordinary = _ranked(self.tok.get_vocab(with_added_tokens=False)).encode_ordinary

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, missing: set[str]) -> None:
        cache = self.cache
        odd = []
        for p in missing:
            if not _PLAIN.fullmatch(p):
                odd.append(p)
                continue
            out = []
            for w in _WORDS.findall(p.lower()):
                ids = cache.get(w)
                if ids is None:
                    shown = w.encode().decode("latin-1").translate(_BYTE_CHARS)
                    cache[w] = ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
                out.append(ids)
            cache[p] = b"".join(out)
        for p, e in zip(odd, self.tok.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            cache[p] = array("I", e.ids).tobytes()

    def _by_words(self, text: str) -> bytes:
        if _NOT_SPACE.search(text):
            return self._whole(text)
        pieces = text.split()
        known = list(map(self.cache.get, pieces))
        if None in known:
            missing = {p for p, ids in zip(pieces, known, strict=True) if ids is None}
            if len(self.cache) > CACHE_PIECES:
                self.cache.clear()
                missing = set(pieces)
            self._learn(missing)
            known = map(self.cache.__getitem__, pieces)
        return b"".join(known)

    def _by_bytes(self, text: str) -> bytes:
        if "<|" in text:
            return self._whole(text)
        if _PLAIN.fullmatch(text):
            return array("I", self.ordinary(text)).tobytes()
        if _UNSAFE.search(text):
            return self._whole(text)
        parts = text.split(" ")
        ids = array("I")
        for plain, run in groupby([parts[0], *[" " + p for p in parts[1:]]], lambda p: bool(_PLAIN.fullmatch(p))):
            run = "".join(run)
            ids.extend(self.ordinary(run) if plain else self.tok.encode(run, add_special_tokens=False).ids)
        return ids.tobytes()

    def encode_batch(self, texts) -> Iterator[bytes]:
        """Ids of each text; a null text has none."""
        encode = self._by_words if self.kind == WORD_LEVEL else self._by_bytes
        for t in texts:
            yield encode(t) if t else b""


def worker_encoder(path: str, kind: str) -> PieceEncoder:
    """The encoder of this Python worker; its cache lives across tasks."""
    if (path, kind) not in _PER_WORKER:
        _PER_WORKER[path, kind] = PieceEncoder(path, kind)
    return _PER_WORKER[path, kind]


def forget() -> None:
    """Drop this worker's encoders and what they remember, when another
    operator takes the worker over."""
    _PER_WORKER.clear()
