"""Whole-text token ids of a public tokenizer, with a bounded per-worker cache of text pieces.

The byte-level vocabulary never joins a space to what stands before it, so a
single space between two non-space characters is always a token boundary:
the ids of a text are the ids of the pieces cut there. Pieces repeat, so a
worker keeps their ids; a full cache drops its younger half (frequent pieces
were met first).

``encode_all`` takes many texts at once. Arrow cuts them and numbers the distinct
pieces, so a piece is looked up once, however often it occurs, and a word that
differs from another by the marks after it is merged once. A line feed between two
non-space characters is a boundary, too.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Marks that the split pattern cuts off the letters before them.
_ENDS = frozenset(".,;:!?")
#: Latin letters, and marks of which the split pattern takes a run after them as one pre-token.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
_MARKS = ".,;:!?#*$%&"
#: Pieces whose ids a worker keeps at most.
CACHE_ENTRIES = 500_000
#: Bytes of text from which on batches are encoded together.
POOL_BYTES = 2 * 1024 * 1024


class _Irregular(Exception):
    """A piece that begins or ends with white space: its neighbours decide its tokens."""


def _byte_alphabet() -> dict[int, str]:
    """Byte -> character of byte-level vocabularies: visible Latin-1 stands for itself, the rest follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Bounded(dict):
    """At most ``CACHE_ENTRIES`` entries."""

    def keep(self, key: str, ids: bytes) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            for young in list(self)[CACHE_ENTRIES // 2:]:
                del self[young]
        self[key] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class _Words(_Bounded):
    """Ids of the model for one pre-token (already cut by the split pattern)."""

    def __init__(self, model):
        super().__init__()
        self.model, self.alphabet = model, _byte_alphabet()

    def ids(self, word: str) -> bytes:
        mapped = word.encode().decode("latin-1").translate(self.alphabet)
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def letters(self, word: str) -> bytes:
        """``ids`` of A-Z letters, perhaps after one space: only the space is spelled otherwise."""
        mapped = self.alphabet[0x20] + word[1:] if word[0] == " " else word
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def __missing__(self, word: str) -> bytes:
        return self.keep(word, self.ids(word))


class _Pieces(_Bounded):
    """Ids of a piece, with the space before it when ``lead`` is a space."""

    def __init__(self, encoder: "TextEncoder", lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace() or (self.lead and piece[0].isspace()):
            raise _Irregular
        words = self.encoder.words
        if piece.isascii() or max(piece) < "ɐ":  # Latin letters: the split pattern takes a run of them as one pre-token
            if piece.isalpha():
                return self.keep(piece, (words.letters if piece.isascii() else words.ids)(self.lead + piece))
            if piece[:-1].isalpha() and piece[-1] in _ENDS:  # most words stand in the text without the mark as well
                return self.keep(piece, self[piece[:-1]] + words[piece[-1]])
        return self.keep(piece, self.encoder.plain(self.lead + piece))


class TextEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.words = _Words(self.tokenizer.model)
        self.first, self.rest = _Pieces(self, ""), _Pieces(self, " ")

    def plain(self, piece: str) -> bytes:
        if (piece.isascii() or max(piece) < "ɐ") and "<|" not in piece:
            words = self.find(piece)
            if len(words) == 1:  # the caller keeps the piece: no second entry
                return self.words.ids(piece)
            return b"".join(map(self.words.__getitem__, words))
        return _packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        head, *rest = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.rest.__getitem__, rest))
        except _Irregular:
            head, *rest = _CUT.split(text)
            return self.plain(head) + b"".join([self.plain(" " + p) for p in rest])

    def _rest_ids(self, pieces: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of pieces with a space before them, or a line feed that is theirs; which are irregular (no ids)."""
        ids = [*map(self.rest.get, pieces := pieces.to_numpy(zero_copy_only=False))]
        irregular = np.zeros(len(ids), bool)
        for i in [i for i, known in enumerate(ids) if known is None]:
            piece = pieces[i]
            try:
                if piece[:1] == "\n" and not piece[1:2].isspace():
                    ids[i] = self.words["\n"] + self.first[piece[1:]]
                else:
                    ids[i] = self.rest[piece]
            except _Irregular:
                ids[i], irregular[i] = b"", True
        return ids, irregular

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (unsigned 32-bit), and where those of each text begin, with the end of the last."""
        texts = texts.fill_null("")
        lines = pc.replace_substring(pc.replace_substring(texts, "\n", " \n"), " \n \n", "\n\n")  # two in a row stay within a piece
        lists = pc.split_pattern(lines, " ")
        at = lists.offsets.to_numpy()  # every text has a piece, if only an empty one
        numbered = lists.flatten().dictionary_encode()
        pieces, codes, n = numbered.dictionary, numbered.indices.to_numpy().copy(), len(numbered.dictionary)

        marks = pc.utf8_ltrim(pieces, characters=_LETTERS)
        marked = pc.and_(pc.equal(pc.ascii_rtrim(marks, characters=_MARKS), ""), pc.not_equal(marks, pieces))
        words = pc.if_else(marked, pc.ascii_rtrim(pieces, characters=_MARKS), pieces).dictionary_encode()
        marks = pc.if_else(marked, marks, "").dictionary_encode()
        word_ids, irregular = self._rest_ids(words.dictionary)
        mark_ids = [self.words[m] if m else b"" for m in marks.dictionary.to_pylist()]
        ids = pc.binary_join_element_wise(pa.array(word_ids, pa.large_binary()).take(words.indices),
                                          pa.array(mark_ids, pa.large_binary()).take(marks.indices), pa.scalar(b"", pa.large_binary()))
        irregular = irregular[words.indices.to_numpy()]

        heads = []  # a text's first piece has no space before it
        for row, piece in enumerate(pieces.take(pa.array(codes[at[:-1]])).to_pylist()):
            codes[at[row]] = n + row
            try:
                heads.append(self.first[piece])
            except _Irregular:
                heads.append(None)
        odd = np.concatenate([irregular, [h is None for h in heads]]).astype(bool)
        for row in np.unique(np.searchsorted(at, np.flatnonzero(odd[codes]), "right") - 1):
            heads[row] = self.encode(texts[row].as_py())  # the whole text in its first piece's place
            codes[at[row] + 1:at[row + 1]] = len(odd)
        taken = pa.concat_arrays([ids, pa.array([*heads, b""], pa.large_binary())]).take(pa.array(codes))
        _, ends, values = taken.buffers()
        ends = np.frombuffer(ends, np.int64, len(codes) + 1) // 4
        return np.frombuffer(values or b"", "<u4", ends[-1]), ends[at]


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder of a vocabulary file (kept between the tasks of a worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def release() -> None:
    """Free the worker's encoders: a step without texts need not hold their vocabulary and caches."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()  # an encoder and its caches refer to each other


def pooled(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[list[pa.RecordBatch]]:
    """Batches, so many at once that their texts reach ``POOL_BYTES``."""
    pool, size = [], 0
    for b in batches:
        pool.append(b)
        size += b.column(column).nbytes
        if size >= POOL_BYTES:
            yield pool
            pool, size = [], 0
    if pool:
        yield pool


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
