"""Operator 13: token counts of whole texts, merging only what is not a token by itself.

1. Proof, once for a vocabulary and before any text is read: each of its
   strings runs alone through the merges; those that come out as one token are
   *whole*. The proof has at most one entry for each vocabulary string, so
   broadcasting it is bounded by the vocabulary.
2. Counting, one pass without a shuffle: a text is cut at single spaces, where
   these vocabularies never join tokens. The library's own splitter turns a
   piece into pre-tokens; a whole one counts 1, only the rest is merged. A worker
   remembers the counts of short pieces in a bounded table.

Kinds of vocabulary: ``.json`` of the tokenizers library (byte level with the
space before a word, or lower-cased words with white space dropped), ``.model`` of
sentencepiece whose pieces hold the space mark at their start only. Any other goes
through the library text by text, with the same results.

Defined results: NULL or empty text: 0 bytes, 0 tokens. NULL doc_id and repeated
rows: counted like any other. Special strings inside a text: as the library's
default has them. Very long texts: counted whole; pieces beyond ``MEMO_CHARS``
are not remembered. Empty table: empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import id_text, map_batches, query, table
from listingmart.llm.encoding import _byte_alphabet

#: Tokens beyond which ``over_limit`` is set.
LIMIT = 512
#: Pieces (and pre-tokens) whose counts a worker remembers at most, and their longest.
MEMO_PIECES, MEMO_CHARS = 400_000, 64
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"


class _Json:
    """A ``.json`` vocabulary: how texts are cut, and the tokens of one pre-token."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.strings = spec["model"]["vocab"]
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        before, normalizer = spec["pre_tokenizer"] or {}, spec["normalizer"]
        parts = [p["type"] for p in before.get("pretokenizers", ())]
        rules = [n["type"] for n in (normalizer or {}).get("normalizers", ())]
        leads = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and normalizer is None
        drops = (parts == ["Split", "ByteLevel"] and before["pretokenizers"][0]["behavior"] == "Removed"
                 and r"\s" not in before["pretokenizers"][0]["pattern"].get("Regex", r"\s").replace(r"[^\s", "")
                 and set(rules) <= {"NFC", "Lowercase", "Replace"})
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
        self.cuts, self.lead = (leads or drops) and plain and spec["model"]["type"] == "BPE", " " if leads else ""
        self.find = regex.compile(public_tokenizers.PATTERN).findall if leads else None
        self.alphabet = _byte_alphabet()

    def whole(self):
        """Vocabulary strings (as pre-tokens) that the merges turn into exactly one token."""
        merge = self.tokenizer.model.tokenize
        return {s for v in self.strings if (s := v.removesuffix(self.suffix)) and len(merge(s)) == 1}

    def library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def split(self, text: str) -> list[str]:
        """The library's pre-tokens of a piece, as the vocabulary spells them."""
        t = self.tokenizer
        if t.normalizer is not None:
            text = t.normalizer.normalize_str(text)
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(text)]

    def spelled(self, pre_token: str) -> str:
        return pre_token.encode().decode("latin-1").translate(self.alphabet)

    def merged(self, spelled: str) -> int:
        return len(self.tokenizer.model.tokenize(spelled))


class _Model:
    """A ``.model`` vocabulary: pre-tokens are the words between spaces, the mark before each."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.processor = p = SentencePieceProcessor(model_file=path)
        self.strings = [p.id_to_piece(i) for i in range(p.get_piece_size())
                        if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        # a space between characters that survive unchanged, and no token that runs over it
        same = p.normalize("a  b ") == f"{_MARK}a{_MARK}{_MARK}b{_MARK}"
        self.cuts, self.lead = same and not any(_MARK in s.lstrip(_MARK) for s in self.strings), ""
        self.special, self.find = [], None

    def whole(self):
        return {s[1:] for s in self.strings if s[0] == _MARK and len(s) > 1 and _MARK not in s[1:] and self.library(s[1:]) == 1}

    def library(self, text: str) -> int:
        return len(self.processor.encode(text))

    def split(self, text: str) -> list[str]:
        return [text]

    merged = library


@cache
def _kind(path: str):
    return (_Model if path.endswith(".model") else _Json)(path)


def prove_whole(path: str) -> frozenset[str]:
    """The pre-tokens of the vocabulary file that are one token each."""
    return frozenset(_kind(path).whole())


class _Memo(dict):
    """At most ``MEMO_PIECES`` counts; frequent strings were met first, so the younger half goes."""

    def keep(self, key: str, n: int) -> int:
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                for young in list(self)[MEMO_PIECES // 2:]:
                    del self[young]
            self[key] = n
        return n


class _Merged(_Memo):
    """Tokens of a pre-token, given as it stands in the text, that is not whole."""

    def __init__(self, kind, whole):
        super().__init__()
        self.kind, self.whole = kind, whole

    def __missing__(self, pre_token: str) -> int:
        spelled = self.kind.spelled(pre_token)
        return self.keep(pre_token, 1 if spelled in self.whole else self.kind.merged(spelled))


class _Irregular(Exception):
    """White space at an end of a piece: its neighbours decide its tokens."""


class _Pieces(_Memo):
    """Tokens of a piece, counted with ``lead`` before it."""

    def __init__(self, kind, lead: str, merged: _Merged):
        super().__init__()
        self.kind, self.lead, self.merged = kind, lead, merged

    def count(self, piece: str) -> int:
        if not piece:
            return 0
        kind, text = self.kind, self.lead + piece
        if kind.find and (text.isascii() or max(text) < "ɐ"):  # Latin letters: every release of Unicode classes them alike
            return sum(map(self.merged.__getitem__, kind.find(text)))
        return sum([1 if p in self.merged.whole else kind.merged(p) for p in kind.split(text)])

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Irregular
        return self.keep(piece, self.count(piece))


class TokenCounter:
    """``count(text)``: tokens of one whole text."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.kind = _kind(path)
        merged = _Merged(self.kind, whole)
        self.first, self.rest = _Pieces(self.kind, "", merged), _Pieces(self.kind, self.kind.lead, merged)

    def _cut(self, text: str) -> int:
        head, *rest = text.split(" ")
        try:
            return self.first[head] + sum(map(self.rest.__getitem__, rest))
        except _Irregular:
            head, *rest = _CUT.split(text)
            return self.first.count(head) + sum(map(self.rest.count, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.kind.cuts or _MARK in text or any(s in text for s in self.kind.special):
            return self.kind.library(text)
        return self._cut(text)


def _counted(path: str, whole):
    def run(batches):
        counter = TokenCounter(path, whole.value)
        for b in batches:
            n = [counter.count(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_bytes": b.column("n_bytes"), "n_tokens": pa.array(np.array(n, np.int64))})
    return run


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, by the vocabulary file at ``path``."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole(path))  # at most one entry a vocabulary string
    rows = id_text(docs, id_col, text_col).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return map_batches(rows, _counted(path, whole), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(table(spark, sf, "documents"))
