"""Token counts against the libraries themselves, for each kind of vocabulary."""

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from listingmart.llm import token_counts
from listingmart.llm.common import table

SF = "/root/testdata/sf0.01"
HARD = ["", " ", "   ", "a  b", "a b ", " a", "x\n y", "x \ny", "a b\n c", "a<|endoftext|>b <|endoftext|>", "<s> hi </s> <unk>",
        "日本語 テキスト   x  y\r\n", "ﬁ Ａ b é x ̈y ̈", "foo▁ bar ▁ baz ▁▁", "I'm he'll 's 'S don't", "\x1c a \x1f", "x" * 5000,
        "1234567 12 345", "ΑΣ ΑΣ.", "a 　b", "b\n", "a b\n", "same same " * 3000, None]
SCHEMA = "doc_id long, text string, n_bytes string, n_tokens string, lang string"


def _library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        p = SentencePieceProcessor(model_file=path)
        return lambda t: len(p.encode(t or ""))
    t = Tokenizer.from_file(path)
    return lambda s: len(t.encode(s or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, name):
    count = _library(name)
    docs = spark.createDataFrame([(i % 20, t, "x", "y", None) for i, t in enumerate(HARD + HARD)], SCHEMA).repartition(3)
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, public_tokenizers.path(name)).collect())
    assert got == sorted((i % 20, len((t or "").encode()), count(t), count(t) > 512) for i, t in enumerate(HARD + HARD))


def test_order_of_texts_does_not_matter():
    path = public_tokenizers.path("byte_bpe_50k.json")
    count, whole = _library("byte_bpe_50k.json"), token_counts.prove_whole(path)
    for texts in (HARD, HARD[::-1]):
        counter = token_counts.TokenCounter(path, whole)
        assert [counter.count(t) for t in texts] == [count(t) for t in texts]


def test_proof(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, t = token_counts.prove_whole(path), Tokenizer.from_file(path)
    assert "Ġthe" in whole and "Ġzqxj" not in whole
    assert all(len(t.model.tokenize(w)) == 1 for w in sorted(whole)[::97])


def test_full_memo(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_PIECES", 4)
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, count = token_counts.TokenCounter(path, token_counts.prove_whole(path)), _library("byte_bpe_50k.json")
    text = " ".join(f"w{i % 13}x" for i in range(200))
    assert counter.count(text) == count(text) and len(counter.rest) <= 4 and len(counter.rest.merged) <= 4


def test_empty_table_and_null_id(spark):
    docs = spark.createDataFrame([(None, "a b", "x", "y", None)], SCHEMA)
    assert [tuple(r) for r in token_counts.token_counts(docs).collect()] == [(None, 3, 2, False)]
    none = token_counts.token_counts(docs.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_query_over_the_whole_table(spark):
    count = _library("byte_bpe_50k.json")
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in token_counts.op13_token_counts(spark, SF).collect()}
    assert got == {d.doc_id: count(d.text) for d in docs}
