"""Collocations against counting every phrase of every text."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from listingmart.llm import collocations as c
from listingmart.llm.common import ORACLE

SCHEMA = "doc_id long, text string, lang string, seg long, phrase string, hash string, n string, f string"


def _brute(rows, longest=3, least=10, hides=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        if any(g == lang and len(q) > len(p) and 100 * b >= hides * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (g, q), b in cand.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    words = np.array(["The", "of", "New", "york", "city", "é", "日本", "a", "b", "ÉA", "x\x1fy", "z-z"])
    texts = [" ".join(words[np.minimum(rng.geometric(0.25, 60) - 1, 11)]) for _ in range(40)]
    texts += ["new york city. " * 30, "a a a a\ta a  a", "end. of, a; piece: b! c? d\ne\rf\x0bg", "", None, "  .. ,", "tail of"] + texts[:3]
    texts.append("ab cd " * 9 + "ab cd")                      # ten times, overlaps included
    texts.append(" ".join(["p", "q", "r"] * 4000))            # a very long piece
    langs = ["en", "fr", None, "und", ""]
    return [(t, langs[i % 5]) for i, t in enumerate(texts)] + [("new york new york " * 6, "only")]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "p", "h", "n", "f") for i, (t, g) in enumerate(rows)], SCHEMA).repartition(4)


def _rows(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("held", [1 << 21, 50])
def test_equals_brute_force(spark, rows, held, monkeypatch):
    monkeypatch.setattr(c, "OPEN_WORDS", held)  # 50: every segment closes early
    assert _rows(c.collocations(_frame(spark, rows))) == _brute(rows)


def test_other_parameters(spark, rows):
    assert _rows(c.collocations(_frame(spark, rows), 4, 3, 80, 7)) == _brute(rows, 4, 3, 80, 7)


def test_hash_collisions_only_let_phrases_through(spark, rows, monkeypatch):
    monkeypatch.setattr(c, "_phrase_hashes", lambda lang, phrases: np.array([len(p) % 3 for p in phrases], np.uint64))
    assert _rows(c.collocations(_frame(spark, rows))) == _brute(rows)


def test_empty_table(spark, rows):
    assert _rows(c.collocations(_frame(spark, rows).limit(0))) == []


def test_segments_keep_pieces_whole(spark, rows):
    for r in c.occurrences(_frame(spark, rows)).collect():
        codes, places = c._occurrences(r.codes, r.places)
        counts = c._unpack(r.counts)
        assert len(codes) == len(places) == counts.sum() and (np.diff(places) > 0).all()
        assert (np.bincount(codes) == counts).all() and len(c._unpack_texts(r.phrases)) == len(counts)


def test_packing():
    for a in ([], [0], [5, 0, 255], [256, 70_000, 1 << 40], [1] * 1000):
        assert c._unpack(c._pack(np.array(a, np.int64))).tolist() == a
    for texts in (["é x", "日本"], ["a"]):
        assert c._unpack_texts(c._pack_texts(texts)) == texts


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(tuple(r) for r in con.sql(ORACLE["op11_collocations"]).fetchall())
    assert len(want) > 1000 and _rows(c.op11_collocations(spark, sf)) == want
