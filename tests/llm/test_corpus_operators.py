"""Each corpus operator against brute force on a small table with hard cases, and on an empty one."""

import hashlib
import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listingmart.llm import (decontaminate, divergence, encoding, hmm, packing, quality_model, simhash, substrings, token_orc, toxicity,
                             url_rules)
from listingmart.llm.common import crc_mod, scratch_path
from listingmart.llm.encoding import default_vocabulary, encoder

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# columns whose names an operator uses inside, too
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, tie long, fp long, tag long, "
          "items string, size string, phrase string, score double")


def _sentence(rng, n, words):
    return " ".join(rng.choice(words, n).tolist())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}x" for i in range(300)]
    passage, leak = _sentence(rng, 70, words), _sentence(rng, 40, words)
    texts = {i: _sentence(rng, int(rng.integers(5, 160)), words) for i in range(60)}
    texts[5] = texts[3]                                    # a copy
    texts[6] = texts[3] + " tail"                          # a near copy
    for i in (10, 20, 30):
        texts[i] = f"{texts[i]} {passage} {_sentence(rng, 12, words)}"
    texts[21] = f"{texts[21]}\n{leak.upper()}!\nend"
    texts[40], texts[41] = "", "  two\t words\n"
    texts[42] = _sentence(rng, 6000, words)                # very long
    texts[43] = "same same " * 100                         # periodic
    texts[44] = texts[43] + "same same"
    texts[45] = "héllo wörld <|endoftext|> 日本語 テキスト   x  y\r\n"
    out = [(i, t, "en" if i % 2 else "fr") for i, t in texts.items()]
    out += [(50, texts[50], "en"), (None, texts[7], None), (61, None, "en"), (None, None, None), (62, texts[8], "fr")]
    return out, leak


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0, 7, 7, 7, 7, "x", "y", "z", 0.5) for i, t, g in rows[0]], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(60)] + [(1, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def _ids(text, end):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_vocabulary())
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_encoder_equals_library(rows):
    enc = encoder(default_vocabulary())
    extra = [" lead", "a  b", "tab\t x", "x\n y", "it's don't", "1 234,5", "\n", "a  b", "ÀÉ ß"]
    for text in [t for _, t, _ in rows[0]] + extra:
        assert enc.encode(text) + np.uint32(2).tobytes() == _ids(text, 2).tobytes()


def test_encode_all_equals_library(rows):
    rng = np.random.default_rng(4)
    parts = ["a", "Word", "é", "語", "1", " ", "\n", "  ", "\n\n", ".", "!#", "'s", "'", "\t", "\r", "<|endoftext|>", "|>", "\x1c", "\u0085"]
    texts = [t for _, t, _ in rows[0]] + ["", "a\n" * 30000, "word." * 3000]
    texts += ["".join(rng.choice(parts, rng.integers(12)).tolist()) for _ in range(5000)]
    enc, library = encoder(default_vocabulary()), Tokenizer.from_file(default_vocabulary())
    for some in (texts, [], [None], ["", None], [" a", "b"]):
        ids, at = enc.encode_all(pa.array(some, pa.string()))
        assert len(at) == len(some) + 1
        for i, text in enumerate(some):
            assert ids[at[i]:at[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_token_orc_merges_and_looks_up_a_word_once(monkeypatch):
    words = [f"{a}{b}zq" for a in "bcdfg" for b in "aeiou"]
    texts = [f"{a}. {b}!\n{a}; {b},\n{b}? {a}##\n{a} {b}" for a in words for b in words]
    merged, looked = [], []
    for name in ("ids", "letters"):
        real = getattr(encoding._Words, name)
        monkeypatch.setattr(encoding._Words, name, lambda self, w, real=real: merged.append(w) or real(self, w))
    for name in ("get", "__getitem__"):
        monkeypatch.setattr(encoding._Pieces, name, lambda self, p, name=name: looked.append(p) or getattr(dict, name)(self, p), raising=False)
    monkeypatch.setattr(encoding, "_ENCODERS", {})
    monkeypatch.setattr(token_orc, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    batches = [pa.record_batch({"doc_id": pa.array(range(i, i + 25)), "text": pa.array(texts[i:i + 25])}) for i in range(0, len(texts), 25)]
    want = Tokenizer.from_file(default_vocabulary()).encode_batch(texts, add_special_tokens=False)
    out = list(token_orc._encode(default_vocabulary(), 2)(iter(batches)))
    assert [b.num_rows for b in out] == [25] * 25 and [x for b in out for x in b["ids"].to_pylist()] == [[*w.ids, 2] for w in want]
    n = [x for b in out for x in b["n_tokens"].to_pylist()]
    assert [x for b in out for x in b["shard_start"].to_pylist()] == np.cumsum([0, *n[:-1]]).tolist()
    spelled = [w for w in merged if w.strip(" Ġ") in words]
    assert len(spelled) == len(set(spelled)) <= 2 * len(words)  # with and without the space before it
    assert len(looked) < 4 * len(texts)  # of eight pieces each


def test_token_orc_pools_batches(monkeypatch):
    batches = [pa.record_batch({"text": pa.array(["x" * 100] * 3)}) for _ in range(7)]
    monkeypatch.setattr(encoding, "POOL_BYTES", 900)
    pools = list(encoding.pooled(iter(batches)))
    assert [b for p in pools for b in p] == batches and [len(p) for p in pools] == [3, 3, 1]
    assert list(encoding.pooled(iter([]))) == []


def test_token_orc(spark, docs, empty, rows):
    path = scratch_path(spark, "test-tokens")
    token_orc.write_tokens(docs, path)
    got = sorted(map(tuple, token_orc.token_digest(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] is None for r in got[:2]] == [True, True] and [r[0] for r in got[2:]] == sorted(r[0] for r in got[2:])
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ((i, _ids(t, 2)) for i, t, _ in rows[0]))
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    pruned = token_orc.read_tokens(spark, path, [42])
    assert "PushedFilters: [In(doc_id, [42])" in pruned._jdf.queryExecution().toString() or pruned.count() == 1
    token_orc.write_tokens(empty, path + "-0")
    assert token_orc.token_digest(spark, path + "-0").count() == 0


def _fingerprint(text):
    w = WORD.findall((text or "").encode().lower())
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def test_simhash(docs, empty, rows):
    f = [_fingerprint(t) for _, t, _ in rows[0]]
    root = list(range(len(f)))
    for _ in f:
        for a in range(len(f)):
            for b in range(a):
                if (f[a] ^ f[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {r: min((i for (i, _, _), x in zip(rows[0], root, strict=True) if x == r and i is not None), default=None) for r in root}
    want = Counter((i, format(x, "016x"), least[r]) for (i, _, _), x, r in zip(rows[0], f, root, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    clash = docs.withColumns({"keep_tag": F.lit(1), "keep_tag_": F.lit(2), "at": F.lit(3), "root": F.lit(4), "k": F.lit(5)})
    assert simhash.keep_one(clash).columns == clash.columns
    assert simhash.keep_one(clash).count() == simhash.keep_one(docs).count()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(least[r] for r in set(root))
    assert simhash.near_duplicates(empty).count() == simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("bucket", [4, 1000])
def test_simhash_dense_groups(spark, bucket):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, int(k), replace=False)) for c in centre for k in rng.integers(0, 4, 80)}
    x = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.classes(df).collect()} if bucket == 1000 else None
    edges = [(r["a"], r["b"]) for r in simhash.link_fingerprints(df, bucket=bucket).collect()]
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 2
    label = np.arange(len(x))
    while not (label == (new := np.where(near, label[None, :], len(x)).min(axis=1))).all():
        label = new
    at = {int(v): i for i, v in enumerate(x.view(np.int64))}
    mine = np.arange(len(x))
    for _ in x:
        for a, b in edges:
            mine[at[a]] = mine[at[b]] = min(mine[at[a]], mine[at[b]])
    assert len(set(map(tuple, zip(label, mine, strict=True)))) == len(set(label)) == len(set(mine))
    if got:
        assert len(set(got.values())) == len(set(label))


def test_simhash_refines_by_its_distance(spark, monkeypatch):
    """Fingerprints that agree on one part of the refined mask only, each part in turn, meet at distance 3."""
    first = (1 << 16) - 1
    parts = simhash.refined(first, 3)
    assert len(parts) == 4
    monkeypatch.setattr(simhash, "probe_masks", lambda *_: [first])
    # pair k differs in one bit outside ``first`` and in one of each refined part but the k-th
    free = [p & ~first for p in parts]
    pairs = []
    for k in range(4):
        a = (k + 1) * 0x0123456700000000 & ~first & ((1 << 63) - 1)
        pairs.append((a, a ^ sum((f & -f) for j, f in enumerate(free) if j != k)))
    df = spark.createDataFrame([(v - (1 << 64) if v >= 1 << 63 else v,) for p in pairs for v in p], "fp long")
    got = {frozenset((r["a"], r["b"])) for r in simhash.link_fingerprints(df, distance=3, bucket=4).collect()}
    want = {frozenset(v - (1 << 64) if v >= 1 << 63 else v for v in p) for p in pairs}
    assert want <= got


def test_allot_and_refine():
    assert sum(simhash.allot([[0, 5, 50, 500], [0, 1, 9, 90], [0, 2, 4, 40]])) == 0
    parts = simhash.refined((1 << 21) - 1)
    assert all(p & ((1 << 21) - 1) == (1 << 21) - 1 for p in parts) and parts[0] | parts[1] | parts[2] == (1 << 64) - 1


def test_toxicity(spark, docs, empty, labels):
    rng = np.random.default_rng(6)
    pool = ["".join(rng.choice(list("abcdefg"), 6)) for _ in range(400)]
    clean = [(i, f"the day is fine {_sentence(rng, 12, pool)}", 0) for i in range(200)]
    toxic = [(1000 + i, f"you {w} go {_sentence(rng, 12, pool)}", 1) for i, w in enumerate(["grumblor", "GRUMBL0R", "snarkity", "snаrkity"] * 15)]
    train = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(train.select("doc_id", "text"), train.select("doc_id", "toxic"))
    probe = spark.createDataFrame([(1, "what a gruмblor this is"), (2, "what a fine road this is"), (3, ""), (4, None), (None, "snark1ty day")],
                                  "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(probe, model).collect()}
    assert got[1] > 0.5 and got[None] > 0.5 and max(got[2], got[3], got[4]) < toxicity.THRESHOLD
    assert [r["doc_id"] for r in toxicity.drop_toxic(probe, model).orderBy("doc_id").collect()] == [2, 3, 4]
    model.exceptions = ("grumblor day",)
    again = {r["doc_id"]: r["n_hits"] for r in toxicity.score_toxicity(
        spark.createDataFrame([(1, "a grumblor day"), (2, "a grumblor night")], "doc_id long, text string"), model).collect()}
    assert again == {1: 0, 2: 1}
    nothing = toxicity.fit_toxicity(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs, nothing).filter("score = 0").count() == docs.count()
    assert toxicity.score_toxicity(empty, nothing).count() == 0 and toxicity.drop_toxic(docs, nothing).columns == docs.columns


def test_toxicity_copies(spark):
    rng = np.random.default_rng(8)
    pool = ["".join(rng.choice(list("abcdefg"), 9)) for _ in range(200)]
    shared = min(pool, key=xxhash.xxh3_64_intdigest)      # the least hash of every text's long words
    texts = [(i, f"{shared} {'grumblor ' * (i % 4 == 0)}{_sentence(rng, 8, pool)}", int(i % 4 == 0)) for i in range(80)]
    # an upper case copy with the other label; equal ids; look-alikes
    texts += [(100, texts[1][1].upper(), 1), (101, texts[4][1], 0), (7, texts[4][1].replace("o", "0"), 0), (102, None, 0), (103, "", 0)]
    train = spark.createDataFrame(texts, "doc_id long, text string, toxic int").repartition(7)
    model = toxicity.fit_toxicity(train.filter("doc_id < 100 AND doc_id != 7").select("doc_id", "text"), train.select("doc_id", "toxic"))
    assert any("grumblor".startswith(s) for s in model.stems)
    got = {r["doc_id"]: (r["toxic"], r["text"]) for r in toxicity.distinct_texts(train).collect() if r["doc_id"] != 7}
    assert got == {i: (1 if i == 1 else x, t) for i, t, x in texts[:80] if i != 7} | {102: (0, None)}
    sevens = [r for r in toxicity.distinct_texts(train).collect() if r["doc_id"] == 7]
    assert [r["toxic"] for r in sevens] == [0]


def test_substrings(docs, empty, rows):
    first = {}
    for i, t, _ in rows[0]:
        w = WORD.findall((t or "").encode())
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            first[k] = min(first.get(k, math.inf), math.inf if i is None else i)
    want, texts = Counter(), {}
    for i, t, _ in rows[0]:
        w = WORD.findall((t or "").encode())
        gone = {j for s in range(len(w) - 49) if first[tuple(w[s:s + 50])] < (math.inf if i is None else i) for j in range(s, s + 50)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        want[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
        if gone:
            texts[i] = kept.decode()
    assert Counter(map(tuple, substrings.repeat_digest(docs).collect())) == want
    assert sum(n for (_, _, gone, _), n in want.items() if gone) >= 5
    cut = substrings.drop_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {r["doc_id"]: r["text"] for r in cut.collect() if r["doc_id"] in texts and r["doc_id"] is not None} == {
        k: v for k, v in texts.items() if k is not None}
    assert substrings.repeat_digest(empty).count() == substrings.drop_repeats(empty).count() == 0


def test_divergence(docs, empty, rows):
    def base(t):
        w = [x.decode() for x in WORD.findall((t or "").encode())]
        lines = [x for x in (t or "").split("\n") if WORD.search(x.encode())]
        c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        rep = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep),
                len(w) < 20 or 100 * len(rep) > 30 * len(w))
    got = divergence.quality_rules(docs).collect()
    assert Counter((r["doc_id"], *tuple(r)[1:7]) for r in got) == Counter((i, *base(t)) for i, t, _ in rows[0])
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert divergence.quality_rules(empty).count() == 0
    p, q = np.array([[1.0, 0.0], [0.5, 0.5]]), np.array([0.5, 0.5])
    assert np.allclose(divergence.js_distance(p, q), [math.sqrt(0.5 * math.log2(4 / 3) + 0.25 * math.log2(2 / 3) + 0.25), 0])


def test_divergence_rare_languages(spark):
    rng = np.random.default_rng(12)
    words = {g: ["".join(rng.choice(list(letters), int(rng.integers(3, 9)))) for _ in range(60)]
             for g, letters in (("en", "abcdefghij"), ("el", "αβγδεζηθικ"), ("ru", "бгджзилпфц"))}
    texts = [("en", _sentence(rng, 25, words["en"])) for _ in range(3000)]
    texts += [("el", _sentence(rng, 100, words["el"])) for _ in range(24)] + [("ru", _sentence(rng, 100, words["ru"])) for _ in range(5)]
    junk = [(g, " ".join(map(str, rng.integers(1000, 1000000, 100)))) for g in ("en", "el", None)]
    table = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(texts + junk)], "doc_id long, lang string, text string")
    got = {r["doc_id"]: r for r in divergence.quality_rules(table.repartition(3)).collect()}
    assert all(got[i]["kept"] for i in range(len(texts)))
    assert not any(got[i]["kept"] for i in range(len(texts), len(texts + junk)))
    # the sparse distance is the dense one
    h, refs = rng.integers(0, 3, (5, 9)), rng.integers(0, 4, (3, 9)) + 0.0
    h[:, 0] += 1
    refs[:, 1] += 1
    want = np.min([divergence.js_distance(h / h.sum(axis=1, keepdims=True), r / r.sum()) for r in refs], axis=0)
    assert np.allclose(divergence._nearest(5, *np.nonzero(h), h[np.nonzero(h)], refs), want)


def test_packing(spark, docs, empty, rows):
    got = packing.pack(packing.pieces(docs, capacity=256), capacity=256).toPandas()
    want = Counter((i, len(_ids(t, 0))) for i, t, _ in rows[0])
    assert sum(n * m for (_, n), m in want.items()) == got["length"].sum() and got["length"].max() <= 256
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id")["length"].cumsum() - by["length"] == by["offset"]).all()
    assert by.groupby("sequence_id")["length"].sum().max() <= 256
    full, rest = (got["length"] == 256).sum(), sorted(got["length"][got["length"] < 256], reverse=True)
    gaps = []
    for n in rest:  # best fit decreasing
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            full, fit = full + 1, 256
        else:
            gaps.remove(fit)
        gaps.append(fit - n)
    assert got["sequence_id"].nunique() <= full + 1
    one = got[got["doc_id"] == 42].sort_values("piece")
    ids = _ids(dict((i, t) for i, t, _ in rows[0])[42], 0)
    assert [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(one["start"], one["length"], strict=True)] == one["ids_crc32"].tolist()
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_packing_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(packing, "SWEEP_ROWS", 40)
    cut = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (1 + F.col("id") * 37 % 130).alias("length"))
    got = packing.pack(cut, capacity=256).toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= 256 and len(got) == 400
    assert got["sequence_id"].nunique() <= math.ceil(got["length"].sum() / 256) + 2
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id")["length"].cumsum() - by["length"] == by["offset"]).all()


def test_packing_sorts_once_however_many_ranges(spark, monkeypatch):
    written, real = [], packing.stored
    monkeypatch.setattr(packing, "SWEEP_ROWS", 40)
    monkeypatch.setattr(packing, "stored", lambda df, name: written.append(name) or real(df, name))
    size = F.when(F.col("id") % 3 == 0, 90).otherwise(1 + F.col("id") * F.col("id") % 230)  # a third of one size, over ranges
    got = packing.pack(spark.range(900).select(F.col("id").alias("doc_id"), size.cast("int").alias("length")), capacity=256).toPandas()
    assert len(written) <= 2  # before, two tables for each round
    assert got["doc_id"].sort_values().tolist() == list(range(900))
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id")["length"].cumsum() - by["length"] == by["offset"]).all()
    assert by.groupby("sequence_id")["length"].sum().max() <= 256
    gaps = []
    for n in sorted(got["length"], reverse=True):  # best fit decreasing, a piece at a time
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((256 if fit is None else fit) - n)
    assert got["sequence_id"].nunique() == len(gaps)


def test_bracket():
    assert packing._bracket([(0, 2, 3, 3, 5), (1, 2, 1, 7, 6), (2, 5, 0, 9, 0)]) == [
        (1, 0, 0, 2, 2, 1), (2, 0, 1, 0, 1, 1), (2, 1, 0, 0, 1, 1)]
    assert packing._bracket([(0, 0, 7, 0, 3), (1, 2, 0, 10, 0)]) == [(1, 0, 0, 6, 6, 3)]  # three documents a gap


def test_hmm(docs, empty, rows):
    tokens = [(i, [*WORD.findall((t or "").encode().lower()), b""]) for i, t, _ in rows[0]]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in tokens]
    c = Counter(w for (_, ws), h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    got = hmm.score_corpus(docs, crc_mod(F.col("doc_id"), 10) == 0).collect()
    want = sorted((-1 if i is None else i, h, len(ws), sum(w in c for w in ws), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (i, ws), h in zip(tokens, held, strict=True))
    assert sorted((-1 if r[0] is None else r[0], *tuple(r)[1:5], round(r[5], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert hmm.score_corpus(empty, F.lit(False)).count() == 0


def test_hmm_recursions(monkeypatch):
    rng = np.random.default_rng(2)
    model = hmm.Model(rng.dirichlet(np.ones(hmm.STATES)), rng.dirichlet(np.ones(hmm.STATES), hmm.STATES),
                      rng.dirichlet(np.ones(hmm.CLASSES), hmm.STATES))
    seqs = [rng.integers(0, hmm.CLASSES, n).astype(np.uint16) for n in (1, 7, 64, 100)]
    for s, got in zip(seqs, hmm.log_likelihoods(model, seqs), strict=True):
        a = model.start * model.emit[:, s[0]]
        for x in s[1:]:
            a = (a @ model.move) * model.emit[:, x] * 1.0
        assert math.isclose(got, math.log10(a.sum()) if a.sum() > 0 else got, rel_tol=1e-9)
    whole = np.zeros(hmm.STATES + hmm.STATES ** 2 + hmm.STATES * hmm.CLASSES + 1)
    for s in seqs:  # forward and backward of one whole sequence, token by token
        alpha = [model.start * model.emit[:, s[0]]]
        for x in s[1:]:
            alpha.append((alpha[-1] @ model.move) * model.emit[:, x])
        beta, total = np.ones(hmm.STATES), alpha[-1].sum()
        start, moves, emits, _ = np.split(whole, np.cumsum([hmm.STATES, hmm.STATES ** 2, hmm.STATES * hmm.CLASSES]))
        for t in range(len(s) - 1, -1, -1):
            emits.reshape(hmm.STATES, -1)[:, s[t]] += alpha[t] * beta / total
            if t:
                ahead = model.emit[:, s[t]] * beta
                moves += (np.outer(alpha[t - 1], ahead) * model.move).ravel() / total
                beta = model.move @ ahead
        start += alpha[0] * beta / total
        whole[-1] += math.log(total)
    for length in (1, 7, 64, 1000):  # cuts change nothing
        assert np.allclose(hmm.expected_counts(model, seqs, length), whole, rtol=2e-4, atol=2e-5)
    monkeypatch.setattr(hmm, "BATCH_TOKENS", 20)
    assert np.allclose(hmm.expected_counts(model, seqs, 7), whole, rtol=2e-4, atol=2e-5)


def test_hmm_iterations_read_all(docs, rows, monkeypatch):
    seen, train = [], hmm.baum_welch

    def counted(some, model, iterations):
        seen.extend([some.count()] * iterations)
        return train(some, model, iterations)

    monkeypatch.setattr(hmm, "START_DOCS", 4, raising=False)
    monkeypatch.setattr(hmm, "baum_welch", counted)
    hmm.score_corpus(docs, F.lit(False)).count()
    assert seen == [len(rows[0])] * 10


def test_decontaminate(spark, docs, empty, rows):
    leak = rows[1]
    words = leak.split(" ")
    edited = " ".join([*words[:9], words[9][:-1] + "q", *words[10:]])
    benchmark = spark.createDataFrame([(1, leak), (2, edited), (3, "too short"), (4, None), (5, "zq" * 60), (None, leak)],
                                      "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontaminate.contaminated(docs, benchmark).collect() if r["items"]}
    assert got == {21: [1, 2]}
    clean = decontaminate.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1
    assert decontaminate.contaminated(docs, benchmark.limit(0)).filter("size(items) > 0").count() == 0
    assert decontaminate.contaminated(empty, benchmark).count() == 0


def test_banded_alignment_equals_full():
    rng = np.random.default_rng(4)
    item = "".join(rng.choice(list("abcdefgh "), 200))
    index = decontaminate.Index([(1, decontaminate.normalise(item))])
    for cuts, expect in ((0, True), (2, True), (60, False)):
        noisy = list(item)
        for k in rng.choice(190, cuts, replace=False):
            noisy[k] = "z"
        text = "".join(rng.choice(list("abcdefgh "), 300)) + " " + "".join(noisy)
        assert bool(decontaminate.matches(index, [text])[0]) == expect


def test_decontaminate_parts_of_items():
    rng = np.random.default_rng(9)

    def prose(n):
        out = ""
        while len(out) < n:
            out += "".join(rng.choice(list("abcdefghijklm"), int(rng.integers(3, 11)))) + " "
        return out[:n - 1] + "z"

    items = [(i, prose(n)) for i, n in enumerate(list(range(50, 400, 7)) * 2)]
    index = decontaminate.Index([(i, decontaminate.normalise(t)) for i, t in items])
    replaced, fragments, apart = [], [], []
    for _, t in items:
        words = t.split(" ")
        words[len(words) // 2] = "q" * int(rng.integers(5, 11))
        replaced.append(f"{prose(200)} {' '.join(words)} {prose(200)}")
        at = int(rng.integers(0, max(1, len(t) - 80)))
        fragments.append(f"{prose(200)} {t[at:at + 80]} {prose(200)}")
        apart.append(f"{prose(200)} {t[:30]} {prose(200)}")
    assert decontaminate.matches(index, replaced) == [{i} for i, _ in items]
    assert decontaminate.matches(index, fragments) == [{i} for i, _ in items]
    assert decontaminate.matches(index, apart + [prose(900)]) == [set()] * (len(items) + 1)
    short = decontaminate.Index([(1, decontaminate.normalise("Who is it?")), (2, decontaminate.normalise("42"))])
    assert decontaminate.matches(short, ["so: who is it", "who is item", None, "x 42, y", "142 who", "Who is it 42"]) == [
        {1}, set(), set(), {2}, set(), {1, 2}]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://net/", "http://NET", "https://a.b.net/x?q#f", "http://example.net/en/1", "http://www.example.net/en",
            "http://xexample.net/en/", "http://example.com/de/", "http://a.example.com/de/x", "http://org/fr/", "http://q.org/fr/x",
            "http://net.org/de/", "ftp://host.net:80/", "http://example.net/en/1"]
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)] + [(None, "http://net/", "h", "k")],
                                  "page_id long, url string, key string, stack string")

    def judge(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow"
    got = url_rules.judge_urls(pages, url_rules.rules_frame(spark, url_rules.RULES))
    assert Counter(map(tuple, got.collect())) == Counter([(i, *judge(u)) for i, u in enumerate(urls)] + [(None, *judge("http://net/"))])
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    none = url_rules.judge_urls(pages, url_rules.rules_frame(spark, []))
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert url_rules.judge_urls(pages.limit(0), url_rules.rules_frame(spark, url_rules.RULES)).count() == 0


def test_quality(spark, docs, empty, labels):
    rng = np.random.default_rng(8)
    plain, loud = ["a", "plain", "line", "of", "text", "with", "words", "in", "it"], ["BUY!!", "NOW!!", "$$$", "###", "99"]
    good = [(i, _sentence(rng, int(rng.integers(4, 40)), plain), 1) for i in range(200)]
    bad = [(1000 + i, _sentence(rng, int(rng.integers(4, 40)), loud), 0) for i in range(200)]
    train = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    model = quality_model.fit_quality(quality_model.measure(train), train.select("doc_id", "quality"))
    probe = spark.createDataFrame([(1, "a line of words in a plain text with it"), (2, "NOW!! 99 $$$ ### BUY!! $$$"), (3, None), (4, "")],
                                  "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality_model.score_quality(quality_model.measure(probe), model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4] and all(0 <= x <= 1 for x in got.values())
    measured = quality_model.measure(docs)
    fitted = quality_model.fit_quality(measured, labels)
    assert quality_model.score_quality(measured, fitted).count() == docs.count()
    assert quality_model.fit_quality(measured, labels.limit(0)).constant == 0.5
    assert quality_model.score_quality(quality_model.measure(empty), model).count() == 0
    curve = quality_model.isotonic(np.array([1, 0, 5, 5, 2.0]), np.array([1, 0, 1, 4, 2.0]))
    assert (np.diff(curve) >= 0).all()


def test_least_places(monkeypatch):
    monkeypatch.setattr(substrings, "_PLACE_BITS", 10)  # many chunks
    rng = np.random.default_rng(4)
    for n in (41, 42, 700, 3000):
        grams = rng.integers(0, 1 << 13, n, dtype=np.uint64) << np.uint64(8)  # many ties
        want = [min(range(i, i + 41), key=lambda j: (int(grams[j]) >> 10, j)) for i in range(n - 40)]
        assert substrings.least_places(grams).tolist() == want


def test_divergence_whatever_the_partitions(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(300)])
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 120, p=np.arange(300, 0, -1) / 45150)), "ab"[i % 2])
                                  for i in range(60)], "doc_id long, text string, lang string")
    got = [[tuple(r) for r in divergence.quality_rules(docs.repartition(n, "doc_id")).orderBy("doc_id").collect()] for n in (2, 13)]
    assert got[0] == got[1] and all(r[-1] > 0 for r in got[0])
    monkeypatch.setattr(divergence, "HELD_WORDS", 50)  # counts come in many parts
    batches = docs.select("text", "lang").toArrow().to_batches(max_chunksize=5)
    parts = list(divergence._word_counts(batches))
    total = Counter()
    for b in parts:
        for r in b.to_pylist():
            total[r["lang"], r["word"].decode()] += r["n"]
    want = Counter((r["lang"], w) for b in batches for r in b.to_pylist() for w in r["text"].split())
    assert len(parts) > 2 and total == want
