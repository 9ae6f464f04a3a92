"""Operator 3: toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first (case, homoglyphs of Latin letters, digit and sign
substitutions inside words, invisible characters), then one automaton finds
lexicon stems at word starts and exception phrases; a hit inside an exception
phrase does not count. The summed weights, plain and per 100 words, give the
score through a logistic curve.

The lexicon is learned: candidate stems (whole folded words and their first 4
to 8 letters) are counted in toxic and clean labelled documents, and a stem
enters with its log-odds weight if its likelihood ratio holds against the
number of candidates tried. Copies (equal whole folded texts) count once, as
the row of the least id, toxic if one of them is.
Labels come from a bounded sample of the labelled rows (``LABEL_SAMPLE``, the
smallest hashes of the id), which is also what bounds the broadcast of ids.

Defined results: NULL or empty text: no hit, the score of a text without hits.
NULL labels are ignored; an id with several labels is toxic if one says so.
Repeated rows are scored alike. No toxic or no clean label: an empty lexicon
and the share of toxic labels (0 without labels) as everyone's score. NULL id:
its crc32 is that of the empty text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import crc_mod, id_text, map_batches, query, stored, table

LABEL_SAMPLE = 20_000
THRESHOLD = 0.3
#: Stems a model holds at most (those with the most toxic documents).
MAX_STEMS = 5_000
STEM_LETTERS = (4, 5, 6, 7, 8)
#: Least log-odds of a stem, and what a longer stem must add to its beginning's.
LEAST_WEIGHT, LONGER_GAIN = 1.2, 1.0
#: Benign phrases that contain an insult's stem.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "circus clown", "sore loser award", "moron mountain")

# Look-alikes of Latin letters (Cyrillic, Greek) and digit substitutions.
_LOOK = dict(zip("аеорсухіјѕԁһӏвкмнтαορνικτυε", "aeopcyxijsdhlbkmhtaopviktue", strict=True))
_DIGIT = dict(zip("0134578", "oieastb", strict=True))
_SIGN = {"@": "a", "$": "s", "!": "i"}
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_WIDE = {0xFF01 + i: 0x21 + i for i in range(94)}
_MAP = {ord(k): v for k, v in (_LOOK | _DIGIT).items()} | _INVISIBLE | _WIDE
_SIGN_IN_WORD = re.compile(r"(?<=[^\W\d_])[@$!](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower case with look-alikes and substitutions mapped to plain letters."""
    if not text:
        return ""
    out = text.lower().translate(_MAP)
    if "@" in out or "$" in out or "!" in out:
        out = _SIGN_IN_WORD.sub(lambda m: _SIGN[m[0]], out)
    return out


@dataclass
class ToxicityModel:
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    coef: tuple[float, float, float] = (0.0, 0.0, 0.0)  # intercept, weight sum, weight per 100 words
    constant: float | None = None  # everyone's score if there was nothing to learn from


def _automaton(model: ToxicityModel):
    import ahocorasick
    auto = ahocorasick.Automaton()
    for stem, weight in model.stems.items():
        auto.add_word(stem, (len(stem), weight))
    for phrase in model.exceptions:
        auto.add_word(fold(phrase), (len(fold(phrase)), None))
    if len(auto):
        auto.make_automaton()
    return auto


def _features(text: str | None, auto) -> tuple[int, float, float]:
    """(hits, summed weight, weight per 100 words) of one whole text."""
    folded = fold(text)
    found: dict[int, tuple[int, float]] = {}
    benign: list[tuple[int, int]] = []
    if len(auto) and folded:
        for last, (n, weight) in auto.iter(folded):
            start = last - n + 1
            if start and folded[start - 1].isalnum():
                continue
            if weight is None:
                benign.append((start, last))
            elif start not in found or found[start][1] < weight:
                found[start] = (last, weight)
    if benign:
        found = {s: (e, w) for s, (e, w) in found.items() if not any(a <= s and e <= b for a, b in benign)}
    total = sum(w for _, w in found.values())
    return len(found), total, 100.0 * total / max(20, len(folded.split()))


def _curve(model: ToxicityModel, total: float, dense: float) -> float:
    if model.constant is not None:
        return model.constant
    a, b, c = model.coef
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * min(total, 30.0) + c * min(dense, 60.0)))))


def _candidates(batches):
    """Partial counts of the candidate stems: (stem, toxic documents, clean documents)."""
    toxic, clean = Counter(), Counter()
    for b in batches:
        for text, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            words = set(_WORD.findall(fold(text)))
            stems = {w for w in words if len(w) >= 3}
            for n in STEM_LETTERS:
                stems.update([w[:n] for w in words if len(w) > n])
            (toxic if label else clean).update(stems)
    keys = list(toxic.keys() | clean.keys())
    for i in range(0, len(keys), 50_000):
        part = keys[i:i + 50_000]
        yield pa.record_batch({"stem": pa.array(part, pa.string()),
                               "toxic": pa.array([toxic[k] for k in part], pa.int64()),
                               "clean": pa.array([clean[k] for k in part], pa.int64())})


def _signed(batches):
    """Adds the 128-bit hash of the whole folded text."""
    for b in batches:
        out = [xxhash.xxh3_128_digest(fold(text)) for text in b.column("text").to_pylist()]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "toxic": b.column("toxic"), "text": b.column("text"),
                               "signature": pa.array(out, pa.binary())})


def distinct_texts(known: DataFrame) -> DataFrame:
    """One row (doc_id, toxic, text) of each folded text of ``known``: the least id, with the greatest label."""
    signed = map_batches(known.select("doc_id", "toxic", "text"), _signed, "doc_id long, toxic int, text string, signature binary")
    return (signed.groupBy("signature").agg(F.min(F.struct("doc_id", "text")).alias("least"), F.max("toxic").alias("toxic"))
            .select("least.doc_id", "toxic", "least.text"))


def _select(rows) -> dict[str, float]:
    """Of (stem, weight) rows: a longer stem enters only if it weighs clearly more than its own beginning."""
    stems: dict[str, float] = {}
    for stem, weight in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if not any(stems.get(stem[:n], -1.0) >= weight - LONGER_GAIN for n in range(3, len(stem))):
            stems[stem] = weight
    return stems


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 25, ridge: float = 1e-2) -> tuple[float, ...]:
    """Newton steps of a lightly penalised logistic regression on the bounded sample's features."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
    return tuple(float(v) for v in w)


def _featured(model: ToxicityModel):
    def run(batches):
        auto = _automaton(model)
        for b in batches:
            rows = [_features(t, auto) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"toxic": b.column("toxic"), "total": pa.array([r[1] for r in rows], pa.float64()),
                                   "dense": pa.array([r[2] for r in rows], pa.float64())})
    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = LABEL_SAMPLE, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic",
                 exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn stems, weights and the curve from at most ``sample`` labelled rows of ``labels``."""
    chosen = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
              .filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most ``sample`` ids and flags: bounded by the parameter
    known = id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    rows = stored(distinct_texts(known), "toxicity-sample")
    counts = {r["toxic"] > 0: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(exceptions=exceptions, constant=1.0 if n_toxic else 0.0)
    stems = (map_batches(rows.select("text", (F.col("toxic") > 0).alias("toxic")), _candidates,
                         "stem string, toxic long, clean long")
             .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .filter("toxic + clean >= 3"))
    stems = stored(stems, "toxicity-stems")
    rate, need = n_toxic / (n_toxic + n_clean), math.log(max(2, stems.count())) + 3.0
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    ratio = (F.col("toxic") * F.log(share / rate)
             + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    strong = (stems.filter(F.col("toxic") >= 3).withColumn("weight", weight).filter(F.col("weight") >= LEAST_WEIGHT)
              .filter(ratio >= need).orderBy(F.desc("toxic"), "stem").limit(MAX_STEMS))
    model = ToxicityModel(_select([(r["stem"], r["weight"]) for r in strong.collect()]), exceptions)
    # at most ``sample`` rows of three numbers
    fitted = map_batches(rows.select("text", "toxic"), _featured(model), "toxic int, total double, dense double").toPandas()
    x = np.minimum(fitted[["total", "dense"]].to_numpy(), (30.0, 60.0))
    model.coef = _logistic(x, (fitted["toxic"].to_numpy() > 0).astype(float))
    return model


def _scored(model: ToxicityModel):
    def run(batches):
        auto = _automaton(model)
        for b in batches:
            rows = [_features(t, auto) for t in b.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_hits": pa.array([r[0] for r in rows], pa.int32()),
                                   "score": pa.array([_curve(model, r[1], r[2]) for r in rows], pa.float64())})
    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_hits, score) of every row."""
    return map_batches(id_text(docs, id_col, text_col), _scored(model), "doc_id long, n_hits int, score double")


def _kept(model: ToxicityModel, text_col: str, threshold: float):
    def run(batches):
        auto = _automaton(model)
        for b in batches:
            texts = b.column(b.schema.names.index(text_col)).to_pylist()
            keep = [_curve(model, *_features(t, auto)[1:]) < threshold for t in texts]
            yield b.filter(pa.array(keep, pa.bool_()))
    return run


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below the threshold."""
    return map_batches(docs, _kept(model, text_col, threshold), docs.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """The rows a model may learn from: crc32 of the id modulo 4 is not 2."""
    return labels.filter(crc_mod(F.col("doc_id"), 4) != 2)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = fit_toxicity(docs, training_labels(table(spark, sf, "labels")))
    return score_toxicity(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits")
