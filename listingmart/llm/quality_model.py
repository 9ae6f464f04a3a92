"""Operator 10: quality classifier on document statistics with random Fourier features.

Each whole text becomes a short vector of statistics; random Fourier features
approximate a Gaussian kernel over the standardised vectors; every partition
sums its part of the normal equations, the driver solves the ridge system
(``FEATURES`` + 1 unknowns, whatever the corpus) and the raw scores are
calibrated by isotonic regression on a fixed number of bins.

All labelled training rows take part: only their statistics meet the labels,
never their texts.

Defined results: NULL or empty text: the statistics of an empty text, scored
like any other. NULL labels are ignored; an id with several labels has their
mean. Labels of one kind only, or none: that share (0.5 without labels) is
everyone's score. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import crc_mod, id_text, map_batches, query, stored, table

FEATURES = 128
BINS = 512
SEED = 20240607
RIDGE = 1e-3
STATISTICS = ("log_words", "mean_word", "distinct_share", "adjacent_repeat", "upper_share", "digit_share",
              "sign_share", "punct_share", "space_share", "line_words", "repeated_lines", "wide_share",
              "common_share", "bang_share", "bar_share")

_CLASS = np.zeros(256, np.int64)  # of a byte: 0 other, 1 upper, 2 digit, 3 sign, 4 punctuation, 5 space, 6 not ASCII
for _c in range(256):
    _s = chr(_c)
    _CLASS[_c] = (6 if _c >= 0x80 else 1 if "A" <= _s <= "Z" else 2 if _s.isdigit() else 3 if _s in "#*$%&|<>" else
                  5 if _s.isspace() else 4 if not _s.isalnum() and _s.isprintable() else 0)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, each of a bounded range."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    counts = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=7) if raw else np.zeros(7)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    some = max(1, n)
    return [math.log1p(n), min(30.0, sum(map(len, words)) / some), len(seen) / math.sqrt(some) / 10.0,
            sum(map(operator.eq, words, words[1:])) / some, counts[1] / size, counts[2] / size, counts[3] / size,
            counts[4] / size, counts[5] / size, math.log1p(n / max(1, len(lines))),
            1 - len(set(lines)) / len(lines) if lines else 0.0, counts[6] / size,
            max(seen.values(), default=0) / some, raw.count(b"!") / size, raw.count(b"|") / size]


def _measured(batches):
    for b in batches:
        rows = [statistics(t) for t in b.column("text").to_pylist()]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "x": pa.array(rows, pa.list_(pa.float64()))})


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every row."""
    return map_batches(id_text(docs, id_col, text_col), _measured, "doc_id long, x array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    low: float = 0.0
    high: float = 1.0
    curve: np.ndarray | None = None  # calibrated score by bin of the raw score
    constant: float = 0.5

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        rng, d = np.random.default_rng(SEED), len(self.mean)
        return rng.normal(size=(d, FEATURES)) / math.sqrt(d), rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, x: np.ndarray, projection) -> np.ndarray:
        """Random Fourier features and a constant of the standardised statistics."""
        w, shift = projection
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.column_stack([math.sqrt(2 / FEATURES) * np.cos(z @ w + shift), np.ones(len(x))])

    def bins(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(((raw - self.low) / (self.high - self.low) * BINS).astype(int), 0, BINS - 1)


def _matrix(column) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, len(STATISTICS)))


def _normal_equations(model: QualityModel):
    """Each partition's sums of z z' (upper half) and z y, as (index, value) rows."""
    def run(batches):
        projection, d = model.projection(), FEATURES + 1
        a, c = np.zeros((d, d)), np.zeros(d)
        for b in batches:
            z = model.features(_matrix(b.column("x")), projection)
            a += z.T @ z
            c += z.T @ b.column("y").to_numpy(zero_copy_only=False)
        upper = np.concatenate([a[np.triu_indices(d)], c])
        yield pa.record_batch({"k": pa.array(np.arange(len(upper), dtype=np.int32)), "v": pa.array(upper)})
    return run


def _binned(model: QualityModel):
    """Each partition's rows and label sums by bin of the raw score."""
    def run(batches):
        projection, n, y = model.projection(), np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            at = model.bins(model.features(_matrix(b.column("x")), projection) @ model.weights)
            n += np.bincount(at, minlength=BINS)
            y += np.bincount(at, b.column("y").to_numpy(zero_copy_only=False), BINS)
        yield pa.record_batch({"k": pa.array(np.arange(BINS, dtype=np.int32)), "n": pa.array(n), "y": pa.array(y)})
    return run


def isotonic(n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins with ``n`` rows and label sums ``y``; empty bins interpolate."""
    blocks: list[list[float]] = []  # first bin, last bin, rows, label sum
    for i in np.flatnonzero(n):
        blocks.append([i, i, n[i], y[i]])
        while len(blocks) > 1 and blocks[-2][3] / blocks[-2][2] >= blocks[-1][3] / blocks[-1][2]:
            _, last, rows, total = blocks.pop()
            blocks[-1][1:] = [last, blocks[-1][2] + rows, blocks[-1][3] + total]
    # a little smoothing keeps the order inside pure blocks and the values inside (0, 1)
    value = [(b[3] + 0.5) / (b[2] + 1.0) for b in blocks]
    at = [x for b in blocks for x in (b[0], b[1])]
    return np.maximum.accumulate(np.interp(np.arange(len(n)), at, np.repeat(value, 2)))


def fit_quality(measured: DataFrame, labels: DataFrame, label_col: str = "quality") -> QualityModel:
    """Fit on all labelled rows of ``labels`` whose statistics are in ``measured``."""
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
         .filter("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.avg("y").alias("y")))
    rows = stored(measured.join(y, "doc_id").select("x", "y"), "quality-training")
    sums = rows.select(F.count("*").alias("n"), F.sum("y").alias("y"), *[
        f(F.col("x")[i]).alias(f"{name}{i}") for i in range(len(STATISTICS))
        for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not sums["n"] or sums["y"] in (0.0, float(sums["n"])):
        return QualityModel(constant=sums["y"] / sums["n"] if sums["n"] else 0.5)
    d = range(len(STATISTICS))
    model = QualityModel(mean=np.array([sums[f"m{i}"] for i in d]), scale=np.array([max(sums[f"s{i}"], 1e-6) for i in d]))
    # (FEATURES + 1) * (FEATURES + 4) / 2 numbers whatever the corpus
    total = (map_batches(rows, _normal_equations(model), "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
             .toPandas().sort_values("k")["v"].to_numpy())
    n, a = FEATURES + 1, np.zeros((FEATURES + 1, FEATURES + 1))
    a[np.triu_indices(n)] = total[:-n]
    a = a + np.triu(a, 1).T
    model.weights = np.linalg.solve(a + RIDGE * sums["n"] * np.eye(n) / n, total[-n:])
    model.low, model.high = -0.25, 1.25
    by_bin = (map_batches(rows, _binned(model), "k int, n double, y double").groupBy("k")
              .agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toPandas().sort_values("k"))
    model.curve = isotonic(by_bin["n"].to_numpy(), by_bin["y"].to_numpy())
    return model


def _scored(model: QualityModel):
    def run(batches):
        projection = model.projection() if model.curve is not None else None
        for b in batches:
            x = _matrix(b.column("x"))
            if projection is None:
                score = np.full(len(x), model.constant)
            else:
                score = model.curve[model.bins(model.features(x, projection) @ model.weights)]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "score": pa.array(score.astype(float))})
    return run


def score_quality(measured: DataFrame, model: QualityModel) -> DataFrame:
    return map_batches(measured, _scored(model), "doc_id long, score double")


@query("op10_quality_model")
def op10_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    measured = stored(measure(table(spark, sf, "documents")), "quality-statistics")
    labels = table(spark, sf, "labels").filter(crc_mod(F.col("doc_id"), 3) != 1)
    return score_quality(measured, fit_quality(measured, labels)).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
