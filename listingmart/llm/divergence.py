"""Operator 5: quality rules by distribution divergence.

A document's histogram of character classes and its histogram of common words
are compared with the references of every language by Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1); the nearest language counts,
so a document is never judged by a wrong language tag. Short texts have noisy
histograms: below ``MIN_CHARS`` or ``MIN_WORDS`` a comparison is not made.

References come from the corpus: a first pass counts the words of each language
(exactly, so the common words do not depend on how rows are dealt to partitions),
a second pass counts the common ones and the character classes in every document, and the references are the sums over all documents of a
language. A language gives references from ``REFERENCE_DOCS`` documents and
``REFERENCE_CHARS`` characters on, whatever its share of the corpus (for words:
from ``REFERENCE_WORDS`` words on). A document whose language has no reference
is not judged by divergence.

Defined results: NULL or empty text: no words, all counts 0, base_failed.
NULL lang: judged, but in no reference. No reference at all (empty table, all
lang NULL): only the base rules decide. Repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import map_batches, query, stored, table

COMMON_WORDS = 64
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 200_000
REFERENCE_DOCS, REFERENCE_CHARS, REFERENCE_WORDS = 20, 10_000, 1_000
MIN_WORDS, MIN_CHARS = 50, 300
MAX_WORD_DISTANCE, MAX_CLASS_DISTANCE = 0.50, 0.30
WINDOW = 8
_SYMBOLS = "#*$%&|<>"
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_CLASSES = 9
_CLASS = np.zeros(256, np.int64)  # of a UTF-8 byte; continuation bytes (8) do not count as characters
for _c in range(256):
    _s = chr(_c)
    _CLASS[_c] = (8 if 0x80 <= _c < 0xC0 else 7 if _c >= 0xC0 else 0 if "a" <= _s <= "z" else 1 if "A" <= _s <= "Z" else
                  2 if _s.isdigit() else 3 if _s == " " else 4 if _s.isspace() else 5 if _s in _SYMBOLS else 6)
#: Odd constants that spread word numbers over 64 bits (one per place of a window).
_SPREAD = np.random.default_rng(11).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of ``WINDOW`` words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number) + 1) for w in words], np.uint64)
    if len(number) == len(words):
        return 0
    ids, key = _mixed(ids), np.zeros(n, np.uint64)
    for j in range(WINDOW):
        key += _mixed(ids[j:j + n] * _SPREAD[j])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    starts = np.zeros(len(words) + 1, np.int64)
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    np.add.at(starts, at, 1)
    np.add.at(starts, at + WINDOW, -1)
    return int((np.cumsum(starts)[:-1] > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [x for x in text.split("\n") if _BLANK.sub("", x)]
    blank = sum(map(text.count, " \t\n\r\x0b\x0c"))
    return (len(words), len(text) - blank, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def _word_counts(batches):
    """(lang, word, count) of every word; a word may come in several parts, which a partition then adds up."""
    counts: dict[str, Counter] = {}

    def flush():
        for lang, c in counts.items():
            yield pa.record_batch({"lang": pa.array([lang] * len(c), pa.string()), "word": pa.array(list(c), pa.binary()),
                                   "n": pa.array(list(c.values()), pa.int64())})
        counts.clear()

    for b in batches:
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
            if text:
                counts.setdefault(lang, Counter()).update(text.lower().encode().split())
        if sum(map(len, counts.values())) > HELD_WORDS:
            yield from flush()
    yield from flush()


def _described(vocabulary: dict[bytes, int]):
    """Base counts, character classes and common-word counts of every document."""
    def run(batches):
        get = vocabulary.get
        for b in batches:
            base, classes, words, counts = [], [], [], []
            for text in b.column("text").to_pylist():
                base.append(base_counts(text))
                raw = (text or "").encode()
                classes.append(np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=_CLASSES)[:8])
                found = Counter(map(get, (text or "").lower().encode().split()))
                found.pop(None, None)
                words.append(list(found.keys()))
                counts.append(list(found.values()))
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "lang": b.column("lang"),
                **{name: pa.array([r[i] for r in base], pa.int64()) for i, name in enumerate(
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))},
                "classes": pa.array(classes, pa.list_(pa.int64())), "words": pa.array(words, pa.list_(pa.int32())),
                "counts": pa.array(counts, pa.list_(pa.int64()))})
    return run


def _histograms(b, size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Class counts and common-word counts (place ``size``: all other words) of a batch as (row, place, count > 0)."""
    n = len(b)
    classes = b.column("classes").flatten().to_numpy().reshape(n, 8)
    row, place = np.nonzero(classes)
    lists = b.column("words")
    rows = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    counts = b.column("counts").flatten().to_numpy()
    others = b.column("n_words").to_numpy() - np.bincount(rows, counts, n).astype(np.int64)
    more = np.flatnonzero(others)
    return [(row, place, classes[row, place]),
            (np.concatenate([rows, more]), np.concatenate([lists.flatten().to_numpy(), np.full(len(more), size)]),
             np.concatenate([counts, others[more]]))]


def _summed(size: int, langs: list[str]):
    """Each partition's reference sums: (row, place, sum) with row = language; common words follow the 8 classes."""
    def run(batches):
        sums: Counter = Counter()
        number, width = {x: i for i, x in enumerate(langs)}, 8 + size + 1
        for b in batches:
            if len(b):
                lang = np.array([number.get(x, -1) for x in b.column("lang").to_pylist()], np.int64)
                for (row, place, count), shift in zip(_histograms(b, size), (0, 8), strict=True):
                    known = lang[row] >= 0
                    code, at = np.unique(lang[row[known]] * width + place[known] + shift, return_inverse=True)
                    total = np.zeros(len(code), np.int64)
                    np.add.at(total, at, count[known])
                    for c, n in zip(code.tolist(), total.tolist(), strict=True):
                        sums[c] += n
        at = np.array(list(sums), np.int64)
        yield pa.record_batch({"lang": pa.array((at // width).astype(np.int32)), "place": pa.array((at % width).astype(np.int32)),
                               "n": pa.array(list(sums.values()), pa.int64())})
    return run


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of ``p`` to the distribution ``q``."""
    m = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)
    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _nearest(n: int, row: np.ndarray, place: np.ndarray, count: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Distance of each of ``n`` histograms to its nearest reference. Only places of the histogram are visited:
    at any other the reference's share q adds q * log2(q / (q / 2)) = q."""
    best = np.full(n, 1.0 if len(references) else 0.0)
    p = count / np.bincount(row, count, n)[row]
    for r in references:
        q = r[place] / r.sum()
        m = (p + q) / 2
        term = p * np.log2(p / m) + q * np.log2(np.where(q > 0, q, 1) / m) - q
        best = np.minimum(best, (np.bincount(row, term, n) + 1) / 2)
    return np.sqrt(np.clip(best, 0, 1))


def _distances(size: int, langs: list[str], references: np.ndarray):
    cuts = references[:, :8], references[:, 8:]
    enough = [c.sum(axis=1) >= least for c, least in zip(cuts, (1, REFERENCE_WORDS), strict=True)]
    known = [{None, *(x for x, e in zip(langs, has, strict=True) if e)} for has in enough]

    def run(batches):
        for b in batches:
            n = len(b)
            near, lang = np.zeros((2, n)), b.column("lang").to_pylist()
            if n:
                for k, h in enumerate(_histograms(b, size)):
                    near[k] = _nearest(n, *h, cuts[k][enough[k]])
            has = [np.array([x in some for x in lang], bool) for some in known]
            n_words = b.column("n_words").to_numpy()
            judged = np.array([has[1] & (n_words >= MIN_WORDS), has[0] & (b.column("word_chars").to_numpy() >= MIN_CHARS)])
            bad = (judged[0] & (near[1] > MAX_WORD_DISTANCE)) | (judged[1] & (near[0] > MAX_CLASS_DISTANCE))
            failed = (n_words < 20) | (100 * b.column("n_repeat_words").to_numpy() > 30 * n_words)
            yield pa.record_batch({
                **{c: b.column(c) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
                "base_failed": pa.array(failed), "kept": pa.array(~failed & ~bad),
                "class_distance": pa.array(near[0]), "word_distance": pa.array(near[1])})
    return run


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, verdict and the two distances of every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    by_lang = rows.filter("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    # one short row for each language of the corpus that has the evidence
    langs = sorted(r["lang"] for r in by_lang.filter(f"n >= {REFERENCE_DOCS} AND chars >= {REFERENCE_CHARS}").collect())
    found = (map_batches(rows.filter(F.col("lang").isin(langs)), _word_counts, "lang string, word binary, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    # at most COMMON_WORDS words a language
    common = found.withColumn("r", rank).filter(F.col("r") <= COMMON_WORDS).select("word").distinct().collect() if langs else []
    vocabulary = {w: i for i, w in enumerate(sorted(bytes(r["word"]) for r in common))}
    size = len(vocabulary)
    described = stored(map_batches(
        rows, _described(vocabulary), "doc_id long, lang string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, classes array<long>, words array<int>, counts array<long>"), "divergence")
    # (languages) x (common words + classes) numbers at most, however many documents
    sums = (map_batches(described, _summed(size, langs), "lang int, place int, n long")
            .groupBy("lang", "place").agg(F.sum("n").alias("n")).collect())
    references = np.zeros((len(langs), 8 + size + 1))
    for r in sums:
        references[r["lang"], r["place"]] = r["n"]
    return map_batches(described, _distances(size, langs, references),
                       "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                       "base_failed boolean, kept boolean, class_distance double, word_distance double")


@query("op5_divergence_rules")
def op5_divergence_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(table(spark, sf, "documents"))
