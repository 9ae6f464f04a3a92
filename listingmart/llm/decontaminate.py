"""Operator 8: benchmark decontamination by q-gram lemma filtering.

Texts are compared as lower-case letters and digits with single spaces. Each
benchmark item is cut into overlapping windows of ``WINDOW`` characters, one
every ``STRIDE``, so that every fragment of ``WINDOW + STRIDE - 1`` characters
holds one; an occurrence of a window with at most k edits shares at least
m - q + 1 - k*q of its q-grams, all within a band of k diagonals. Shared q-grams
are counted in bands of two steps that overlap by one step (no less than k), so
one band holds them all; bands that reach the bound are verified by a banded
alignment, and a document is contaminated by an item if one of its windows occurs.

An item of fewer than ``WHOLE`` characters may have a place that all its windows
share. It is tested as a whole, too, with the edits of one replaced word (w: a
fifth of the item, ``WORD`` at most) and up to ``APART`` elsewhere: the word
breaks w + q - 1 neighbouring q-grams, each edit elsewhere q.

The benchmark is a stated query set: it is taken in blocks of bounded size
(``BLOCK_CHARS``), each of which passes over all documents.

Defined results: NULL or empty text: clean. Items with fewer than ``LEAST``
compared characters match exactly, between word boundaries; items without a
letter or digit and NULL items match nothing.
Equal items count each by its own id. Repeated rows are judged alike. Empty
benchmark: every document is clean. Very long texts are searched in overlapping
pieces, without loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import id_text, map_batches, query, table

Q, WINDOW, STRIDE, ERROR_RATE, LEAST = 12, 64, 16, 0.05, 32
#: Below ``WHOLE`` compared characters an item is a pattern itself, with ``WORD`` edits in a row and ``APART`` others.
WHOLE, WORD, APART = 2 * WINDOW + STRIDE + 16, 16, 2
#: Diagonals a band advances; at least the largest edit budget.
STEP = 20
BLOCK_CHARS = 4_000_000
#: Characters searched at once, and what neighbouring pieces of a long text share.
PIECE, OVERLAP = 1_000_000, 256
#: Zeros between texts searched together: more than a pattern and its bands.
GAP = WHOLE + 6 * STEP
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SIEVE_BITS = 20


def _table() -> np.ndarray:
    out = np.full(0x10000, 32, np.uint32)
    for i in range(0x10000):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


_PLAIN = _table()


def normalise(text: str | None) -> np.ndarray:
    """Code points of the lower-case letters and digits, runs of anything else as one space."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    plain = np.where(codes < 0x10000, _PLAIN[np.minimum(codes, 0xFFFF)], codes)
    blank = plain == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    plain = plain[keep]
    return plain[int(len(plain) > 0 and plain[0] == 32):len(plain) - int(len(plain) > 1 and plain[-1] == 32)]


def grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``Q`` characters from each place on."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    one = codes.astype(np.uint64)
    two = one[:-1] * _BASE + one[1:]
    four = two[:-2] * (_BASE ** np.uint64(2)) + two[2:]
    eight = four[:-4] * (_BASE ** np.uint64(4)) + four[4:]
    h = eight[:n] * (_BASE ** np.uint64(4)) + four[8:8 + n]
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """Windows of one block of benchmark items, the postings of their q-grams, and the short items."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.windows: list[tuple[int, np.ndarray]] = []
        whole: list[tuple[int, np.ndarray]] = []
        self.short: dict[str, list[int]] = {}
        for item, codes in items:
            if len(codes) < LEAST:
                self.short.setdefault(_plain(codes), []).append(item)
                continue
            if len(codes) < WHOLE:
                whole.append((item, codes))
            last = max(0, len(codes) - WINDOW)
            for start in sorted({*range(0, last, STRIDE), last}):
                self.windows.append((item, codes[start:start + WINDOW]))
        sizes = np.array([len(w) for _, w in self.windows], np.int64)
        self.budget = np.minimum((sizes * ERROR_RATE).astype(np.int64), np.maximum(0, (sizes - Q) // Q))
        self.bound = sizes - Q + 1 - self.budget * Q
        sizes = np.array([len(w) for _, w in whole], np.int64)
        word = np.minimum(sizes // 5, WORD)
        apart = np.clip((sizes - 2 * Q + 2 - word - Q) // Q, 0, APART)
        self.windows += whole
        self.budget = np.concatenate([self.budget, word + apart])
        self.bound = np.concatenate([self.bound, sizes - 2 * Q + 2 - word - apart * Q])
        assert STEP >= self.budget.max(initial=0)
        h = [grams(w) for _, w in self.windows]
        key = np.concatenate(h) if h else np.zeros(0, np.uint64)
        window = np.repeat(np.arange(len(h)), [len(x) for x in h])
        place = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, first = np.unique(key[order], return_index=True)
        self.first = np.concatenate([first, [len(key)]])
        self.window, self.place = window[order], place[order]
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[(self.key >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first diagonal) of the bands that reach their window's bound."""
        h = grams(codes)
        at = np.flatnonzero(self.sieve[(h >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
        k = np.searchsorted(self.key, h[at])
        k[k == len(self.key)] = 0
        hit = self.key[k] == h[at] if len(self.key) else np.zeros(len(at), bool)
        at, k = at[hit], k[hit]
        n = self.first[k + 1] - self.first[k]
        where = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        window, diagonal = self.window[where], np.repeat(at, n) - self.place[where]
        band = diagonal // STEP
        # each shared q-gram counts in the two bands that hold its diagonal; numbers are shifted to be positive
        both = np.concatenate([band, band - 1]) + WHOLE
        code, count = np.unique(np.concatenate([window, window]) * (len(codes) + 4 * WHOLE) + both, return_counts=True)
        window, band = code // (len(codes) + 4 * WHOLE), code % (len(codes) + 4 * WHOLE) - WHOLE
        full = count >= self.bound[window]
        return window[full], band[full] * STEP

    def verify(self, codes: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Whether each window occurs within its budget on the diagonals of its band (banded alignment, all at once)."""
        if not len(window):
            return np.zeros(0, bool)
        k = int(self.budget.max(initial=0))
        width, size = 2 * STEP + 2 * k, max(len(self.windows[w][1]) for w in window)
        pattern = np.full((len(window), size), 1, np.uint32)  # 1 stands in no text
        for i, w in enumerate(window):
            pattern[i, :len(self.windows[w][1])] = self.windows[w][1]
        length = np.array([len(self.windows[w][1]) for w in window])
        pad = size + width + WHOLE
        text = np.concatenate([np.full(pad, 2, np.uint32), codes, np.full(pad, 2, np.uint32)])
        base, ramp = diagonal - k + pad, np.arange(width)
        row, best = np.zeros((len(window), width), np.int64), np.full(len(window), size, np.int64)
        for i in range(size):
            same = text[(base + i)[:, None] + ramp] == pattern[:, i:i + 1]
            step = row + ~same
            step[:, :-1] = np.minimum(step[:, :-1], row[:, 1:] + 1)
            row = np.minimum.accumulate(step - ramp, axis=1) + ramp
            over = length == i + 1
            best[over] = row[over].min(axis=1)
        return best <= self.budget[window]


def _plain(codes: np.ndarray) -> str:
    """Compared characters as text between two spaces: an occurrence begins and ends at word boundaries."""
    return f" {codes.astype('<u4').tobytes().decode('utf-32-le', 'surrogatepass')} "


def _short_automaton(index: Index):
    import ahocorasick
    auto = ahocorasick.Automaton()
    for text, ids in index.short.items():
        auto.add_word(text, ids)
    auto.make_automaton()
    return auto


def matches(index: Index, texts: list[str | None]) -> list[set[int]]:
    """The items that occur in each text. Texts are searched together, ``GAP`` zeros apart, so that no band
    reaches from one into another; very long ones in overlapping pieces."""
    items: list[set[int]] = [set() for _ in texts]
    short = _short_automaton(index) if index.short else None
    group: list[tuple[int, np.ndarray]] = []

    def search():
        sizes = np.array([len(c) + GAP for _, c in group])
        starts = GAP + np.concatenate([[0], np.cumsum(sizes)[:-1]])
        joined = np.zeros(int(sizes.sum()) + GAP, np.uint32)
        for (_, c), s in zip(group, starts, strict=True):
            joined[s:s + len(c)] = c
        window, diagonal = index.candidates(joined)
        owner = np.searchsorted(starts, diagonal + GAP - 2 * STEP, "right") - 1
        for i in range(0, len(window), 512):
            ok = index.verify(joined, window[i:i + 512], diagonal[i:i + 512])
            for o, w in zip(owner[i:i + 512][ok].tolist(), window[i:i + 512][ok].tolist(), strict=True):
                items[group[o][0]].add(index.windows[w][0])
        group.clear()

    size = 0
    for i, text in enumerate(texts):
        codes = normalise(text)
        if short:
            for _, ids in short.iter(_plain(codes)):
                items[i].update(ids)
        for s in range(0, max(1, len(codes) - OVERLAP), PIECE):
            group.append((i, codes[s:s + PIECE + OVERLAP]))
            size += len(group[-1][1])
            if size >= PIECE:
                search()
                size = 0
    if group:
        search()
    return items


def _annotate(block):
    """Adds the items of one block to the row's list."""
    def run(batches):
        for b in batches:
            found = matches(block.value, b.column("text").to_pylist())
            items = [sorted({*old, *new}) for old, new in zip(b.column("items").to_pylist(), found, strict=True)]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text": b.column("text"),
                                   "items": pa.array(items, pa.list_(pa.int64()))})
    return run


def _clean(block, text_col: str):
    """Keeps whole rows in which no item of one block occurs."""
    def run(batches):
        for b in batches:
            found = matches(block.value, b.column(b.schema.names.index(text_col)).to_pylist())
            yield b.filter(pa.array([not x for x in found], pa.bool_()))
    return run


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The benchmark as indexes of at most ``BLOCK_CHARS`` compared characters (a longer item: alone)."""
    items, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    for r in rows.filter("item IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        codes = normalise(r["text"])
        if not len(codes) or (codes == 32).all():
            continue
        if items and size + len(codes) > BLOCK_CHARS:
            yield Index(items)
            items, size = [], 0
        items.append((r["item"], codes))
        size += len(codes)
    if items:
        yield Index(items)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, items) of every row: the benchmark items that occur in it."""
    rows = id_text(docs, id_col, text_col).withColumn("items", F.array().cast("array<bigint>"))
    for index in blocks(benchmark):
        block = docs.sparkSession.sparkContext.broadcast(index)  # bounded by BLOCK_CHARS
        rows = map_batches(rows, _annotate(block), "doc_id long, text string, items array<long>")
    return rows.select("doc_id", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item occurs."""
    for index in blocks(benchmark):
        block = docs.sparkSession.sparkContext.broadcast(index)  # bounded by BLOCK_CHARS
        docs = map_batches(docs, _clean(block, text_col), docs.schema)
    return docs


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").alias("n_items"), "items")
