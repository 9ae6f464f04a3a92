"""Operator 6: best-fit packing of token sequences, by size classes.

A document's ids are cut only if they are longer than a sequence. Pieces are packed
by best fit decreasing:

* pieces are range-sorted by size and numbered, each range on its own; the driver
  sees the rows of each range and of each size, never a piece;
* sizes are at most a sequence, so it places whole classes of equal pieces, the
  largest first: gaps of ascending size take as many of a class as fit, what is
  left opens new sequences. This gives runs: so many pieces of a size from one number on, so
  many to a sequence, sequences from one number on, all at one place. Their number depends on
  the sizes alone, not on the pieces;
* every piece finds its run by its number, where it lies.

So a table is sorted once and read once more, however many ranges it has. Tables
are written to the shared folder, so a lost executor costs at most one step.

Defined results: NULL or empty text: one piece of the end id alone. NULL
doc_id: packed like any other. Repeated rows: each is a document. Equal sizes:
ordered by tag. Empty table: empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingmart.llm.common import id_text, map_batches, query, stored, table
from listingmart.llm.encoding import default_vocabulary, encoder, release

CAPACITY, END_ID = 2048, 0
#: Pieces of one range partition.
SWEEP_ROWS = 200_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, end_id: int, capacity: int):
    def run(batches):
        enc, tail = encoder(path), np.uint32(end_id).tobytes()
        for b in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = enc.encode(text) + tail
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, s in enumerate([0, *range(first, n, capacity)]):
                    e = first if k == 0 else s + capacity
                    doc.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(memoryview(ids)[4 * s:4 * e]))
            yield pa.record_batch({"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()),
                                   "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                                   "ids_crc32": pa.array(crc, pa.int64())})
    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
           end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): whole documents, or their pieces where longer than a sequence."""
    return map_batches(id_text(docs, id_col, text_col), _cut(vocabulary or default_vocabulary(), end_id, capacity), _PIECES)


def _bracket(counts: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Match gaps of a class with the largest documents of lower classes.

    ``counts``: (class, gaps, documents, least gap, largest document) in order; returns runs (gap class,
    first gap rank, document class, last document rank, documents, documents a gap). A gap takes as many
    documents of a run as surely fit, from the largest down.
    """
    stack, runs = [], []
    for part, gaps, items, least, widest in counts:
        at = 0
        while at < gaps and stack:
            low, n, size = stack[-1]
            each = max(1, least // size)
            take = min(n, (gaps - at) * each)
            runs.append((part, at, low, n - 1, take, each))
            at += -(-take // each)
            stack[-1] = (low, n - take, size)
            if n == take:
                stack.pop()
        if items:
            stack.append((part, items, widest))
    return runs


def _plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing of ``counts`` (size -> pieces).

    Returns runs (first piece, size, pieces a sequence, first sequence, offset) in order of their first piece, when
    pieces are numbered by ascending size; within a run, sequences follow each other.
    """
    first = dict(zip(sorted(counts), accumulate((counts[s] for s in sorted(counts)), initial=0)))
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences) that have it
    runs, opened = [], 0

    def fill(size: int, gap: int, held: list[tuple[int, int]], at: int, n: int) -> None:
        """Pieces ``at`` to ``at + n`` go into sequences with one gap."""
        each = gap // size
        for sequence, m in held:
            took = min(n, m * each)
            used = -(-took // each)
            if took:
                runs.append((at, size, each, sequence, capacity - gap))
            for start, k, rest in ((sequence, took // each, gap - each * size),  # full, partly filled and untouched ones
                                   (sequence + used - 1, int(took % each > 0), gap - took % each * size),
                                   (sequence + used, m - used, gap)):
                if k and rest:
                    gaps.setdefault(rest, []).append((start, k))
            at, n = at + took, n - took

    for size in sorted(counts, reverse=True):
        at, end = first[size], first[size] + counts[size]
        fitting = [(gap, sum(m for _, m in gaps[gap]), 0, gap, 0) for gap in sorted(gaps) if gap >= size]
        for gap, _, _, _, n, _ in _bracket([(0, 0, end - at, 0, size), *fitting]):
            fill(size, gap, gaps.pop(gap), at, n)
            at += n
        if at < end:
            new = -(-(end - at) // (capacity // size))
            fill(size, capacity, [(opened, new)], at, end - at)
            opened += new
    return sorted(runs)


def _place(runs: list[tuple[int, int, int, int, int]]):
    """Sequence and offset of pieces by ``_number``: a piece is of the last run that begins at its number or before."""
    first, size, each, sequence, offset = np.array(runs, np.int64).reshape(-1, 5).T

    def run(batches):
        release()
        for b in batches:
            number = b.column("_number").to_numpy()
            r = np.searchsorted(first, number, "right") - 1
            k = number - first[r]
            out = b.drop_columns(["_number"])
            yield (out.append_column("sequence_id", pa.array(sequence[r] + k // each[r], pa.int64()))
                   .append_column("offset", pa.array(offset[r] + k % each[r] * size[r], pa.int64())))
    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows with a length from 1 to ``capacity``) with sequence_id and offset."""
    tagged = stored(cut.withColumn("_tag", F.monotonically_increasing_id()), "packing-pieces")
    by = ["length", "_tag"]
    dealt = tagged.repartitionByRange(max(1, -(-tagged.count() // SWEEP_ROWS)), *by).sortWithinPartitions(*by).drop("_tag")
    place = F.monotonically_increasing_id()  # of range and row
    dealt = stored(dealt.withColumns({"_range": F.shiftright(place, 33), "_row": place.bitwiseAND((1 << 33) - 1)}), "packing-sorted")
    # ranges hold ascending sizes: at most ``capacity`` rows and one for each range partition
    rows, counts = Counter(), Counter()
    for part, size, n in dealt.groupBy("_range", "length").count().collect():
        rows[part] += n
        counts[size] += n
    parts = sorted(rows)
    bases = pa.table({"_range": pa.array(parts, pa.int64()),
                      "_base": pa.array([*accumulate((rows[p] for p in parts), initial=0)][:-1], pa.int64())})
    numbered = dealt.join(F.broadcast(cut.sparkSession.createDataFrame(bases)), "_range")
    numbered = numbered.select(*cut.columns, (F.col("_base") + F.col("_row")).alias("_number"))
    placed = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_batches(numbered, _place(_plan(counts, capacity)), placed)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(pieces(table(spark, sf, "documents")))
