"""Operator 1: token ids of every document in ORC files.

One row per document: integer run-length encoded ids, row indexes every
``ROW_INDEX`` rows and Bloom filters on the document id, so that a reader of
some ids skips whole stripes and row groups from metadata, and stripes of one
file can be read by different tasks.

The documents are range-sorted by (doc_id, hash of the text), so no id, however
often it repeats, has to fit one task. Each task is a shard; a row stores its
start within the shard, and the shard totals (one row per shard) give the
start within the whole corpus.

Defined results: NULL or empty text: only the end id. NULL doc_id: sorts
first. Repeated ids: each row is a document of its own, ordered by a hash of
its text. Empty table: no files' rows, empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import id_text, map_batches, offsets_by, query, scratch_path, table
from listingmart.llm.encoding import default_vocabulary, encoder, pooled

#: Rows of one row group of the index.
ROW_INDEX = 1000
STRIPE_BYTES = 64 * 1024 * 1024
SCHEMA = "shard int, shard_start long, doc_id long, n_tokens int, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        enc, shard, at = encoder(path), TaskContext.get().partitionId(), 0
        for pool in pooled(batches):
            ids, begin = enc.encode_all(pa.concat_arrays([b.column("text") for b in pool]))
            row = 0
            for b in pool:
                bounds = begin[row:row + b.num_rows + 1]
                row += b.num_rows
                offsets = bounds - bounds[0] + np.arange(len(bounds))  # the end ids of the rows before
                n = np.diff(offsets)
                values = np.insert(ids[bounds[0]:bounds[-1]], bounds[1:] - bounds[0], end_id).view(np.int32)
                yield pa.record_batch({
                    "shard": pa.array(np.full(len(n), shard, np.int32)), "shard_start": pa.array(at + offsets[:-1]),
                    "doc_id": b.column("doc_id"), "n_tokens": pa.array(n.astype(np.int32)),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))})
                at += int(offsets[-1])
    return run


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 2) -> None:
    """Encode whole texts and write them in ascending id order as ORC files under ``path``."""
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    (map_batches(dealt, _encode(vocabulary or default_vocabulary(), end_id), SCHEMA).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(ROW_INDEX))
     .option("orc.stripe.size", str(STRIPE_BYTES)).orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, shard, shard_start, n_tokens, ids); ids given: only those, pruned by index and Bloom filter."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def _digest(batches):
    for b in batches:
        ids = b.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy().astype("<u4")
        crc = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.record_batch({
            "shard": b.column("shard"), "shard_start": b.column("shard_start"), "doc_id": b.column("doc_id"),
            "n_tokens": pa.array(np.diff(offsets).astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64())})


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32."""
    rows = read_tokens(spark, path)
    totals = offsets_by(rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")), "shard", "n")
    digest = map_batches(rows.select("shard", "shard_start", "doc_id", "ids"), _digest,
                         "shard int, shard_start long, doc_id long, n_tokens long, ids_crc32 long")
    # one row per shard: bounded by the number of write tasks
    return digest.join(F.broadcast(totals), "shard").select(
        "doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


@query("op1_token_orc")
def op1_token_orc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), path)
    return token_digest(spark, path)
