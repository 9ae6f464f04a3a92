"""Helpers shared by the corpus operators of this subpackage.

Every operator takes a DataFrame and the names of its id and text columns,
projects to those two first (other columns, whatever their names, never meet
an internal name) and returns a new DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingmart.session import checkpoint_dir

#: Rows of one Arrow batch handed to a Python worker (Spark bounds its bytes as well).
BATCH_ROWS = 500

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a corpus query, with its DuckDB SQL where SQL can express it."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (string; NULL stays NULL) of each row."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches small enough for a worker's memory.

    Workers started from another folder find this package by the driver's path
    (on a cluster: an installed package or ``--py-files``).
    """
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of this application."""
    return f"{checkpoint_dir(spark)}/corpus/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (cuts the lineage)."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(id_column: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (NULL id: the text is empty)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % n


def offsets_by(totals: DataFrame, key: str, value: str) -> DataFrame:
    """Exclusive running sums of per-partition totals: one row per partition, so one task is enough."""
    from pyspark.sql import Window
    w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long").alias("base"))
