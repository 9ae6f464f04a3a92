"""Incremental landing scan (optional, §2.11): only pages landed since the last run.

The landing folder is consumed as a file stream (``trigger(availableNow=True)``,
progress in the given checkpoint folder) that only flattens and lands raw
listing rows: each micro-batch replaces its own ``batch=<id>`` folder, so a
retried batch lands once. The day is then cleaned and staged as a whole from
the landed rows and takes the place of what an earlier run staged for it, so
the result does not depend on how many files arrived when, how the stream was
cut into batches, or which runs failed. The cleaned day meets the daily run's checks
before it is staged. A file beside the landed rows names the batches that are staged;
it is written last, so a run that fails in between is made up for by the next one, new
pages or not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.plans.clean import clean_a, clean_b
from listingmart.plans.daily_run import A_KEY, B_KEY, checked
from listingmart.plans.snapshot import replace_day_b, stage_a
from listingmart.schemas import STG_A, STG_B
from listingmart.sources.listings import PAGE_A, PAGE_B, flatten_a, flatten_b
from listingmart.sources.store import TableStore


def stream_pages(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    """Landed page files as a stream (one row per page, ``_page`` = file path)."""
    return (spark.readStream.schema(schema).option("multiLine", True)
            .option("maxFilesPerTrigger", max_files).json(path)
            .withColumn("_page", F.col("_metadata.file_path")))


def landed_rows(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """All raw listing rows landed for one day."""
    page, flatten = (PAGE_A, flatten_a) if source == "a" else (PAGE_B, flatten_b)
    empty = spark.createDataFrame([], page).withColumn("_page", F.lit(""))
    return spark.read.schema(flatten(empty).schema).parquet(f"{folder}/batch=*")


def ingest_new_pages(spark: SparkSession, source: str, pages_path: str, warehouse: str,
                     ds: dt.date | str, lookups: dict, checkpoint: str) -> int:
    """Land every page of ``source`` ('a' or 'b') that came since the last run, then clean and stage the whole day.

    ``lookups``: for 'a' the six attribute lists; for 'b' keys experience,
    sector, function. ``checkpoint``: a lasting folder of this source and day.
    Returns the number of micro-batches landed in this run.
    """
    store = TableStore(spark, warehouse)
    schema, flatten = (PAGE_A, flatten_a) if source == "a" else (PAGE_B, flatten_b)
    folder = store.path(f"raw_{source}/ds={ds}")
    batches = []

    def land(pages: DataFrame, batch_id: int) -> None:
        flatten(pages).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        batches.append(batch_id)

    q = (stream_pages(spark, pages_path, schema).writeStream.foreachBatch(land)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    landed = sorted(n for n in store.names(folder) if n.startswith("batch="))
    if landed and store.note(f"{folder}/_staged") != ",".join(landed) or batches:
        rows = landed_rows(spark, source, folder)
        if source == "a":
            stage_a(store, checked(clean_a(rows, ds, lookups), STG_A, A_KEY, "cleaned A"))
        else:
            cleaned = clean_b(rows, ds, lookups["experience"], lookups["sector"], lookups["function"])
            replace_day_b(store, checked(cleaned, STG_B, B_KEY, "cleaned B"), ds)
        store.write_note(f"{folder}/_staged", ",".join(landed))
    return len(batches)
