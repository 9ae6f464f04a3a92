"""File scans that keep what they cannot use.

Landed pages are read as text, one page a file or one page a line, and parsed
with the source's schema; nothing that fails stops the scan or disappears. A
page that does not parse (truncated, another type), that has no list of listings, or
that repeats a page already read becomes a row of the rejects table, as does
a listing without a title or with a time that cannot be read, each with the file, the
reason and its text. What is left is what the strict checks of the daily run accept.
A file without a byte holds no page for Spark; the report's ``complete`` tells that one is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from listingmart.functions.dates import parse_timestamp

REJECTS = "file string, reason string, title string, raw string"


def scan_pages(spark: SparkSession, path: str, schema: T.StructType, list_col: str, lines: bool = False) -> DataFrame:
    """Every page under ``path``: ``_page`` (its file), ``_raw``, the schema's columns, ``_reason`` (NULL: usable).

    ``lines``: files hold one page a line, else one page each.
    """
    text = spark.read.option("wholetext", not lines).text(path).select(
        F.col("_metadata.file_path").alias("_page"), F.col("value").alias("_raw"))
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    pages = text.withColumn("_p", F.from_json("_raw", wide, options)).select("_page", "_raw", "_p.*")
    same = W.partitionBy(F.xxhash64("_raw"), F.xxhash64(F.lit(1), F.col("_raw"))).orderBy("_page")
    listed = F.col(f"`{list_col}`")
    unreadable = F.col("_corrupt").isNotNull() | F.col("_raw").isNull() | (F.trim("_raw") == "")
    return (pages.withColumn("_nth", F.row_number().over(same))
            .withColumn("_reason", F.when(unreadable, "unreadable page").when(listed.isNull(), "page without listings")
                        .when((F.col("_nth") > 1) & (F.size(listed) > 0), "repeated page"))
            .drop("_corrupt", "_nth"))


def usable_pages(scanned: DataFrame) -> DataFrame:
    """The pages that the flatteners take, ``_page`` among their columns."""
    return scanned.where(F.col("_reason").isNull()).drop("_raw", "_reason")


def rejected_pages(scanned: DataFrame) -> DataFrame:
    """Rejects table of the unusable pages."""
    return scanned.where(F.col("_reason").isNotNull()).select(
        F.col("_page").alias("file"), F.col("_reason").alias("reason"), F.lit(None).cast("string").alias("title"), F.col("_raw").alias("raw"))


def _row_reason(times: list[str]) -> Column:
    """Why a flattened listing cannot be used: the first time column is required, the others may be missing."""
    reason = F.when(F.col("title").isNull() | (F.trim("title") == ""), "no title").when(F.col(times[0]).isNull(), f"no {times[0]}")
    for c in times:
        reason = reason.when(F.col(c).isNotNull() & parse_timestamp(c).isNull(), f"unreadable {c}")
    return reason


def split_rows(rows: DataFrame, times: list[str]) -> tuple[DataFrame, DataFrame]:
    """(usable listings, rejects table of the others)."""
    judged = rows.withColumn("_reason", _row_reason(times))
    bad = judged.where(F.col("_reason").isNotNull())
    return (judged.where(F.col("_reason").isNull()).drop("_reason"),
            bad.select(F.col("_page").alias("file"), F.col("_reason").alias("reason"), "title",
                       F.to_json(F.struct(*[c for c in rows.columns if c != "_page"])).alias("raw")))


def scan_report(scanned: DataFrame, total: str, list_col: str) -> DataFrame:
    """S12 over a scan: the announced total, pages by their fate, listings in usable pages, and whether all came."""
    ok = F.col("_reason").isNull()
    size = F.size(F.coalesce(F.col(f"`{list_col}`"), F.array()))
    return scanned.agg(
        F.max(F.when(ok, F.expr(total))).cast("long").alias("announced_total"), F.count(F.lit(1)).cast("long").alias("pages_read"),
        F.count_if(~ok).cast("long").alias("pages_rejected"), F.coalesce(F.sum(F.when(ok, size)), F.lit(0)).cast("long").alias("rows_read"),
    ).withColumn("complete", F.coalesce(F.col("announced_total") == F.col("rows_read"), F.lit(False)))
