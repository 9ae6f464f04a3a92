"""Keys: the hashed job key (M10), surrogate keys (M7) and unknown members (M8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingmart.functions.text import concat_as_string, first_word_lower, md5_hex8
from listingmart.schemas import UNKNOWN, UNKNOWN_ID
from listingmart.session import cut_lineage

JOB_KEY_COLUMNS = ["title", "company", "datetime_published"]


def job_key_expr(cols: list[str], hex_digits: int = 8):
    """lower(first title word) + '-' + first hex digits of md5 of the columns as text.

    NULLs render as ``None`` (T7); a NULL title gives a NULL key. Pass
    ``hex_digits=32`` for the full digest (T8: 8 digits can collide at scale).
    """
    return F.concat(first_word_lower("title"), F.lit("-"),
                    md5_hex8(concat_as_string(*cols), hex_digits))


def job_key(df: DataFrame, extra: list[str] | None = None, out: str = "job_id",
            hex_digits: int = 8) -> DataFrame:
    """M10 on a frame; ``extra`` columns are appended to title, company, publication time."""
    cols = JOB_KEY_COLUMNS + list(extra or [])
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{missing} not in the input DataFrame")
    return df.withColumn(out, job_key_expr(cols, hex_digits))


def assign_keys(new_members: DataFrame, natural_key: list[str], id_col: str,
                start: int | DataFrame = 0, group: str | None = None) -> DataFrame:
    """M7: dense, repeatable surrogate keys ``start + 1, start + 2, ...`` by natural key.

    ``new_members`` must be distinct on ``natural_key`` (within ``group``). The
    members are range-partitioned and sorted in parallel; each partition
    numbers its own rows and a per-partition count (one row per partition and
    group) gives the offsets, so no single task sees all members.

    ``start``: an int, or a DataFrame holding the current keys (one column, or
    with ``group``: columns ``group`` and ``id_col``, numbered per group).
    With ``group``, each group (e.g. one dimension of several) is numbered on
    its own, all groups in one pass.
    """
    keys = ([group] if group else []) + list(natural_key)
    g = [group] if group else []
    # No fixed partition count: AQE sizes the range partitions (contiguous ranges
    # are merged, so partition order is still key order).
    ordered = (new_members.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = cut_lineage(ordered.withColumn("_pid", F.shiftright("_mid", 33))
                          .withColumn("_local", F.col("_mid").bitwiseAND((1 << 33) - 1)))
    # One row per (partition, group): count and first local index of the group there.
    counts = ordered.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    if group:
        if isinstance(start, DataFrame):
            base = start.groupBy(group).agg(F.greatest(F.max(id_col), F.lit(0)).alias("_base"))
            offsets = offsets.join(base, group, "left")
        else:
            offsets = offsets.withColumn("_base", F.lit(int(max(start, 0))))
        offsets = offsets.withColumn("_base", F.coalesce("_base", F.lit(0)))
    else:
        if isinstance(start, DataFrame):
            # One scalar (the current maximum key) comes back to the driver.
            start = start.agg(F.max(start.columns[0])).first()[0] or 0
        offsets = offsets.withColumn("_base", F.lit(int(max(start, 0))))
    # ``offsets`` has one row per partition and group: bounded by partitions x groups.
    out = ordered.join(F.broadcast(offsets.select("_pid", *g, "_off", "_first", "_base")), ["_pid", *g])
    return (out.withColumn(id_col, (F.col("_base") + F.col("_off") + F.col("_local") - F.col("_first") + 1)
                           .cast("long"))
            .drop("_mid", "_pid", "_local", "_off", "_base", "_first"))


def seed_unknown(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """M8: the one-row unknown member: id -1 and the unknown label in every text column."""
    row = []
    for f in schema.fields:
        if isinstance(f.dataType, (T.LongType, T.IntegerType)):
            row.append(UNKNOWN_ID)
        else:
            row.append(UNKNOWN)
    return spark.createDataFrame([tuple(row)], schema)
