"""Cleaning of each source's listing rows (C1 ``clean_a``, C2 ``clean_b``).

Both are one lazy DataFrame plan: de-duplicate, key, translate or look up
labels, standardise values, type, tag. The output matches the staging
schemas in ``schemas.STG_A`` / ``schemas.STG_B``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions.arrays import replace_in_array, replace_scalar, unwrap, wrap
from listingmart.functions.dates import _date_lit, parse_timestamp
from listingmart.functions.text import capitalize, french_titlecase, slash_to_comma, title_case
from listingmart.operators.dedup import (atomic_columns, drop_exact_duplicates, duplicate_report,
                                         first_per_key, merge_duplicates)
from listingmart.operators.keys import job_key
from listingmart.operators.lookup import label_translation, replace_ids
from listingmart.schemas import SOURCE_A, SOURCE_B, STG_A, STG_B
from listingmart.session import cut_lineage
from listingmart.sources.lookups import value_maps

# Source A attributes translated through a lookup list when not all in French.
A_TRANSLATED = ["location", "education_level", "experience_years", "function", "job_level", "sector"]
B_GROUP_KEYS = ["job_id", "country", "region", "state", "city"]

# "First" = arrival order of the source: newest publication first, then page, position.
def arrival_order(pub_col: str | None = None):
    pub = F.col(pub_col) if pub_col else parse_timestamp("datetime_published")
    return [pub.desc_nulls_last(), F.col("_page"), F.col("_pos")]


def arrival_rank(pub_col: str | None = None):
    """The same order as one struct, smallest first (for ``min_by`` inside aggregates)."""
    pub = F.col(pub_col) if pub_col else parse_timestamp("datetime_published")
    since_epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), pub)
    return F.struct(pub.isNull().alias("n"), (-since_epoch).alias("p"),
                    F.col("_page").alias("page"), F.col("_pos").alias("pos"))


def _apply_maps(df: DataFrame, maps: dict[str, dict[str, str]]) -> DataFrame:
    """replace whole values (scalars) or each element (arrays)."""
    from pyspark.sql import types as T
    for field, m in maps.items():
        if field not in df.columns:
            raise KeyError(f"{field} is not a column in the input DataFrame")
        if isinstance(df.schema[field].dataType, T.ArrayType):
            df = df.withColumn(field, replace_in_array(field, m))
        else:
            df = df.withColumn(field, replace_scalar(field, m))
    return df


def clean_a(rows: DataFrame, ds: dt.date | str, lookups: dict[str, DataFrame],
            lang: str = "fr", null_as_null_element: bool = True) -> DataFrame:
    """A5 -> M10 -> A6 -> P8 -> P2 -> C9 (x6) -> F19 -> F20/F21 -> F3 -> P8.

    ``rows`` is ``sources.listings.flatten_a`` output; ``lookups`` maps each of
    the six translated attributes to its (id, label) list.
    """
    # The publication time is parsed once: it orders "first" and becomes the typed column.
    rows = rows.withColumn("_pub", parse_timestamp("datetime_published"))
    order = arrival_order("_pub")
    # A5 then A6: rows equal on every atomic column share their job key, so the
    # first row per key (same order) is also first among its exact copies; one
    # window does both.
    df = job_key(rows)  # built on the raw publication text (T7)
    df = first_per_key(df, ["job_id"], order)
    df = df.withColumn("datetime_published", F.col("_pub"))
    # Materialise the day's de-duplicated rows once: the translation reads them twice.
    df = cut_lineage(df.drop("_page", "_pos", "_pub"))
    df = df.withColumn("date_scraped", _date_lit(ds))
    df = df.withColumn("sector", wrap("sector"))
    df = label_translation(df, "job_id",
                           {a: lookups[a] for a in A_TRANSLATED}, lang, null_as_null_element)
    df = df.withColumn("sector", unwrap("sector"))
    df = _apply_maps(df, value_maps("A"))
    df = df.withColumn("work_mode", capitalize("work_mode"))
    df = df.withColumn("job_source", F.lit(SOURCE_A))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STG_A.fields])


def clean_b(rows: DataFrame, ds: dt.date | str, experience: DataFrame, sector: DataFrame,
            function: DataFrame) -> DataFrame:
    """A5 -> M10 (+sector_id) -> A7 -> J10 x3 -> P8 -> P2 -> F5 -> F2, F1 -> F20/F21 -> F3.

    ``experience`` is (id, label); ``sector`` and ``function`` are (id, name).
    """
    subset = atomic_columns(rows, exclude=["_page", "_pos"])
    rows = rows.withColumn("_pub", parse_timestamp("datetime_published"))  # parsed once
    df = drop_exact_duplicates(rows, arrival_order("_pub"), subset)
    df = job_key(df, ["sector_id"])
    df = df.withColumn("_ord", arrival_rank("_pub")).drop("_pub")
    df = merge_duplicates(df.drop("_page", "_pos"), B_GROUP_KEYS, ["nb_views", "nb_applicants"], "_ord")
    df = replace_ids(df, experience, "experience_years_id", "id", "label", "experience_years")
    df = replace_ids(df, sector, "sector_id", "id", "name", "sector")
    df = replace_ids(df, function, "function_id", "id", "name", "function")
    df = df.withColumn("date_scraped", _date_lit(ds))
    for c in ["datetime_published", "expire_date"]:
        df = df.withColumn(c, parse_timestamp(c))
    df = df.withColumn("function", slash_to_comma("function")).withColumn("sector", slash_to_comma("sector"))
    df = df.withColumn("region", title_case("region"))
    for c in ["job_level", "experience_years", "function"]:
        df = df.withColumn(c, french_titlecase(c))
    df = _apply_maps(df, value_maps("B"))
    df = df.withColumn("work_mode", capitalize("work_mode"))
    df = df.withColumn("job_source", F.lit(SOURCE_B))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STG_B.fields])


def duplicate_report_b(rows: DataFrame) -> DataFrame:
    """A8 for source B: rows before, exact duplicates, rows after merge, merged duplicates."""
    subset = atomic_columns(rows, exclude=["_page", "_pos"])
    keyed = job_key(drop_exact_duplicates(rows, arrival_order(), subset), ["sector_id"])
    report = duplicate_report(keyed, B_GROUP_KEYS, subset)
    exact = duplicate_report(rows, subset, subset).select(
        F.col("rows_before").alias("rows_in"), F.col("exact_duplicates").alias("exact_in"))
    return exact.unionByName(report, allowMissingColumns=True).agg(
        F.max("rows_in").alias("rows_before"), F.max("exact_in").alias("exact_duplicates"),
        F.max("rows_after_merge").alias("rows_after_merge"),
        F.max("merged_duplicates").alias("merged_duplicates"))
