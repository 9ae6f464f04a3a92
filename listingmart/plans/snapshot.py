"""Staging upserts (K2, K3) and the exploded daily snapshots.

Staging tables are partitioned by ``date_scraped``; a day's snapshot reads
one partition (partition pruning, S13/P3).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions.arrays import (coalesce_unknown, coalesce_unknown_array, location_parts,
                                          lockstep_unnest)
from listingmart.functions.text import split_location, unicode_repair
from listingmart.operators.merge import upsert
from listingmart.schemas import (STG_A, STG_A_KEYS, STG_A_UPDATE, STG_B, STG_B_KEYS, STG_B_UPDATE)
from listingmart.sources.store import TableStore

#: Staging rows of one partition of a snapshot.
DEALT_ROWS = 50_000
A_ARRAYS = ["location", "job_level", "function", "contract_type", "education_level", "experience_years"]
B_SCALARS = ["company", "function", "city", "state", "region", "country", "job_level", "sector",
             "education_level", "experience_years", "work_mode", "job_source"]


def stage_a(store: TableStore, cleaned: DataFrame) -> None:
    """K2 (+T21): upsert source A's day into staging A, keyed by job_id only.

    A re-scraped job moves to the new ``date_scraped``: the table's locator tells which
    dates hold one of today's jobs; those and today's own are rewritten and published together.
    """
    store.upsert_located("stg_emploitic", STG_A, STG_A_KEYS, "date_scraped", cleaned, STG_A_UPDATE)


def stage_b(store: TableStore, cleaned: DataFrame, ds, null_safe: bool = False) -> None:
    """K3: upsert source B's day into staging B; only the ``ds`` partition is touched.

    ``null_safe=False`` keeps the reference's rule that NULL key parts never
    conflict (T9): re-running a day appends such rows again.
    """
    name = "stg_emploi_partner"
    target = store.read_partition(name, STG_B, "date_scraped", _py_date(ds))
    merged = upsert(target, cleaned, STG_B_KEYS, STG_B_UPDATE, null_safe=null_safe)
    store.overwrite_partitions(name, merged, "date_scraped")


def replace_day_b(store: TableStore, cleaned: DataFrame, ds) -> None:
    """K3 for a whole cleaned day: it takes the place of the ``ds`` partition.

    Staging a day again, with more pages or after a failure, gives the same rows
    as staging it once, NULL key parts included.
    """
    day = cleaned.where(F.col("date_scraped") == F.lit(_py_date(ds)))
    store.overwrite_partitions("stg_emploi_partner", day, "date_scraped", reads_self=False)


def _py_date(ds) -> dt.date:
    if isinstance(ds, dt.datetime):
        return ds.date()
    if isinstance(ds, dt.date):
        return ds
    return dt.date.fromisoformat(str(ds))


def _dealt(stg_day: DataFrame) -> DataFrame:
    """A day's rows dealt out by job before they are exploded: a day is few and small files of many rows.

    What is grouped by job afterwards finds its rows together (staging's job_id is never NULL). As many
    partitions as the rows need, since those of a cached frame are not merged later.
    """
    return stg_day.repartition(max(1, -(-stg_day.count() // DEALT_ROWS)), "job_id")


def snapshot_a(stg_day: DataFrame, empty_too: bool = False) -> DataFrame:
    """S13 -> P6, P7 -> F14 -> F10 -> F11 -> F12.

    Six arrays are unnested in lockstep (T1), repaired, and the location is
    split into city (4th part from the end, T3), state and country.
    """
    df = _dealt(stg_day)
    for c in ["company", "sector", "work_mode", "job_source"]:
        df = df.withColumn(c, coalesce_unknown(c))
    for a in A_ARRAYS:
        df = df.withColumn(a, coalesce_unknown_array(a, empty_too=empty_too))
    df = lockstep_unnest(df, A_ARRAYS)
    for a in A_ARRAYS:
        df = df.withColumn(a, unicode_repair(a))
    parts = location_parts(split_location("location"))
    return df.select(
        "job_id", "title", "company", "sector", "job_level", "function", "contract_type",
        "education_level", "experience_years", "positions", "datetime_published", "is_anonymous",
        "work_mode", "job_source", "date_scraped", "location",
        parts["city"].alias("city"), parts["state"].alias("state"), parts["country"].alias("country"))


def snapshot_b(stg_day: DataFrame) -> DataFrame:
    """C4: S13 -> P6 (x12), P7 (empty too) -> F15 -> F10 on contract_type."""
    df = _dealt(stg_day)
    for c in B_SCALARS:
        df = df.withColumn(c, coalesce_unknown(c))
    df = df.withColumn("contract_type", F.explode(coalesce_unknown_array("contract_type", empty_too=True)))
    return df.withColumn("contract_type", unicode_repair("contract_type")).select(
        "job_id", "title", "company", "function", "city", "state", "region", "country", "job_level",
        "positions", "datetime_published", "expire_date", "sector", "contract_type",
        "education_level", "experience_years", "is_anonymous", "work_mode", "has_salary",
        "min_salary", "max_salary", "job_source", "date_scraped")


def read_day(store: TableStore, name: str, ds) -> DataFrame:
    schema = STG_A if name == "stg_emploitic" else STG_B
    return store.read_partition(name, schema, "date_scraped", _py_date(ds))
