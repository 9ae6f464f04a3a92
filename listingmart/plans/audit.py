"""Constraint audit of the star schema (M11-M13): the reference's PK / UNIQUE /
NOT NULL / FK constraints, re-aimed as one report.

``star_report`` returns one row per (table, check) with the number of
violating rows; every count is 0 on a consistent store. Each check is a
grouped count or a left-anti join: distributed, no driver-side data. It reads
whole tables, so it is an audit job to run on demand, not part of the daily path
(whose inserts are anti-joined and whose keys are assigned once, by design).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.operators.checks import check_unique, orphans
from listingmart.schemas import (BRIDGES, DIM_LOCATION, FCT_DAILY, FCT_DAILY_KEYS, FCT_JOBS, LABEL_DIMS,
                                 LOCATION_KEYS, UNKNOWN_ID, bridge_schema, label_dim_schema)
from listingmart.sources.store import TableStore


def _row(table: str, check: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), "violations")


def star_report(store: TableStore) -> DataFrame:
    """One row per (table, check): unique keys and labels, NOT NULL keys,
    unknown member present, and no orphan references."""
    fact = store.read("fct_jobs", FCT_JOBS)
    parts = [_row("fct_jobs", "unique job_id", check_unique(fact, ["job_id"])),
             _row("fct_jobs", "job_id not null", fact.where(F.col("job_id").isNull()))]
    dims = {}
    for name, (id_col, label_col, _) in LABEL_DIMS.items():
        dim = dims[name] = store.read(name, label_dim_schema(name))
        parts += [_row(name, f"unique {id_col}", check_unique(dim, [id_col])),
                  _row(name, f"unique {label_col}", check_unique(dim, [label_col])),
                  _row(name, "unknown member missing", dim.where(F.col(id_col) == UNKNOWN_ID)
                       .agg(F.count(F.lit(1)).alias("n")).where("n = 0"))]
    loc = dims["dim_location"] = store.read("dim_location", DIM_LOCATION)
    parts += [_row("dim_location", "unique location_id", check_unique(loc, ["location_id"])),
              _row("dim_location", "unique (city, state, country)", check_unique(loc, LOCATION_KEYS)),
              _row("dim_location", "unknown member missing", loc.where(F.col("location_id") == UNKNOWN_ID)
                   .agg(F.count(F.lit(1)).alias("n")).where("n = 0"))]
    parts += [_row("fct_jobs", "company_id references dim_company",
                   orphans(fact, dims["dim_company"], ["company_id"])),
              _row("fct_jobs", "sector_id references dim_sector", orphans(fact, dims["dim_sector"], ["sector_id"]))]
    for name, (dim_name, id_col, _) in BRIDGES.items():
        br = store.read(name, bridge_schema(name))
        parts += [_row(name, f"unique (job_id, {id_col})", check_unique(br, ["job_id", id_col])),
                  _row(name, "job_id references fct_jobs", orphans(br, fact, ["job_id"])),
                  _row(name, f"{id_col} references {dim_name}", orphans(br, dims[dim_name], [id_col]))]
    daily = store.read("fct_job_performance_daily", FCT_DAILY)
    parts += [_row("fct_job_performance_daily", "unique (job_id, location_id, date)",
                   check_unique(daily, FCT_DAILY_KEYS)),
              _row("fct_job_performance_daily", "job_id references fct_jobs", orphans(daily, fact, ["job_id"])),
              _row("fct_job_performance_daily", "location_id references dim_location",
                   orphans(daily, loc, ["location_id"]))]
    return reduce(lambda a, b: a.unionByName(b), parts)
