"""Registry of the analogue queries: shared helpers and run parameters.

Registered queries: every operator of the inventory run on the supplied tables.

The supplied tables hold no job listings, so each operator runs on an
analogue (SURVEY §7.5) over whole tables: part names stand in for labels,
orders for listings, events for cumulative counters, documents for texts.
Each key has a Spark implementation that calls the library operator and,
where SQL can express it, an equivalent DuckDB query (``ORACLE``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.session import checkpoint_dir
from listingmart.sources.store import TableStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def iso_date(c):
    """Dates leave the registered queries as ISO text, so any engine's compare agrees."""
    return F.date_format(c, "yyyy-MM-dd")


def with_iso_dates(df: DataFrame) -> DataFrame:
    from pyspark.sql import types as T
    return df.select(*[iso_date(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DateType)
                       else F.col(f.name) for f in df.schema.fields])


# Run parameters of the analogues (fixed dates inside the supplied tables' ranges).
EVENTS_DS = "2024-01-20"
ORDERS_DS = "1998-08-02"
RUN_DS = "2025-06-02"


def _iso_sql(sql: str, cols: list[str]) -> str:
    rep = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql})"


def _scratch_store(spark) -> TableStore:
    """A private table store under the cluster's shared checkpoint folder."""
    return TableStore(spark, f"{checkpoint_dir(spark)}/analogue-store/{uuid.uuid4().hex}")


def _joined(c, sep="|"):
    return F.array_join(c, sep, "NULL")
