"""Data checks: keys, NULLs, references, types, columns, gates, page reports.

(A16, M11-M14, P11, P18, S12.) Each check returns a small DataFrame of
violations (or one report row) computed by Spark; ``assert_empty`` turns a
violation frame into an exception by fetching at most a few example rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingmart.operators.dedup import check_unique

__all__ = ["check_unique", "check_not_null", "orphans", "check_schema", "require_columns",
           "has_rows", "page_report", "assert_empty"]


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the number of NULLs per column (all zero = passes)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str],
            parent_keys: list[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row (left-anti join)."""
    parent_keys = parent_keys or child_keys
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)]).distinct()
    c = child.dropna(subset=child_keys)
    return c.join(p, child_keys, "left_anti")


def check_schema(df: DataFrame, expected: dict[str, T.DataType]) -> list[str]:
    """Names of columns whose type differs from the expected one (driver-side, no job)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return [c for c, t in expected.items() if c not in actual or actual[c] != t]


def require_columns(df: DataFrame, cols: list[str]) -> None:
    """Raise if a named column is absent (driver-side, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{missing} not in the input DataFrame")


def has_rows(df: DataFrame) -> bool:
    """The batch is non-empty (reads at most one row)."""
    return not df.isEmpty()


def page_report(pages: DataFrame, total_col: str, rows_col: str, by: list[str] | None = None) -> DataFrame:
    """Announced total vs rows actually read, per listing (``by``) or overall.

    ``pages`` has one row per page with the announced total and an array of
    rows; a mismatch means pages were lost or the listing moved while paging.
    """
    return pages.groupBy(*(by or [])).agg(
        F.max(total_col).cast("long").alias("announced_total"),
        F.count(F.lit(1)).cast("long").alias("pages_read"),
        F.coalesce(F.sum(F.size(rows_col)), F.lit(0)).cast("long").alias("rows_read"),
    ).withColumn("complete", F.col("announced_total") == F.col("rows_read"))


def assert_empty(violations: DataFrame, what: str) -> None:
    sample = violations.take(5)
    if sample:
        raise AssertionError(f"{what}: {sample}")
