"""Sorting and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame


def page(df: DataFrame, order: list, size: int, number: int) -> DataFrame:
    """Page ``number`` (1-based) of ``size`` rows in ``order``.

    A global top-k: each task keeps its own first ``number * size`` rows, so
    only those reach the final merge, whatever the table size.
    """
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def sort_values(df: DataFrame, order: list) -> DataFrame:
    """O2: a total sort (range-partitioned, distributed)."""
    return df.orderBy(*order)
