"""De-duplication and "first per key" operators.

Every "first" needs a total order (T6): callers pass order columns, normally
``(published desc, page, position)`` carried from the scan, and a hash of the
row breaks any remaining tie so results are repeatable.

Skew: a key may hold a large share of the rows. ``first_per_key`` uses
``row_number() = 1``, which Catalyst plans as a partial ``WindowGroupLimit``
before the exchange (each map task ships at most one row per key); the merge
and report operators are plain aggregates with partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.StructType, T.MapType)


def atomic_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Columns usable as de-duplication keys (not array, struct or map)."""
    exclude = set(exclude or [])
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, _NESTED) and f.name not in exclude]


def _order_cols(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def tie_breaker(df: DataFrame) -> Column:
    """A hash of the whole row, the last resort of every total order."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the first row per key by ``order`` (DISTINCT ON).

    ``order`` items are column names or sort expressions, e.g.
    ``F.col("expire_date").asc_nulls_last()`` for A4 (T5).
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order), tie_breaker(df))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def drop_exact_duplicates(df: DataFrame, order: list, subset: list[str] | None = None) -> DataFrame:
    """A5: keep the first of the rows equal on the atomic columns (NULLs equal).

    Order columns (source position) are excluded from the comparison.
    """
    order_names = [o for o in order if isinstance(o, str)]
    subset = subset or atomic_columns(df, exclude=order_names)
    w = Window.partitionBy(*subset).orderBy(*_order_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_non_null(c: str, pos: Column) -> Column:
    """First non-NULL value of ``c`` by ``pos`` inside an aggregate (pandas ``first``)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), pos))


def merge_duplicates(df: DataFrame, keys: list[str], sums: list[str], pos: Column | str,
                     count_col: str | None = None) -> DataFrame:
    """One row per key (NULL is a group): first non-NULL of every other column, sums.

    Sums of all-NULL groups are 0, as in the reference's frame library (T13).
    Every aggregate is partial-aggregable, so a hot key is reduced map-side.
    """
    pos_names = [pos] if isinstance(pos, str) else []
    pos = F.col(pos) if isinstance(pos, str) else pos
    others = [c for c in df.columns if c not in keys and c not in sums and c not in pos_names]
    aggs = [first_non_null(c, pos).alias(c) for c in others]
    aggs += [F.coalesce(F.sum(c), F.lit(0)).cast(df.schema[c].dataType).alias(c) for c in sums]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*keys).agg(*aggs).select(
        *[c for c in df.columns if c not in pos_names], *([count_col] if count_col else []))


def duplicate_report(df: DataFrame, keys: list[str], exact_subset: list[str] | None = None) -> DataFrame:
    """One row: rows before, exact duplicates, rows after merge, merged duplicates.

    merged duplicates = sum of counts over groups larger than one minus the
    number of such groups.
    """
    exact_subset = exact_subset or atomic_columns(df)
    n = F.count(F.lit(1)).alias("n")
    counts = (df.groupBy(*exact_subset).agg(n).select(F.lit("exact").alias("kind"), "n")
              .unionByName(df.groupBy(*keys).agg(n).select(F.lit("key").alias("kind"), "n")))
    is_key, is_exact = F.col("kind") == "key", F.col("kind") == "exact"
    dup = is_key & (F.col("n") > 1)
    return counts.agg(
        F.coalesce(F.sum(F.when(is_key, F.col("n"))), F.lit(0)).cast("long").alias("rows_before"),
        F.coalesce(F.sum(F.when(is_exact, F.col("n") - 1)), F.lit(0)).cast("long")
        .alias("exact_duplicates"),
        F.count_if(is_key).cast("long").alias("rows_after_merge"),
        (F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)) - F.count_if(dup))
        .cast("long").alias("merged_duplicates"),
    )


def distinct_members(df: DataFrame, cols: list[str], drop_nulls: bool = True) -> DataFrame:
    """A1/A2: distinct values (or value tuples) of dimension members.

    With ``drop_nulls`` a member with any NULL part is dropped (P5).
    """
    out = df.select(*cols)
    if drop_nulls:
        out = out.dropna(how="any", subset=cols)
    return out.distinct()


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their counts (empty = unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
