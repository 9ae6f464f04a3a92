"""Cumulative counters -> daily changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingmart.functions.dates import _date_lit, days_between
from listingmart.operators.lookup import fits, small_side


def history_totals(history: DataFrame, today: DataFrame, keys: list[str], metrics: list[str],
                   date_col: str, ds, since=None) -> DataFrame:
    """A10 + J6: per key, the sum of earlier daily changes, only for keys seen today.

    The history is restricted to dates before ``ds`` (pruned on the partition
    column) and semi-joined to today's keys, so a duplicate row today cannot
    multiply the sums (T11). Sums of all-NULL histories stay NULL (T13).
    """
    hist = history.where(F.col(date_col) < _date_lit(ds))
    if since is not None:  # no history row of today's keys can be older (partition pruning)
        hist = hist.where(F.col(date_col) >= _date_lit(since))
    today_keys = today.select(*keys).distinct()
    if fits(today_keys):  # a day's keys, proven bounded: filter the history map-side
        today_keys = F.broadcast(today_keys)
    active = hist.join(today_keys, keys, "left_semi")
    return active.groupBy(*keys).agg(*[F.sum(m).alias(f"_{m}_total") for m in metrics])


def counter_delta(today: DataFrame, history: DataFrame, keys: list[str], metrics: list[str],
                  ds, date_col: str = "date", published_col: str | None = None, since=None) -> DataFrame:
    """today's change = today's cumulative value - sum of earlier changes.

    No history -> today's value; NULL today -> NULL; no clamping (T12).
    Output: keys, ``date_col`` (= ds), metrics, and ``days_since_published``
    (W4) when ``published_col`` is given. ``since`` (optional) is a date no
    history row of today's keys can precede, e.g. their earliest publication:
    it prunes the history scan to the partitions that can matter.
    """
    totals = history_totals(history, today, keys, metrics, date_col, ds, since)
    j = today.join(totals, keys, "left")
    out = [*[F.col(k) for k in keys], _date_lit(ds).alias(date_col)]
    for m in metrics:
        out.append(F.coalesce(F.col(m) - F.col(f"_{m}_total"), F.col(m))
                   .cast(today.schema[m].dataType).alias(m))
    if published_col:
        out.append(days_between(_date_lit(ds), F.col(published_col)).alias("days_since_published"))
    return j.select(*out)


def counter_delta_full(cumulative: DataFrame, keys: list[str], order: str,
                       metrics: list[str]) -> DataFrame:
    """The same changes recomputed over the whole history.

    change = value - last earlier non-NULL value (0 if none); equal to W2 run
    day by day (telescoping), and also correct after a past day is re-run.
    One row per key and day, so a window partition is bounded by the number
    of days.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = cumulative
    for m in metrics:
        prev = F.last(F.col(m), ignorenulls=True).over(w)
        out = out.withColumn(m, (F.col(m) - F.coalesce(prev, F.lit(0))).cast(cumulative.schema[m].dataType))
    return out


def counter_delta_interval(batch: DataFrame, history: DataFrame, keys: list[str], metrics: list[str], start, end,
                           date_col: str = "date", published_col: str | None = None) -> DataFrame:
    """W2 for every day from ``start`` to ``end`` in one plan, later days repaired.

    ``batch``: cumulative values, one row per key and day. ``history``: stored
    changes of any day, also of days in or after the interval. Returned are the
    batch's rows as changes and every stored row of the batch's keys from
    ``start`` on whose change is no longer right, so a late correction moves
    the first later day as well (T12). Stored days without a batch row keep
    their cumulative value. A key without earlier values starts at its own
    value; a NULL value has a NULL change; rows of the batch outside the interval are ignored.

    One exchange on the keys serves the sums by day and the windows; earlier
    history travels as one row per key, and a window holds one key's days
    since ``start``.
    """
    day, first, last = F.col(date_col), _date_lit(start), _date_lit(end)
    batch = batch.where(day.between(first, last))
    wanted = batch.select(*keys).distinct()
    if fits(wanted):  # proven bounded: the history is filtered map-side
        wanted = F.broadcast(wanted)
    stored = history.join(wanted, keys, "left_semi")
    none = F.lit(None)
    published = [F.col(published_col).cast("timestamp").alias("_published")] if published_col else []
    no_time = [none.cast("timestamp").alias("_published")] if published_col else []
    before = stored.where(day < first).groupBy(*keys).agg(*[F.sum(m).alias(f"_old_{m}") for m in metrics]).select(
        *keys, none.cast("date").alias(date_col), F.lit(False).alias("_new"),
        *[F.col(f"_old_{m}") for m in metrics], *[none.cast("long").alias(f"_val_{m}") for m in metrics], *no_time)
    since = stored.where(day >= first).select(
        *keys, date_col, F.lit(False).alias("_new"),
        *[F.col(m).cast("long").alias(f"_old_{m}") for m in metrics], *[none.cast("long").alias(f"_val_{m}") for m in metrics], *no_time)
    fresh = batch.select(
        *keys, date_col, F.lit(True).alias("_new"),
        *[none.cast("long").alias(f"_old_{m}") for m in metrics], *[F.col(m).cast("long").alias(f"_val_{m}") for m in metrics], *published)
    rows = before.unionByName(since).unionByName(fresh).repartition(*[F.col(k) for k in keys])
    by_day = rows.groupBy(*keys, date_col).agg(
        F.max("_new").alias("_new"),
        *[F.max(f"_{side}_{m}").alias(f"_{side}_{m}") for side in ("old", "val") for m in metrics],
        *([F.max("_published").alias("_published")] if published_col else []))
    in_order = Window.partitionBy(*keys).orderBy(day.asc_nulls_first())  # the row of earlier days comes first
    until, earlier = (in_order.rowsBetween(Window.unboundedPreceding, to) for to in (Window.currentRow, -1))
    for m in metrics:
        # a stored NULL change on a day is a day without a value
        held = F.when(F.col(f"_old_{m}").isNotNull(), F.sum(f"_old_{m}").over(until))
        by_day = by_day.withColumn(f"_now_{m}", F.when(F.col("_new"), F.col(f"_val_{m}")).otherwise(held))
    for m in metrics:
        previous = F.last(F.col(f"_now_{m}"), ignorenulls=True).over(earlier)
        by_day = by_day.withColumn(m, F.col(f"_now_{m}") - F.coalesce(previous, F.lit(0)))
    if published_col:
        by_day = by_day.withColumn("_published", F.max("_published").over(Window.partitionBy(*keys)))
    moved = F.lit(False)
    for m in metrics:
        moved = moved | ~F.col(m).eqNullSafe(F.col(f"_old_{m}"))
    out = [*keys, date_col, *[F.col(m).cast(batch.schema[m].dataType).alias(m) for m in metrics]]
    if published_col:
        out.append(days_between(day, F.col("_published")).alias("days_since_published"))
    return by_day.where(day.isNotNull() & (F.col("_new") | moved)).select(*out)


def metrics_location_join(staging_day: DataFrame, br_location: DataFrame,
                          dim_location: DataFrame) -> DataFrame:
    """J4 + J5: staging rows of one day -> (job, location) via the location bridge.

    The join is on job_id and all four location parts; NULL parts never match,
    so rows with an unknown place drop out (T10), as in the reference.
    """
    ids = staging_day.select("job_id").distinct()
    if fits(ids):  # only today's jobs' bridge rows are read past the scan
        br_location = br_location.join(F.broadcast(ids), "job_id", "left_semi")
    br_dim = br_location.join(small_side(dim_location), "location_id", "inner")
    return staging_day.join(br_dim, ["job_id", "city", "state", "region", "country"], "inner")
