"""Date and time windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from listingmart.functions.util import as_col


def _date_lit(ds) -> Column:
    if isinstance(ds, Column):
        return ds.cast("date")
    if isinstance(ds, dt.datetime):
        ds = ds.date()
    return F.lit(ds).cast("date") if isinstance(ds, dt.date) else F.to_date(F.lit(str(ds)))


def _midnight(ds) -> Column:
    return _date_lit(ds).cast("timestamp_ntz")


def truncate_day(c) -> Column:
    """timestamp -> midnight of the same day."""
    return F.date_trunc("day", as_col(c)).cast("timestamp_ntz")


_EPOCH = "1970-01-01 00:00:00"


def epoch_millis(c) -> Column:
    """a wall-clock timestamp -> milliseconds since the epoch, read as UTC
    whatever the session time zone (truncated, as the reference's int())."""
    us = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), as_col(c).cast("timestamp_ntz"))
    return F.floor(us / 1000).cast("long")


def date_sub_days(ds, days: int) -> Column:
    """``ds`` minus ``days`` days."""
    return F.date_sub(_date_lit(ds), days)


def daily_window(c, ds) -> Column:
    """``c`` in [day before ``ds`` 00:00, ``ds`` 00:00)."""
    c = as_col(c)
    return (c >= date_sub_days(ds, 1).cast("timestamp_ntz")) & (c < _midnight(ds))


def trailing_window(c, ds, days: int = 30) -> Column:
    """``c`` in [``ds`` - ``days``, ``ds``), so running counters are re-read daily."""
    c = as_col(c)
    return (c >= date_sub_days(ds, days).cast("timestamp_ntz")) & (c < _midnight(ds))


def backfill_window(c, lo, hi) -> Column:
    """``c`` in [lo, hi)."""
    c = as_col(c)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo).cast("timestamp_ntz")
    hi_c = hi if isinstance(hi, Column) else F.lit(hi).cast("timestamp_ntz")
    return (c >= lo_c) & (c < hi_c)


def parse_timestamp(c) -> Column:
    """Time text -> ``timestamp_ntz`` keeping the wall clock as written.

    An ISO text with an offset keeps its local clock (the offset is dropped),
    which is what a cast to a zone-less timestamp does in the reference store.
    The text is read as a UTC instant and the wall clock rebuilt from the
    epoch, so the result never depends on the session time zone (no DST gaps).
    Offsets may be ``Z``, ``+01``, ``+0100`` or ``+01:00``, with or without a
    space; seconds may be missing, fractions have any length (microseconds are
    kept). Unparseable text gives NULL, which the daily checks refuse.
    """
    c = as_col(c)
    clock = F.regexp_replace(c, r"(\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*([+-]\d{2}(:?\d{2})?|Z)$", "$1")
    txt = F.concat(F.regexp_replace(clock, r"(\.\d{6})\d+$", "$1"), F.lit("Z"))
    inst = F.coalesce(*[F.try_to_timestamp(txt, F.lit(fmt)) for fmt in
                        ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X", "yyyy-MM-dd HH:mm:ss[.SSSSSS]X", "yyyy-MM-dd'T'HH:mmX",
                         "yyyy-MM-dd HH:mmX", "yyyy-MM-ddX")])
    return F.timestamp_add("MICROSECOND", F.unix_micros(inst), F.lit(_EPOCH).cast("timestamp_ntz"))


def days_between(later, earlier) -> Column:
    """Date - date as an integer number of days."""
    return F.datediff(F.to_date(as_col(later)), F.to_date(as_col(earlier)))
