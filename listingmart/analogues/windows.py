"""Analogue queries, SURVEY §2.6 windows: cumulative counters -> daily changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.functions import dates as D
from listingmart.operators import delta as DL
from listingmart.analogues.aggregates import _daily_events
from listingmart.analogues.registry import EVENTS_DS, ORDERS_DS, _iso_sql, query, tbl, with_iso_dates


def _cumulative(spark, sf):
    """Cumulative per-(user, type) counts by day, with holes (NULL) on some days."""
    from pyspark.sql import Window
    d = _daily_events(spark, sf)
    w = Window.partitionBy("user_id", "event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum("cnt").over(w).cast("int")
    hole = ((F.col("user_id") + F.dayofmonth("day")) % 7) == 0
    return d.select("user_id", "event_type", "day", F.when(hole, F.lit(None)).otherwise(cum).alias("cnt"))


_CUM_SQL = r"""(SELECT user_id, event_type, day, CASE WHEN (user_id + dayofmonth(day)) % 7 = 0 THEN NULL
  ELSE CAST(sum(cnt) OVER (PARTITION BY user_id, event_type ORDER BY day ROWS UNBOUNDED PRECEDING) AS INTEGER)
  END AS cnt
  FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS cnt FROM events GROUP BY ALL))"""


@query("counter_to_delta_full", r"""
SELECT user_id, event_type, day, CAST(cnt - coalesce(lag(cnt IGNORE NULLS) OVER
  (PARTITION BY user_id, event_type ORDER BY day), 0) AS INTEGER) AS cnt FROM """ + _CUM_SQL)
def q_counter_to_delta_full(spark, sf):
    """change = value - last earlier non-NULL value, over the whole history."""
    return DL.counter_delta_full(_cumulative(spark, sf), ["user_id", "event_type"], "day", ["cnt"])


@query("counter_to_delta_incremental", r"""
WITH c AS """ + _CUM_SQL + r""",
hist AS (SELECT user_id, event_type, day, cnt - coalesce(lag(cnt IGNORE NULLS) OVER
  (PARTITION BY user_id, event_type ORDER BY day), 0) AS cnt FROM c WHERE day < DATE '2024-01-20'),
today AS (SELECT * FROM c WHERE day = DATE '2024-01-20'),
tot AS (SELECT user_id, event_type, sum(cnt) AS total FROM hist WHERE (user_id, event_type) IN
  (SELECT (user_id, event_type) FROM today) GROUP BY 1, 2),
pub AS (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY 1)
SELECT t.user_id, t.event_type, DATE '2024-01-20' AS day, CAST(coalesce(t.cnt - tot.total, t.cnt) AS INTEGER) AS cnt,
  CAST(date_diff('day', CAST(pub.first_ts AS DATE), DATE '2024-01-20') AS INTEGER) AS days_since_published
FROM today t LEFT JOIN tot USING (user_id, event_type) JOIN pub USING (user_id)""")
def q_counter_to_delta_incremental(spark, sf):
    """W2 (+J6, A10, J7, W4): today's change from today's cumulative value and stored history."""
    cum = _cumulative(spark, sf)
    ds = F.lit(EVENTS_DS).cast("date")
    history = DL.counter_delta_full(cum.where(F.col("day") < ds), ["user_id", "event_type"], "day", ["cnt"])
    pub = tbl(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("published"))
    today = cum.where(F.col("day") == ds).join(pub, "user_id")
    return DL.counter_delta(today, history, ["user_id", "event_type"], ["cnt"], EVENTS_DS, "day", "published")


_LATE_FROM, _LATE_TO = "2024-01-10", "2024-01-19"
_W3_SQL = """SELECT user_id, event_type, day, CAST(cnt - coalesce(lag(cnt IGNORE NULLS) OVER
  (PARTITION BY user_id, event_type ORDER BY day), 0) AS INTEGER) AS cnt FROM """


@query("counter_to_delta_interval", _iso_sql(r"""
WITH c AS """ + _CUM_SQL + rf""",
s AS (SELECT user_id, event_type, day, CASE WHEN day BETWEEN DATE '{_LATE_FROM}' AND DATE '{_LATE_TO}'
  THEN cnt + CAST(user_id % 3 AS INTEGER) ELSE cnt END AS cnt FROM c
  WHERE NOT (day BETWEEN DATE '{_LATE_FROM}' AND DATE '{_LATE_TO}' AND (user_id + dayofmonth(day)) % 5 = 0)),
now AS ({_W3_SQL} c), stored AS ({_W3_SQL} s)
SELECT now.* FROM now LEFT JOIN stored USING (user_id, event_type, day)
WHERE day BETWEEN DATE '{_LATE_FROM}' AND DATE '{_LATE_TO}' OR (day > DATE '{_LATE_TO}' AND now.cnt IS DISTINCT FROM stored.cnt)""", ["day"]))
def q_counter_to_delta_interval(spark, sf):
    """W2 over an interval that is backfilled late: stored days in it are wrong or missing, the first later day is repaired."""
    keys, cum = ["user_id", "event_type"], _cumulative(spark, sf)
    late = F.col("day").between(F.lit(_LATE_FROM).cast("date"), F.lit(_LATE_TO).cast("date"))
    wrong = F.when(late, F.col("cnt") + F.col("user_id") % 3).otherwise(F.col("cnt")).cast("int")
    missing = late & ((F.col("user_id") + F.dayofmonth("day")) % 5 == 0)
    history = DL.counter_delta_full(cum.where(~missing).withColumn("cnt", wrong), keys, "day", ["cnt"])
    return with_iso_dates(DL.counter_delta_interval(cum.where(late), history, keys, ["cnt"], _LATE_FROM, _LATE_TO, "day"))


@query("days_since_published", r"""
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS INTEGER) AS days
FROM orders""")
def q_days_since_published(spark, sf):
    """Run date - publication date in days."""
    o = tbl(spark, sf, "orders")
    return o.select("o_orderkey", D.days_between(F.lit(ORDERS_DS), "o_orderdate").alias("days"))
