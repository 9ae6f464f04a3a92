"""Analogue queries, SURVEY §2.5 aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.operators import checks as CK
from listingmart.operators import dedup as DD
from listingmart.operators import delta as DL
from listingmart.operators import lookup as LK
from listingmart.plans import gold as GD
from listingmart.analogues.registry import EVENTS_DS, query, tbl, with_iso_dates


@query("dim_members", r"""
SELECT DISTINCT nullif(p_type, 'PROMO') AS p_type FROM part WHERE nullif(p_type, 'PROMO') IS NOT NULL""")
def q_dim_members(spark, sf):
    """A1: distinct non-NULL members of one column."""
    p = tbl(spark, sf, "part").select(F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return DD.distinct_members(p, ["p_type"])


@query("location_members", r"""
SELECT c_mktsegment, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_mktsegment, n_name, n_regionkey""")
def q_location_members(spark, sf):
    """A2: distinct member tuples (GROUP BY without aggregates)."""
    c, n = tbl(spark, sf, "customer"), tbl(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return DD.distinct_members(j, ["c_mktsegment", "n_name", "n_regionkey"])


@query("first_per_key", r"""
SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def q_first_per_key(spark, sf):
    """A3: DISTINCT ON (key) with an explicit total order."""
    o = tbl(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return DD.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("first_per_key_ordered", r"""
SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
  ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END ASC NULLS LAST, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def q_first_per_key_ordered(spark, sf):
    """A4: first per key by a nullable date, NULLs last (T5)."""
    o = tbl(spark, sf, "orders").select(
        "o_custkey", "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderdate")).alias("d"))
    return DD.first_per_key(o, ["o_custkey"], [F.col("d").asc_nulls_last(), "o_orderkey"]).select(
        "o_custkey", "o_orderkey")


@query("drop_exact_duplicates", r"""
SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1""")
def q_drop_exact_duplicates(spark, sf):
    """A5: keep the first of the rows equal on the compared columns."""
    d = tbl(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    return DD.drop_exact_duplicates(d, ["doc_id"], ["text", "lang"]).select("doc_id", "n_chars")


@query("drop_duplicate_keys", r"""
SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source""")
def q_drop_duplicate_keys(spark, sf):
    """First row per key."""
    d = tbl(spark, sf, "documents").select("source", "doc_id")
    return DD.first_per_key(d, ["source"], ["doc_id"])


@query("merge_duplicates", r"""
SELECT md5(text) AS text_key, lang, arg_min(source, doc_id) FILTER (WHERE source IS NOT NULL) AS source,
  CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS n_chars, count(*) AS dup_count
FROM (SELECT text, nullif(lang, 'de') AS lang, nullif(source, 'src0') AS source, n_chars, doc_id FROM documents)
GROUP BY text, lang""")
def q_merge_duplicates(spark, sf):
    """One row per key (NULL a group): first non-NULL per column, sums, count."""
    d = tbl(spark, sf, "documents").select(
        "text", F.nullif("lang", F.lit("de")).alias("lang"), F.nullif("source", F.lit("src0")).alias("source"),
        "n_chars", "doc_id")
    m = DD.merge_duplicates(d, ["text", "lang"], ["n_chars"], "doc_id", count_col="dup_count")
    return m.select(F.md5("text").alias("text_key"), "lang", "source", "n_chars", "dup_count")


@query("duplicate_report", r"""
WITH d AS (SELECT text, nullif(lang, 'de') AS lang, source FROM documents),
k AS (SELECT count(*) AS n FROM d GROUP BY text, lang)
SELECT (SELECT count(*) FROM d) AS rows_before,
  (SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT 1 FROM d GROUP BY text, lang, source)) AS exact_duplicates,
  (SELECT count(*) FROM k) AS rows_after_merge,
  (SELECT CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) FROM k WHERE n > 1) AS merged_duplicates""")
def q_duplicate_report(spark, sf):
    """Rows before, exact duplicates, rows after merge, merged duplicates."""
    d = tbl(spark, sf, "documents").select("text", F.nullif("lang", F.lit("de")).alias("lang"), "source")
    return DD.duplicate_report(d, ["text", "lang"], ["text", "lang", "source"])


@query("regroup_array", r"""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
  lambda x: CASE WHEN x = 'red' THEN 'NULL' ELSE upper(x) END), ' ') AS regrouped FROM part""")
def q_regroup_array(spark, sf):
    """Exploded values collected back in position order, NULL elements kept."""
    p = tbl(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("toks"))
    ex = p.select("p_partkey", F.posexplode("toks").alias("pos", "tok"))
    ex = ex.withColumn("tok", F.when(F.col("tok") == "red", F.lit(None)).otherwise(F.upper("tok")))
    rg = LK.regroup_array(ex, ["p_partkey"], "pos", "tok", "toks")
    return rg.select("p_partkey", F.array_join("toks", " ", "NULL").alias("regrouped"))


def _daily_events(spark, sf):
    """Daily counters per (user, event type): the analogue of a daily metric fact."""
    e = tbl(spark, sf, "events")
    return e.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).cast("int").alias("cnt"))


@query("history_totals", r"""
WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS INTEGER) AS cnt FROM events
           GROUP BY ALL)
SELECT user_id, event_type, CAST(sum(cnt) AS BIGINT) AS cnt_total FROM d
WHERE day < DATE '2024-01-20' AND (user_id, event_type) IN
  (SELECT (user_id, event_type) FROM d WHERE day = DATE '2024-01-20')
GROUP BY user_id, event_type""")
def q_history_totals(spark, sf):
    """A10: sums of earlier daily values, only for keys seen on the run date."""
    d = _daily_events(spark, sf)
    today = d.where(F.col("day") == F.lit(EVENTS_DS).cast("date"))
    t = DL.history_totals(d, today, ["user_id", "event_type"], ["cnt"], "day", EVENTS_DS)
    return t.select("user_id", "event_type", F.col("_cnt_total").alias("cnt_total"))


def _daily_user(spark, sf):
    e = tbl(spark, sf, "events")
    return e.groupBy(F.col("user_id").alias("job_id"), F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).cast("int").alias("nb_views"),
        F.count_if(F.col("event_type") == "purchase").cast("int").alias("nb_applicants"))


_DAILY_USER_SQL = r"""(SELECT user_id AS job_id, CAST(ts AS DATE) AS date, CAST(count(*) AS INTEGER) AS nb_views,
  CAST(count(*) FILTER (WHERE event_type = 'purchase') AS INTEGER) AS nb_applicants FROM events GROUP BY 1, 2)"""


@query("job_performance_summary", r"""
SELECT job_id, CAST(sum(nb_views) AS BIGINT) AS total_views, CAST(sum(nb_applicants) AS BIGINT) AS total_applicants,
  strftime(min(date), '%Y-%m-%d') AS first_active_day, strftime(max(date), '%Y-%m-%d') AS last_active_day
FROM """ + _DAILY_USER_SQL + " GROUP BY job_id")
def q_job_performance_summary(spark, sf):
    """A11 (flagship): per key totals and first / last active day from daily rows."""
    return with_iso_dates(GD.job_performance_summary(_daily_user(spark, sf)))


@query("first_last_application_days", r"""
WITH f AS (SELECT user_id AS job_id, min(ts) AS datetime_published FROM events GROUP BY 1)
SELECT p.job_id,
  CAST(date_diff('day', CAST(f.datetime_published AS DATE), min(p.date) FILTER (WHERE p.nb_applicants > 0)) AS INTEGER)
    AS days_to_first_applicant,
  CAST(date_diff('day', CAST(f.datetime_published AS DATE), max(p.date) FILTER (WHERE p.nb_applicants > 0)) AS INTEGER)
    AS days_to_last_applicant
FROM """ + _DAILY_USER_SQL + r""" p JOIN f ON f.job_id = p.job_id GROUP BY p.job_id, f.datetime_published""")
def q_first_last_application_days(spark, sf):
    """J9 + A12: days from publication to the first / last day with applicants."""
    e = tbl(spark, sf, "events")
    fact = e.groupBy(F.col("user_id").alias("job_id")).agg(F.min("ts").alias("datetime_published"))
    return GD.first_last_application_days(_daily_user(spark, sf), fact)


@query("distinct_rows", r"""SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""")
def q_distinct_rows(spark, sf):
    """Distinct rows."""
    return tbl(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").dropDuplicates()


@query("flag_count", r"""
SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 100000) AS n_flagged FROM orders GROUP BY 1""")
def q_flag_count(spark, sf):
    """Number of rows failing a flag."""
    o = tbl(spark, sf, "orders")
    return o.groupBy("o_orderstatus").agg(F.count_if(F.col("o_totalprice") > 100000).alias("n_flagged"))


@query("duplicate_check", r"""
SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1""")
def q_duplicate_check(spark, sf):
    """Keys occurring more than once."""
    return CK.check_unique(tbl(spark, sf, "part"), ["p_name"])
