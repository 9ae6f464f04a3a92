"""Analogue queries, SURVEY §2.9 merge, keys and constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.operators import checks as CK
from listingmart.operators import dedup as DD
from listingmart.operators import keys as KY
from listingmart.operators import merge as MG
from listingmart.analogues.aggregates import _daily_events
from listingmart.analogues.registry import EVENTS_DS, _scratch_store, query, tbl


_UPSERT_T = r"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-01-01')"""
_UPSERT_S = r"""(SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'X' || o_orderstatus AS o_orderstatus,
  o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')"""


def _upsert_inputs(spark, sf):
    o = tbl(spark, sf, "orders")
    t = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    s = o.where(F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp_ntz")).select(
        "o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"),
        F.concat(F.lit("X"), "o_orderstatus").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return t, s


def _upsert_sql(update: list[str]) -> str:
    cols = []
    for c in ["o_custkey", "o_orderstatus", "o_totalprice"]:
        if c in update:
            cols.append(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN t.o_orderkey IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
    return ("SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, " + ", ".join(cols)
            + f" FROM {_UPSERT_T} t FULL OUTER JOIN {_UPSERT_S} s ON t.o_orderkey = s.o_orderkey")


@query("upsert", _upsert_sql(["o_orderstatus"]))
def q_upsert(spark, sf):
    """M1: insert new keys, overwrite only the listed columns of existing keys."""
    t, s = _upsert_inputs(spark, sf)
    return MG.upsert(t, s, ["o_orderkey"], ["o_orderstatus"])


@query("upsert_fact_a", _upsert_sql(["o_orderstatus", "o_custkey"]))
def q_upsert_fact_a(spark, sf):
    """M4: fact upsert with source A's update list (kept columns stay)."""
    t, s = _upsert_inputs(spark, sf)
    return MG.upsert(t, s, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


@query("upsert_fact_b", _upsert_sql(["o_orderstatus", "o_custkey", "o_totalprice"]))
def q_upsert_fact_b(spark, sf):
    """M5: fact upsert with source B's longer update list."""
    t, s = _upsert_inputs(spark, sf)
    return MG.upsert(t, s, ["o_orderkey"], ["o_orderstatus", "o_custkey", "o_totalprice"])


def _bucketed(spark, sf):
    """A bucketed table of orders and the buckets that a batch rewrote."""
    t, s = _upsert_inputs(spark, sf)
    store = _scratch_store(spark)
    store.upsert_buckets("orders", t.schema, ["o_orderkey"], [(t, [])])
    return store, t.schema, store.upsert_buckets("orders", t.schema, ["o_orderkey"], [(s, ["o_orderstatus", "o_custkey"])])


@query("upsert_bucketed", _upsert_sql(["o_orderstatus", "o_custkey"]))
def q_upsert_bucketed(spark, sf):
    """M4 on a bucketed table: only the buckets a batch touches are rewritten; read back whole."""
    store, schema, _ = _bucketed(spark, sf)
    return store.read("orders", schema)


@query("insert_if_absent", r"""
SELECT DISTINCT 'Brand#' || s_nationkey AS p_brand FROM supplier
WHERE 'Brand#' || s_nationkey NOT IN (SELECT p_brand FROM part)""")
def q_insert_if_absent(spark, sf):
    """Only members whose key is not yet in the target."""
    target = tbl(spark, sf, "part").select("p_brand")
    src = tbl(spark, sf, "supplier").select(F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string"))
                                            .alias("p_brand"))
    return MG.insert_if_absent(target, src, ["p_brand"])


_LOC_DIM_SQL = r"""(SELECT n_nationkey AS location_id, n_name AS city, 'S' || n_regionkey AS state,
  r_name AS country, 'Inconnu' AS region FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_LOC_MEMBERS_SQL = r"""(SELECT CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE n_name || '-' || (c_custkey % 3) END AS city,
  'S' || n_regionkey AS state, r_name AS country, c_mktsegment AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("upsert_location_region", r"""
WITH m AS (SELECT city, state, country, coalesce(max(region) FILTER (WHERE region <> 'Inconnu'), max(region), 'Inconnu')
  AS region FROM """ + _LOC_MEMBERS_SQL + r""" GROUP BY city, state, country)
SELECT d.location_id, city, state, country, m.region FROM """ + _LOC_DIM_SQL + r""" d JOIN m USING (city, state, country)
UNION ALL
SELECT NULL::BIGINT, city, state, country, region FROM m
WHERE (city, state, country) NOT IN (SELECT (city, state, country) FROM """ + _LOC_DIM_SQL + ")")
def q_upsert_location_region(spark, sf):
    """M3: place upsert where the region is overwritten and two regions resolve to the max."""
    n, r, c = tbl(spark, sf, "nation"), tbl(spark, sf, "region"), tbl(spark, sf, "customer")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    dim = nr.select(F.col("n_nationkey").cast("long").alias("location_id"), F.col("n_name").alias("city"),
                    F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
                    F.col("r_name").alias("country"), F.lit("Inconnu").alias("region"))
    m = c.join(nr, c.c_nationkey == nr.n_nationkey).select(
        F.when(F.col("c_custkey") % 3 == 0, F.col("n_name"))
        .otherwise(F.concat("n_name", F.lit("-"), (F.col("c_custkey") % 3).cast("string"))).alias("city"),
        F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
        F.col("r_name").alias("country"), F.col("c_mktsegment").alias("region"))
    updated, new = MG.upsert_location_region(dim, m, overwrite_region=True)
    return updated.unionByName(new.withColumn("location_id", F.lit(None).cast("long")))


@query("upsert_daily_metrics", r"""
WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS INTEGER) AS cnt FROM events
  GROUP BY ALL),
t AS (SELECT *, CAST(dayofmonth(day) AS INTEGER) AS days_since FROM d WHERE day <= DATE '2024-01-20'),
s AS (SELECT user_id, event_type, day, cnt * 2 AS cnt, CAST(-1 AS INTEGER) AS days_since FROM d
  WHERE day >= DATE '2024-01-15')
SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.event_type, t.event_type) AS event_type,
  coalesce(s.day, t.day) AS day, CASE WHEN s.user_id IS NOT NULL THEN s.cnt ELSE t.cnt END AS cnt,
  CASE WHEN t.user_id IS NOT NULL THEN t.days_since ELSE s.days_since END AS days_since
FROM t FULL OUTER JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type AND t.day = s.day""")
def q_upsert_daily_metrics(spark, sf):
    """M6: on (key, date) update the metric, keep days_since."""
    d = _daily_events(spark, sf)
    t = d.where(F.col("day") <= F.lit(EVENTS_DS).cast("date")).withColumn(
        "days_since", F.dayofmonth("day").cast("int"))
    s = d.where(F.col("day") >= F.lit("2024-01-15").cast("date")).select(
        "user_id", "event_type", "day", (F.col("cnt") * 2).alias("cnt"), F.lit(-1).cast("int").alias("days_since"))
    return MG.upsert(t, s, ["user_id", "event_type", "day"], ["cnt"])


@query("surrogate_keys", r"""
SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS member_id
FROM (SELECT DISTINCT p_brand, p_type FROM part)""")
def q_surrogate_keys(spark, sf):
    """M7: dense, repeatable keys by natural key, computed in parallel."""
    m = DD.distinct_members(tbl(spark, sf, "part"), ["p_brand", "p_type"])
    return KY.assign_keys(m, ["p_brand", "p_type"], "member_id")


@query("unknown_member", r"""
SELECT -1 AS brand_id, 'Inconnu' AS p_brand
UNION ALL SELECT row_number() OVER (ORDER BY p_brand), p_brand FROM (SELECT DISTINCT p_brand FROM part)""")
def q_unknown_member(spark, sf):
    """M8: a keyed dimension with its unknown member (-1, Inconnu)."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("brand_id", T.LongType(), False),
                           T.StructField("p_brand", T.StringType(), False)])
    m = KY.assign_keys(DD.distinct_members(tbl(spark, sf, "part"), ["p_brand"]), ["p_brand"], "brand_id")
    return KY.seed_unknown(spark, schema).unionByName(m.select("brand_id", "p_brand"))


@query("job_key", r"""
SELECT p_partkey, lower(split_part(p_name, ' ', 1)) || '-' ||
  substr(md5(p_name || coalesce(nullif(p_brand, 'Brand#1'), 'None') || p_type), 1, 8) AS job_id FROM part""")
def q_job_key(spark, sf):
    """M10 (F7, F8, F9): first title word + 8 hex digits of md5 over the key columns as text."""
    p = tbl(spark, sf, "part").select("p_partkey", F.col("p_name").alias("title"),
                                      F.nullif("p_brand", F.lit("Brand#1")).alias("company"),
                                      F.col("p_type").alias("datetime_published"))
    return KY.job_key(p).select("p_partkey", "job_id")


@query("check_unique", r"""
SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2 HAVING count(*) > 1""")
def q_check_unique(spark, sf):
    """Key groups that occur more than once."""
    return CK.check_unique(tbl(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


@query("check_not_null", r"""
SELECT count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL) AS o_orderstatus,
  count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey FROM orders""")
def q_check_not_null(spark, sf):
    """NULL counts of NOT NULL columns."""
    o = tbl(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return CK.check_not_null(o, ["o_orderstatus", "o_orderkey"])


@query("check_foreign_key", r"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL
AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def q_check_foreign_key(spark, sf):
    """Child rows whose reference has no parent (left anti join)."""
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parent = tbl(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return CK.orphans(o, parent, ["o_custkey"], ["c_custkey"])
