"""Analogue queries, SURVEY §2.4 joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.operators import dedup as DD
from listingmart.operators import keys as KY
from listingmart.operators import lookup as LK
from listingmart.plans import gold as GD
from listingmart.analogues.registry import ORDERS_DS, query, tbl


@query("fact_dim_join", r"""
SELECT o_orderkey, c_custkey, n_name FROM orders
JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
JOIN nation ON c_nationkey = n_nationkey""")
def q_fact_dim_join(spark, sf):
    """Snapshot rows joined to two dimensions by label (inner)."""
    o, c, n = tbl(spark, sf, "orders"), tbl(spark, sf, "customer"), tbl(spark, sf, "nation")
    snap = o.select("o_orderkey", F.format_string("Customer#%09d", "o_custkey").alias("company"))
    j = snap.join(LK.small_side(c.select("c_name", "c_custkey", "c_nationkey")),
                  snap["company"] == c["c_name"], "inner")
    return j.join(LK.small_side(n.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"),
                  "inner").select("o_orderkey", "c_custkey", "n_name")


def _type_dim(spark, sf):
    p = tbl(spark, sf, "part")
    return KY.assign_keys(DD.distinct_members(p, ["p_type"]), ["p_type"], "type_id")


@query("bridge_join", r"""
WITH dim AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS type_id FROM (SELECT DISTINCT p_type FROM part))
SELECT DISTINCT l_orderkey, type_id FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN dim ON part.p_type = dim.p_type""")
def q_bridge_join(spark, sf):
    """(order, member id) pairs through a label join, distinct."""
    li, p = tbl(spark, sf, "lineitem"), tbl(spark, sf, "part")
    snap = li.join(p.select("p_partkey", "p_type"), li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("job_id"), "p_type")
    dim = _type_dim(spark, sf)
    j = snap.join(LK.small_side(dim), "p_type", "inner")
    return j.select(F.col("job_id").alias("l_orderkey"), "type_id").distinct()


@query("bridge_location_join", r"""
WITH m AS (SELECT DISTINCT c_mktsegment, n_name, r_name FROM customer
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dim AS (SELECT *, row_number() OVER (ORDER BY c_mktsegment, n_name, r_name) AS location_id FROM m)
SELECT DISTINCT c_custkey, location_id FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN dim USING (c_mktsegment, n_name, r_name)""")
def q_bridge_location_join(spark, sf):
    """Three-column key join to a keyed place dimension."""
    c, n, r = tbl(spark, sf, "customer"), tbl(spark, sf, "nation"), tbl(spark, sf, "region")
    snap = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name")
    keys = ["c_mktsegment", "n_name", "r_name"]
    dim = KY.assign_keys(DD.distinct_members(snap, keys), keys, "location_id")
    return snap.join(LK.small_side(dim), keys, "inner").select("c_custkey", "location_id").distinct()


@query("bridge_dim_prejoin", r"""
SELECT l_orderkey, l_suppkey, s_name, s_nationkey
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) br JOIN supplier ON l_suppkey = s_suppkey""")
def q_bridge_dim_prejoin(spark, sf):
    """A bridge pre-joined to its dimension."""
    br = tbl(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    s = tbl(spark, sf, "supplier")
    return br.join(LK.small_side(s.select("s_suppkey", "s_name", "s_nationkey")),
                   br.l_suppkey == s.s_suppkey, "inner").select("l_orderkey", "l_suppkey", "s_name", "s_nationkey")


@query("metrics_location_join", r"""
SELECT k1, k2, l_linenumber FROM (SELECT l_orderkey AS k1, l_linestatus AS k2, l_linenumber FROM lineitem) l
JOIN (SELECT o_orderkey AS k1, nullif(o_orderstatus, 'P') AS k2 FROM orders) o USING (k1, k2)""")
def q_metrics_location_join(spark, sf):
    """Inner join USING several columns; NULL key parts never match."""
    li = tbl(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k1"), F.col("l_linestatus").alias("k2"),
                                           "l_linenumber")
    o = tbl(spark, sf, "orders").select(F.col("o_orderkey").alias("k1"),
                                        F.nullif("o_orderstatus", F.lit("P")).alias("k2"))
    return li.join(o, ["k1", "k2"], "inner").select("k1", "k2", "l_linenumber")


@query("active_history_join", r"""
SELECT o_orderkey FROM orders h WHERE o_orderdate < TIMESTAMP '1998-08-02'
AND EXISTS (SELECT 1 FROM orders t WHERE t.o_orderdate >= TIMESTAMP '1998-08-02' AND t.o_custkey = h.o_custkey)""")
def q_active_history_join(spark, sf):
    """History rows of keys also seen today (semi join: no fan-out)."""
    o = tbl(spark, sf, "orders")
    cut = F.lit(ORDERS_DS).cast("timestamp_ntz")
    hist = o.where(F.col("o_orderdate") < cut)
    today = o.where(F.col("o_orderdate") >= cut).select("o_custkey")
    return hist.join(today, "o_custkey", "left_semi").select("o_orderkey")


@query("delta_left_join", r"""
WITH t AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-08-02' GROUP BY 1),
h AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-08-02' GROUP BY 1)
SELECT t.o_custkey, coalesce(t.n - h.n, t.n) AS delta FROM t LEFT JOIN h USING (o_custkey)""")
def q_delta_left_join(spark, sf):
    """today's values left-joined to history totals."""
    o = tbl(spark, sf, "orders")
    cut = F.lit(ORDERS_DS).cast("timestamp_ntz")
    t = o.where(F.col("o_orderdate") >= cut).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    h = o.where(F.col("o_orderdate") < cut).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("h"))
    return t.join(h, "o_custkey", "left").select(
        "o_custkey", F.coalesce(F.col("n") - F.col("h"), F.col("n")).alias("delta"))


@query("view_join", r"""
SELECT l_orderkey AS job_id, l_partkey AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey""")
def q_view_join(spark, sf):
    """A bridge view (bridge joined to its dimension)."""
    br = tbl(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"),
                                           F.col("l_partkey").alias("p_partkey")).distinct()
    return GD.bridge_view(br, tbl(spark, sf, "part"), "p_partkey")


@query("metrics_fact_join", r"""
SELECT o_orderstatus, l_returnflag, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderstatus, l_returnflag""")
def q_metrics_fact_join(spark, sf):
    """Daily rows joined to the fact on the key (planner picks the strategy)."""
    li, o = tbl(spark, sf, "lineitem"), tbl(spark, sf, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .groupBy("o_orderstatus", "l_returnflag").agg(F.count(F.lit(1)).alias("n")))


@query("lookup_left_join", r"""
SELECT o_orderkey, c_name AS customer_name FROM orders LEFT JOIN customer ON nullif(o_custkey, 7) = c_custkey""")
def q_lookup_left_join(spark, sf):
    """Ids replaced by labels (left join; repeated lookup ids do not fan out, T24)."""
    o = tbl(spark, sf, "orders").select("o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("cust_id"))
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name")
    lookup = c.unionByName(c)  # every id twice
    return LK.replace_ids(o, lookup, "cust_id", "c_custkey", "c_name", "customer_name")


@query("values_outer_join", r"""
SELECT a.v AS brand_a, b.v AS brand_b FROM (SELECT DISTINCT nullif(p_brand, 'Brand#25') AS v FROM part) a
FULL OUTER JOIN (SELECT DISTINCT 'Brand#' || nullif(n_nationkey, 0) AS v FROM nation) b
ON a.v IS NOT DISTINCT FROM b.v""")
def q_values_outer_join(spark, sf):
    """Full outer match of two value lists; NULL matches NULL as in the reference."""
    from listingmart.operators.standardise import outer_match
    a = tbl(spark, sf, "part").select(F.nullif("p_brand", F.lit("Brand#25")).alias("brand_a")).distinct()
    b = tbl(spark, sf, "nation").select(
        F.concat(F.lit("Brand#"), F.nullif("n_nationkey", F.lit(0)).cast("string")).alias("brand_b")).distinct()
    return outer_match(a, b, "brand_a", "brand_b")
