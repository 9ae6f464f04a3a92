"""Analogue queries, SURVEY §2.7 sort and paging, 2.8 set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.functions import arrays as A
from listingmart.operators import dedup as DD
from listingmart.operators import keys as KY
from listingmart.operators import paging as PG
from listingmart.analogues.registry import query, tbl


@query("sort_values", r"""SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey""")
def q_sort_values(spark, sf):
    """O2: total sort."""
    return PG.sort_values(tbl(spark, sf, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"])


@query("page_limit", r"""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200""")
def q_page_limit(spark, sf):
    """Page 3 of 100 rows (the limit is the feature)."""
    return PG.page(tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100, 3)


@query("sorted_join", r"""
SELECT p_partkey, array_to_string(list_sort(string_split(p_name || ' ' || p_type, ' ')), ', ') AS joined FROM part""")
def q_sorted_join(spark, sf):
    """Sorted list -> one string."""
    p = tbl(spark, sf, "part")
    return p.select("p_partkey", A.sorted_join(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")).alias("joined"))


@query("conformed_union", r"""
SELECT label, row_number() OVER (ORDER BY label) AS label_id FROM
  (SELECT p_type AS label FROM part UNION SELECT upper(c_mktsegment) FROM customer)""")
def q_conformed_union(spark, sf):
    """Members of two sources unioned, then keyed once."""
    a = tbl(spark, sf, "part").select(F.col("p_type").alias("label"))
    b = tbl(spark, sf, "customer").select(F.upper("c_mktsegment").alias("label"))
    members = DD.distinct_members(a.unionByName(b), ["label"])
    return KY.assign_keys(members, ["label"], "label_id")


@query("element_set_union", r"""
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '),
  [p_brand, split_part(p_name, ' ', 1)]))), ', ') AS union_str FROM part""")
def q_element_set_union(spark, sf):
    """Set union of two token lists."""
    p = tbl(spark, sf, "part")
    u = A.set_union(F.split("p_name", " "), F.array("p_brand", F.element_at(F.split("p_name", " "), 1)))
    return p.select("p_partkey", A.sorted_join(u).alias("union_str"))
