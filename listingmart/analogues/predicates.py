"""Analogue queries, SURVEY §2.3 projections, filters, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.functions import arrays as A
from listingmart.operators import checks as CK
from listingmart.operators import dedup as DD
from listingmart.analogues.registry import EVENTS_DS, ORDERS_DS, iso_date, query, tbl


@query("select_rename", r"""
SELECT o_orderkey AS job_id, o_orderpriority AS _function, o_orderstatus AS _state FROM orders""")
def q_select_rename(spark, sf):
    """Selection with aliases, reserved names repaired with a leading underscore."""
    return tbl(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"),
                                           F.col("o_orderpriority").alias("_function"),
                                           F.col("o_orderstatus").alias("_state"))


@query("typed_cast", r"""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
       CAST(user_id AS INTEGER) AS user_id, event_type = 'purchase' AS is_purchase FROM events""")
def q_typed_cast(spark, sf):
    """P2 + F33: typed casts (ANSI) of a JSON field, a timestamp, an id and a flag."""
    e = tbl(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                    iso_date(F.col("ts").cast("date")).alias("day"), F.col("user_id").cast("int").alias("user_id"),
                    (F.col("event_type") == "purchase").alias("is_purchase"))


@query("date_filter", r"""
SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'""")
def q_date_filter(spark, sf):
    """Rows of one run date."""
    e = tbl(spark, sf, "events")
    return e.where(F.to_date("ts") == F.lit(EVENTS_DS).cast("date")).select("event_id", "user_id")


@query("before_date_filter", r"""
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-08-02'
GROUP BY o_orderstatus""")
def q_before_date_filter(spark, sf):
    """History strictly before the run date (pushed to the scan)."""
    o = tbl(spark, sf, "orders")
    return (o.where(F.col("o_orderdate") < F.lit(ORDERS_DS).cast("timestamp_ntz"))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@query("not_null_filter", r"""
SELECT DISTINCT nullif(c_mktsegment, 'HOUSEHOLD') AS segment FROM customer
WHERE nullif(c_mktsegment, 'HOUSEHOLD') IS NOT NULL""")
def q_not_null_filter(spark, sf):
    """P5: NULL members dropped before a dimension insert."""
    c = tbl(spark, sf, "customer").select(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment"))
    return c.where(A.not_null("segment")).distinct()


@query("coalesce_unknown", r"""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), 'Inconnu') AS segment FROM customer""")
def q_coalesce_unknown(spark, sf):
    """NULL scalar -> unknown label."""
    c = tbl(spark, sf, "customer")
    return c.select("c_custkey", A.coalesce_unknown(F.nullif("c_mktsegment", F.lit("HOUSEHOLD"))).alias("segment"))


_ARR_SQL = r"""(SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN [NULL]::VARCHAR[]
   WHEN 2 THEN []::VARCHAR[] ELSE string_split(p_name, ' ') END AS arr FROM part)"""


def _arr(spark, sf):
    p = tbl(spark, sf, "part")
    arr = (F.when(F.col("p_size") % 4 == 0, F.lit(None).cast("array<string>"))
           .when(F.col("p_size") % 4 == 1, F.array(F.lit(None).cast("string")))
           .when(F.col("p_size") % 4 == 2, F.array().cast("array<string>"))
           .otherwise(F.split("p_name", " ")))
    return p.select("p_partkey", arr.alias("arr"))


@query("coalesce_unknown_array", r"""
SELECT p_partkey,
  array_to_string(CASE WHEN arr IS NULL OR arr = [NULL]::VARCHAR[] THEN ['Inconnu'] ELSE arr END, '|') AS keep_empty,
  array_to_string(CASE WHEN arr IS NULL OR arr = [NULL]::VARCHAR[] OR len(arr) = 0 THEN ['Inconnu'] ELSE arr END, '|')
    AS empty_too
FROM """ + _ARR_SQL)
def q_coalesce_unknown_array(spark, sf):
    """NULL or [NULL] -> [unknown]; optionally [] too."""
    a = _arr(spark, sf)
    return a.select("p_partkey",
                    F.array_join(A.coalesce_unknown_array("arr"), "|").alias("keep_empty"),
                    F.array_join(A.coalesce_unknown_array("arr", empty_too=True), "|").alias("empty_too"))


@query("require_columns", r"""SELECT c_custkey, c_name FROM customer""")
def q_require_columns(spark, sf):
    """Fail early when a named column is absent (driver-side, no job)."""
    c = tbl(spark, sf, "customer")
    CK.require_columns(c, ["c_custkey", "c_name"])
    return c.select("c_custkey", "c_name")


@query("atomic_columns", r"""SELECT vec_id, label FROM embeddings""")
def q_atomic_columns(spark, sf):
    """The de-duplication columns are the non-nested ones."""
    e = tbl(spark, sf, "embeddings")
    return e.select(*DD.atomic_columns(e))


def _items(spark, sf):
    p = tbl(spark, sf, "part")
    items = F.array(
        F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("label"),
                 F.when(F.col("p_size") > 25, "en").otherwise("fr").alias("lang")),
        F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("label"),
                 F.when(F.col("p_retailprice") > 1500, "en").otherwise("fr").alias("lang")))
    items = F.when(F.col("p_size") % 10 == 0, F.lit(None)).otherwise(items)
    return p.select("p_partkey", "p_name", "p_brand", items.alias("items"))


@query("all_in_language", r"""
SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN true ELSE (p_size <= 25 AND p_retailprice <= 1500) END AS in_fr
FROM part""")
def q_all_in_language(spark, sf):
    """Every element in French; NULL lists count as true."""
    return _items(spark, sf).select("p_partkey", A.all_in_language("items", "fr").alias("in_fr"))


@query("flagged_split", r"""
SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN '' WHEN (p_size <= 25 AND p_retailprice <= 1500)
  THEN p_name || '|' || p_brand ELSE 'lookup:' || p_partkey || '|' || p_brand END AS value
FROM part""")
def q_flagged_split(spark, sf):
    """One conditional column instead of splitting rows by a flag."""
    it = _items(spark, sf)
    flag = A.all_in_language("items", "fr")
    labels = F.coalesce(F.array_join(A.struct_labels("items"), "|"), F.lit(""))
    ids = F.concat(F.lit("lookup:"), F.array_join(A.struct_labels("items", "id"), "|"))
    return it.select("p_partkey", F.when(flag, labels).otherwise(ids).alias("value"))


@query("membership_filter", r"""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def q_membership_filter(spark, sf):
    """Values not in a key set (left anti join)."""
    c, o = tbl(spark, sf, "customer"), tbl(spark, sf, "orders")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("set_differs", r"""
SELECT p_partkey, list_sort(list_distinct([p_brand, p_type])) <>
  list_sort(list_distinct([p_type, 'Brand#' || (p_size % 25 + 1)])) AS differs FROM part""")
def q_set_differs(spark, sf):
    """Two lists differ as sets."""
    p = tbl(spark, sf, "part")
    b = F.array("p_type", F.concat(F.lit("Brand#"), (F.col("p_size") % 25 + 1).cast("string")))
    return p.select("p_partkey", A.set_differs(F.array("p_brand", "p_type"), b).alias("differs"))


@query("nonempty_gate", r"""
SELECT count(*) > 0 AS has_rows FROM (SELECT 1 FROM lineitem LIMIT 1)""")
def q_nonempty_gate(spark, sf):
    """The batch has rows (reads at most one row)."""
    li = tbl(spark, sf, "lineitem")
    return li.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))


@query("positive_filter", r"""
SELECT user_id, strftime(min(CAST(ts AS DATE)) FILTER (WHERE value > 50), '%Y-%m-%d') AS first_high_day
FROM events GROUP BY user_id""")
def q_positive_filter(spark, sf):
    """Filtered minimum inside an aggregate."""
    e = tbl(spark, sf, "events")
    return e.groupBy("user_id").agg(iso_date(F.min(F.when(F.col("value") > 50, F.to_date("ts"))))
                                    .alias("first_high_day"))
