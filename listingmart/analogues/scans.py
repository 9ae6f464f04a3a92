"""Analogue queries, SURVEY §2.1 scans: pages and lookups rendered as JSON from table rows, parsed as landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions import arrays as A
from listingmart.functions import dates as D
from listingmart.operators import checks as CK
from listingmart.operators import lookup as LK
from listingmart.plans import clean as CL
from listingmart.session import checkpoint_dir
from listingmart.sources import listings as LS
from listingmart.sources import lookups as LU
from listingmart.sources import scans as SC
from listingmart.analogues.registry import EVENTS_DS, ORDERS_DS, query, tbl


_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _pages(rows: DataFrame, page: str, key: str, rows_field: str, header) -> DataFrame:
    """Group rows into pages of at most 100 (by key // 100), sorted by key, as JSON text."""
    grouped = rows.groupBy(page).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("r").alias("r")))),
                    lambda x: x["r"]).alias("rows"),
        F.count(F.lit(1)).alias("n"))
    body = header(F.col("n"))
    return grouped.select(F.col(page).alias("page"),
                          F.to_json(F.struct(*body, F.col("rows").alias(rows_field))).alias("json"))


def _a_row(o: DataFrame) -> DataFrame:
    loc = F.array(F.struct(F.col("o_custkey").cast("string").alias("id"),
                           F.concat(F.lit("Ville "), (F.col("o_custkey") % 50).cast("string"),
                                    F.lit(", Wilaya "), (F.col("o_custkey") % 7).cast("string"),
                                    F.lit(", Algérie")).alias("label"),
                           F.lit("fr").alias("lang")))
    r = F.struct(
        F.concat(F.lit("Job "), F.col("o_orderkey").cast("string")).alias("title"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("openPositions"),
        F.date_format("o_orderdate", _ISO).alias("publishedAt"),
        F.lower("o_orderstatus").alias("workMode"),
        (F.col("o_orderstatus") == "F").alias("isAnonymous"),
        F.struct(F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("name"),
                 F.struct(F.col("o_orderpriority").alias("id"), F.col("o_orderpriority").alias("label"),
                          F.lit("fr").alias("lang")).alias("sector")).alias("company"),
        F.struct(loc.alias("location"),
                 F.array(F.struct(F.col("o_orderstatus").alias("label"))).alias("contractType")).alias("criteria"))
    return o.select("o_orderkey", (F.col("o_orderkey") / 100).cast("long").alias("page"), r.alias("r"))


def _a_pages(spark, sf):
    o = tbl(spark, sf, "orders")
    txt = _pages(_a_row(o), "page", "o_orderkey", "results",
                 lambda n: [F.struct(n.alias("total"), F.lit(1).alias("totalPages")).alias("pagination")])
    return LS.pages_from_text(txt, "json", LS.PAGE_A, "page")


_A_ROWS_SQL = r"""(SELECT o_orderkey // 100 AS _page,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER) AS _pos,
  'Job ' || o_orderkey AS title, CAST(o_custkey % 5 + 1 AS INTEGER) AS positions,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS datetime_published, lower(o_orderstatus) AS work_mode,
  'Company ' || o_custkey AS company, o_orderpriority AS sector_label, o_orderstatus = 'F' AS is_anonymous,
  'Ville ' || (o_custkey % 50) || ', Wilaya ' || (o_custkey % 7) || ', Algérie' AS location,
  o_orderstatus AS contract_type, o_orderkey FROM orders)"""


@query("listing_scan_a", r"""
SELECT o_orderkey // 100 AS page, count(*) AS n_results, count(*) AS announced_total FROM orders GROUP BY 1""")
def q_listing_scan_a(spark, sf):
    """S1 (+S11): every page of source A's listing, one row per page."""
    p = _a_pages(spark, sf)
    return p.select(F.col("_page").alias("page"), F.size("results").cast("long").alias("n_results"),
                    F.col("pagination.total").alias("announced_total"))


def _page_files(spark, sf):
    """Source A's pages as text files, one page a line: some truncated, some written twice, some times unreadable."""
    o = tbl(spark, sf, "orders")
    row = _a_row(o)
    soon = F.when(F.col("o_orderkey") % 101 == 3, "soon").otherwise(F.col("r.publishedAt"))
    row = row.withColumn("r", F.col("r").withField("publishedAt", soon))
    txt = _pages(row, "page", "o_orderkey", "results",
                 lambda n: [F.struct(n.alias("total"), F.lit(1).alias("totalPages")).alias("pagination")])
    cut = F.expr("left(json, cast(length(json) / 2 as int))")
    txt = txt.select("page", F.when(F.col("page") % 97 == 5, cut).otherwise(F.col("json")).alias("json"))
    lines = txt.select("json").unionByName(txt.where(F.col("page") % 53 == 7).select("json"))
    path = f"{checkpoint_dir(spark)}/analogue-pages/{uuid.uuid4().hex}"
    lines.write.text(path)
    return SC.scan_pages(spark, path, LS.PAGE_A, "results", lines=True)


_FILE_ROWS_SQL = r"""SELECT 'Job ' || o_orderkey AS title, CAST(o_custkey % 5 + 1 AS INTEGER) AS positions,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS datetime_published, 'Company ' || o_custkey AS company
FROM orders WHERE (o_orderkey // 100) % 97 <> 5 AND o_orderkey % 101 <> 3"""


@query("listing_scan_files", _FILE_ROWS_SQL)
def q_listing_scan_files(spark, sf):
    """Page files on disk, bad and repeated pages and unreadable times set aside -> listing rows."""
    good, _ = SC.split_rows(LS.flatten_a(SC.usable_pages(_page_files(spark, sf))), ["datetime_published"])
    return good.select("title", "positions", "datetime_published", "company")


@query("page_rejects", r"""
WITH p AS (SELECT DISTINCT o_orderkey // 100 AS page FROM orders)
SELECT 'unreadable page' AS reason, NULL AS title FROM p WHERE page % 97 = 5
UNION ALL SELECT CASE WHEN page % 97 = 5 THEN 'unreadable page' ELSE 'repeated page' END, NULL FROM p WHERE page % 53 = 7
UNION ALL SELECT 'unreadable datetime_published', 'Job ' || o_orderkey FROM orders
  WHERE (o_orderkey // 100) % 97 <> 5 AND o_orderkey % 101 = 3""")
def q_page_rejects(spark, sf):
    """What a scan of page files set aside, page by page and listing by listing."""
    scanned = _page_files(spark, sf)
    _, bad = SC.split_rows(LS.flatten_a(SC.usable_pages(scanned)), ["datetime_published"])
    return SC.rejected_pages(scanned).unionByName(bad).select("reason", "title")


def _flat_a(spark, sf):
    f = LS.flatten_a(_a_pages(spark, sf))
    return f.select("_page", "_pos", "title", "positions", "datetime_published", "work_mode", "company",
                    F.col("sector.label").alias("sector_label"), "is_anonymous",
                    F.array_join(A.struct_labels("location"), "|").alias("location"),
                    F.array_join("contract_type", "|").alias("contract_type"))


@query("flatten_listings_a", "SELECT * EXCLUDE (o_orderkey) FROM " + _A_ROWS_SQL)
def q_flatten_listings_a(spark, sf):
    """S3 (+F17, F18, F33): source A pages -> one row per listing, with page and position."""
    return _flat_a(spark, sf)


def _b_row(o: DataFrame) -> DataFrame:
    st = F.col("o_orderstatus")
    name = lambda c: F.struct(c.alias("name"))
    contracts = (F.when(st == "F", F.array(name(F.lit("CDI")), name(F.lit("CDD"))))
                 .when(st == "O", F.array().cast("array<struct<name:string>>")))
    salary = (F.when(st == "F", F.struct(F.col("o_custkey").cast("int").alias("min"),
                                         (F.col("o_custkey") + 1000).cast("int").alias("max")))
              .when(st == "O", F.struct(F.lit(None).cast("int").alias("min"), F.lit(None).cast("int").alias("max"))))
    r = F.struct(
        F.concat(F.lit("Job "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("companyName"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("nbPosition"),
        F.date_format("o_orderdate", _ISO).alias("publishedDate"),
        F.when(st != "P", F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), _ISO)).alias("expireDate"),
        (F.col("o_orderkey") % 7).cast("int").alias("nbApplicant"),
        (F.col("o_orderkey") % 100).cast("int").alias("nbView"),
        (st == "O").alias("hideCompany"),
        (F.col("o_custkey") % 4).cast("string").alias("nbMonthExperience"),
        name(F.concat(F.lit("City "), (F.col("o_custkey") % 50).cast("string"))).alias("city"),
        F.struct(F.col("o_orderpriority").alias("name"), F.lower(st).alias("cardinal")).alias("region"),
        name(F.concat(F.lit("Country "), (F.col("o_custkey") % 5).cast("string"))).alias("country"),
        F.struct((F.col("o_custkey") % 9).cast("string").alias("id")).alias("sectorGroup"),
        F.struct((F.col("o_orderkey") % 11).cast("string").alias("id")).alias("function"),
        name(F.col("o_orderpriority")).alias("careerLevel"),
        name(F.concat(F.lit("Bac +"), (F.col("o_custkey") % 6).cast("string"))).alias("studyLevel"),
        name(st).alias("workplace"),
        contracts.alias("contractTypes"),
        salary.alias("salary"))
    return o.select("o_orderkey", (F.col("o_orderkey") / 100).cast("long").alias("page"), r.alias("r"))


def _b_pages(spark, sf):
    o = tbl(spark, sf, "orders")
    txt = _pages(_b_row(o), "page", "o_orderkey", "hydra:member",
                 lambda n: [n.alias("hydra:totalItems")])
    return LS.pages_from_text(txt, "json", LS.PAGE_B, "page")


_B_ROWS_SQL = r"""(SELECT o_orderkey // 100 AS _page,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER) AS _pos,
  'Job ' || o_orderkey AS title, 'Company ' || o_custkey AS company, CAST(o_custkey % 5 + 1 AS INTEGER) AS positions,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS datetime_published,
  CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%S') END AS expire_date,
  CAST(o_orderkey % 7 AS INTEGER) AS nb_applicants, CAST(o_orderkey % 100 AS INTEGER) AS nb_views,
  o_orderstatus = 'O' AS is_anonymous, CAST(o_custkey % 4 AS VARCHAR) AS experience_years_id,
  'City ' || (o_custkey % 50) AS city, o_orderpriority AS state, lower(o_orderstatus) AS region,
  'Country ' || (o_custkey % 5) AS country, CAST(o_custkey % 9 AS VARCHAR) AS sector_id,
  CAST(o_orderkey % 11 AS VARCHAR) AS function_id, o_orderpriority AS job_level,
  'Bac +' || (o_custkey % 6) AS education_level, o_orderstatus AS work_mode,
  CASE o_orderstatus WHEN 'F' THEN 'CDI|CDD' WHEN 'O' THEN '' END AS contract_type,
  o_orderstatus = 'F' AS has_salary,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS INTEGER) END AS min_salary,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey + 1000 AS INTEGER) END AS max_salary, o_orderkey
  FROM orders)"""


@query("listing_scan_b", r"""
SELECT o_orderkey // 100 AS page, count(*) AS n_results, count(*) AS announced_total FROM orders GROUP BY 1""")
def q_listing_scan_b(spark, sf):
    """Every page of source B's listing, one row per page."""
    p = _b_pages(spark, sf)
    return p.select(F.col("_page").alias("page"), F.size("`hydra:member`").cast("long").alias("n_results"),
                    F.col("`hydra:totalItems`").alias("announced_total"))


def _flat_b(spark, sf):
    f = LS.flatten_b(_b_pages(spark, sf))
    return f.withColumn("contract_type", F.array_join("contract_type", "|"))


@query("flatten_listings_b", "SELECT * EXCLUDE (o_orderkey) FROM " + _B_ROWS_SQL)
def q_flatten_listings_b(spark, sf):
    """S5 (+S6): source B pages -> rows: first-level, nested and list fields, salary."""
    return _flat_b(spark, sf)


@query("salary_unpack", r"""
SELECT o_orderkey, o_orderstatus = 'F' AS has_salary,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS INTEGER) END AS min_salary,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey + 1000 AS INTEGER) END AS max_salary FROM orders""")
def q_salary_unpack(spark, sf):
    """Optional salary object -> flag, min, max; an empty object is no salary."""
    o = tbl(spark, sf, "orders")
    raw = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('{"min": '), F.col("o_custkey").cast("string"),
                                                          F.lit(', "max": '), (F.col("o_custkey") + 1000).cast("string"),
                                                          F.lit("}")))
           .when(F.col("o_orderstatus") == "O", F.lit("{ }")))
    s = LS.salary_unpack(raw)
    return o.select("o_orderkey", *[s[k].alias(k) for k in ("has_salary", "min_salary", "max_salary")])


@query("criteria_normalise", r"""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_name || '|' || p_brand WHEN 1 THEN p_type END AS labels,
  CASE p_size % 3 WHEN 0 THEN 'fr|en' WHEN 1 THEN 'fr' END AS langs FROM part""")
def q_criteria_normalise(spark, sf):
    """A criterion as a list, one object or null -> one list of {id, label, lang}."""
    p = tbl(spark, sf, "part")
    q = F.lit('"')
    lst = F.concat(F.lit('[{"id": "'), F.col("p_partkey").cast("string"), F.lit('", "label": '), q, F.col("p_name"),
                   q, F.lit(', "lang": "fr"}, {"id": "x", "label": '), q, F.col("p_brand"), q,
                   F.lit(', "lang": "en"}]'))
    obj = F.concat(F.lit('{"id": "'), F.col("p_partkey").cast("string"), F.lit('", "label": '), q, F.col("p_type"),
                   q, F.lit(', "lang": "fr"}'))
    raw = F.when(F.col("p_size") % 3 == 0, lst).when(F.col("p_size") % 3 == 1, obj).otherwise(F.lit("null"))
    items = LS.criteria_items(raw)
    return p.select("p_partkey", F.array_join(A.struct_labels(items), "|").alias("labels"),
                    F.array_join(A.struct_labels(items, "lang"), "|").alias("langs"))


def _lookup_text(spark, sf):
    p = tbl(spark, sf, "part")
    item = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("label"))
    # every id is listed twice (on two pages), as a lookup list may repeat entries
    both = p.select((F.col("p_partkey") / 500).cast("long").alias("pg"), "p_partkey", item.alias("r")).unionByName(
        p.select(((F.col("p_partkey") / 500).cast("long") + 1_000_000).alias("pg"), "p_partkey", item.alias("r")))
    g = both.groupBy("pg").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        F.col("p_partkey").alias("k"), F.col("r").alias("r")))), lambda x: x["r"]).alias("collection"))
    return g.select(F.to_json(F.struct("collection")).alias("json"))


@query("lookup_scan", r"""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS label FROM part""")
def q_lookup_scan(spark, sf):
    """S7 (+T24): lookup lists nested under a result key, one label per id."""
    lk = LU.lookup_from_text(_lookup_text(spark, sf), "json", "collection")
    return LK.dedupe_lookup(lk.select("id", "label"), "id", "label")


@query("window_daily_a", r"""
SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'
GROUP BY 1""")
def q_window_daily_a(spark, sf):
    """S8 (+F28, F29): publications in [day before, run day) at midnight."""
    e = tbl(spark, sf, "events")
    return e.where(D.daily_window("ts", EVENTS_DS)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("window_trailing_30d_b", r"""
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-07-03' AND o_orderdate < TIMESTAMP '1998-08-02' GROUP BY 1""")
def q_window_trailing_30d_b(spark, sf):
    """The trailing 30 days re-read daily."""
    o = tbl(spark, sf, "orders")
    return (o.where(D.trailing_window("o_orderdate", ORDERS_DS, 30))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@query("window_backfill", r"""
SELECT user_id, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 18:00:00' GROUP BY 1""")
def q_window_backfill(spark, sf):
    """A backfill interval [lo, hi)."""
    e = tbl(spark, sf, "events")
    return (e.where(D.backfill_window("ts", "2024-01-05 06:00:00", "2024-01-09 18:00:00"))
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))


@query("page_union", r"""
SELECT 'A' AS src, title, company, positions, datetime_published, work_mode, is_anonymous, contract_type,
  location, NULL AS city, _page, _pos FROM """ + _A_ROWS_SQL + r"""
UNION ALL
SELECT 'B', title, company, positions, datetime_published, work_mode, is_anonymous, contract_type,
  NULL, city, _page, _pos FROM """ + _B_ROWS_SQL)
def q_page_union(spark, sf):
    """Rows of both sources' pages appended by name (missing columns NULL)."""
    common = ["title", "company", "positions", "datetime_published", "work_mode", "is_anonymous",
              "contract_type", "_page", "_pos"]
    a = _flat_a(spark, sf).select(F.lit("A").alias("src"), *common, "location")
    b = _flat_b(spark, sf).select(F.lit("B").alias("src"), *common, "city")
    return a.unionByName(b, allowMissingColumns=True)


@query("page_completeness", r"""
SELECT o_orderkey // 1000 AS listing, count(*) AS announced_total, count(DISTINCT o_orderkey // 100)
  FILTER (WHERE o_orderstatus <> 'P') AS pages_read, count(*) FILTER (WHERE o_orderstatus <> 'P') AS rows_read,
  count(*) = count(*) FILTER (WHERE o_orderstatus <> 'P') AS complete
FROM orders GROUP BY 1""")
def q_page_completeness(spark, sf):
    """Announced totals vs rows read per listing; pages lost 'P' rows in transit."""
    o = tbl(spark, sf, "orders").withColumn("listing", (F.col("o_orderkey") / 1000).cast("long"))
    totals = o.groupBy("listing").agg(F.count(F.lit(1)).alias("total"))
    rows = _a_row(o.where(F.col("o_orderstatus") != "P")).join(
        o.select("o_orderkey", "listing"), "o_orderkey")
    pages = rows.groupBy("listing", "page").agg(F.collect_list("r").alias("results"))
    pages = pages.join(LK.small_side(totals), "listing")
    return CK.page_report(pages, "total", "results", by=["listing"]).select(
        "listing", "announced_total", "pages_read", "rows_read", "complete")


@query("staging_scan_by_date", r"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-01-02'""")
def q_staging_scan_by_date(spark, sf):
    """One day of a table (a partition filter on partitioned tables)."""
    o = tbl(spark, sf, "orders")
    return o.where(F.to_date("o_orderdate") == F.lit("1996-01-02").cast("date")).select(
        "o_orderkey", "o_custkey", "o_totalprice")




@query("newest_first", r"""
SELECT title, datetime_published, _page, _pos FROM """ + _A_ROWS_SQL + r"""
ORDER BY datetime_published DESC, _page, _pos""")
def q_newest_first(spark, sf):
    """O3: listings in arrival order (newest publication first, then page, position)."""
    f = LS.flatten_a(_a_pages(spark, sf))
    return f.select("title", "datetime_published", "_page", "_pos").orderBy(*CL.arrival_order())
