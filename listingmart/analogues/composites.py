"""Analogue queries, SURVEY §2.13 composite jobs and 2.2 sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.functions import text as X
from listingmart.operators import lookup as LK
from listingmart.operators import classes as LC
from listingmart.operators import similarity as SM
from listingmart.operators import standardise as SD
from listingmart.plans import clean as CL
from listingmart.plans import gold as GD
from listingmart.plans import silver as SV
from listingmart.plans import snapshot as SN
from listingmart.schemas import STG_A
from listingmart.schemas import STG_B
from listingmart.sources import listings as LS
from listingmart.analogues.aggregates import _daily_user
from listingmart.analogues.predicates import _items
from listingmart.analogues.registry import ORACLE, QUERIES, RUN_DS, _joined, _scratch_store, query, tbl
from listingmart.analogues.scans import _A_ROWS_SQL, _ISO, _flat_a, _pages


# -- C3 / C4 snapshots -------------------------------------------------------

def _stg_a(spark, sf) -> DataFrame:
    """Staging-A rows built from part: arrays of every shape (NULL, [NULL], [], 1-3 items)."""
    p = tbl(spark, sf, "part")
    m5 = F.col("p_size") % 5
    loc1 = F.concat("p_type", F.lit(", "), "p_brand", F.lit(", X, Y"))
    loc2 = F.concat(F.lit("u00e9cole, "), "p_name")
    sa = "array<string>"
    location = (F.when(m5 == 0, F.lit(None).cast(sa)).when(m5 == 1, F.array(F.lit(None).cast("string")))
                .when(m5 == 2, F.array().cast(sa)).otherwise(F.array(loc1, loc2)))
    df = p.select(
        F.concat(F.lit("job-"), F.col("p_partkey").cast("string")).alias("job_id"),
        F.col("p_name").alias("title"), F.nullif("p_brand", F.lit("Brand#3")).alias("company"),
        location.alias("location"), F.split("p_name", " ").alias("job_level"),
        F.col("p_size").cast("int").alias("positions"),
        F.lit("2025-06-01 08:00:00").cast("timestamp_ntz").alias("datetime_published"),
        F.nullif("p_type", F.lit("PROMO")).alias("sector"), F.array("p_type").alias("function"),
        F.when(F.col("p_size") % 3 == 0, F.array().cast(sa)).otherwise(F.array(F.lit("CDI"))).alias("contract_type"),
        F.lit(None).cast(sa).alias("education_level"),
        F.array("p_brand", F.lit("x"), F.lit("y")).alias("experience_years"),
        (F.col("p_size") > 25).alias("is_anonymous"), F.nullif(F.lower("p_type"), F.lit("small")).alias("work_mode"),
        F.lit(RUN_DS).cast("date").alias("date_scraped"), F.lit("Emploitic").alias("job_source"))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STG_A.fields])


_STG_A_SQL = r"""(SELECT 'job-' || p_partkey AS job_id, coalesce(nullif(p_brand, 'Brand#3'), 'Inconnu') AS company,
  coalesce(nullif(p_type, 'PROMO'), 'Inconnu') AS sector, coalesce(nullif(lower(p_type), 'small'), 'Inconnu') AS work_mode,
  CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN [NULL]::VARCHAR[] WHEN 2 THEN []::VARCHAR[]
    ELSE [p_type || ', ' || p_brand || ', X, Y', 'u00e9cole, ' || p_name] END AS location,
  string_split(p_name, ' ') AS job_level, [p_type] AS function,
  CASE WHEN p_size % 3 = 0 THEN []::VARCHAR[] ELSE ['CDI'] END AS contract_type,
  NULL::VARCHAR[] AS education_level, [p_brand, 'x', 'y'] AS experience_years FROM part)"""


def _unk(c):
    return f"CASE WHEN {c} IS NULL OR {c} = [NULL]::VARCHAR[] THEN ['Inconnu'] ELSE {c} END"


_SNAP_A_SQL = r"""
WITH u AS (SELECT job_id, company, sector, work_mode, """ + ", ".join(
    f"unnest({_unk(c)}) AS {c}" for c in
    ["location", "job_level", "function", "contract_type", "education_level", "experience_years"]) + r"""
  FROM """ + _STG_A_SQL + r"""),
r AS (SELECT * REPLACE (replace(location, 'u00e9', 'é') AS location),
  regexp_split_to_array(replace(location, 'u00e9', 'é'), '\s*,\s*') AS a FROM u)
SELECT job_id, company, sector, work_mode, location, job_level, function, contract_type, education_level,
  experience_years, CASE WHEN a IS NOT NULL THEN coalesce(a[-4], 'Inconnu') END AS city,
  CASE WHEN a IS NOT NULL THEN coalesce(a[-2], 'Inconnu') END AS state,
  CASE WHEN a IS NOT NULL THEN coalesce(a[-1], 'Inconnu') END AS country FROM r"""

_SNAP_A_COLS = ["job_id", "company", "sector", "work_mode", "location", "job_level", "function", "contract_type",
                "education_level", "experience_years", "city", "state", "country"]


@query("snapshot_a", _SNAP_A_SQL)
def q_snapshot_a(spark, sf):
    """One day of staging A exploded in lockstep, repaired, location split."""
    return SN.snapshot_a(_stg_a(spark, sf)).select(*_SNAP_A_COLS)


def _stg_b(spark, sf, views_bonus: int = 0) -> DataFrame:
    """Staging-B rows built from orders, with NULL key parts and list shapes."""
    o = tbl(spark, sf, "orders")
    st = F.col("o_orderstatus")
    ct = (F.when(st == "F", F.array(F.lit("CDI"), F.lit("CDu00e9"))).when(st == "O", F.array().cast("array<string>")))
    df = o.select(
        F.concat(F.lit("job-"), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.concat(F.lit("Job "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("Company "), F.col("o_custkey").cast("string")))
        .alias("company"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("positions"),
        F.col("o_orderdate").alias("datetime_published"),
        F.when(st != "P", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("expire_date"),
        F.nullif(F.concat(F.lit("City "), (F.col("o_custkey") % 50).cast("string")), F.lit("City 0")).alias("city"),
        F.col("o_orderpriority").alias("state"), F.nullif(F.lower(st), F.lit("p")).alias("region"),
        F.lit("DZ").alias("country"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("job_level"),
        F.nullif(st, F.lit("O")).alias("sector"),
        F.concat(F.lit("F"), (F.col("o_orderkey") % 11).cast("string")).alias("function"),
        ct.alias("contract_type"), F.lit("Bac + 2").alias("education_level"),
        F.lit(None).cast("string").alias("experience_years"), (st == "O").alias("is_anonymous"),
        st.alias("work_mode"), (st == "F").alias("has_salary"),
        F.lit(None).cast("int").alias("min_salary"), F.lit(None).cast("int").alias("max_salary"),
        (F.col("o_orderkey") % 7).cast("int").alias("nb_applicants"),
        ((F.col("o_orderkey") % 100) + views_bonus).cast("int").alias("nb_views"),
        F.lit(RUN_DS).cast("date").alias("date_scraped"), F.lit("EmploiPartner").alias("job_source"))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STG_B.fields])


_SNAP_B_COLS = ["job_id", "company", "function", "city", "state", "region", "country", "job_level", "sector",
                "contract_type", "education_level", "experience_years", "work_mode"]


@query("snapshot_b", r"""
SELECT 'job-' || o_orderkey AS job_id, CASE WHEN o_custkey % 10 <> 0 THEN 'Company ' || o_custkey ELSE 'Inconnu' END
  AS company, 'F' || (o_orderkey % 11) AS function,
  coalesce(nullif('City ' || (o_custkey % 50), 'City 0'), 'Inconnu') AS city, o_orderpriority AS state,
  coalesce(nullif(lower(o_orderstatus), 'p'), 'Inconnu') AS region, 'DZ' AS country,
  coalesce(nullif(o_orderpriority, '5-LOW'), 'Inconnu') AS job_level,
  coalesce(nullif(o_orderstatus, 'O'), 'Inconnu') AS sector,
  replace(unnest(CASE o_orderstatus WHEN 'F' THEN ['CDI', 'CDu00e9'] ELSE ['Inconnu'] END), 'u00e9', 'é')
    AS contract_type, 'Bac + 2' AS education_level, 'Inconnu' AS experience_years, o_orderstatus AS work_mode
FROM orders""")
def q_snapshot_b(spark, sf):
    """C4 / K5: one day of staging B: unknown labels, contract types unnested (empty too)."""
    return SN.snapshot_b(_stg_b(spark, sf)).select(*_SNAP_B_COLS)


QUERIES["daily_snapshot_a"] = QUERIES["snapshot_a"]
ORACLE["daily_snapshot_a"] = ORACLE["snapshot_a"]
QUERIES["daily_snapshot_b"] = QUERIES["snapshot_b"]
ORACLE["daily_snapshot_b"] = ORACLE["snapshot_b"]


# -- C9 label translation ------------------------------------------------------

@query("label_translation", r"""
SELECT p_partkey, CASE
  WHEN p_size % 10 = 0 THEN 'NULL'
  WHEN p_size <= 25 AND p_retailprice <= 1500 THEN p_name || '|' || p_brand
  ELSE p_name || '|NULL' END AS labels FROM part""")
def q_label_translation(spark, sf):
    """C9 (P13, P14, F16, J10, A9, F18): labels in French, ids looked up where a list mixes languages.

    The lookup (id -> French label) comes from the part table; brand ids are
    not in it, so a translated list gets a NULL in their place.
    """
    it = _items(spark, sf).select("p_partkey", "items")
    en_label = F.transform("items", lambda x: x.withField("label", F.when(x["lang"] == "en", F.upper(x["label"]))
                                                          .otherwise(x["label"])))
    it = it.withColumn("items", en_label)
    lookup = tbl(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"),
                                           F.col("p_name").alias("label"))
    out = LK.label_translation(it, "p_partkey", {"items": lookup})
    return out.select("p_partkey", _joined("items").alias("labels"))


# -- C1 / C2 cleaning ------------------------------------------------------------

def _clean_a_pages(spark, sf):
    o = tbl(spark, sf, "orders")
    en = (F.col("o_orderkey") % 4) == 0
    nat = (F.col("o_custkey") % 25)
    nat_label = F.when(en, F.concat(F.lit("Nation "), nat.cast("string"), F.lit(" (en)"))) \
        .otherwise(F.concat(F.lit("NATION_"), nat.cast("string")))
    lang = F.when(en, "en").otherwise("fr")
    it = lambda i, lbl, lg: F.struct(i.cast("string").alias("id"), lbl.alias("label"), lg.alias("lang"))
    reg = F.col("o_orderkey") % 5
    fen = (F.col("o_orderkey") % 3) == 0
    st = F.col("o_orderstatus")
    prof = F.array(it(reg, F.when(fen, F.lit("Region (en)")).otherwise(F.lit("R")), F.when(fen, "en").otherwise("fr")),
                   it(F.lit(99), F.lit("Autre"), F.lit("fr")))
    crit = F.struct(
        F.array(it(nat, nat_label, lang)).alias("location"),
        prof.alias("profession"),
        it(F.lit(1), F.col("o_orderpriority"), F.lit("fr")).alias("jobLevel"),
        F.when(st == "F", F.array(it(F.lit(1), F.lit("TS Bac +2"), F.lit("fr")))).alias("educationLevel"),
        F.when(st == "O", F.array().cast("array<struct<id:string,label:string,lang:string>>"))
        .otherwise(F.array(it(F.lit(2), F.lit("Sans Expérience"), F.lit("fr")))).alias("experienceYears"),
        F.array(F.struct(F.lit("Permanent Contract").alias("label"))).alias("contractType"))
    r = F.struct(
        F.concat(F.lit("Job "), F.col("o_orderkey").cast("string")).alias("title"),
        (F.col("o_custkey") % 5 + 1).cast("int").alias("openPositions"),
        F.date_format("o_orderdate", _ISO).alias("publishedAt"),
        F.when(st == "F", "onsite").when(st == "O", "hybrid").alias("workMode"),
        (st == "F").alias("isAnonymous"),
        F.struct(F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("name"),
                 it(nat, nat_label, lang).alias("sector")).alias("company"),
        crit.alias("criteria"))
    rows = o.select("o_orderkey", (F.col("o_orderkey") / 100).cast("long").alias("page"), r.alias("r"))
    dups = rows.where(F.col("r.workMode").isNull()).withColumn("page", F.col("page") + 1_000_000)
    txt = _pages(rows.unionByName(dups), "page", "o_orderkey", "results",
                 lambda n: [F.struct(n.alias("total"), F.lit(1).alias("totalPages")).alias("pagination")])
    return LS.pages_from_text(txt, "json", LS.PAGE_A, "page")


def _lookups_a(spark, sf):
    n = tbl(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("label"))
    r = tbl(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("label"))
    return {"location": n, "sector": n, "function": r, "job_level": r, "education_level": r, "experience_years": r}


_STG_OUT = ["job_id", "title", "company", "positions", "datetime_published", "sector", "work_mode", "location",
            "function", "job_level", "education_level", "experience_years", "contract_type", "is_anonymous",
            "date_scraped", "job_source"]


@query("clean_a", r"""
WITH o AS (SELECT *, 'job-' || substr(md5('Job ' || o_orderkey || 'Company ' || o_custkey ||
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')), 1, 8) AS job_id FROM orders),
d AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY o_orderdate DESC, o_orderkey // 100,
  o_orderkey) = 1)
SELECT job_id, 'Job ' || o_orderkey AS title, 'Company ' || o_custkey AS company, CAST(o_custkey % 5 + 1 AS INTEGER)
  AS positions, o_orderdate AS datetime_published, n_name AS sector,
  CASE o_orderstatus WHEN 'F' THEN 'Sur site' WHEN 'O' THEN 'Hybride' END AS work_mode, n_name AS location,
  CASE WHEN o_orderkey % 3 = 0 THEN r_name || '|NULL' ELSE 'R|Autres' END AS function,
  o_orderpriority AS job_level, CASE WHEN o_orderstatus = 'F' THEN 'Bac +2' ELSE 'NULL' END AS education_level,
  CASE WHEN o_orderstatus = 'O' THEN 'NULL' ELSE '<1 An' END AS experience_years, 'CDI' AS contract_type,
  o_orderstatus = 'F' AS is_anonymous, '2025-06-02' AS date_scraped, 'Emploitic' AS job_source
FROM d JOIN nation ON n_nationkey = o_custkey % 25 JOIN region ON r_regionkey = o_orderkey % 5""")
def q_clean_a(spark, sf):
    """Source A pages -> de-duplicated, keyed, translated, standardised staging rows."""
    rows = LS.flatten_a(_clean_a_pages(spark, sf))
    c = CL.clean_a(rows, RUN_DS, _lookups_a(spark, sf))
    arrays = ["location", "function", "job_level", "education_level", "experience_years", "contract_type"]
    return c.select(*[_joined(x).alias(x) if x in arrays else F.col(x) for x in _STG_OUT])


def _clean_b_pages(spark, sf):
    o = tbl(spark, sf, "orders")
    st = F.col("o_orderstatus")
    name = lambda c: F.struct(c.alias("name"))

    def row(app_bonus, view_bonus, expire):
        return F.struct(
            F.concat(F.lit("Job "), F.col("o_orderkey").cast("string")).alias("title"),
            F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("companyName"),
            (F.col("o_custkey") % 5 + 1).cast("int").alias("nbPosition"),
            F.date_format("o_orderdate", _ISO).alias("publishedDate"),
            expire.alias("expireDate"),
            ((F.col("o_orderkey") % 7) + app_bonus).cast("int").alias("nbApplicant"),
            ((F.col("o_orderkey") % 100) + view_bonus).cast("int").alias("nbView"),
            (st == "O").alias("hideCompany"),
            (F.col("o_custkey") % 25).cast("string").alias("nbMonthExperience"),
            name(F.concat(F.lit("City "), (F.col("o_custkey") % 50).cast("string"))).alias("city"),
            F.struct(F.col("o_orderpriority").alias("name"), F.lower(st).alias("cardinal")).alias("region"),
            name(F.lit("DZ")).alias("country"),
            F.struct((F.col("o_custkey") % 5).cast("string").alias("id")).alias("sectorGroup"),
            F.struct((F.col("o_orderkey") % 25).cast("string").alias("id")).alias("function"),
            name(F.col("o_orderpriority")).alias("careerLevel"),
            name(F.concat(F.lit("Bac +"), (F.col("o_custkey") % 6).cast("string"))).alias("studyLevel"),
            name(F.when(st == "F", "en partie depuis la maison").when(st == "O", "100% depuis la maison")
                 .otherwise("sur site")).alias("workplace"),
            F.array(name(F.lit("Pre-emploi"))).alias("contractTypes"))

    exp = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), _ISO)
    base = o.select("o_orderkey", (F.col("o_orderkey") / 100).cast("long").alias("page"),
                    row(0, 0, exp).alias("r"), st)
    exact = base.where(st == "F").withColumn("page", F.col("page") + 1_000_000)
    merged = o.where(st == "P").select("o_orderkey", (F.col("o_orderkey") / 100 + 2_000_000).cast("long").alias("page"),
                                       row(1, 2, F.lit(None).cast("string")).alias("r"), st)
    allrows = base.unionByName(exact).unionByName(merged).drop("o_orderstatus")
    txt = _pages(allrows, "page", "o_orderkey", "hydra:member", lambda n: [n.alias("hydra:totalItems")])
    return LS.pages_from_text(txt, "json", LS.PAGE_B, "page")


_STG_B_OUT = ["job_id", "title", "company", "positions", "datetime_published", "expire_date", "city", "state",
              "region", "country", "job_level", "sector", "function", "contract_type", "education_level",
              "experience_years", "work_mode", "nb_applicants", "nb_views", "date_scraped", "job_source"]


@query("clean_b", r"""
WITH o AS (SELECT *, 'job-' || substr(md5('Job ' || o_orderkey || 'Company ' || o_custkey ||
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || (o_custkey % 5)), 1, 8) AS job_id,
  o_orderstatus = 'P' AS dup FROM orders)
SELECT job_id, 'Job ' || o_orderkey AS title, 'Company ' || o_custkey AS company, CAST(o_custkey % 5 + 1 AS INTEGER)
  AS positions, o_orderdate AS datetime_published, o_orderdate + INTERVAL 30 DAY AS expire_date,
  'City ' || (o_custkey % 50) AS city, o_orderpriority AS state, upper(o_orderstatus) AS region, 'DZ' AS country,
  o_orderpriority AS job_level, s.r_name AS sector, f.n_name AS function, 'Pré-emploi' AS contract_type,
  CASE o_custkey % 6 WHEN 1 THEN 'Bac + 1' WHEN 2 THEN 'Bac + 2' WHEN 3 THEN 'Licence (LMD), Bac + 3'
    WHEN 4 THEN 'Master 1, Licence  Bac + 4' WHEN 5 THEN 'Master 2, Ingéniorat, Bac + 5' ELSE 'Bac +0' END
    AS education_level, e.n_name AS experience_years,
  CASE o_orderstatus WHEN 'F' THEN 'Hybride' WHEN 'O' THEN 'Remote' ELSE 'Sur site' END AS work_mode,
  CAST(CASE WHEN dup THEN 2 * (o_orderkey % 7) + 1 ELSE o_orderkey % 7 END AS INTEGER) AS nb_applicants,
  CAST(CASE WHEN dup THEN 2 * (o_orderkey % 100) + 2 ELSE o_orderkey % 100 END AS INTEGER) AS nb_views,
  '2025-06-02' AS date_scraped, 'EmploiPartner' AS job_source
FROM o JOIN nation e ON e.n_nationkey = o_custkey % 25 JOIN region s ON s.r_regionkey = o_custkey % 5
JOIN nation f ON f.n_nationkey = o_orderkey % 25""")
def q_clean_b(spark, sf):
    """Source B pages -> de-duplicated, merged, looked up, standardised staging rows."""
    rows = LS.flatten_b(_clean_b_pages(spark, sf))
    n = tbl(spark, sf, "nation")
    r = tbl(spark, sf, "region")
    exp = n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("label"))
    sec = r.select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"))
    fun = n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    c = CL.clean_b(rows, RUN_DS, exp, sec, fun)
    return c.select(*[_joined(x).alias(x) if x == "contract_type" else F.col(x) for x in _STG_B_OUT])


# -- C8 value standardisation ----------------------------------------------------

def _std_sides(spark, sf):
    p = tbl(spark, sf, "part")
    a = p.select(F.regexp_replace(F.initcap("p_name"), " ", ", ").alias("v"))
    raw_b = F.concat(F.element_at(F.split("p_name", " "), 2), F.lit(" / "), F.element_at(F.split("p_name", " "), 1),
                     F.lit(" / "), F.lower("p_type"))
    b = p.select(X.french_titlecase(X.slash_to_comma(raw_b)).alias("v"))
    return a, b


_STD_SQL = r"""
WITH a AS (SELECT DISTINCT array_to_string(list_transform(string_split(p_name, ' '),
    lambda w: upper(w[1]) || w[2:]), ', ') AS source_a FROM part),
b AS (SELECT DISTINCT upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] || ', ' ||
    upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ', ' ||
    upper(lower(p_type)[1]) || lower(p_type)[2:] AS source_b FROM part),
an AS (SELECT source_a, string_split_regex(source_a, '\s*,\s*|\s*-\s*|\s+&\s*|\s*&\s+') AS names FROM a),
bn AS (SELECT source_b, string_split_regex(source_b, '\s*,\s*|\s*-\s*|\s+&\s*|\s*&\s+') AS names FROM b),
ae AS (SELECT source_a, unnest(names) AS t FROM an), be AS (SELECT source_b, unnest(names) AS t FROM bn),
pairs AS (SELECT source_a, source_b, count(*) AS shared_names FROM ae JOIN be USING (t)
  GROUP BY source_a, source_b HAVING count(*) >= 2),
full_ AS (SELECT pairs.*, list_distinct(an.names) AS sa, list_distinct(bn.names) AS sb,
  list_sort(list_distinct(list_concat(an.names, bn.names))) AS u FROM pairs JOIN an USING (source_a)
  JOIN bn USING (source_b))
"""

_PAIRS_SQL = _STD_SQL + r"""SELECT source_a, source_b, shared_names, array_to_string(u, ', ') AS union_str,
  u <> list_sort(sa) AS replace_source_a, u <> list_sort(sb) AS replace_source_b FROM full_"""


@query("standardise_values", _PAIRS_SQL)
def q_standardise_values(spark, sf):
    """C8 (A14, F5, F1, F6, F24, F16, J12, U3, O5, A13, P17): label pairs of two sources sharing >= 2 names."""
    a, b = _std_sides(spark, sf)
    return SD.standardise_values(a, "v", b, "v")["pairs"]


@query("token_join", _STD_SQL + r"""SELECT source_a, source_b, t AS name, count(*) AS n FROM ae JOIN be USING (t)
  WHERE (source_a, source_b) IN (SELECT (source_a, source_b) FROM pairs) GROUP BY source_a, source_b, t""")
def q_token_join(spark, sf):
    """The name-join rows of matched label pairs (name, rows contributed)."""
    a, b = _std_sides(spark, sf)
    pa, pb = SD.prepare(a, "v", "source_a"), SD.prepare(b, "v", "source_b")
    return SD.matched_token_rows(pa, pb, "source_a", "source_b")


@query("matched_pairs", _STD_SQL + r"""SELECT source_a, source_b, shared_names FROM pairs""")
def q_matched_pairs(spark, sf):
    """Pairs sharing at least two names (repetitions counted, T25)."""
    a, b = _std_sides(spark, sf)
    pa, pb = SD.prepare(a, "v", "source_a"), SD.prepare(b, "v", "source_b")
    return SD.matched_pairs(pa, pb, "source_a", "source_b").select("source_a", "source_b", "shared_names")


@query("mapping_export", _STD_SQL + r"""SELECT DISTINCT source_a AS old_value, array_to_string(u, ', ') AS new_value
FROM full_ WHERE u <> list_sort(sa)""")
def q_mapping_export(spark, sf):
    """K9 (+F23): label -> standard label for one source, where it changes."""
    a, b = _std_sides(spark, sf)
    return SD.standardise_values(a, "v", b, "v")["map_a"]


@query("unmatched_values", _STD_SQL + r""",
ma AS (SELECT DISTINCT source_a FROM full_ WHERE u <> list_sort(sa)),
mb AS (SELECT DISTINCT source_b FROM full_ WHERE u <> list_sort(sb)),
ua AS (SELECT source_a FROM a WHERE source_a NOT IN (SELECT source_a FROM ma)),
ub AS (SELECT source_b FROM b WHERE source_b NOT IN (SELECT source_b FROM mb))
SELECT ua.source_a, ub.source_b FROM ua FULL OUTER JOIN ub ON ua.source_a IS NOT DISTINCT FROM ub.source_b""")
def q_unmatched_values(spark, sf):
    """Labels of either side without a mapping, matched outer on equal text, for review."""
    a, b = _std_sides(spark, sf)
    return SD.standardise_values(a, "v", b, "v")["unmatched"]


_CLASS_SQL = (_STD_SQL + r""",
edge AS (SELECT source_a AS u, source_b AS v FROM pairs UNION SELECT source_b, source_a FROM pairs),
lab AS (SELECT DISTINCT u AS label FROM edge),
reach AS (SELECT label, label AS met FROM lab UNION SELECT r.label, e.v FROM reach r JOIN edge e ON e.u = r.met),
cls AS (SELECT label, min(met) AS root FROM reach GROUP BY label),
nam AS (SELECT c.root, unnest(coalesce(an.names, bn.names)) AS name FROM cls c
  LEFT JOIN an ON an.source_a = c.label LEFT JOIN bn ON bn.source_b = c.label),
std AS (SELECT root, string_agg(DISTINCT name, ', ' ORDER BY name) AS standard FROM nam GROUP BY root),
tgt AS (SELECT label, count(DISTINCT array_to_string(u, ', ')) AS targets FROM (
  SELECT source_a AS label, u FROM full_ UNION ALL SELECT source_b, u FROM full_) GROUP BY label),
classes AS (SELECT label, root, standard, targets FROM cls JOIN std USING (root) JOIN tgt USING (label))
""").replace("WITH a AS", "WITH RECURSIVE a AS", 1)


def _classes(spark, sf):
    a, b = _std_sides(spark, sf)
    return LC.label_classes(SD.standardise_values(a, "v", b, "v")["pairs"], "source_a", "source_b")


@query("label_classes", _CLASS_SQL + "SELECT label, root, standard, targets FROM classes")
def q_label_classes(spark, sf):
    """Connected classes of matched labels, one standard label each."""
    return _classes(spark, sf)


@query("ambiguous_labels", _CLASS_SQL + "SELECT label, standard, targets FROM classes WHERE targets > 1")
def q_ambiguous_labels(spark, sf):
    """K9: labels with several pairwise targets, for review."""
    return LC.ambiguous_labels(_classes(spark, sf))


@query("mapping_apply", _CLASS_SQL + r""",
rows AS (SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ', ') AS v FROM part)
SELECT p_partkey, v AS label, coalesce(c.standard, v) AS standard FROM rows LEFT JOIN classes c ON c.label = v""")
def q_mapping_apply(spark, sf):
    """Every row's label through the class mapping, one row each."""
    rows = tbl(spark, sf, "part").select("p_partkey", F.regexp_replace(F.initcap("p_name"), " ", ", ").alias("label"))
    return LC.apply_mapping(rows, "label", LC.class_mapping(_classes(spark, sf)), "standard")


_GRAMS_SQL = "unnest(list_distinct([substring('##' || lower({0}) || '##', i, 3) FOR i IN range(1, length({0}) + 3)]))"


@query("unmatched_candidates", rf"""
WITH ua AS (SELECT DISTINCT array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS source_a FROM part),
ub AS (SELECT DISTINCT p_name || CASE p_partkey % 3 WHEN 0 THEN 's' WHEN 1 THEN ' ' || lower(split_part(p_type, ' ', 1)) ELSE '' END AS source_b
  FROM part),
ga AS (SELECT source_a, {_GRAMS_SQL.format('source_a')} AS g FROM ua), gb AS (SELECT source_b, {_GRAMS_SQL.format('source_b')} AS g FROM ub),
na AS (SELECT source_a, count(*) AS na FROM ga GROUP BY ALL), nb AS (SELECT source_b, count(*) AS nb FROM gb GROUP BY ALL),
sh AS (SELECT source_a, source_b, count(*) AS shared FROM ga JOIN gb USING (g) GROUP BY ALL)
SELECT source_a, source_b, CAST(shared AS INTEGER) AS shared, CAST(na + nb - shared AS INTEGER) AS total
FROM sh JOIN na USING (source_a) JOIN nb USING (source_b) WHERE source_a <> source_b AND 100 * shared >= 60 * (na + nb - shared)""")
def q_unmatched_candidates(spark, sf):
    """U4: labels of two sources that no shared name matches, nearly the same text."""
    p = tbl(spark, sf, "part")
    a = p.select(F.initcap("p_name").alias("v"))
    m = F.col("p_partkey") % 3
    end = F.when(m == 0, "s").when(m == 1, F.concat(F.lit(" "), F.lower(F.element_at(F.split("p_type", " "), 1)))).otherwise("")
    b = p.select(F.concat("p_name", end).alias("v"))
    left = SD.standardise_values(a, "v", b, "v")["unmatched"]
    return SM.near_matches(left.select("source_a"), "source_a", left.select("source_b"), "source_b")


# -- sinks -----------------------------------------------------------------------

@query("raw_landing", "SELECT * EXCLUDE (o_orderkey) FROM " + _A_ROWS_SQL)
def q_raw_landing(spark, sf):
    """K1: a cleaned batch landed in a raw table, landed again as a retry does, read back."""
    store = _scratch_store(spark)
    for _ in range(2):
        store.land("raw_listings_a", _flat_a(spark, sf), RUN_DS)
    return spark.read.parquet(f"{store.path('raw_listings_a')}/data").drop("batch")


def _stg_a_batches(spark, sf):
    base = _stg_a_orders(spark, sf)
    b1 = base.where(F.col("datetime_published") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .withColumn("date_scraped", F.lit("2025-06-01").cast("date"))
    b2 = base.where(F.col("datetime_published") >= F.lit("1997-06-01").cast("timestamp_ntz")) \
        .withColumn("positions", F.col("positions") + 100).withColumn("title", F.concat(F.lit("New "), "title")) \
        .withColumn("date_scraped", F.lit("2025-06-02").cast("date"))
    return b1, b2


def _stg_a_orders(spark, sf):
    o = tbl(spark, sf, "orders")
    sa = "array<string>"
    df = o.select(
        F.concat(F.lit("job-"), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.concat(F.lit("Job "), F.col("o_orderkey").cast("string")).alias("title"),
        F.lit("Acme").alias("company"), F.array(F.lit("Alger")).alias("location"), F.lit(None).cast(sa).alias("job_level"),
        (F.col("o_custkey") % 5).cast("int").alias("positions"), F.col("o_orderdate").alias("datetime_published"),
        F.col("o_orderpriority").alias("sector"), F.lit(None).cast(sa).alias("function"),
        F.lit(None).cast(sa).alias("contract_type"), F.lit(None).cast(sa).alias("education_level"),
        F.lit(None).cast(sa).alias("experience_years"), F.lit(False).alias("is_anonymous"),
        F.col("o_orderstatus").alias("work_mode"), F.lit(None).cast("date").alias("date_scraped"),
        F.lit("Emploitic").alias("job_source"))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STG_A.fields])


@query("stage_upsert_a", r"""
SELECT 'job-' || o_orderkey AS job_id,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'Job ' || o_orderkey ELSE 'New Job ' || o_orderkey END AS title,
  CAST(o_custkey % 5 + CASE WHEN o_orderdate >= TIMESTAMP '1997-06-01' THEN 100 ELSE 0 END AS INTEGER) AS positions,
  CASE WHEN o_orderdate >= TIMESTAMP '1997-06-01' THEN '2025-06-02' ELSE '2025-06-01' END AS date_scraped
FROM orders""")
def q_stage_upsert_a(spark, sf):
    """K2 (+T16, T21): two days upserted into staging A; re-scraped jobs move partition, title kept."""
    store = _scratch_store(spark)
    b1, b2 = _stg_a_batches(spark, sf)
    SN.stage_a(store, b1)
    SN.stage_a(store, b2)
    return store.read("stg_emploitic", STG_A).select("job_id", "title", "positions", "date_scraped")


@query("stage_a_moved", r"""
SELECT '2025-06-01' AS day, 'job-' || o_orderkey AS job_id, CAST(o_custkey % 5 AS INTEGER) AS positions FROM orders
WHERE o_orderdate < TIMESTAMP '1997-06-01'
UNION ALL SELECT '2025-06-02', 'job-' || o_orderkey, CAST(o_custkey % 5 + 100 AS INTEGER) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'""")
def q_stage_a_moved(spark, sf):
    """After a day that moved jobs, each day read by itself."""
    store = _scratch_store(spark)
    for batch in _stg_a_batches(spark, sf):
        SN.stage_a(store, batch)
    one, two = (SN.read_day(store, "stg_emploitic", day).select(F.lit(day).alias("day"), "job_id", "positions")
                for day in ("2025-06-01", "2025-06-02"))
    return one.unionByName(two)


@query("stage_upsert_b", r"""
WITH s1 AS (SELECT 'job-' || o_orderkey AS job_id, nullif('City ' || (o_custkey % 50), 'City 0') AS city,
  o_orderpriority AS state, nullif(lower(o_orderstatus), 'p') AS region, CAST(o_orderkey % 100 AS INTEGER) AS nb_views
  FROM orders),
s2 AS (SELECT job_id, city, state, region, nb_views + 5 AS nb_views FROM s1)
SELECT coalesce(s2.job_id, s1.job_id) AS job_id, coalesce(s2.city, s1.city) AS city,
  CASE WHEN s2.job_id IS NOT NULL THEN s2.nb_views ELSE s1.nb_views END AS nb_views
FROM s1 FULL OUTER JOIN s2 ON s1.job_id = s2.job_id AND s1.city = s2.city AND s1.state = s2.state
  AND s1.region = s2.region""")
def q_stage_upsert_b(spark, sf):
    """K3 (+T9): the same day upserted twice; NULL key parts never conflict, so those rows repeat."""
    store = _scratch_store(spark)
    SN.stage_b(store, _stg_b(spark, sf), RUN_DS)
    SN.stage_b(store, _stg_b(spark, sf, views_bonus=5), RUN_DS)
    return store.read("stg_emploi_partner", STG_B).select("job_id", "city", "nb_views")


@query("summary_refresh", ORACLE["job_performance_summary"])
def q_summary_refresh(spark, sf):
    """K8: the stored summary fully refreshed as a new version, then read back."""
    store = _scratch_store(spark)
    store.replace("mv_job_performance_summary", GD.job_performance_summary(_daily_user(spark, sf)))
    return spark.read.parquet(store.current_path("mv_job_performance_summary"))


@query("view_publish", ORACLE["view_join"])
def q_view_publish(spark, sf):
    """K7: a bridge view published as a temporary view and queried by name."""
    QUERIES["view_join"](spark, sf).createOrReplaceTempView("vw_job_part")
    return spark.table("vw_job_part")


# -- C5 / C6 / C7 star schema, daily metrics and gold on the analogue snapshots ---

def _silver_store(spark, sf, with_metrics: bool = False):
    store = _scratch_store(spark)
    snap_a = SN.snapshot_a(_stg_a(spark, sf))
    stg_b = _stg_b(spark, sf)
    SV.build_silver(store, snap_a, SN.snapshot_b(stg_b))
    if with_metrics:
        SV.daily_metrics(store, stg_b, RUN_DS)
    return store


@query("build_silver", r"""
WITH a AS (SELECT DISTINCT 'job-' || p_partkey AS job_id, coalesce(nullif(p_brand, 'Brand#3'), 'Inconnu') AS company,
  coalesce(nullif(p_type, 'PROMO'), 'Inconnu') AS sector, CAST(p_size AS INTEGER) AS positions FROM part),
b AS (SELECT 'job-' || o_orderkey AS job_id, CASE WHEN o_custkey % 10 <> 0 THEN 'Company ' || o_custkey
  ELSE 'Inconnu' END AS company, coalesce(nullif(o_orderstatus, 'O'), 'Inconnu') AS sector,
  CAST(o_custkey % 5 + 1 AS INTEGER) AS positions FROM orders),
comp AS (SELECT label, row_number() OVER (ORDER BY label) AS id FROM
  (SELECT company AS label FROM a UNION SELECT company FROM b) WHERE label <> 'Inconnu'
  UNION ALL SELECT 'Inconnu', -1),
sect AS (SELECT label, row_number() OVER (ORDER BY label) AS id FROM
  (SELECT sector AS label FROM a UNION SELECT sector FROM b) WHERE label <> 'Inconnu'
  UNION ALL SELECT 'Inconnu', -1)
SELECT b.job_id, comp.id AS company_id, sect.id AS sector_id, b.positions AS m_positions,
  'EmploiPartner' AS job_source FROM b JOIN comp ON b.company = comp.label JOIN sect ON b.sector = sect.label
UNION ALL
SELECT a.job_id, comp.id, sect.id, a.positions, 'Emploitic' FROM a JOIN comp ON a.company = comp.label
  JOIN sect ON a.sector = sect.label WHERE a.job_id NOT IN (SELECT job_id FROM b)""")
def q_build_silver(spark, sf):
    """C5 (A1, A2, M2, M3, M7, J1, A3, A4, M4, M5, J2, J3): both sources into one star schema."""
    from listingmart.schemas import FCT_JOBS
    store = _silver_store(spark, sf)
    return store.read("fct_jobs", FCT_JOBS).select("job_id", "company_id", "sector_id", "m_positions", "job_source")


_DAILY_METRICS_SQL = r"""
WITH b AS (SELECT 'job-' || o_orderkey AS job_id, nullif('City ' || (o_custkey % 50), 'City 0') AS city,
  o_orderpriority AS state, nullif(lower(o_orderstatus), 'p') AS region, 'DZ' AS country,
  CAST(o_orderkey % 7 AS INTEGER) AS nb_applicants, CAST(o_orderkey % 100 AS INTEGER) AS nb_views, o_orderdate
  FROM orders),
bp AS (SELECT coalesce(city, 'Inconnu') AS city, state, country, max(region) AS region FROM b GROUP BY 1, 2, 3),
sa AS """ + "(" + _SNAP_A_SQL + ")" + r""",
places AS (SELECT city, state, country FROM sa WHERE city IS NOT NULL AND state IS NOT NULL
  AND country IS NOT NULL UNION SELECT city, state, country FROM bp),
ids AS (SELECT city, state, country, row_number() OVER (ORDER BY city, state, country) AS location_id FROM places
  WHERE NOT (city = 'Inconnu' AND state = 'Inconnu' AND country = 'Inconnu')),
daily AS (SELECT b.job_id, ids.location_id, '2025-06-02' AS date, b.nb_applicants, b.nb_views,
  CAST(date_diff('day', CAST(b.o_orderdate AS DATE), DATE '2025-06-02') AS INTEGER) AS days_since_published
  FROM b JOIN bp ON b.city = bp.city AND b.state = bp.state AND b.country = bp.country AND b.region = bp.region
  JOIN ids ON ids.city = b.city AND ids.state = b.state AND ids.country = b.country)
"""


@query("daily_metrics", _DAILY_METRICS_SQL + "SELECT * FROM daily")
def q_daily_metrics(spark, sf):
    """C6 (J4, J5, J6, A10, J7, W4, M6): daily changes of one day through the location bridge."""
    from listingmart.schemas import FCT_DAILY
    store = _silver_store(spark, sf, with_metrics=True)
    return store.read("fct_job_performance_daily", FCT_DAILY)


@query("build_gold", _DAILY_METRICS_SQL + r"""SELECT job_id, CAST(sum(nb_views) AS BIGINT) AS total_views,
  CAST(sum(nb_applicants) AS BIGINT) AS total_applicants, min(date) AS first_active_day, max(date) AS last_active_day
FROM daily GROUP BY job_id""")
def q_build_gold(spark, sf):
    """C7 (J8 x6, A11, J9, A12, K7, K8): gold views and refreshed summaries."""
    store = _silver_store(spark, sf, with_metrics=True)
    gold = GD.build_gold(store)
    return gold["mv_job_performance_summary"]
