"""Analogue queries, SURVEY §2.10 scalar, array and map functions (and the F22 value maps)."""

from __future__ import annotations

from pyspark.sql import functions as F

from listingmart.functions import arrays as A
from listingmart.functions import dates as D
from listingmart.functions import text as X
from listingmart.sources import lookups as VM
from listingmart.analogues.registry import ORACLE, QUERIES, query, tbl


_SQL_TITLE_WORD = r"""array_to_string(list_transform(regexp_extract_all(w, '(\p{L}+|[^\p{L}]+)', 1),
    lambda r: CASE WHEN regexp_matches(r, '^\p{L}') THEN
      (CASE WHEN substr(r, 1, 1) = 'ß' THEN 'Ss' ELSE upper(substr(r, 1, 1)) END) || lower(substr(r, 2))
                   ELSE r END), '')"""


@query("french_titlecase", r"""
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN text ELSE array_to_string(list_transform(
  string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+'),
  lambda w, i: CASE
    WHEN starts_with(lower(w), 'd''') OR starts_with(lower(w), 'l''')
      THEN substr(w, 1, 2) || (CASE WHEN substr(w, 3, 1) = 'ß' THEN 'Ss' ELSE upper(substr(w, 3, 1)) END)
           || lower(substr(w, 4))
    WHEN i <> 1 AND lower(w) IN ('et','de','du','des','la','le','les','d''','l''') THEN lower(w)
    WHEN w = upper(w) AND NOT contains(w, 'ß') THEN w
    ELSE """ + _SQL_TITLE_WORD + r""" END), ' ') END AS titled
FROM documents""")
def q_french_titlecase(spark, sf):
    """F1 on whole documents."""
    return tbl(spark, sf, "documents").select("doc_id", X.french_titlecase("text").alias("titled"))


@query("title_case", r"""
SELECT page_id, array_to_string(list_transform(regexp_extract_all(url, '(\p{L}+|[^\p{L}]+)', 1),
  lambda r: CASE WHEN regexp_matches(r, '^\p{L}') THEN upper(substr(r, 1, 1)) || lower(substr(r, 2))
                 ELSE r END), '') AS titled
FROM pages""")
def q_title_case(spark, sf):
    """F2 on page URLs."""
    return tbl(spark, sf, "pages").select("page_id", X.title_case("url").alias("titled"))


@query("capitalize", r"""
SELECT c_custkey, upper(substr(v, 1, 1)) || lower(substr(v, 2)) AS capitalized
FROM (SELECT c_custkey, lower(c_mktsegment) || ' ' || c_name AS v FROM customer)""")
def q_capitalize(spark, sf):
    """F3 on customer segment + name."""
    c = tbl(spark, sf, "customer")
    v = F.concat(F.lower("c_mktsegment"), F.lit(" "), F.col("c_name"))
    return c.select("c_custkey", X.capitalize(v).alias("capitalized"))


@query("slash_to_comma", r"""
SELECT page_id, regexp_replace(url, '\s*/\s*', ', ', 'g') AS url_commas FROM pages""")
def q_slash_to_comma(spark, sf):
    """F5 on page URLs."""
    return tbl(spark, sf, "pages").select("page_id", X.slash_to_comma("url").alias("url_commas"))


@query("split_names", r"""
SELECT p_partkey, array_to_string(string_split_regex(
  p_name || ' - ' || p_type || ' & ' || p_brand || ', R&D', '\s*,\s*|\s*-\s*|\s+&\s*|\s*&\s+'), '|') AS names
FROM part""")
def q_split_names(spark, sf):
    """names split on comma, dash, spaced ampersand (R&D kept whole)."""
    p = tbl(spark, sf, "part")
    v = F.concat_ws("", "p_name", F.lit(" - "), "p_type", F.lit(" & "), "p_brand", F.lit(", R&D"))
    return p.select("p_partkey", F.array_join(X.split_names(v), "|").alias("names"))


@query("unicode_repair", r"""
SELECT doc_id, replace(text, 'e', 'é') AS repaired FROM documents""")
def q_unicode_repair(spark, sf):
    """F10 on whole documents: every 'e' escaped (bare or with backslash by language), then repaired."""
    d = tbl(spark, sf, "documents")
    broken = F.when(F.col("lang").isin("fr", "de"), F.regexp_replace("text", "e", "u00e9")) \
        .otherwise(F.regexp_replace("text", "e", r"\\u00e9"))
    return d.select("doc_id", X.unicode_repair(broken).alias("repaired"))


@query("split_location", r"""
SELECT c_custkey, array_to_string(regexp_split_to_array(
  r_name || ' , ' || n_name || ',' || c_mktsegment || '  ,c' || c_custkey, '\s*,\s*'), '|') AS parts
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_split_location(spark, sf):
    """F11 on a place text built from customer, nation and region."""
    c, n, r = tbl(spark, sf, "customer"), tbl(spark, sf, "nation"), tbl(spark, sf, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    loc = F.concat("r_name", F.lit(" , "), "n_name", F.lit(","), "c_mktsegment", F.lit("  ,c"),
                   F.col("c_custkey").cast("string"))
    return j.select("c_custkey", F.array_join(X.split_location(loc), "|").alias("parts"))


_LOC_SQL = r"""(SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE array_to_string(
   list_slice([p_type, p_brand, p_name, 'Z' || p_size, 'Y'], 1, p_size % 5 + 1), ', ') END AS loc FROM part)"""


def _loc(spark, sf):
    p = tbl(spark, sf, "part")
    parts = F.array("p_type", "p_brand", "p_name", F.concat(F.lit("Z"), F.col("p_size").cast("string")),
                    F.lit("Y"))
    loc = F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.array_join(F.slice(parts, 1, F.col("p_size") % 5 + 1), ", "))
    return p.select("p_partkey", loc.alias("loc"))


@query("location_parts", r"""
SELECT p_partkey,
  CASE WHEN a IS NOT NULL THEN coalesce(a[-4], 'Inconnu') END AS city,
  CASE WHEN a IS NOT NULL THEN coalesce(a[-2], 'Inconnu') END AS state,
  CASE WHEN a IS NOT NULL THEN coalesce(a[-1], 'Inconnu') END AS country
FROM (SELECT p_partkey, regexp_split_to_array(loc, '\s*,\s*') AS a FROM """ + _LOC_SQL + ")")
def q_location_parts(spark, sf):
    """city is the 4th part from the end; 1 to 5 parts and NULL places."""
    parts = A.location_parts(X.split_location("loc"))
    return _loc(spark, sf).select("p_partkey", *[parts[k].alias(k) for k in ("city", "state", "country")])


@query("lockstep_unnest", r"""
SELECT p_partkey, unnest(a) AS a, unnest(b) AS b, unnest(c) AS c FROM (
  SELECT p_partkey, string_split(p_name, ' ') AS a,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE string_split(p_brand, '#') END AS b,
         string_split(p_type, 'O') AS c FROM part)""")
def q_lockstep_unnest(spark, sf):
    """three arrays side by side, padded with NULL; a NULL array pads too."""
    p = tbl(spark, sf, "part").select(
        "p_partkey", F.split("p_name", " ").alias("a"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(F.split("p_brand", "#")).alias("b"),
        F.split("p_type", "O").alias("c"))
    return A.lockstep_unnest(p, ["a", "b", "c"]).select("p_partkey", "a", "b", "c")


_EXPLODE_SRC = r"""(SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN []::VARCHAR[]
   ELSE string_split(p_name, ' ') END AS l FROM part)"""


@query("explode", r"""
SELECT p_partkey, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS token
FROM """ + _EXPLODE_SRC + r""" WHERE len(l) > 0
UNION ALL
SELECT p_partkey, NULL::INTEGER, NULL::VARCHAR FROM """ + _EXPLODE_SRC + " WHERE l IS NULL OR len(l) = 0")
def q_explode(spark, sf):
    """F16: list -> rows with position; NULL and empty lists keep one NULL row."""
    p = tbl(spark, sf, "part")
    lst = (F.when(F.col("p_size") % 4 == 0, F.lit(None).cast("array<string>"))
           .when(F.col("p_size") % 4 == 1, F.array().cast("array<string>"))
           .otherwise(F.split("p_name", " ")))
    return A.explode_keep_empty(p.select("p_partkey", lst.alias("l")), "l", "pos", "token")


@query("struct_labels", r"""
SELECT p_partkey, p_name || ' / ' || p_brand AS labels FROM part""")
def q_struct_labels(spark, sf):
    """list of {id, label} structs -> list of labels."""
    p = tbl(spark, sf, "part")
    items = F.array(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("label")),
                    F.struct((F.col("p_partkey") + 1).alias("id"), F.col("p_brand").alias("label")))
    return p.select("p_partkey", F.array_join(A.struct_labels(items), " / ").alias("labels"))


PRIORITY_MAP = {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"}
TOKEN_MAP = {"red": "rouge", "bolt": "boulon", "small": "petit"}


@query("replace_scalar", r"""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
  WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS priority FROM orders""")
def q_replace_scalar(spark, sf):
    """whole-value map, unmapped values kept."""
    o = tbl(spark, sf, "orders")
    return o.select("o_orderkey", A.replace_scalar("o_orderpriority", PRIORITY_MAP).alias("priority"))


@query("replace_in_array", r"""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x:
  CASE x WHEN 'red' THEN 'rouge' WHEN 'bolt' THEN 'boulon' WHEN 'small' THEN 'petit' ELSE x END), ' ') AS replaced
FROM part""")
def q_replace_in_array(spark, sf):
    """the same map on every element."""
    p = tbl(spark, sf, "part")
    return p.select("p_partkey", F.array_join(A.replace_in_array(F.split("p_name", " "), TOKEN_MAP), " ")
                    .alias("replaced"))


@query("epoch_millis", r"""
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events""")
def q_epoch_millis(spark, sf):
    """timestamp -> milliseconds since the epoch."""
    return tbl(spark, sf, "events").select("event_id", D.epoch_millis("ts").alias("ts_ms"))




# -- F22 the fixed value maps applied to table rows ----------------------------


_ARRAY_FIELDS_A = {"education_level", "experience_years", "function", "contract_type"}


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _map_labels(source: str, field: str) -> list[str]:
    return list(VM.value_map(source, field)) + ["Valeur Sans Correspondance"]


def _value_map_query(source: str):
    def q(spark, sf):
        c = tbl(spark, sf, "customer")
        cols = [F.col("c_custkey")]
        for field, m in VM.value_maps(source).items():
            labels = _map_labels(source, field)
            pick = F.element_at(F.array(*[F.lit(x) for x in labels]),
                                (F.col("c_custkey") % len(labels) + 1).cast("int"))
            if source == "A" and field in _ARRAY_FIELDS_A:
                other = F.element_at(F.array(*[F.lit(x) for x in labels]),
                                     ((F.col("c_custkey") + 1) % len(labels) + 1).cast("int"))
                cols.append(F.array_join(A.replace_in_array(F.array(pick, other), m), "|").alias(field))
            else:
                cols.append(A.replace_scalar(pick, m).alias(field))
        return c.select(*cols)
    return q


def _value_map_sql(source: str) -> str:
    cols = ["c_custkey"]
    for field, m in VM.value_maps(source).items():
        labels = _map_labels(source, field)
        lst = "[" + ", ".join(_sql_str(x) for x in labels) + "]"
        case = "CASE x " + " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(v)}" for k, v in m.items()) + " ELSE x END"
        pick = f"list_extract({lst}, CAST(c_custkey % {len(labels)} + 1 AS INTEGER))"
        if source == "A" and field in _ARRAY_FIELDS_A:
            other = f"list_extract({lst}, CAST((c_custkey + 1) % {len(labels)} + 1 AS INTEGER))"
            cols.append(f"array_to_string(list_transform([{pick}, {other}], lambda x: {case}), '|') AS {field}")
        else:
            cols.append(f"(SELECT {case} FROM (SELECT {pick} AS x)) AS {field}")
    return "SELECT " + ", ".join(cols) + " FROM customer"


QUERIES["value_map_a"] = _value_map_query("A")
ORACLE["value_map_a"] = _value_map_sql("A")
QUERIES["value_map_b"] = _value_map_query("B")
ORACLE["value_map_b"] = _value_map_sql("B")
