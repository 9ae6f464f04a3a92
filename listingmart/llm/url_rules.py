"""Operator 9: URL filter rules by a sort-merge range join (DataFrame functions only).

A host's labels are reversed and each ends with a dot (``www.example.net`` ->
``net.example.www.``), so a host and all its subdomains are one interval of
the sorted keys: from ``net.example.`` up to, not including, ``net.example/``
(the character after the dot, which no host holds). Every interval bound opens
a segment that carries the stack of rules active from there on; the urls and
the segments are range-sorted together and one sweep gives each url the last
segment at or before its key. Of the stack, the rule with the longest text
whose path starts the url's path decides.

The sweep is a running ``last`` within each range partition; what a partition
inherits from those before it is one row per partition. Equal keys are spread
by a hash of the row, so a host with a third of all pages fills no partition.

Defined results: NULL url or no ``://``: empty host and path, no rule, the
default verdict. Equal rules count once; block wins between the two verdicts
of one (host, path). No rules: every url gets the default verdict. Rules whose
text is equally long: the one with the longer host. Repeated pages are judged
alike. NULL page_id is kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingmart.llm.common import query, stored, table

#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DEFAULT_VERDICT = "allow"
_RULE = "struct<span:int,host_span:int,path:string,rule:string,verdict:string>"


def _ascii_lower(c):
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url):
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host):
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    """(verdict, host, path) rows from literals."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("verdict", "host", "path")])
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("verdict", "host", "path"), r, strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def segments(rules: DataFrame) -> DataFrame:
    """(key, stack): the rules active from each interval bound on, up to the next bound.

    The rules around a bound are those whose key is a label prefix of it, so the
    nesting is an equi-join on the prefixes and never compares rules in pairs.
    """
    r = (rules.select(F.col("verdict").alias("verdict"), _ascii_lower(F.col("host")).alias("host"), F.col("path").alias("path"))
         .filter("verdict IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL")
         .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
         .select(host_key(F.col("host")).alias("key"), "host", "path", "verdict"))
    own = r.select(F.col("key").alias("of"), F.struct(
        F.length(F.concat("host", "path")).alias("span"), F.length("host").alias("host_span"), "path",
        F.concat("host", "path").alias("rule"), "verdict").alias("entry"))
    keys = r.select("key").distinct()
    labels = F.slice(F.split("key", r"\."), 1, F.size(F.split("key", r"\.")) - 1)
    prefixes = F.transform(F.sequence(F.lit(1), F.size("labels")),
                           lambda n: F.concat(F.array_join(F.slice("labels", 1, n), "."), F.lit(".")))
    around = keys.withColumn("labels", labels).select("key", F.explode(prefixes).alias("of"))
    after = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    bounds = around.select("key", "of").unionByName(
        around.filter("of <> key").select(after.alias("key"), "of"))
    closed = keys.select(after.alias("key"))
    stacks = bounds.join(own, "of").groupBy("key").agg(F.collect_list("entry").alias("stack"))
    return closed.unionByName(keys).distinct().join(stacks, "key", "left").select(
        "key", F.coalesce("stack", F.array().cast(f"array<{_RULE}>")).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``."""
    urls = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
            .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    events = urls.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
                         F.xxhash64("page_id", "path").alias("tie"), "page_id", "host", "path",
                         F.lit(None).cast(f"array<{_RULE}>").alias("stack")).unionByName(
        segments(rules).select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tie"),
                               F.lit(None).cast(urls.schema["page_id"].dataType).alias("page_id"),
                               F.lit("").alias("host"), F.lit("").alias("path"), "stack"))
    dealt = stored(events.repartitionByRange("key", "kind", "tie").withColumn("part", F.spark_partition_id()), "url-sweep")
    last = F.last("stack", ignorenulls=True)
    swept = dealt.withColumn("own", last.over(
        Window.partitionBy("part").orderBy("key", "kind", "tie").rowsBetween(Window.unboundedPreceding, 0)))
    # one row per range partition: the last segment that the partitions before it have seen
    ends = dealt.groupBy("part").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack"))
    inherited = ends.select("part", last.over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    active = F.filter(F.coalesce("own", "before", F.array().cast(f"array<{_RULE}>")),
                      lambda e: F.col("path").startswith(e["path"]))
    best = F.array_max(active)  # longest text, then longest host
    return (swept.filter("kind = 1").join(F.broadcast(inherited), "part")
            .select("page_id", "host", "path", best["rule"].alias("rule"), best["verdict"].alias("verdict"))
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))


def _oracle(rules, default: str) -> str:
    """The rules as plain predicates, longest first."""
    whens = []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]))):
        test = f"((host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}'))"
        whens.append((test, host + path, verdict))
    rule = reduce(lambda s, w: s + f" WHEN {w[0]} THEN '{w[1]}'", whens, "CASE") + " END"
    verdict = reduce(lambda s, w: s + f" WHEN {w[0]} THEN '{w[2]}'", whens, "CASE") + f" ELSE '{default}' END"
    return rf"""WITH u AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages)
SELECT page_id, host, path, {rule} AS "rule", {verdict} AS verdict FROM u"""


@query("op9_url_rules", _oracle(RULES, DEFAULT_VERDICT))
def op9_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    return judge_urls(table(spark, sf, "pages"), rules_frame(spark, RULES))
