"""One daily run over both sources (§3.1, §3.2): landing -> bronze -> silver -> gold.

Landing layout (one JSON file per fetched page or lookup list)::

    <landing>/a/<ds>/pages/*.json           source A listing pages
    <landing>/a/lookups/<attribute>.json    {"collection": [{id, label, ...}]}
    <landing>/b/<ds>/pages/*.json           source B listing pages
    <landing>/b/lookups/<name>.json         {"hydra:member": [{id, label|name}]}

HTTP fetching itself is an orchestrator's job and is not part of this engine.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from listingmart.operators.checks import assert_empty, check_not_null, check_schema, check_unique, has_rows
from listingmart.plans.clean import A_TRANSLATED, clean_a, clean_b
from listingmart.plans.gold import build_gold
from listingmart.plans.silver import build_silver, daily_metrics
from listingmart.plans.snapshot import read_day, snapshot_a, snapshot_b, stage_a, stage_b
from listingmart.schemas import STG_A, STG_B
from listingmart.session import cut_lineage
from listingmart.sources.listings import PAGE_A, PAGE_B, flatten_a, flatten_b, read_pages
from listingmart.sources.lookups import read_lookup
from listingmart.sources.scans import rejected_pages, scan_pages, scan_report, split_rows, usable_pages
from listingmart.sources.store import TableStore

B_LOOKUPS = {"experience": "experience", "sector": "sector", "function": "function"}


# What one cleaned day must satisfy before it is staged.
A_KEY = ["job_id"]
B_KEY = ["job_id", "country", "region", "state", "city"]
REQUIRED = ["job_id", "title", "datetime_published"]


def checked(df: DataFrame, schema: T.StructType, key: list[str], what: str) -> DataFrame:
    """The cleaned day, computed once; a wrong type, a missing value or a repeated key stops the run."""
    wrong = check_schema(df, {f.name: f.dataType for f in schema.fields})
    if wrong:
        raise AssertionError(f"{what}: wrong or missing columns {wrong}")
    df = cut_lineage(df)
    missing = {c: n for c, n in check_not_null(df, REQUIRED).first().asDict().items() if n}
    if missing:
        raise AssertionError(f"{what}: rows without a value: {missing}")
    assert_empty(check_unique(df, key), f"{what}: repeated {key}")
    return df


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# Of each source: page schema, list of listings, announced total, flattener, time columns (the first is required).
SCANS = {"a": (PAGE_A, "results", "pagination.total", flatten_a, ["datetime_published"]),
         "b": (PAGE_B, "hydra:member", "`hydra:totalItems`", flatten_b, ["datetime_published", "expire_date"])}


def day_rows(store: TableStore, source: str, path: str, ds: dt.date, rejects: bool) -> DataFrame:
    """The day's raw listings. With ``rejects`` unusable pages and listings go to the table
    ``rejects_<source>`` and the page report to ``page_report_<source>``, a folder for each day
    that a re-run replaces; without, they are left to the checks, which stop the run.
    """
    schema, listed, total, flatten, times = SCANS[source]
    if not rejects:
        return flatten(read_pages(store.spark, path, schema))
    scanned = cut_lineage(scan_pages(store.spark, path, schema, listed))  # read once for all that follows
    rows, bad = split_rows(flatten(usable_pages(scanned)), times)
    store.land(f"rejects_{source}", rejected_pages(scanned).unionByName(bad), str(ds))
    store.land(f"page_report_{source}", scan_report(scanned, total, listed), str(ds))
    return rows


def run_day(spark: SparkSession, landing: str, warehouse: str, ds: dt.date | str, keep: int | None = None, rejects: bool = False) -> dict:
    """Run both sources for ``ds`` and publish gold; returns the gold frames.

    ``keep``: versions of each table that stay (older ones go before the run
    writes, so frames of this run and of the one before it can be read); None: all.
    ``rejects``: unusable pages and listings are set aside (``day_rows``) and do not stop the run.
    """
    ds = dt.date.fromisoformat(str(ds)) if not isinstance(ds, dt.date) else ds
    store = TableStore(spark, warehouse)
    if keep:
        store.vacuum_all(keep)
    snaps = {}
    a_pages = f"{landing}/a/{ds.isoformat()}/pages"
    if _exists(spark, a_pages):
        rows = day_rows(store, "a", a_pages, ds, rejects)
        if has_rows(rows):  # P18 gate
            lookups = {a: read_lookup(spark, f"{landing}/a/lookups/{a}.json", "collection")
                       for a in A_TRANSLATED}
            stage_a(store, checked(clean_a(rows, ds, lookups), STG_A, A_KEY, "cleaned A"))
            snaps["a"] = snapshot_a(read_day(store, "stg_emploitic", ds))
    b_pages = f"{landing}/b/{ds.isoformat()}/pages"
    if _exists(spark, b_pages):
        rows = day_rows(store, "b", b_pages, ds, rejects)
        if has_rows(rows):
            lk = {k: read_lookup(spark, f"{landing}/b/lookups/{v}.json", "hydra:member")
                  for k, v in B_LOOKUPS.items()}
            cleaned = clean_b(rows, ds, lk["experience"].select("id", "label"), lk["sector"].select("id", "name"),
                              lk["function"].select("id", "name"))
            stage_b(store, checked(cleaned, STG_B, B_KEY, "cleaned B"), ds)
            snaps["b"] = snapshot_b(read_day(store, "stg_emploi_partner", ds))
    change = None
    if snaps:
        build_silver(store, snaps.get("a"), snaps.get("b"))
        if "b" in snaps:
            change = daily_metrics(store, read_day(store, "stg_emploi_partner", ds), ds)
    return build_gold(store, change)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m listingmart.plans.daily_run --landing L --warehouse W --ds YYYY-MM-DD``."""
    import argparse

    from listingmart.plans.audit import star_report
    from listingmart.session import get_session
    ap = argparse.ArgumentParser(description="Run one day of both sources: landing -> gold.")
    ap.add_argument("--landing", required=True, help="landing folder (see module docstring)")
    ap.add_argument("--warehouse", required=True, help="table store folder (shared file system)")
    ap.add_argument("--ds", required=True, help="run date, YYYY-MM-DD")
    ap.add_argument("--keep", type=int, help="versions of each table that stay (default: all)")
    ap.add_argument("--rejects", action="store_true", help="set unusable pages and listings aside")
    ap.add_argument("--audit", action="store_true", help="print the star-schema constraint report")
    args = ap.parse_args(argv)
    spark = get_session()
    gold = run_day(spark, args.landing, args.warehouse, args.ds, args.keep, args.rejects)
    print(f"published: {', '.join(sorted(gold))}")
    if args.audit:
        star_report(TableStore(spark, args.warehouse)).where("violations > 0").show(truncate=False)


if __name__ == "__main__":
    main()
