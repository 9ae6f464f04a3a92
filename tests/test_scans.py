"""File scans: what cannot be used is kept as rows, the rest goes on."""

import json
import os

from fixtures import a_listing, item, land_a, land_lookups
from listingmart.plans.daily_run import run_day
from listingmart.schemas import STG_A
from listingmart.sources.listings import PAGE_A, flatten_a
from listingmart.sources.scans import rejected_pages, scan_pages, scan_report, split_rows, usable_pages
from listingmart.sources.store import TableStore


def _row(title, published="2025-06-01T10:00:00"):
    return a_listing(title, "Acme", published, location=[item(10, "Alger, Alger, Algérie")], sector=item(60, "Industrie"))


def _landing(base):
    land_lookups(base)
    land_a(base, "2025-06-02", [[_row("Un"), _row("Deux")], [_row(None), _row("Trois", "bientôt"), _row("Quatre", None)], [_row("Cinq")]])
    pages = f"{base}/a/2025-06-02/pages"
    whole = open(f"{pages}/page-00001.json", encoding="utf-8").read()
    bad = {"page-00004.json": whole, "page-00005.json": whole[:len(whole) // 2], "page-00006.json": " \n", "page-00007.json": "[1, 2]",
           "page-00008.json": json.dumps({"pagination": {"total": 6}}), "page-00009.json": json.dumps({"pagination": {"total": 6}, "results": []})}
    for name, text in bad.items():
        with open(os.path.join(pages, name), "w", encoding="utf-8") as f:
            f.write(text)
    return pages


def test_every_page_is_used_or_rejected(spark, tmp_path):
    scanned = scan_pages(spark, _landing(str(tmp_path / "l")), PAGE_A, "results")
    bad = {r.file.rsplit("/", 1)[1]: r.reason for r in rejected_pages(scanned).collect()}
    assert bad == {"page-00004.json": "repeated page", "page-00005.json": "unreadable page", "page-00006.json": "unreadable page",
                   "page-00007.json": "unreadable page", "page-00008.json": "page without listings"}
    good, rows = split_rows(flatten_a(usable_pages(scanned)), ["datetime_published"])
    assert sorted(r.title for r in good.collect()) == ["Cinq", "Deux", "Un"] and good.columns == flatten_a(usable_pages(scanned)).columns
    assert sorted((r.reason, r.title or "") for r in rows.collect()) == [
        ("no datetime_published", "Quatre"), ("no title", ""), ("unreadable datetime_published", "Trois")]
    assert all(json.loads(r.raw)["company"] == "Acme" for r in rows.collect())
    assert tuple(scan_report(scanned, "pagination.total", "results").first()) == (6, 9, 5, 6, True)


def test_a_day_goes_on_without_what_it_rejects(spark, tmp_path):
    base, wh = str(tmp_path / "l"), str(tmp_path / "wh")
    _landing(base)
    for _ in range(2):  # a re-run replaces the day's rejects
        run_day(spark, base, wh, "2025-06-02", rejects=True)
    store = TableStore(spark, wh)
    assert sorted(r.title for r in store.read("stg_emploitic", STG_A).collect()) == ["Cinq", "Deux", "Un"]
    assert spark.read.parquet(f"{store.path('rejects_a')}/data").count() == 8
    assert spark.read.parquet(f"{store.path('page_report_a')}/data").first().pages_rejected == 5
