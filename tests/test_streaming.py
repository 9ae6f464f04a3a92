import pytest

from fixtures import a_listing, item, land_a, land_lookups
from listingmart.plans.clean import A_TRANSLATED
from listingmart.schemas import STG_A
from listingmart.sources.lookups import read_lookup
from listingmart.sources.store import TableStore
from listingmart.streaming.landing import ingest_new_pages


def test_incremental_landing(spark, tmp_path):
    landing, wh, ck = str(tmp_path / "l"), str(tmp_path / "wh"), str(tmp_path / "ck")
    land_lookups(landing)
    lookups = {a: read_lookup(spark, f"{landing}/a/lookups/{a}.json", "collection") for a in A_TRANSLATED}
    row = lambda t: a_listing(t, "Acme", "2025-06-01T10:00:00", location=[item(10, "Alger, Alger, Algérie")],  # noqa
                              sector=item(60, "Industrie"))
    land_a(landing, "2025-06-02", [[row("Poste un")]])
    pages = f"{landing}/a/2025-06-02/pages"
    assert ingest_new_pages(spark, "a", pages, wh, "2025-06-02", lookups, ck) == 1
    # a second page lands later; only it is processed
    import json
    import os
    with open(os.path.join(pages, "page-00002.json"), "w", encoding="utf-8") as f:
        json.dump({"pagination": {"total": 2, "totalPages": 2}, "results": [row("Poste deux")]}, f)
    assert ingest_new_pages(spark, "a", pages, wh, "2025-06-02", lookups, ck) == 1
    assert ingest_new_pages(spark, "a", pages, wh, "2025-06-02", lookups, ck) == 0
    titles = sorted(r.title for r in TableStore(spark, wh).read("stg_emploitic", STG_A).collect())
    assert titles == ["Poste deux", "Poste un"]


def test_any_split_of_a_day_gives_one_result(spark, tmp_path):
    """Source B sums the counters of a listing's pages, whichever run of the stream landed them."""
    import os
    import shutil

    from fixtures import b_listing, land_b
    from listingmart.schemas import STG_B
    landing = str(tmp_path / "l")
    land_lookups(landing)
    lk = {k: read_lookup(spark, f"{landing}/b/lookups/{k}.json", "hydra:member") for k in ("experience", "sector", "function")}
    lk = {"experience": lk["experience"].select("id", "label"), "sector": lk["sector"].select("id", "name"),
          "function": lk["function"].select("id", "name")}
    one, two = (b_listing("Poste", "Acme", "2025-06-01 10:00:00", views=v, applicants=a) for v, a in ((10, 2), (7, 3)))
    land_b(landing, "2025-06-02", [[one], [two]])
    pages = f"{landing}/b/2025-06-02/pages"
    ingest_new_pages(spark, "b", pages, str(tmp_path / "w1"), "2025-06-02", lk, str(tmp_path / "c1"))
    slow = str(tmp_path / "slow")
    os.makedirs(slow)
    for name in sorted(os.listdir(pages)):
        shutil.copy(os.path.join(pages, name), slow)
        ingest_new_pages(spark, "b", slow, str(tmp_path / "w2"), "2025-06-02", lk, str(tmp_path / "c2"))
    both = [[(r.nb_views, r.nb_applicants) for r in TableStore(spark, str(tmp_path / w)).read("stg_emploi_partner", STG_B).collect()]
            for w in ("w1", "w2")]
    assert both[0] == both[1] == [(17, 5)]


def _lookups_b(spark, landing):
    lk = {k: read_lookup(spark, f"{landing}/b/lookups/{k}.json", "hydra:member") for k in ("experience", "sector", "function")}
    return {"experience": lk["experience"].select("id", "label"), "sector": lk["sector"].select("id", "name"),
            "function": lk["function"].select("id", "name")}


def test_a_failed_staging_is_made_up_for(spark, tmp_path, monkeypatch):
    from listingmart.streaming import landing as LD
    landing, wh, ck = (str(tmp_path / x) for x in ("l", "wh", "ck"))
    land_lookups(landing)
    lookups = {a: read_lookup(spark, f"{landing}/a/lookups/{a}.json", "collection") for a in A_TRANSLATED}
    land_a(landing, "2025-06-02", [[a_listing("Poste un", "Acme", "2025-06-01T10:00:00", location=[item(10, "Alger, Alger, Algérie")],
                                              sector=item(60, "Industrie"))]])
    pages, whole = f"{landing}/a/2025-06-02/pages", LD.stage_a

    def broken(*_):
        raise OSError("lost")
    monkeypatch.setattr(LD, "stage_a", broken)
    with pytest.raises(OSError):
        ingest_new_pages(spark, "a", pages, wh, "2025-06-02", lookups, ck)
    monkeypatch.setattr(LD, "stage_a", whole)
    assert ingest_new_pages(spark, "a", pages, wh, "2025-06-02", lookups, ck) == 0  # no new page, yet staged
    assert TableStore(spark, wh).read("stg_emploitic", STG_A).count() == 1


def test_null_places_do_not_repeat(spark, tmp_path):
    import os
    import shutil

    from fixtures import b_listing, land_b
    from listingmart.schemas import STG_B
    landing, slow = str(tmp_path / "l"), str(tmp_path / "slow")
    land_lookups(landing)
    listings = [b_listing(f"Poste {i}", "Acme", "2025-06-01 10:00:00", views=i, applicants=1) for i in range(3)]
    for x in listings:
        x["city"] = None
    land_b(landing, "2025-06-02", [[x] for x in listings])
    pages = f"{landing}/b/2025-06-02/pages"
    os.makedirs(slow)
    for name in sorted(os.listdir(pages)):
        shutil.copy(os.path.join(pages, name), slow)
        ingest_new_pages(spark, "b", slow, str(tmp_path / "w"), "2025-06-02", _lookups_b(spark, landing), str(tmp_path / "c"))
    assert TableStore(spark, str(tmp_path / "w")).read("stg_emploi_partner", STG_B).count() == 3


def test_rows_without_title_stop_the_stream(spark, tmp_path):
    landing, wh, ck = (str(tmp_path / x) for x in ("l", "wh", "ck"))
    land_lookups(landing)
    lookups = {a: read_lookup(spark, f"{landing}/a/lookups/{a}.json", "collection") for a in A_TRANSLATED}
    land_a(landing, "2025-06-02", [[a_listing(None, "Acme", "2025-06-01T10:00:00", location=[item(10, "Alger, Alger, Algérie")],
                                              sector=item(60, "Industrie"))]])
    with pytest.raises(AssertionError, match="title"):
        ingest_new_pages(spark, "a", f"{landing}/a/2025-06-02/pages", wh, "2025-06-02", lookups, ck)
    assert TableStore(spark, wh).read("stg_emploitic", STG_A).count() == 0
