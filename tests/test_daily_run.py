import datetime as dt


from pyspark.sql import functions as F

from fixtures import a_listing, b_listing, item, land_a, land_b, land_lookups
from listingmart.plans.daily_run import run_day
from listingmart.sources.store import TableStore
from listingmart.schemas import STG_A, STG_B, FCT_JOBS, FCT_DAILY, DIM_LOCATION


def _a_pages():
    p1 = [
        a_listing("Ingénieur réseau", "Acme", "2025-06-01T10:00:00+01:00",
                  location=[item(10, "Alger, Alger, Algérie")],
                  function=[item(41, "Informatique"), item(40, "Autre")],
                  job_level={"id": "50", "label": "Confirmé", "lang": "fr"},
                  education=[item(20, "TS Bac +2")], experience=[item(30, "Sans Expérience")],
                  contract=[{"label": "Permanent Contract"}], sector=item(60, "Industrie")),
        a_listing("Comptable", "Beta", "2025-06-01T09:00:00",
                  location=[item(11, "Centre, Bab Ezzouar, X, Alger, Algérie", "en")],
                  function=None, job_level=[], education=[item(21, "Master")],
                  experience=[item(31, "3 À 5 Ans")], contract=None, sector=item(61, "Bank", "en"),
                  work_mode="hybrid"),
    ]
    p2 = [p1[0]]  # exact duplicate on page 2
    return [p1, p2]


def _b_pages():
    return [[
        b_listing("Juriste senior", "Gamma", "2025-06-01T08:00:00", applicants=3, views=30,
                  salary={"min": 100, "max": 200}, expire="2025-07-01T00:00:00"),
        b_listing("Juriste senior", "Gamma", "2025-06-01T08:00:00", applicants=2, views=5,
                  salary={}, expire=None),
        b_listing("Coach sportif", "Acme", "2025-05-30T08:00:00", city=None, function_id=2,
                  exp_id=2, sector_id=2, contracts=[], applicants=None, views=None),
    ]]


def test_two_days(spark, tmp_path):
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    land_lookups(landing)
    land_a(landing, "2025-06-02", _a_pages())
    land_b(landing, "2025-06-02", _b_pages())
    gold = run_day(spark, landing, wh, "2025-06-02")
    store = TableStore(spark, wh)
    stg_a = store.read("stg_emploitic", STG_A).collect()
    assert len(stg_a) == 2
    by_title = {r.title: r for r in stg_a}
    r = by_title["Ingénieur réseau"]
    assert r.function == ["Informatique", "Autres"]
    assert r.education_level == ["Bac +2"]
    assert r.experience_years == ["<1 An"]
    assert r.contract_type == ["CDI"]
    assert r.job_level == ["Confirmé"]
    assert r.work_mode == "Sur site"
    assert r.datetime_published == dt.datetime(2025, 6, 1, 10, 0)
    c = by_title["Comptable"]
    assert c.sector == "Banque"  # translated by id
    assert c.location == ["Centre, Bab Ezzouar, X, Alger, Algérie"]
    assert c.function == [None]
    stg_b = store.read("stg_emploi_partner", STG_B).collect()
    assert len(stg_b) == 2
    j = [r for r in stg_b if r.title == "Juriste senior"][0]
    assert j.nb_applicants == 5 and j.nb_views == 35
    assert j.function == "Audit, Conseil, Fiscal, Juridique"
    assert j.sector == "BTP, Construction, Immobilier"
    assert j.experience_years == "<1 An"
    assert j.region == "Ouest"
    assert j.work_mode == "Hybride"
    fact = store.read("fct_jobs", FCT_JOBS)
    assert fact.count() == 4
    daily = store.read("fct_job_performance_daily", FCT_DAILY).collect()
    # the job with a NULL city never matches the location dimension
    assert len(daily) == 1 and daily[0].nb_applicants == 5
    summ = gold["mv_job_performance_summary"].collect()
    assert summ[0].total_views == 35
    _star_constraints(store)
    from listingmart.plans.audit import star_report
    report = star_report(store).collect()
    assert len(report) > 30 and all(r.violations == 0 for r in report), [r for r in report if r.violations]
    loc = store.read("dim_location", DIM_LOCATION).collect()
    cities = {(r.city, r.state, r.country) for r in loc}
    assert ("Bab Ezzouar", "Alger", "Algérie") in cities and ("Inconnu", "Alger", "Algérie") in cities
    # day 2: counters grow, delta = new cumulative - previous
    land_b(landing, "2025-06-03", [[
        b_listing("Juriste senior", "Gamma", "2025-06-01T08:00:00", applicants=9, views=50,
                  salary={"min": 100, "max": 200}, expire="2025-07-01T00:00:00")]])
    run_day(spark, landing, wh, "2025-06-03")
    daily = {r.date: r for r in store.read("fct_job_performance_daily", FCT_DAILY).collect()}
    assert daily[dt.date(2025, 6, 3)].nb_applicants == 4
    assert daily[dt.date(2025, 6, 3)].nb_views == 15
    assert daily[dt.date(2025, 6, 3)].days_since_published == 2
    # re-running a day changes nothing
    run_day(spark, landing, wh, "2025-06-03")
    again = store.read("fct_job_performance_daily", FCT_DAILY).orderBy("date").collect()
    assert [(r.date, r.nb_applicants) for r in again] == [(dt.date(2025, 6, 2), 5), (dt.date(2025, 6, 3), 4)]
    assert store.read("fct_jobs", FCT_JOBS).count() == 4


def test_cleaning_is_repeatable_under_any_partitioning(spark, tmp_path):
    """With an explicit total order, results do not depend on how rows arrive."""
    from listingmart.plans.clean import clean_b
    from listingmart.sources.listings import PAGE_B, flatten_b, read_pages
    from listingmart.sources.lookups import read_lookup
    landing = str(tmp_path / "l")
    land_lookups(landing)
    land_b(landing, "2025-06-02", _b_pages() + [_b_pages()[0][::-1]])  # the same rows again, reversed
    rows = flatten_b(read_pages(spark, f"{landing}/b/2025-06-02/pages", PAGE_B)).cache()
    lk = {k: read_lookup(spark, f"{landing}/b/lookups/{k}.json", "hydra:member")
          for k in ("experience", "sector", "function")}

    def run(df):
        out = clean_b(df, "2025-06-02", lk["experience"].select("id", "label"), lk["sector"].select("id", "name"),
                      lk["function"].select("id", "name"))
        return sorted(tuple(r) for r in out.collect())

    base = run(rows)
    assert run(rows.repartition(7)) == base
    assert run(rows.repartition(3).orderBy(F.rand(5))) == base


def _star_constraints(store):
    """M11-M13 on the star tables: unique keys and labels, no orphans, T20."""
    from listingmart.operators.checks import check_unique, orphans
    from listingmart.schemas import BRIDGES, FCT_DAILY, LABEL_DIMS, bridge_schema, label_dim_schema
    fact = store.read("fct_jobs", FCT_JOBS)
    assert check_unique(fact, ["job_id"]).isEmpty()
    for name, (id_col, label_col, _) in LABEL_DIMS.items():
        dim = store.read(name, label_dim_schema(name))
        assert check_unique(dim, [id_col]).isEmpty() and check_unique(dim, [label_col]).isEmpty()
        assert dim.where(f"{id_col} = -1").count() == 1  # unknown member
    companies = [r.company_name for r in store.read("dim_company", label_dim_schema("dim_company")).collect()]
    assert companies.count("Acme") == 1  # the same label from both sources is one member (T20)
    assert orphans(fact, store.read("dim_company", label_dim_schema("dim_company")), ["company_id"]).isEmpty()
    assert orphans(fact, store.read("dim_sector", label_dim_schema("dim_sector")), ["sector_id"]).isEmpty()
    for name, (dim_name, id_col, _) in BRIDGES.items():
        br = store.read(name, bridge_schema(name))
        assert check_unique(br, ["job_id", id_col]).isEmpty()
        assert orphans(br, fact, ["job_id"]).isEmpty()
        dim_schema = DIM_LOCATION if dim_name == "dim_location" else label_dim_schema(dim_name)
        assert orphans(br, store.read(dim_name, dim_schema), [id_col]).isEmpty()
    daily = store.read("fct_job_performance_daily", FCT_DAILY)
    assert check_unique(daily, ["job_id", "location_id", "date"]).isEmpty()
    assert orphans(daily, fact, ["job_id"]).isEmpty()


def test_empty_pages_are_a_no_op(spark, tmp_path):
    """Empty pages pass the gate as 'no rows'; gold still publishes (empty)."""
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    land_lookups(landing)
    land_a(landing, "2025-06-02", [[]])
    land_b(landing, "2025-06-02", [[]])
    gold = run_day(spark, landing, wh, "2025-06-02")
    assert gold["mv_job_performance_summary"].count() == 0
    assert gold["vw_job_function"].count() == 0
    assert TableStore(spark, wh).read("fct_jobs", FCT_JOBS).count() == 0


def test_incremental_summaries_equal_full_refresh(spark, tmp_path):
    """K8: summaries kept from day changes equal a full refresh, re-runs and NULLs included."""
    import random
    from listingmart.plans.gold import (first_last_application_days, job_performance_summary,
                                        refresh_summaries)
    from listingmart.schemas import FCT_DAILY, FCT_JOBS
    rnd = random.Random(3)
    store = TableStore(spark, str(tmp_path))
    jobs = [f"j{i}" for i in range(12)]
    fact = spark.createDataFrame([(j, None, None, None, None, dt.datetime(2025, 5, 28), None, None, None, None,
                                   None, None, None, None) for j in jobs], FCT_JOBS)
    store.replace("fct_jobs", fact)

    def day_rows(d):
        out = []
        for j in jobs:
            for loc in (1, 2):
                if rnd.random() < 0.6:
                    a = None if rnd.random() < 0.2 else rnd.choice([0, 0, 1, 2])
                    v = None if rnd.random() < 0.2 else rnd.randint(0, 9)
                    out.append((j, loc, d, a, v, 3))
        return spark.createDataFrame(out, FCT_DAILY)

    plan = [dt.date(2025, 6, d) for d in (1, 2, 3, 2, 4, 4, 1)]  # with re-runs of past days
    for i, d in enumerate(plan):
        old = store.read("fct_job_performance_daily", FCT_DAILY).where(F.col("date") == d)
        from listingmart.session import cut_lineage
        old = cut_lineage(old)
        new_rows = day_rows(d)
        # a re-run upserts: keep the old keys, update metrics, add new keys
        from listingmart.operators.merge import upsert
        merged = upsert(old, new_rows, ["job_id", "location_id", "date"], ["nb_applicants", "nb_views"])
        store.overwrite_partitions("fct_job_performance_daily", merged, "date")
        new = store.read("fct_job_performance_daily", FCT_DAILY).where(F.col("date") == d)
        got = refresh_summaries(store, (old, new, d) if i else None)
        daily = store.read("fct_job_performance_daily", FCT_DAILY)
        want_perf = sorted(tuple(r) for r in job_performance_summary(daily).collect())
        want_days = sorted(tuple(r) for r in first_last_application_days(daily, fact).collect())
        assert sorted(tuple(r) for r in got["mv_job_performance_summary"].collect()) == want_perf
        assert sorted(tuple(r) for r in got["mv_job_first_last_application_days"].collect()) == want_days


def test_landed_page_report_and_helpers(spark, tmp_path):
    """S12 on landed files (announced totals vs rows read), F29, the value-map table."""
    from listingmart.functions.dates import truncate_day
    from listingmart.operators.checks import page_report
    from listingmart.sources.listings import PAGE_A, PAGE_B, page_totals_a, page_totals_b, read_pages
    from listingmart.sources.lookups import value_map_table
    landing = str(tmp_path / "landing")
    land_a(landing, "2025-06-02", _a_pages())
    land_b(landing, "2025-06-02", _b_pages())
    ra = page_report(page_totals_a(read_pages(spark, f"{landing}/a/2025-06-02/pages", PAGE_A)), "announced_total",
                     "rows").first()
    assert (ra.announced_total, ra.pages_read, ra.rows_read, ra.complete) == (3, 2, 3, True)
    rb = page_report(page_totals_b(read_pages(spark, f"{landing}/b/2025-06-02/pages", PAGE_B)), "announced_total",
                     "rows").first()
    assert (rb.rows_read, rb.complete) == (3, True)
    ts = spark.createDataFrame([(dt.datetime(2025, 6, 1, 17, 45),)], "t timestamp_ntz")
    assert ts.select(truncate_day("t")).first()[0] == dt.datetime(2025, 6, 1)
    vm = value_map_table(spark)
    assert vm.count() == 60 and vm.where("source = 'B'").count() == 34


def test_command_line_run(spark, tmp_path, capsys):
    from listingmart.plans.daily_run import main
    landing = str(tmp_path / "landing")
    land_lookups(landing)
    land_b(landing, "2025-06-02", [[b_listing("Juriste", "Gamma", "2025-06-01T08:00:00")]])
    main(["--landing", landing, "--warehouse", str(tmp_path / "wh"), "--ds", "2025-06-02", "--audit"])
    out = capsys.readouterr().out
    assert "mv_job_performance_summary" in out


def test_rescraped_jobs_leave_no_stale_partition(spark, tmp_path):
    """Staging A is keyed by job_id only; a partition whose jobs all moved is removed."""
    from listingmart.plans.snapshot import stage_a
    store = TableStore(spark, str(tmp_path))

    def batch(day, ids, positions):
        rows = [(f"job-{i}", f"T{i}", "Acme", ["Alger"], None, positions, dt.datetime(2025, 6, 1), "S", None, None,
                 None, None, False, "Sur site", day, "Emploitic") for i in ids]
        return spark.createDataFrame(rows, STG_A)

    stage_a(store, batch(dt.date(2025, 6, 1), [1, 2], 1))
    stage_a(store, batch(dt.date(2025, 6, 2), [3], 1))
    stage_a(store, batch(dt.date(2025, 6, 3), [1, 2, 3], 5))  # every job re-scraped
    rows = store.read("stg_emploitic", STG_A).collect()
    assert sorted((r.job_id, r.date_scraped.day, r.positions) for r in rows) == [
        ("job-1", 3, 5), ("job-2", 3, 5), ("job-3", 3, 5)]


def test_source_a_only_day(spark, tmp_path):
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    land_lookups(landing)
    land_a(landing, "2025-06-02", _a_pages())
    gold = run_day(spark, landing, wh, "2025-06-02")
    store = TableStore(spark, wh)
    assert store.read("fct_jobs", FCT_JOBS).count() == 2
    assert gold["mv_job_performance_summary"].count() == 0  # only B has counters (T22)
    assert gold["vw_job_contract_type"].count() == 2  # CDI, and NULL list -> unknown member (P7)
    from listingmart.plans.audit import star_report
    assert all(r.violations == 0 for r in star_report(store).collect())
